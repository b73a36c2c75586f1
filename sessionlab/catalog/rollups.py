"""Reports from stored sketches.

Sketches are estimates, so these queries return the exact figures and whether the estimates lie
within the stated error of them.
"""

from pyspark.sql import functions as F

from sessionlab.catalog.registry import query
from sessionlab.operators import sketches
from sessionlab.plans import rollups

SHARES = (0.1, 0.5, 0.9)
# Three times the error that holds in 99 of 100 cases.
RANK_ERROR = 3 * sketches.rank_error()


def stored_artists(t):
    """Daily sketches of the plays in two batches: the even and the odd plays."""
    path = t.scratch("daily_artists")
    for batch in (0, 1):
        plays = t.id_plays.filter(F.col("seq") % 2 == batch)
        rollups.store_daily(rollups.daily_artists(plays), path, batch)
    return rollups.read_daily(t.spark, path)


def close(estimate, exact):
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(
        F.col(exact) * sketches.count_error(), F.lit(1)
    )


DISTINCT = "count(DISTINCT userId) AS exactUsers, count(DISTINCT trackKey) AS exactTracks"


def _checked(report, exact, keys):
    return report.join(exact, keys).select(
        *keys,
        "exactUsers",
        "exactTracks",
        close("users", "exactUsers").alias("usersClose"),
        close("tracks", "exactTracks").alias("tracksClose"),
    )


def _exact(plays, *keys):
    return plays.groupBy(*keys).agg(
        F.count_distinct("userId").alias("exactUsers"), F.count_distinct("trackKey").alias("exactTracks")
    )


@query(
    "sketched_users_by_month",
    f"""SELECT CAST(date_trunc('month', timestamp) AS DATE) AS month, {DISTINCT}, true AS usersClose,
               true AS tracksClose FROM id_plays GROUP BY 1""",
)
def _(t):
    report = rollups.distinct_report(rollups.by_month(stored_artists(t)))
    return _checked(report, _exact(t.id_plays, F.trunc("timestamp", "month").alias("month")), ["month"])


@query(
    "sketched_users_by_year_and_artist",
    f"""SELECT CAST(date_trunc('year', timestamp) AS DATE) AS year, artistName, {DISTINCT},
               true AS usersClose, true AS tracksClose FROM id_plays GROUP BY 1, 2""",
)
def _(t):
    months = rollups.by_month(stored_artists(t), ["artistName"])
    report = rollups.distinct_report(rollups.by_year(months, ["artistName"]))
    exact = _exact(t.id_plays, F.trunc("timestamp", "year").alias("year"), "artistName")
    return _checked(report, exact, ["year", "artistName"])


@query(
    "sketched_session_quantiles",
    """SELECT month, share, count(*) AS n, true AS isClose
       FROM (SELECT CAST(date_trunc('month', sessionStart) AS DATE) AS month FROM sessions),
            (SELECT unnest([0.1, 0.5, 0.9])::DOUBLE AS share)
       GROUP BY month, share""",
)
def _(t):
    sessions = t.sessions()
    path = rollups.store_daily(rollups.daily_sessions(sessions), t.scratch("daily_sessions"), 0)
    merged = rollups.by_month(t.spark.read.parquet(path))
    report = rollups.quantile_report(merged, "minutes", SHARES)
    own = sessions.select(F.trunc("sessionStart", "month").alias("month"), "durationMinutes")
    # The returned value's true rank: between the share of smaller and of no larger values.
    smaller = F.avg((F.col("durationMinutes") < F.col("value")).cast("int"))
    up_to = F.avg((F.col("durationMinutes") <= F.col("value")).cast("int"))
    ranks = (
        report.join(own, "month")
        .groupBy("month", "share", "n")
        .agg(smaller.alias("smaller"), up_to.alias("upTo"))
    )
    is_close = (F.col("share") >= F.col("smaller") - RANK_ERROR) & (F.col("share") <= F.col("upTo") + RANK_ERROR)
    return ranks.select("month", "share", "n", is_close.alias("isClose"))
