"""Daily sketches of plays and sessions, and reports that merge them.

The finest level is stored: a day and artist, or a day. Months, years and totals merge stored rows
in levels and read no plays. New plays add rows under a batch of their own; a day that several
batches touch is merged like any other group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.operators import sketches
from sessionlab.operators.sketches import HLL_LG_K, KLL_K
from sessionlab.sources.writers import write_parquet

SHARES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def daily_artists(plays: DataFrame, *, k: int = KLL_K, lg_k: int = HLL_LG_K) -> DataFrame:
    """Per day and artist: ``n`` user-days, the quantiles of a user's plays on that day, and the
    distinct users and tracks. Plays are reduced to one row per user, day, artist and track first."""
    by_track = plays.groupBy(
        F.to_date("timestamp").alias("day"), "artistName", "userId", "trackKey"
    ).agg(F.count("*").alias("plays"))
    tracks = sketches.build(by_track, ["day", "artistName"], distinct={"tracks": "trackKey"}, lg_k=lg_k)
    by_user = by_track.groupBy("day", "artistName", "userId").agg(F.sum("plays").alias("plays"))
    users = sketches.build(
        by_user, ["day", "artistName"], {"plays": "plays"}, {"users": "userId"}, k=k, lg_k=lg_k
    )
    return users.join(tracks.drop("n"), ["day", "artistName"])


def daily_sessions(sessions: DataFrame, *, k: int = KLL_K, lg_k: int = HLL_LG_K) -> DataFrame:
    """Per day on which sessions start: ``n`` sessions, the quantiles of their length in minutes and
    in tracks, and the distinct users."""
    return sketches.build(
        sessions.withColumn("day", F.to_date("sessionStart")),
        ["day"],
        {"minutes": "durationMinutes", "tracks": "trackCount"},
        {"users": "userId"},
        k=k,
        lg_k=lg_k,
    )


def store_daily(daily: DataFrame, path: str, batch: int) -> str:
    """Store the sketches of a batch; a batch that is written again replaces itself."""
    return write_parquet(daily, f"{path.rstrip('/')}/batch={batch}")


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")


def by_month(daily: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    month = F.trunc("day", "month").alias("month")
    return sketches.merge(daily, [month, *groups])


def by_year(monthly: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    year = F.trunc("month", "year").alias("year")
    return sketches.merge(monthly, [year, *groups])


def quantile_report(merged: DataFrame, name: str, shares: Sequence[float] = SHARES) -> DataFrame:
    """Long form: the group's columns, n, share, value."""
    groups = [c for c in merged.columns if c != "n" and not c.endswith(("_kll", "_hll"))]
    asked = F.array(*[F.lit(float(s)) for s in shares])
    pairs = F.arrays_zip(asked.alias("share"), sketches.quantiles(name, shares).alias("value"))
    return merged.select(*groups, "n", F.inline(pairs))


def distinct_report(merged: DataFrame) -> DataFrame:
    """The group's columns, n and one rounded count for every distinct-count sketch."""
    groups = [c for c in merged.columns if not c.endswith(("_kll", "_hll"))]
    names = [c.removesuffix("_hll") for c in merged.columns if c.endswith("_hll")]
    return merged.select(*groups, *[sketches.distinct_count(n).alias(n) for n in names])
