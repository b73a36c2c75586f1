"""Row rules, projections and scalar functions."""

import datetime as dt

from pyspark.sql import functions as F

from sessionlab.catalog.oracle import cases, r6, rd
from sessionlab.catalog.registry import query
from sessionlab.functions import buckets, keys
from sessionlab.functions.numbers import rounded
from sessionlab.functions.text import sanitize
from sessionlab.functions.times import seconds
from sessionlab.operators import cleaning
from sessionlab.plans import quality

RAW = ("userId", "timestamp", "artistName", "trackName", "seq")


@query(
    "filter_required",
    """SELECT userId, timestamp, artistName, trackName, seq FROM raw_plays
       WHERE userId IS NOT NULL AND timestamp IS NOT NULL AND artistName IS NOT NULL
         AND trackName IS NOT NULL""",
)
def _(t):
    return cleaning.require_fields(t.raw_plays).select(*RAW)


@query("parse_timestamp", "SELECT userId, timestamp, seq FROM parsed WHERE timestamp IS NOT NULL")
def _(t):
    return cleaning.parse_times(t.raw_plays).select("userId", "timestamp", "seq")


@query(
    "invalid_ts_count",
    """SELECT count(*) AS rowsRead, count(*) FILTER (timestamp IS NULL) AS invalidTimes,
              count(timestamp) AS validTimes FROM parsed""",
)
def _(t):
    return quality.invalid_times(t.raw_plays)


@query(
    "dedup_plays",
    """SELECT DISTINCT userId, timestamp, artistName, trackName,
              artistName || ' - ' || trackName AS trackKey
       FROM parsed WHERE timestamp IS NOT NULL AND artistName IS NOT NULL""",
)
def _(t):
    valid = cleaning.parse_times(cleaning.require_fields(t.raw_plays))
    return cleaning.drop_duplicate_plays(valid)


@query(
    "filter_nonempty",
    """SELECT userId, timestamp, artistName, trackName, seq FROM raw_plays
       WHERE artistName <> '' AND trackName <> ''""",
)
def _(t):
    return cleaning.require_text(t.raw_plays).select(*RAW)


@query(
    "project_silver",
    """SELECT userId AS user_id, timestamp AS ts, artistName AS artist_name,
              trackName AS track_name FROM plays""",
)
def _(t):
    return t.plays.drop("artistId", "trackId", "seq").toDF("user_id", "ts", "artist_name", "track_name")


@query("track_key_name", "SELECT seq, artistName || ' - ' || trackName AS trackKey FROM raw_plays")
def _(t):
    return t.raw_plays.select("seq", keys.name_key().alias("trackKey"))


@query(
    "track_key_mbid",
    """SELECT seq, CASE WHEN trackId <> '' THEN trackId
                        ELSE concat(coalesce(artistName, '?'), ' — ', coalesce(trackName, '?'))
                   END AS trackKey FROM raw_plays""",
)
def _(t):
    return t.raw_plays.select("seq", keys.mbid_key().alias("trackKey"))


@query(
    "sanitize_strings",
    """SELECT seq, trackName AS before,
              trim(regexp_replace(trackName, '[[:cntrl:]]', '', 'g')) AS after FROM raw_plays""",
)
def _(t):
    return t.raw_plays.select("seq", F.col("trackName").alias("before"), sanitize("trackName").alias("after"))


@query("clean_events", "SELECT * FROM silver")
def _(t):
    return t.silver


@query(
    "filter_in",
    """SELECT seq, userId, artistName FROM plays WHERE artistName IN ('artist click', 'artist view')""",
)
def _(t):
    return t.plays.filter(F.col("artistName").isin("artist click", "artist view")).select(
        "seq", "userId", "artistName"
    )


@query(
    "filter_range",
    """SELECT seq, userId, timestamp FROM plays
       WHERE timestamp >= TIMESTAMP '2024-01-08' AND timestamp < TIMESTAMP '2024-01-15'
         AND artistName <> 'artist error'""",
)
def _(t):
    start, end = dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 15)
    time = F.col("timestamp")
    return t.plays.filter(
        (time >= F.lit(start).cast("timestamp_ntz"))
        & (time < F.lit(end).cast("timestamp_ntz"))
        & (F.col("artistName") != "artist error")
    ).select("seq", "userId", "timestamp")


@query(
    "bucket_case",
    f"""SELECT userId, totalPlays, {cases([('totalPlays >= 85', 'Power User'),
        ('totalPlays >= 75', 'Active User'), ('totalPlays >= 65', 'Regular User')], 'Casual User')}
        AS userSegment FROM activity""",
)
def _(t):
    rules = ((85, "Power User"), (75, "Active User"), (65, "Regular User"))
    return t.activity.select(
        "userId",
        "totalPlays",
        buckets.at_least("totalPlays", rules, buckets.PLAY_SEGMENT_ELSE).alias("userSegment"),
    )


@query(
    "fn_date_parts",
    """SELECT seq, year(timestamp) AS year, month(timestamp) AS month, hour(timestamp) AS hour,
              dayofweek(timestamp) + 1 AS dayOfWeek FROM plays""",
)
def _(t):
    time = F.col("timestamp")
    return t.plays.select(
        "seq",
        F.year(time).alias("year"),
        F.month(time).alias("month"),
        F.hour(time).alias("hour"),
        F.dayofweek(time).alias("dayOfWeek"),
    )


@query("fn_year_month", "SELECT seq, strftime(timestamp, '%Y-%m') AS yearMonth FROM plays")
def _(t):
    return t.plays.select("seq", F.date_format("timestamp", "yyyy-MM").alias("yearMonth"))


@query(
    "fn_date_diff",
    """SELECT userId, strftime(min(timestamp), '%Y-%m-%d') AS firstDay,
              date_diff('day', CAST(min(timestamp) AS DATE), CAST(max(timestamp) AS DATE)) AS days
       FROM plays GROUP BY userId""",
)
def _(t):
    bounds = t.plays.groupBy("userId").agg(
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )
    return bounds.select(
        "userId",
        F.to_date("first").cast("string").alias("firstDay"),
        F.datediff("last", "first").alias("days"),
    )


@query("fn_epoch", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epochSeconds FROM events")
def _(t):
    return t.table("events").select("event_id", seconds("ts").alias("epochSeconds"))


@query(
    "fn_concat",
    """SELECT seq, concat(coalesce(artistName, '?'), '/', coalesce(trackName, '?')) AS path,
              concat_ws(', ', artistName, trackName) AS listed FROM raw_plays""",
)
def _(t):
    artist, track = (F.coalesce(F.col(c), F.lit("?")) for c in ("artistName", "trackName"))
    return t.raw_plays.select(
        "seq",
        F.concat(artist, F.lit("/"), track).alias("path"),
        F.concat_ws(", ", "artistName", "trackName").alias("listed"),
    )


@query(
    "fn_string",
    """SELECT seq, length(trackName) AS nameLength, trim(trackName) AS trimmed,
              upper(trackName) AS capitals FROM raw_plays WHERE trackName IS NOT NULL""",
)
def _(t):
    name = F.col("trackName")
    return t.raw_plays.filter(name.isNotNull()).select(
        "seq",
        F.length(name).alias("nameLength"),
        F.trim(name).alias("trimmed"),
        F.upper(name).alias("capitals"),
    )


@query(
    "fn_mbid_valid",
    """SELECT seq, regexp_matches(artistId,
         '^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$') AS validArtistId,
         regexp_matches(trackName, '[0-9]') AS hasDigit
       FROM plays WHERE artistId IS NOT NULL""",
)
def _(t):
    return t.plays.filter(F.col("artistId").isNotNull()).select(
        "seq", keys.is_mbid("artistId").alias("validArtistId"), F.col("trackName").rlike("[0-9]").alias("hasDigit")
    )


@query(
    "fn_round_div",
    f"""SELECT userId, {rd('uniqueTracks / totalPlays', 3)} AS ratio,
               {r6('totalPlays / nullif(listeningSpanDays - 29, 0)')} AS guarded,
               abs(totalPlays - 67) AS distance
        FROM activity""",
)
def _(t):
    return t.activity.select(
        "userId",
        rounded(F.col("uniqueTracks") / F.col("totalPlays"), 3).alias("ratio"),
        F.try_divide(F.col("totalPlays"), F.col("listeningSpanDays") - 29).alias("guarded"),
        F.abs(F.col("totalPlays") - 67).alias("distance"),
    )


@query(
    "null_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER ("{c}" IS NULL) AS nulls,
            count(*) FILTER ({'false' if c == 'seq' else f'"{c}" = ' + "''"}) AS empty,
            count(*) AS rows FROM raw_plays"""
        for c in ("userId", "timestamp", "artistId", "artistName", "trackId", "trackName", "seq")
    ),
)
def _(t):
    return quality.null_profile(t.raw_plays)
