"""Reading, writing and laying out data."""

from pyspark.sql import functions as F

from sessionlab.catalog.inputs import GAP
from sessionlab.catalog.oracle import r6
from sessionlab.catalog.registry import query
from sessionlab.functions.times import DAY_NAMES
from sessionlab.operators import layout
from sessionlab.operators.ranking import top_songs_in_top_sessions
from sessionlab.plans.quality import metric_table, quality_counts
from sessionlab.schemas import METRIC
from sessionlab.sources import readers, writers
from sessionlab.sources.folded import read_folded

# Cores assumed where a result must not depend on the machine.
CORES = 8


def _raw_tsv(t) -> str:
    rows = t.raw_plays.select("userId", "timestamp", "artistId", "artistName", "trackId", "trackName")
    return writers.write_text_table(rows, t.scratch("events.tsv"))


@query(
    "scan_events_tsv",
    """SELECT userId, timestamp, artistId, artistName, trackId, nullif(trackName, '') AS trackName
       FROM raw_plays""",
)
def _(t):
    return readers.read_events(t.spark, _raw_tsv(t))


@query(
    "scan_events_typed",
    """SELECT userId, timestamp, artistId, artistName, trackId, nullif(trackName, '') AS trackName
       FROM parsed""",
)
def _(t):
    return readers.read_events_typed(t.spark, _raw_tsv(t))


@query(
    "scan_profiles",
    """SELECT userId, gender, CAST(age AS VARCHAR) AS age, nullif(country, '') AS country, signup
       FROM profiles""",
)
def _(t):
    path = writers.write_text_table(t.profiles, t.scratch("profiles.tsv"))
    return readers.read_profiles(t.spark, path).withColumn("age", F.col("age").cast("string"))


@query("scan_parquet", "SELECT * FROM events")
def _(t):
    return readers.read_parquet(t.spark, t.path("events"))


@query(
    "scan_parquet_merge",
    """SELECT userId, timestamp, trackName, CASE WHEN artistId IS NOT NULL THEN artistName END
              AS artistName FROM plays""",
)
def _(t):
    wide = t.plays.select("userId", "timestamp", "trackName", "artistName")
    known = F.col("artistId").isNotNull()
    with_artist = writers.write_parquet(
        t.plays.filter(known).select(wide.columns), t.scratch("part=wide")
    )
    without = writers.write_parquet(
        t.plays.filter(~known).select("userId", "timestamp", "trackName"), t.scratch("part=narrow")
    )
    # The two folders are read as one table; neither sits under a common partitioned root.
    return readers.read_parquet(t.spark, f"{with_artist}/*", f"{without}/*", merge_schema=True).select(
        wide.columns
    )


@query(
    "scan_mixed_types",
    """SELECT userId, timestamp, CAST(seq AS VARCHAR) AS seq,
              CASE WHEN seq % 3 = 2 THEN artistName END AS artistName FROM plays""",
)
def _(t):
    # One column as int, long and text, in folders written by different jobs.
    folder, part = t.scratch("mixed"), F.col("seq") % 3
    for kind, rest in (("int", 0), ("long", 1), ("string", 2)):
        rows = t.plays.filter(part == rest).withColumn("seq", F.col("seq").cast(kind))
        more = ["artistName"] if rest == 2 else []
        writers.write_parquet(rows.select("userId", "timestamp", "seq", *more), f"{folder}/{kind}")
    return read_folded(t.spark, folder, one_schema_per_folder=True)


@query(
    "scan_results_tsv",
    "SELECT rank, trackName, artistName, playCount FROM best_songs",
)
def _(t):
    ranked = top_songs_in_top_sessions(t.silver, gap_minutes=GAP)
    renamed = ranked.select(
        "rank",
        F.col("trackName").alias("track_name"),
        F.col("artistName").alias("artist_name"),
        F.col("playCount").alias("play_count"),
    )
    path = writers.write_single_tsv(renamed, t.scratch("songs.tsv"))
    names = {"trackName": "track_name", "artistName": "artist_name", "playCount": "play_count"}
    return readers.read_ranked_songs(t.spark, path, names, ["rank", *names])


@query(
    "inline_rows",
    f"""WITH days(dayOfWeek, dayName) AS (VALUES
        {', '.join(f"({i}, '{d}')" for i, d in enumerate(DAY_NAMES, 1))})
        SELECT dayName, plays FROM days JOIN (
          SELECT dayofweek(timestamp) + 1 AS dayOfWeek, count(*) AS plays FROM plays GROUP BY 1)
        USING (dayOfWeek)""",
)
def _(t):
    days = readers.inline_table(
        t.spark, enumerate(DAY_NAMES, start=1), "dayOfWeek int, dayName string"
    )
    counts = t.plays.groupBy(F.dayofweek("timestamp").alias("dayOfWeek")).agg(
        F.count("*").alias("plays")
    )
    return counts.join(days, "dayOfWeek").select("dayName", "plays")


@query("sink_parquet_roundtrip", "SELECT * FROM silver")
def _(t):
    path = writers.write_parquet(layout.by_user(t.silver), t.scratch("silver.parquet"))
    return readers.read_parquet(t.spark, path)


@query(
    "sink_partitioned_roundtrip",
    "SELECT substr(userId, 6) AS userId, timestamp, trackKey, seq FROM id_plays",
)
def _(t):
    # Ids of digits with leading zeros, which must not come back as numbers.
    rows = t.id_plays.select(
        F.substring("userId", 6, 100).alias("userId"), "timestamp", "trackKey", "seq"
    )
    path = writers.write_user_partitioned(rows, t.scratch("curated"))
    return readers.read_parquet(t.spark, path, schema=rows.schema)


@query(
    "sink_hashed_folders_roundtrip",
    "SELECT substr(userId, 6) AS userId, timestamp, trackKey, seq FROM id_plays",
)
def _(t):
    rows = t.id_plays.select(
        F.substring("userId", 6, 100).alias("userId"), "timestamp", "trackKey", "seq"
    )
    path = writers.write_user_partitioned(rows, t.scratch("hashed"), folders=CORES)
    return readers.read_parquet(t.spark, path).select(rows.columns)


@query("sink_tsv_roundtrip", "SELECT * FROM best_songs")
def _(t):
    ranked = top_songs_in_top_sessions(t.silver, gap_minutes=GAP)
    path = writers.write_single_tsv(ranked, t.scratch("top_songs.tsv"))
    return readers.read_ranked_songs(t.spark, path)


METRICS_SQL = """
counts AS (SELECT count(*) AS r, count(*) FILTER (ok) AS v,
                  count(*) FILTER (ok AND coalesce(trackId, '') = '') AS m
           FROM (SELECT trackId, coalesce(timestamp IS NOT NULL
                   AND trim(regexp_replace(userId, '[[:cntrl:]]', '', 'g')) <> ''
                   AND trim(regexp_replace(artistName, '[[:cntrl:]]', '', 'g')) <> ''
                   AND trim(regexp_replace(trackName, '[[:cntrl:]]', '', 'g')) <> '', false) AS ok
                 FROM parsed))"""

METRIC_ROWS = f"""WITH {METRICS_SQL}
SELECT 'rows_read' AS metric, CAST(r AS VARCHAR) AS value FROM counts
UNION ALL SELECT 'rows_valid', CAST(v AS VARCHAR) FROM counts
UNION ALL SELECT 'rows_dropped', CAST(r - v AS VARCHAR) FROM counts
UNION ALL SELECT 'missing_track_id', CAST(m AS VARCHAR) FROM counts
UNION ALL SELECT 'pct_missing_track_id', format('{{:.2f}}%', m * 100.0::DOUBLE / v) FROM counts"""


@query("sink_metrics_csv", METRIC_ROWS)
def _(t):
    table = metric_table(quality_counts(t.raw_plays))
    path = writers.write_metrics_csv(table, t.scratch("metrics"))
    return t.spark.read.schema(METRIC).option("header", "true").csv(path)


@query(
    "layout_by_user",
    "SELECT userId, count(*) AS plays, CAST(1 AS BIGINT) AS partitions FROM silver GROUP BY userId",
)
def _(t):
    placed = layout.by_user(t.silver, CORES).withColumn("partitionId", F.spark_partition_id())
    return placed.groupBy("userId").agg(
        F.count("*").alias("plays"), F.count_distinct("partitionId").alias("partitions")
    )


@query(
    "layout_round_robin",
    f"SELECT count(*) AS plays, CAST({CORES} AS BIGINT) AS partitions FROM plays",
)
def _(t):
    placed = layout.round_robin(t.plays, CORES).withColumn("partitionId", F.spark_partition_id())
    return placed.agg(
        F.count("*").alias("plays"), F.count_distinct("partitionId").alias("partitions")
    )


@query(
    "layout_coalesce",
    "SELECT count(*) AS plays, CAST(4 AS BIGINT) AS partitions FROM plays",
)
def _(t):
    merged = layout.fewer_partitions(layout.round_robin(t.plays, CORES), 4)
    return merged.withColumn("partitionId", F.spark_partition_id()).agg(
        F.count("*").alias("plays"), F.count_distinct("partitionId").alias("partitions")
    )


@query(
    "layout_partition_advice",
    f"""SELECT users, least(greatest({2 * CORES}, users // 70, 4), 32) AS partitions
        FROM (SELECT count(DISTINCT userId) AS users FROM plays)""",
)
def _(t):
    return layout.user_count(t.plays).withColumn(
        "partitions", layout.partition_advice(F.col("users"), CORES)
    )


@query(
    "layout_repartition_decision",
    """SELECT *, 20 / partitions < 0.6 OR 20 / partitions > 1.8 AS repartition,
              users / partitions BETWEEN 30 AND 100 AS balanced
       FROM (SELECT artistName, users, least(greatest(4, users // 70, 4), 32) AS partitions
             FROM (SELECT artistName, count(DISTINCT userId) AS users FROM plays
                   GROUP BY artistName))""",
)
def _(t):
    users = t.plays.groupBy("artistName").agg(F.count_distinct("userId").alias("users"))
    return (
        users.withColumn("partitions", layout.partition_advice(F.col("users"), cores=2))
        .withColumn("repartition", layout.should_repartition(20, F.col("partitions")))
        .withColumn("balanced", layout.is_balanced(F.col("users"), F.col("partitions")))
    )


@query(
    "layout_balance_report",
    f"""SELECT count(*) AS rows, count(DISTINCT userId) AS users, CAST(0 AS BIGINT) AS splitUsers,
               true AS withinPartitions, true AS flagsAgree FROM silver""",
)
def _(t):
    # Which partition a user lies in is Spark's affair; what must hold of any placing is not.
    placed = layout.by_user(t.silver, CORES)
    report = layout.balance_report(placed)
    agree = F.col("balanced") == F.col("users").between(*layout.BALANCED_USERS)
    flags = report.agg(F.coalesce(F.bool_and(agree), F.lit(True))).scalar()
    return layout.balance_facts(placed).select(
        "rows",
        "users",
        "splitUsers",
        (F.col("partitions") <= CORES).alias("withinPartitions"),
        flags.alias("flagsAgree"),
    )


@query("user_count", "SELECT count(DISTINCT userId) AS users FROM silver")
def _(t):
    return layout.user_count(t.silver)


@query(
    "cached_reuse",
    f"""SELECT artistName, count(*) AS plays, count(DISTINCT userId) AS users,
               {r6('count(*) * 100.0 / (SELECT count(*) FROM plays)')} AS pct
        FROM plays GROUP BY artistName""",
)
def _(t):
    # The reduced frame is what two reports read, so that is what is worth keeping. The reports
    # are stored inside the block, because the frame is released at its end.
    reduced = t.plays.groupBy("userId", "artistName").agg(F.count("*").alias("plays"))
    with layout.cached(reduced) as per_user:
        total = per_user.agg(F.sum("plays")).scalar()
        shares = (
            per_user.groupBy("artistName")
            .agg(F.sum("plays").alias("plays"), F.count("*").alias("users"))
            .withColumn("pct", F.col("plays") * F.lit(100.0) / total)
        )
        path = writers.write_parquet(shares, t.scratch("shares"))
    return readers.read_parquet(t.spark, path)


@query(
    "sample_bernoulli",
    "SELECT CAST(0 AS BIGINT) AS unknown, CAST(0 AS BIGINT) AS repeated, true AS shareAsAsked FROM plays LIMIT 1",
)
def _(t):
    # Which rows are drawn is Spark's affair; that they are plays, once each, and as many as asked
    # (within five standard deviations) is checked against all plays.
    sample = layout.bernoulli_sample(t.plays, 0.05, seed=42).select("seq", F.lit(1).alias("drawn"))
    per_play = t.plays.select("seq", F.lit(0).alias("drawn")).unionByName(sample).groupBy("seq").agg(
        F.count_if(F.col("drawn") == 0).alias("plays"), F.sum("drawn").alias("drawn")
    )
    expected = F.sum("plays") * 0.05
    return per_play.agg(
        F.count_if(F.col("plays") == 0).alias("unknown"),
        F.count_if(F.col("drawn") > 1).alias("repeated"),
        (F.abs(F.sum("drawn") - expected) <= 5 * F.sqrt(expected * 0.95)).alias("shareAsAsked"),
    )


@query(
    "sample_hash",
    """SELECT userId, timestamp, trackName, seq FROM plays
       WHERE CAST(concat('0x', substr(md5(concat_ws('|', userId, seq)), 1, 8)) AS BIGINT)
             < 214748364""",
)
def _(t):
    return layout.hash_sample(t.plays, 0.05, "userId", "seq").select(
        "userId", "timestamp", "trackName", "seq"
    )
