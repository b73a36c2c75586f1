"""The driver tables seen as a play log with user profiles."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.operators.cleaning import clean_events, normalize_events
from sessionlab.operators.sessions import sessionize, sessionize_with_tracks
from sessionlab.plans.users import user_activity, user_session_stats, user_types
from sessionlab.session import scratch_path, use_utc

# The plays lie hours apart (median 7 h), so most queries allow a gap of six hours; with the
# default of 20 minutes nearly every play is a session of its own.
GAP = 360

# Thresholds that fit the number of plays and sessions per user in these tables.
PLAY_RULES = ((85, "Power User"), (75, "Active User"), (65, "Regular User"))
TYPE_RULES = (
    (42, 1.9, "Power User"),
    (40, 1.8, "Heavy Listener"),
    (38, 1.7, "Regular User"),
    (36, 1.6, "Casual Listener"),
    (30, 0, "Light User"),
)
RETENTION_RULES = ((36, "High Risk"), (40, "Medium Risk"))
REFERENCE_USER = "user_000001"


class Inputs:
    """Lazily built frames for one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = use_utc(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    @cached_property
    def plays(self) -> DataFrame:
        """Valid plays with identifiers, whole seconds, and the event number as ``seq``.

        The events lie in one month. Users are therefore moved by 0, 200, 400 or 600 days, which
        keeps the gaps between a user's plays, and some artist ids are malformed.
        """
        kind, number, digest = F.col("event_type"), F.col("number"), F.col("digest")
        uuid = F.concat_ws(
            "-",
            F.substring(digest, 1, 8),
            F.substring(digest, 9, 4),
            F.substring(digest, 13, 4),
            F.substring(digest, 17, 4),
            F.substring(digest, 21, 12),
        )
        # Two steps, so that the JSON value and the digest are computed once per row.
        parsed = self.table("events").withColumns(
            {"number": F.get_json_object("props", "$.k"), "digest": F.md5(kind)}
        )
        return parsed.select(
            F.concat(F.lit("user_"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("userId"),
            (
                F.date_trunc("SECOND", "ts").cast("timestamp_ntz")
                + F.make_dt_interval(days=(F.col("user_id") % 4 * 200).cast("int"))
            ).alias("timestamp"),
            F.when(F.col("event_id") % 53 == 0, F.substring(uuid, 2, 100))
            .when(kind != "error", uuid)
            .alias("artistId"),
            F.concat(F.lit("artist "), kind).alias("artistName"),
            F.when(
                number.cast("int") % 3 != 0, F.concat(F.lit("t-"), F.md5(F.concat(kind, number)))
            ).alias("trackId"),
            F.concat(F.lit("track "), number).alias("trackName"),
            F.col("event_id").alias("seq"),
        )

    @cached_property
    def raw_plays(self) -> DataFrame:
        """Plays as they arrive: text times, some of them bad, missing and untidy names, copies."""
        seq = F.col("seq")
        # The untidy values are built once per play, inside the array that is exploded. As plain
        # columns they would be computed again in every filter that Spark pushes towards the scan.
        untidy = F.struct(
            F.when(seq % 97 == 0, "not-a-date")
            .otherwise(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .alias("timestamp"),
            F.when(seq % 89 != 0, F.col("artistName")).alias("artistName"),
            F.when(seq % 83 == 0, "")
            .when(seq % 79 == 0, F.concat(F.char(F.lit(1)), "trackName", F.lit(" ")))
            .otherwise(F.col("trackName"))
            .alias("trackName"),
        )
        copies = F.array_repeat(untidy, F.when(seq % 10 == 0, 2).otherwise(1))
        return self.plays.select(
            "userId", "artistId", "trackId", "seq", F.explode(copies).alias("untidy")
        ).select(
            "userId",
            "untidy.timestamp",
            "artistId",
            "untidy.artistName",
            "trackId",
            "untidy.trackName",
            "seq",
        )

    @cached_property
    def profiles(self) -> DataFrame:
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        country = (
            F.when(key % 7 == 0, "")
            .when(nation % 4 == 0, F.col("n_name"))
            .otherwise(F.concat(F.lit("Country "), F.char(nation + 65)))
        )
        return (
            self.table("customer")
            .join(self.table("nation"), nation == F.col("n_nationkey"))
            .select(
                F.concat(F.lit("user_"), F.lpad(key.cast("string"), 6, "0")).alias("userId"),
                F.when(key % 3 == 0, "m").when(key % 3 == 1, "f").alias("gender"),
                F.when(key % 5 != 0, F.floor(F.col("c_acctbal") / 100).cast("int")).alias("age"),
                country.alias("country"),
                F.lit(None).cast("string").alias("signup"),
            )
        )

    @cached_property
    def silver(self) -> DataFrame:
        """Cleaned plays, keyed by name."""
        return clean_events(self.raw_plays)

    @cached_property
    def id_plays(self) -> DataFrame:
        """Sanitized plays with all identifiers, keyed by id."""
        return normalize_events(self.raw_plays)

    def sessions(self, gap_minutes: int = GAP) -> DataFrame:
        return sessionize(self.silver, gap_minutes)

    @cached_property
    def track_sessions(self) -> DataFrame:
        return sessionize_with_tracks(self.silver, GAP)

    @cached_property
    def activity(self) -> DataFrame:
        return user_activity(self.id_plays)

    @cached_property
    def user_stats(self) -> DataFrame:
        return user_session_stats(self.sessions())

    @cached_property
    def typed_users(self) -> DataFrame:
        return user_types(self.user_stats, TYPE_RULES)
