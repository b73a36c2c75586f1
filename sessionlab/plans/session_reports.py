"""Reports on the sessions themselves: length, diversity, anomalies, features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from sessionlab.operators.percentiles import percentiles
from sessionlab.functions import buckets
from sessionlab.functions.buckets import Rules
from sessionlab.functions.numbers import correlation, mean, rounded, rounded_avg
from sessionlab.operators.shares import with_percentage

# Rule limits.
LONG_SESSION_HOURS = 6
ANOMALY_HOURS = 12
ANOMALY_TRACKS = 500
REPEAT_LOOP_TRACKS = 20
EXTREME_REPETITION_RATIO = 0.1
DIVERSE_SESSION_TRACKS = 10
DURATION_PERCENTILES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def duration_buckets(
    sessions: DataFrame,
    rules: Rules = buckets.SESSION_DURATION,
    otherwise: str = buckets.SESSION_DURATION_ELSE,
) -> DataFrame:
    return (
        sessions.groupBy(buckets.at_most("durationMinutes", rules, otherwise).alias("durationCategory"))
        .agg(
            F.count("*").alias("sessionCount"),
            rounded_avg("durationMinutes", 2).alias("avgDurationMin"),
            rounded_avg("trackCount", 2).alias("avgTracks"),
        )
        .orderBy("sessionCount", "durationCategory")
    )


def top_duration_buckets(
    top: DataFrame,
    rules: Rules = buckets.TOP_SESSION_DURATION,
    otherwise: str = buckets.TOP_SESSION_DURATION_ELSE,
) -> DataFrame:
    groups = top.groupBy(
        buckets.below("durationMinutes", rules, otherwise).alias("durationCategory")
    ).agg(
        F.count("*").alias("sessionCount"),
        mean("durationMinutes").alias("avgDuration"),
        F.avg("trackCount").alias("avgTracks"),
    )
    return with_percentage(groups, "sessionCount").orderBy(F.desc("sessionCount"), "durationCategory")


def duration_percentiles(
    sessions: DataFrame,
    column: str = "durationMinutes",
    shares: tuple[float, ...] = DURATION_PERCENTILES,
) -> DataFrame:
    """Columns p10, p25, …, exact."""
    return percentiles(sessions, column, shares, [f"p{round(p * 100)}" for p in shares])


def describe(df: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of each column, one row per column."""
    counts = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                mean(c).alias("mean"),
                F.stddev(c).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return counts.select(F.inline(F.array(*columns)))


def simple_outliers(sessions: DataFrame, long_hours: float = LONG_SESSION_HOURS) -> DataFrame:
    single = F.count_if(F.col("trackCount") == 1)
    return sessions.agg(
        F.count("*").alias("totalSessions"),
        single.alias("singleTrackSessions"),
        F.try_divide(single * F.lit(100.0), F.count("*")).alias("singleTrackPct"),
        F.count_if(F.col("durationHours") > long_hours).alias("longSessions"),
    )


def longest_sessions(sessions: DataFrame, long_hours: float = LONG_SESSION_HOURS) -> DataFrame:
    return (
        sessions.filter(F.col("durationHours") > long_hours)
        .select("userId", "userSessionId", "durationHours", "trackCount", "sessionStart")
        .orderBy(F.desc("durationHours"), "userSessionId")
    )


def with_diversity(
    sessions: DataFrame,
    rules: Rules = buckets.DIVERSITY,
    otherwise: str = buckets.DIVERSITY_ELSE,
) -> DataFrame:
    """Add the share of distinct tracks, its category, and the repetitions per distinct track."""
    unique, count = F.col("uniqueTracks"), F.col("trackCount")
    return (
        sessions.withColumn("diversityRatio", rounded(unique / count, 3))
        .withColumn("diversityCategory", buckets.at_least("diversityRatio", rules, otherwise))
        .withColumn(
            "repetitionsPerTrack", rounded((count - unique) / F.greatest(unique, F.lit(1)), 2)
        )
    )


def diversity_summary(diverse: DataFrame) -> DataFrame:
    return (
        diverse.groupBy("diversityCategory")
        .agg(
            F.count("*").alias("sessionCount"),
            rounded_avg("trackCount", 1).alias("avgTracks"),
            rounded_avg("diversityRatio", 3).alias("avgDiversityRatio"),
        )
        .orderBy(F.desc("sessionCount"))
    )


def repetition_summary(diverse: DataFrame) -> DataFrame:
    return (
        diverse.groupBy("diversityCategory")
        .agg(
            rounded_avg("repetitionsPerTrack", 2).alias("avgRepetitions"),
            F.min("repetitionsPerTrack").alias("minRepetitions"),
            F.max("repetitionsPerTrack").alias("maxRepetitions"),
        )
        .orderBy(F.desc("avgRepetitions"))
    )


def extreme_repetition(
    diverse: DataFrame, min_tracks: int = REPEAT_LOOP_TRACKS, max_ratio: float = EXTREME_REPETITION_RATIO
) -> DataFrame:
    return (
        diverse.filter((F.col("trackCount") > min_tracks) & (F.col("diversityRatio") < max_ratio))
        .select("userSessionId", "userId", "trackCount", "uniqueTracks", "diversityRatio")
        .orderBy("diversityRatio", "userSessionId")
    )


def most_diverse(diverse: DataFrame, min_tracks: int = DIVERSE_SESSION_TRACKS) -> DataFrame:
    return (
        diverse.filter((F.col("diversityRatio") == 1.0) & (F.col("trackCount") > min_tracks))
        .select("userSessionId", "userId", "trackCount", "uniqueTracks")
        .orderBy(F.desc("trackCount"), "userSessionId")
    )


def with_anomaly(
    sessions: DataFrame,
    *,
    max_hours: float = ANOMALY_HOURS,
    max_tracks: int = ANOMALY_TRACKS,
    loop_tracks: int = REPEAT_LOOP_TRACKS,
    loop_max_diversity: float | None = None,
) -> DataFrame:
    """Sessions that look wrong, with the first ``anomaly`` that applies.

    ``loop_max_diversity`` makes the repeat-loop rule also ask for a low ``diversityRatio``.
    """
    minutes, tracks = F.col("durationMinutes"), F.col("trackCount")
    loop = tracks > loop_tracks
    if loop_max_diversity is not None:
        loop = loop & (F.col("diversityRatio") < loop_max_diversity)
    rules = [
        (F.col("durationHours") > max_hours, buckets.ANOMALY_LONG),
        (tracks > max_tracks, buckets.ANOMALY_MANY_TRACKS),
        ((minutes == 0) & (tracks > 1), buckets.ANOMALY_NO_DURATION),
        (loop, buckets.ANOMALY_LOOP),
    ]
    return sessions.withColumn("anomaly", buckets.first_match(rules, buckets.ANOMALY_ELSE)).filter(
        F.col("anomaly") != buckets.ANOMALY_ELSE
    )


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.groupBy("anomaly")
        .agg(F.count("*").alias("sessionCount"), F.count_distinct("userId").alias("affectedUsers"))
        .orderBy(F.desc("sessionCount"))
    )


def session_features(diverse: DataFrame) -> DataFrame:
    minutes = F.col("durationMinutes")
    per_minute = rounded(F.col("trackCount") / minutes.cast("double"), 3)
    pace = F.when(minutes > 0, per_minute).otherwise(F.lit(0).cast(DecimalType(18, 3)))
    return diverse.select(
        "userId",
        "userSessionId",
        "trackCount",
        "durationMinutes",
        "diversityRatio",
        pace.alias("tracksPerMinute"),
    )


def user_features(features: DataFrame) -> DataFrame:
    return features.groupBy("userId").agg(
        rounded_avg("trackCount", 2).alias("avgTracksPerSession"),
        rounded_avg("durationMinutes", 2).alias("avgDurationMinutes"),
        rounded_avg("diversityRatio", 3).alias("avgDiversityRatio"),
        rounded_avg("tracksPerMinute", 3).alias("avgTracksPerMinute"),
        F.count("*").alias("sessionCount"),
    )


def feature_correlations(users: DataFrame) -> DataFrame:
    return users.agg(
        correlation("avgTracksPerSession", "avgDurationMinutes").alias("tracksVsDuration"),
        correlation("avgTracksPerSession", "avgDiversityRatio").alias("tracksVsDiversity"),
    )


def correlation_matrix(users: DataFrame, columns: Sequence[str]) -> DataFrame:
    """leftFeature, rightFeature, users and correlation of every pair of columns, from one pass: the
    co-moments of all pairs are one aggregate, which combines before the shuffle. A pair counts the
    rows in which both are known; it is NULL where one side does not vary."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]

    def entry(a: str, b: str) -> Column:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        left, right = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
        spread = F.stddev_pop(left) * F.stddev_pop(right)
        return F.struct(
            F.lit(a).alias("leftFeature"),
            F.lit(b).alias("rightFeature"),
            F.count_if(both).alias("users"),
            F.try_divide(F.covar_pop(left, right), spread).alias("correlation"),
        )

    return users.agg(F.array(*[entry(a, b) for a, b in pairs]).alias("matrix")).select(F.inline("matrix"))


def with_behaviour(
    users: DataFrame,
    *,
    fast: float = 2.0,
    explorer: float = 0.8,
    repeater: float = 0.3,
    marathon: float = 120.0,
) -> DataFrame:
    rules = [
        (F.col("avgTracksPerMinute") > fast, buckets.BEHAVIOUR_FAST),
        (F.col("avgDiversityRatio") > explorer, buckets.BEHAVIOUR_EXPLORER),
        (F.col("avgDiversityRatio") < repeater, buckets.BEHAVIOUR_REPEATER),
        (F.col("avgDurationMinutes") > marathon, buckets.BEHAVIOUR_MARATHON),
    ]
    return users.withColumn("behaviorPattern", buckets.first_match(rules, buckets.BEHAVIOUR_ELSE))


def behaviour_patterns(labelled: DataFrame) -> DataFrame:
    return (
        labelled.groupBy("behaviorPattern")
        .agg(
            F.count("*").alias("userCount"),
            rounded_avg("sessionCount", 0).alias("avgSessions"),
            rounded_avg("avgTracksPerSession", 1).alias("avgTracks"),
        )
        .orderBy(F.desc("userCount"))
    )
