"""Per-user activity, segments and comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlab.functions import buckets
from sessionlab.functions.buckets import Rules
from sessionlab.functions.numbers import mean, rounded, rounded_avg
from sessionlab.operators.percentiles import percentile_of_each, percentiles

# Rule limits.
SIMILAR_TRACKS = 2.0
SIMILAR_SESSIONS_SHARE = 0.3
OUTLIER_FACTOR = 2.0


def listening(plays: DataFrame) -> DataFrame:
    """One row per user, artist and track. Reports with several distinct counts start here, so
    that the rows Spark multiplies for those counts are already reduced."""
    return plays.groupBy("userId", "artistName", "trackKey").agg(
        F.count("*").alias("plays"),
        F.min("timestamp").alias("firstPlay"),
        F.max("timestamp").alias("lastPlay"),
    )


def user_activity(plays: DataFrame) -> DataFrame:
    return (
        listening(plays)
        .groupBy("userId")
        .agg(
            F.sum("plays").alias("totalPlays"),
            F.count_distinct("trackKey").alias("uniqueTracks"),
            F.count_distinct("artistName").alias("uniqueArtists"),
            F.min("firstPlay").alias("firstPlay"),
            F.max("lastPlay").alias("lastPlay"),
        )
        .withColumn("listeningSpanDays", F.datediff("lastPlay", "firstPlay"))
    )


def activity_distribution(activity: DataFrame) -> DataFrame:
    plays = F.col("totalPlays")
    names = ["medianPlays", "p90Plays", "p95Plays"]
    limits = percentiles(activity, "totalPlays", (0.5, 0.9, 0.95), names)
    return activity.agg(
        F.count("*").alias("totalUsers"),
        F.avg(plays).alias("avgPlays"),
        F.stddev(plays).alias("stddevPlays"),
        F.min(plays).alias("minPlays"),
        F.max(plays).alias("maxPlays"),
    ).withColumns({name: limits.select(name).scalar() for name in names})


def play_segments(
    activity: DataFrame,
    rules: Rules = buckets.PLAY_SEGMENTS,
    otherwise: str = buckets.PLAY_SEGMENT_ELSE,
) -> DataFrame:
    return (
        activity.groupBy(buckets.at_least("totalPlays", rules, otherwise).alias("userSegment"))
        .agg(
            F.count("*").alias("userCount"),
            F.avg("totalPlays").alias("avgPlays"),
            F.sum("totalPlays").alias("totalSegmentPlays"),
        )
        .orderBy(F.desc("avgPlays"))
    )


def diversity(activity: DataFrame) -> DataFrame:
    return activity.agg(
        F.avg("uniqueTracks").alias("avgUniqueTracks"),
        F.avg("uniqueArtists").alias("avgUniqueArtists"),
        F.avg(F.col("uniqueTracks") / F.col("totalPlays")).alias("avgTrackDiversityRatio"),
        F.avg(F.col("uniqueArtists") / F.col("totalPlays")).alias("avgArtistDiversityRatio"),
    )


def repeats_per_user(plays: DataFrame) -> DataFrame:
    """Tracks a user played more than once: how many, and how often at most and on average."""
    return (
        plays.groupBy("userId", "trackKey")
        .agg(F.count("*").alias("playCount"))
        .filter(F.col("playCount") > 1)
        .groupBy("userId")
        .agg(
            F.count("*").alias("repeatedTracks"),
            F.max("playCount").alias("maxRepeats"),
            F.avg("playCount").alias("avgRepeats"),
        )
    )


def repeat_listening(repeats: DataFrame) -> DataFrame:
    return repeats.agg(
        F.avg("repeatedTracks").alias("avgRepeatedTracksPerUser"),
        F.avg("maxRepeats").alias("avgMaxRepeats"),
        F.max("maxRepeats").alias("globalMaxRepeats"),
    )


def user_session_stats(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("userId").agg(
        F.count("*").alias("totalSessions"),
        rounded_avg("durationMinutes", 2).alias("avgSessionDuration"),
        F.sum("trackCount").alias("totalTracks"),
        rounded_avg("trackCount", 2).alias("avgTracksPerSession"),
        F.max("trackCount").alias("maxTracksInSession"),
        F.min("durationMinutes").alias("minDurationMinutes"),
        F.max("durationMinutes").alias("maxDurationMinutes"),
    )


def user_types(
    stats: DataFrame,
    rules: Sequence[tuple[float, float, str]] = buckets.USER_TYPES,
    otherwise: str = buckets.USER_TYPE_ELSE,
) -> DataFrame:
    """Add ``userType`` from the number of sessions and the tracks per session."""
    sessions, tracks = F.col("totalSessions"), F.col("avgTracksPerSession")
    chain = [((sessions >= s) & (tracks >= t), label) for s, t, label in rules]
    return stats.withColumn("userType", buckets.first_match(chain, otherwise))


def user_type_summary(typed: DataFrame) -> DataFrame:
    return (
        typed.groupBy("userType")
        .agg(
            F.count("*").alias("userCount"),
            rounded_avg("totalSessions", 0).alias("avgSessions"),
            rounded_avg("avgSessionDuration", 1).alias("avgDurationMin"),
            rounded_avg("avgTracksPerSession", 1).alias("avgTracksPerSession"),
            rounded_avg("totalTracks", 0).alias("avgTotalTracks"),
        )
        .orderBy(F.desc("avgSessions"))
    )


def leaderboard(stats: DataFrame, measure: str, limit: int = 10) -> DataFrame:
    """The users with the highest ``measure``."""
    return stats.orderBy(F.desc(measure), "userId").limit(limit)


def similar_users(
    typed: DataFrame,
    reference_user: str,
    *,
    max_tracks: float = SIMILAR_TRACKS,
    max_sessions_share: float = SIMILAR_SESSIONS_SHARE,
) -> DataFrame:
    """Users close to the reference user in tracks per session and number of sessions, closest
    first. The reference is one row, read as a scalar subquery; no result without it."""
    reference = (
        typed.filter(F.col("userId") == reference_user)
        .agg(
            F.struct(
                F.max("avgTracksPerSession").alias("tracks"), F.max("totalSessions").alias("sessions")
            ).alias("reference")
        )
        .scalar()
    )
    others = typed.filter(F.col("userId") != reference_user).withColumn("reference", reference)
    distance = F.abs(F.col("avgTracksPerSession") - F.col("reference.tracks"))
    sessions = F.abs(F.col("totalSessions") - F.col("reference.sessions"))
    return (
        others.withColumn("distance", distance)
        .filter(F.col("distance") <= max_tracks)
        .filter(sessions <= F.col("reference.sessions") * max_sessions_share)
        .select(
            "userId", "userType", "totalSessions", "avgTracksPerSession", "avgSessionDuration", "distance"
        )
        .orderBy("distance", "userId")
    )


def retention_risk(
    stats: DataFrame,
    rules: Rules = buckets.RETENTION_RISK,
    otherwise: str = buckets.RETENTION_RISK_ELSE,
) -> DataFrame:
    return (
        stats.groupBy(buckets.below("totalSessions", rules, otherwise).alias("retentionRisk"))
        .agg(
            F.count("*").alias("userCount"),
            rounded_avg("totalTracks", 0).alias("avgTotalTracks"),
        )
        .orderBy(F.desc("userCount"))
    )


def engagement_summary(stats: DataFrame) -> DataFrame:
    ratio = F.try_divide(F.sum("totalTracks"), F.sum("totalSessions"))
    return stats.agg(
        F.count("*").alias("totalUsers"),
        rounded_avg("totalSessions", 2).alias("avgSessionsPerUser"),
        rounded_avg("avgTracksPerSession", 2).alias("avgTracksPerSession"),
        F.round(ratio, 2).alias("overallAvgTracksPerSession"),
        F.max("totalSessions").alias("maxSessionsByUser"),
        F.round(F.stddev("totalSessions"), 2).alias("sessionCountStdDev"),
    )


def with_rates(activity: DataFrame) -> DataFrame:
    """Plays per day of the listening span, and plays per distinct track."""
    return activity.withColumns(
        {
            "playsPerDay": F.col("totalPlays") / (F.col("listeningSpanDays") + 1),
            "trackRepetitionRate": F.col("totalPlays") / F.col("uniqueTracks"),
        }
    )


def outlier_users(
    activity: DataFrame, factor: float = OUTLIER_FACTOR, percentile: float = 0.95
) -> DataFrame:
    """Users above ``factor`` times the percentile of plays, plays per day or repetition."""
    rates = with_rates(activity)
    measures = ("totalPlays", "playsPerDay", "trackRepetitionRate")
    limits = percentile_of_each(rates, measures, percentile)

    def above(name: str) -> Column:
        return F.col(name) > F.col(f"limits.{name}") * factor

    reasons = [
        (above("totalPlays"), buckets.OUTLIER_PLAYS),
        (above("playsPerDay"), buckets.OUTLIER_PER_DAY),
        (above("trackRepetitionRate"), buckets.OUTLIER_REPETITION),
    ]
    return (
        rates.withColumn("limits", limits.select(F.struct(*measures)).scalar())
        .filter(reasons[0][0] | reasons[1][0] | reasons[2][0])
        .withColumn("outlierReason", buckets.first_match(reasons[:-1], reasons[-1][1]))
        .drop("limits")
        .orderBy(F.desc("totalPlays"), "userId")
    )


def sampled_behaviour(sample: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events, tracks and artists in a sample of plays, for the users of the given sessions. The
    sample is reduced to one row per user, artist and track before the distinct counts."""
    reduced = sample.groupBy("userId", "artistName", "trackName").agg(F.count("*").alias("events"))
    return (
        reduced.join(sessions.select("userId").distinct(), "userId", "left_semi")
        .groupBy("userId")
        .agg(
            F.sum("events").alias("totalEvents"),
            F.count_distinct("trackName").alias("uniqueTracks"),
            F.count_distinct("artistName").alias("uniqueArtists"),
        )
        .withColumn("trackDiversity", rounded(F.col("uniqueTracks") / F.col("totalEvents"), 3))
    )


def most_diverse(behaviour: DataFrame, limit: int = 10) -> DataFrame:
    """The users whose sampled plays repeat least."""
    return behaviour.orderBy(F.desc("trackDiversity"), F.desc("totalEvents"), "userId").limit(limit)


def behaviour_summary(behaviour: DataFrame) -> DataFrame:
    return behaviour.agg(
        F.count("*").alias("totalUsers"),
        F.avg("totalEvents").alias("avgEvents"),
        F.avg("uniqueTracks").alias("avgUniqueTracks"),
        mean("trackDiversity").alias("avgDiversity"),
    )
