"""When plays and sessions happen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.functions.numbers import rounded_avg
from sessionlab.functions.times import day_name, period_type

# Rule limits.
LOW_ACTIVITY_SHARE = 0.1
OUTLIER_DEVIATIONS = 2.0


def plays_by(plays: DataFrame, part: Column, name: str, *, users: bool = True) -> DataFrame:
    """Plays, and active users, per value of a time expression.

    With users, plays are first counted per (value, user); that is the only wide shuffle and it
    is spread over the users even if one value holds most plays.
    """
    rows = plays.withColumn(name, part)
    if not users:
        return rows.groupBy(name).agg(F.count("*").alias("plays")).orderBy(name)
    per_user = rows.groupBy(name, "userId").agg(F.count("*").alias("plays"))
    return (
        per_user.groupBy(name)
        .agg(F.sum("plays").alias("plays"), F.count("*").alias("activeUsers"))
        .orderBy(name)
    )


def plays_by_year(plays: DataFrame) -> DataFrame:
    return plays_by(plays, F.year("timestamp"), "year")


def plays_by_hour(plays: DataFrame) -> DataFrame:
    return plays_by(plays, F.hour("timestamp"), "hour")


def plays_by_weekday(plays: DataFrame) -> DataFrame:
    """Days are numbered 1 (Sunday) to 7."""
    return plays_by(plays, F.dayofweek("timestamp"), "dayOfWeek")


def plays_by_month(plays: DataFrame) -> DataFrame:
    return plays_by(plays, F.date_format("timestamp", "yyyy-MM"), "yearMonth", users=False)


def low_activity_days(plays: DataFrame, share: float = LOW_ACTIVITY_SHARE) -> DataFrame:
    """Days with fewer plays than ``share`` of the daily mean. The window sees a row per day."""
    days = plays.groupBy(F.to_date("timestamp").alias("date")).agg(F.count("*").alias("dailyPlays"))
    mean = F.avg("dailyPlays").over(Window.partitionBy())
    return (
        days.withColumn("avgDailyPlays", mean)
        .filter(F.col("dailyPlays") < F.col("avgDailyPlays") * share)
        .orderBy("date")
    )


def hour_outliers(plays: DataFrame, deviations: float = OUTLIER_DEVIATIONS) -> DataFrame:
    """Hours whose plays are further from the mean than ``deviations`` sample deviations."""
    hours = plays.groupBy(F.hour("timestamp").alias("hour")).agg(F.count("*").alias("plays"))
    everything = Window.partitionBy()
    return (
        hours.withColumn("avgPlays", F.avg("plays").over(everything))
        .withColumn("stddevPlays", F.stddev("plays").over(everything))
        .filter(F.abs(F.col("plays") - F.col("avgPlays")) > F.col("stddevPlays") * deviations)
        .orderBy(F.desc("plays"), "hour")
    )


def with_start_parts(sessions: DataFrame) -> DataFrame:
    """Hour, weekday, month and year of the session start."""
    start = F.col("sessionStart")
    day = F.dayofweek(start)
    return sessions.withColumns(
        {
            "hour": F.hour(start),
            "dayOfWeek": day,
            "dayName": day_name(day),
            "periodType": period_type(day),
            "month": F.month(start),
            "year": F.year(start),
        }
    )


def _averages() -> list[Column]:
    return [
        rounded_avg("durationMinutes", 2).alias("avgDurationMin"),
        rounded_avg("trackCount", 1).alias("avgTracks"),
    ]


def sessions_by_hour(sessions: DataFrame) -> DataFrame:
    return (
        with_start_parts(sessions)
        .groupBy("hour")
        .agg(F.count("*").alias("sessionCount"), *_averages())
        .orderBy("hour")
    )


def peak_hours(by_hour: DataFrame, limit: int = 5) -> DataFrame:
    return by_hour.orderBy(F.desc("sessionCount"), "hour").limit(limit)


def sessions_by_weekday(sessions: DataFrame) -> DataFrame:
    return (
        with_start_parts(sessions)
        .groupBy("dayOfWeek", "dayName")
        .agg(F.count("*").alias("sessionCount"), *_averages())
        .orderBy("dayOfWeek")
    )


def sessions_weekend(sessions: DataFrame) -> DataFrame:
    return (
        with_start_parts(sessions)
        .groupBy("periodType")
        .agg(
            F.count("*").alias("sessionCount"),
            *_averages(),
            F.count_distinct("userId").alias("uniqueUsers"),
        )
    )


def sessions_by_month(sessions: DataFrame) -> DataFrame:
    return (
        with_start_parts(sessions)
        .groupBy("year", "month")
        .agg(
            F.count("*").alias("sessionCount"),
            F.count_distinct("userId").alias("activeUsers"),
            rounded_avg("durationMinutes", 2).alias("avgDurationMin"),
        )
        .orderBy("year", "month")
    )


def hour_utilization(sessions: DataFrame, limit: int = 3) -> DataFrame:
    """The hours with the highest and the lowest sessions x average tracks."""
    hours = (
        with_start_parts(sessions)
        .groupBy("hour")
        .agg(
            F.count("*").alias("sessionCount"),
            F.count_distinct("userId").alias("activeUsers"),
            rounded_avg("trackCount", 1).alias("avgTracks"),
        )
        .withColumn("utilizationScore", F.col("sessionCount") * F.col("avgTracks"))
    )
    everything = Window.partitionBy()
    best = F.row_number().over(everything.orderBy(F.desc("utilizationScore"), "hour"))
    worst = F.row_number().over(everything.orderBy("utilizationScore", "hour"))
    ranked = hours.withColumns({"best": best, "worst": worst})
    return ranked.filter((F.col("best") <= limit) | (F.col("worst") <= limit)).select(
        F.when(F.col("best") <= limit, "peak").otherwise("low").alias("usage"),
        "hour",
        "sessionCount",
        "activeUsers",
        "avgTracks",
        "utilizationScore",
    )
