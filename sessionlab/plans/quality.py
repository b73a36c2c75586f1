"""Data-quality reports on raw and cleaned plays."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.functions.keys import has_value
from sessionlab.operators.cleaning import (
    NAMES,
    REQUIRED,
    missing,
    normalize_events,
    parse_times,
    sanitize_names,
)

# Rule limits and message texts.
MISSING_ID_LIMIT_PCT = 50.0
SUSPICIOUS_USER_PLAYS = 100_000
EARLIEST_DATE = "2000-01-01"
MISSING_ID_WARNING = "High percentage of missing track IDs"
MISSING_ID_ADVICE = "Consider improving track ID matching or using fallback keys"


def completeness_counts() -> list[Column]:
    """Raw rows and those with all required fields, as aggregates."""
    complete = F.lit(True)
    for name in REQUIRED:
        complete = complete & F.col(name).isNotNull()
    return [F.count(F.lit(1)).alias("rawRows"), F.count_if(complete).alias("completeRows")]


def completeness(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """The counts as a frame, where they were observed while the rows were used."""
    return spark.createDataFrame(
        [(counts["rawRows"], counts["completeRows"])], "rawRows long, completeRows long"
    )


def clean_metrics(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row: size and range of the cleaned plays, completeness of the raw ones.

    ``raw`` is the raw events or their :func:`completeness`. Completeness is measured before
    cleaning; afterwards no NULL is left to find.
    """
    counts = raw if "rawRows" in raw.columns else raw.agg(*completeness_counts())
    score = counts.select(F.try_divide(F.col("completeRows") * F.lit(100.0), "rawRows")).scalar()
    return (
        cleaned.agg(
            F.count("*").alias("totalRecords"),
            F.count_distinct("userId").alias("uniqueUsers"),
            F.min("timestamp").alias("firstPlay"),
            F.max("timestamp").alias("lastPlay"),
        )
        .withColumn("avgTracksPerUser", F.try_divide("totalRecords", "uniqueUsers"))
        .withColumn("qualityScore", score)
    )


def quality_counts(raw: DataFrame) -> DataFrame:
    """One row over the raw events: rows read, valid, dropped, without a track id.

    A row is valid when its time parses and its sanitized names are not empty. All counts come
    from a single pass.
    """
    rows = flag_valid_events(raw)
    valid = F.col("isValid")
    return rows.agg(
        F.count("*").alias("rowsRead"),
        F.count_if(valid).alias("rowsValid"),
        F.count_if(~valid).alias("rowsDropped"),
        F.count_if(valid & missing("trackId")).alias("missingTrackId"),
    ).withColumn(
        "pctMissingTrackId",
        F.coalesce(F.try_divide(F.col("missingTrackId") * F.lit(100.0), "rowsValid"), F.lit(0.0)),
    )


def flag_valid_events(raw: DataFrame) -> DataFrame:
    """All raw rows, normalized, with ``isValid`` instead of a filter."""
    rows = sanitize_names(parse_times(raw, keep_invalid=True))
    valid = F.col("timestamp").isNotNull()
    for name in NAMES:
        valid = valid & has_value(name)
    return rows.withColumn("isValid", valid)


def metric_table(counts: DataFrame) -> DataFrame:
    """The counts as (metric, value) text rows."""
    return counts.select(
        F.col("rowsRead").cast("string").alias("rows_read"),
        F.col("rowsValid").cast("string").alias("rows_valid"),
        F.col("rowsDropped").cast("string").alias("rows_dropped"),
        F.col("missingTrackId").cast("string").alias("missing_track_id"),
        F.concat(F.format_string("%.2f", "pctMissingTrackId"), F.lit("%")).alias("pct_missing_track_id"),
    ).unpivot(
        [],
        ["rows_read", "rows_valid", "rows_dropped", "missing_track_id", "pct_missing_track_id"],
        "metric",
        "value",
    )


def quality_warnings(counts: DataFrame, limit_pct: float = MISSING_ID_LIMIT_PCT) -> DataFrame:
    """Warning and recommendation rows; empty when nothing is wrong."""
    text = F.concat(
        F.lit(f"{MISSING_ID_WARNING}: "), F.format_string("%.2f", "pctMissingTrackId"), F.lit("%")
    )
    return counts.filter(F.col("pctMissingTrackId") > limit_pct).select(
        text.alias("warning"), F.lit(MISSING_ID_ADVICE).alias("recommendation")
    )


def quality_report(
    counts: DataFrame,
    dataset: str,
    limit_pct: float = MISSING_ID_LIMIT_PCT,
    *,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """One row: time, data set, metrics as a struct, lists of warnings and recommendations."""
    high = F.col("pctMissingTrackId") > limit_pct
    warning = F.concat(
        F.lit(f"{MISSING_ID_WARNING}: "), F.format_string("%.2f", "pctMissingTrackId"), F.lit("%")
    )
    nothing = F.array().cast("array<string>")
    return counts.select(
        (F.current_timestamp() if as_of is None else F.lit(as_of)).alias("timestamp"),
        F.lit(dataset).alias("dataset"),
        F.struct("*").alias("metrics"),
        F.when(high, F.array(warning)).otherwise(nothing).alias("warnings"),
        F.when(high, F.array(F.lit(MISSING_ID_ADVICE))).otherwise(nothing).alias("recommendations"),
    )


def sanity_issues(
    plays: DataFrame,
    *,
    as_of: dt.datetime | None = None,
    earliest: str = EARLIEST_DATE,
    max_user_plays: int = SUSPICIOUS_USER_PLAYS,
) -> DataFrame:
    """One row per rule with the number of offending rows (or users, for the last rule).

    Plays are counted per user first, so the three rules share one pass and one shuffle.
    """
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    time = F.col("timestamp").cast("timestamp")
    per_user = plays.groupBy("userId").agg(
        F.count("*").alias("plays"),
        F.count_if(time > now).alias("future"),
        F.count_if(time < F.lit(earliest).cast("timestamp")).alias("old"),
    )
    counts = per_user.agg(
        F.coalesce(F.sum("future"), F.lit(0)).alias("future_timestamps"),
        F.coalesce(F.sum("old"), F.lit(0)).alias("very_old_timestamps"),
        F.count_if(F.col("plays") > max_user_plays).alias("suspicious_users"),
    )
    return counts.unpivot(
        [], ["future_timestamps", "very_old_timestamps", "suspicious_users"], "issue", "offending"
    )


def invalid_times(raw: DataFrame) -> DataFrame:
    rows = parse_times(raw, keep_invalid=True)
    return rows.agg(
        F.count("*").alias("rowsRead"),
        F.count_if(F.col("timestamp").isNull()).alias("invalidTimes"),
        F.count("timestamp").alias("validTimes"),
    )


def empty_fields(raw: DataFrame) -> DataFrame:
    """Empty user, artist and track names after sanitizing, and rows left if those are dropped."""
    rows = normalize_events(raw, drop_empty=False)
    keep = has_value("userId") & has_value("artistName") & has_value("trackName")
    return rows.agg(
        F.count_if(missing("userId")).alias("emptyUsers"),
        F.count_if(missing("artistName")).alias("emptyArtists"),
        F.count_if(missing("trackName")).alias("emptyTracks"),
        F.count_if(keep).alias("rowsKept"),
    )


def duplicate_keys(plays: DataFrame) -> DataFrame:
    """Keys (user, time, track) that occur more than once."""
    return (
        plays.groupBy("userId", "timestamp", "trackKey")
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )


def duplicate_totals(duplicates: DataFrame) -> DataFrame:
    return duplicates.agg(
        F.count("*").alias("duplicateKeys"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("duplicatedRows"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: rows that are NULL, and rows that are empty text. One pass for all columns."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}.nulls") for c in df.columns],
        *[F.count_if(F.col(c) == "").alias(f"{c}.empty") for c in df.columns if c in text],
    )
    per_column = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"`{c}.nulls`").alias("nulls"),
                (F.col(f"`{c}.empty`") if c in text else F.lit(0).cast("long")).alias("empty"),
                F.col("rows").alias("rows"),
            )
            for c in df.columns
        ]
    )
    return counts.select(F.inline(per_column))
