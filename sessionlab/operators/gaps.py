"""Time between consecutive plays of a user, and order checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.functions.buckets import GAP_MINUTES, GAP_MINUTES_ELSE, Rules, at_most
from sessionlab.functions.times import seconds_between
from sessionlab.operators.sessions import DEFAULT_GAP_MINUTES, _cell, activity_cells, number_cells


def with_previous_play(
    plays: DataFrame, *tie_breakers: str, gap_minutes: int = DEFAULT_GAP_MINUTES
) -> DataFrame:
    """Add ``previousTimestamp``, ``gapSeconds`` (0 on a user's first play) and ``isSessionBreak``.

    The lag runs inside a (user, cell) window, so a heavy user is spread over time. Only the first
    play of a cell looks further back, and takes the last play of the user's previous cell.
    """
    cells = number_cells(activity_cells(plays, gap_minutes), gap_minutes)
    in_cell = Window.partitionBy("userId", "cell").orderBy("timestamp", *tie_breakers)
    gap = F.coalesce(seconds_between("previousTimestamp", "timestamp"), F.lit(0))
    return (
        plays.withColumn("cell", _cell("timestamp", gap_minutes))
        .withColumn("previousInCell", F.lag("timestamp").over(in_cell))
        .join(cells.select("userId", "cell", "previousPlay"), ["userId", "cell"])
        .withColumn("previousTimestamp", F.coalesce("previousInCell", "previousPlay"))
        .withColumn("gapSeconds", gap)
        .withColumn("isSessionBreak", F.when(F.col("gapSeconds") > gap_minutes * 60, 1).otherwise(0))
        .drop("cell", "previousInCell", "previousPlay")
    )


def gap_stats(plays: DataFrame, gap_minutes: int = DEFAULT_GAP_MINUTES) -> DataFrame:
    """Per user: plays, breaks, sessions, mean and median gap in minutes, plays per session.

    A user's first play counts with gap 0. ``sessions`` is breaks + 1, so it is never zero. The
    median is exact: it is taken from counts per user and gap, which combine before the shuffle.
    """
    counts = (
        with_previous_play(plays.select("userId", "timestamp"), gap_minutes=gap_minutes)
        .groupBy("userId", "gapSeconds")
        .agg(F.count("*").alias("n"), F.sum("isSessionBreak").alias("breaks"))
    )
    user = Window.partitionBy("userId")
    up_to = user.orderBy("gapSeconds").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counts.withColumn("upTo", F.sum("n").over(up_to)).withColumn("all", F.sum("n").over(user))
    seconds = F.sum(F.col("n") * F.col("gapSeconds"))
    median = F.min(F.when(2 * F.col("upTo") >= F.col("all"), F.col("gapSeconds")))
    return (
        running.groupBy("userId")
        .agg(
            F.sum("n").alias("totalPlays"),
            F.sum("breaks").alias("breaks"),
            (seconds / (60 * F.sum("n"))).alias("avgGapMinutes"),
            (median / 60).alias("medianGapMinutes"),
        )
        .withColumn("sessions", F.col("breaks") + 1)
        .withColumn("playsPerSession", F.try_divide("totalPlays", "sessions"))
    )


def gap_summary(stats: DataFrame) -> DataFrame:
    return stats.agg(
        F.avg("breaks").alias("avgBreaksPerUser"),
        F.avg("sessions").alias("avgSessionsPerUser"),
        F.avg("playsPerSession").alias("avgPlaysPerSession"),
        F.avg("avgGapMinutes").alias("avgGapBetweenPlays"),
    )


def gap_distribution(
    plays: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    rules: Rules = GAP_MINUTES,
    otherwise: str = GAP_MINUTES_ELSE,
) -> DataFrame:
    """Positive gaps by length category, shortest category first."""
    gap = F.col("gapSeconds") / 60
    position = F.array_position(
        F.array(*[F.lit(label) for _, label in rules], F.lit(otherwise)), F.col("gapCategory")
    )
    return (
        with_previous_play(plays.select("userId", "timestamp"), gap_minutes=gap_minutes)
        .filter(F.col("gapSeconds") > 0)
        .groupBy(at_most(gap, rules, otherwise).alias("gapCategory"))
        .agg(F.count("*").alias("gapCount"))
        .orderBy(position)
    )


def check_chronology(
    events: DataFrame, key: str, sequence: str, time: str = "timestamp", block: int = 1_000_000
) -> DataFrame:
    """Per key: whether the times never go back when the rows are read by ``sequence``.

    The sequence is an integer column. Rows are compared inside blocks of ``block`` sequence
    numbers, then the end of each block with the start of the next, so no task sees all rows of
    a large key.
    """
    blocks = events.withColumn("block", F.floor(F.col(sequence) / block))
    in_block = Window.partitionBy(key, "block").orderBy(sequence)
    per_block = (
        blocks.withColumn("back", F.col(time) < F.lag(time).over(in_block))
        .groupBy(key, "block")
        .agg(
            F.count("*").alias("rows"),
            F.count_if("back").alias("stepsBack"),
            F.min_by(time, sequence).alias("firstTime"),
            F.max_by(time, sequence).alias("lastTime"),
        )
    )
    across = Window.partitionBy(key).orderBy("block")
    return (
        per_block.withColumn("back", F.col("firstTime") < F.lag("lastTime").over(across))
        .groupBy(key)
        .agg(
            F.sum("rows").alias("rows"),
            (F.sum("stepsBack") + F.count_if("back")).alias("stepsBack"),
        )
        .withColumn("inOrder", F.col("stepsBack") == 0)
    )
