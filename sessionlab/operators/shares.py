"""Shares of a total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_percentage(groups: DataFrame, value: str, name: str = "percentage", digits: int | None = 2) -> DataFrame:
    """Each row's percentage of the sum of ``value``; for frames with a row per category."""
    total = F.sum(value).over(Window.partitionBy())
    share = F.try_divide(F.col(value) * F.lit(100.0), total)
    return groups.withColumn(name, share if digits is None else F.round(share, digits))


def long_tail(item_plays: DataFrame, plays: str = "totalPlays", share: float = 0.8) -> DataFrame:
    """How few items reach ``share`` of all plays, and what part of the items that is.

    Items with equal plays are interchangeable, so they are counted per number of plays first.
    N plays can have at most sqrt(2 N) different counts, which keeps the running sum small
    (1.5 million rows for 10^12 plays) without ever sorting the items. The level at which the sum
    passes the target says how many of its items are needed.
    """
    levels = item_plays.groupBy(F.col(plays).alias("level")).agg(F.count("*").alias("items"))
    everything = Window.partitionBy()
    down = Window.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level_plays = F.col("level") * F.col("items")
    running = levels.select(
        "level",
        "items",
        F.sum(level_plays).over(down).alias("playsSoFar"),
        F.sum("items").over(down).alias("itemsSoFar"),
        F.sum(level_plays).over(everything).alias("totalPlays"),
        F.sum("items").over(everything).alias("totalItems"),
    ).withColumn("targetPlays", F.floor(F.col("totalPlays") * F.lit(share)))
    passed = running.filter(F.col("playsSoFar") >= F.col("targetPlays"))
    missing_plays = F.col("targetPlays") - (F.col("playsSoFar") - level_plays)
    needed = F.col("itemsSoFar") - F.col("items") + F.greatest(
        F.ceil(missing_plays / F.col("level")), F.lit(1)
    )
    return (
        passed.orderBy(F.desc("level"))
        .limit(1)
        .select("totalItems", "totalPlays", "targetPlays", needed.alias("itemsForShare"))
        .withColumn(
            "pctOfItems", F.round(F.col("itemsForShare") * F.lit(100.0) / F.col("totalItems"), 2)
        )
    )
