"""Exact percentiles from counts per distinct value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ranges of values: bits of the value after its power of two. 64 ranges to a factor of two.
RANGES_PER_DOUBLING = 64


def percentiles(df: DataFrame, column: str, shares: Sequence[float], names: Sequence[str]) -> DataFrame:
    """One row: for every share the least value that at least that share of the rows does not
    exceed. NULL is left out; without rows the result is NULL."""
    values = df.select(F.lit(column).alias("measure"), F.col(column).alias("value"))
    reached = _reached(values)
    return reached.agg(*[_least(share).alias(name) for share, name in zip(shares, names)])


def percentile_of_each(df: DataFrame, columns: Sequence[str], share: float) -> DataFrame:
    """One row with the percentile of every column, as doubles. All columns are counted in one
    pass over ``df``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in columns])
    reached = _reached(df.select(F.inline(pairs)))
    return reached.agg(*[_least(share, F.col("measure") == c).alias(c) for c in columns])


def _least(share: float, condition: Column | None = None) -> Column:
    enough = F.col("reached") >= F.greatest(F.ceil(F.col("rows") * F.lit(share)), F.lit(1))
    return F.min(F.when(enough if condition is None else enough & condition, F.col("value")))


def _reached(values: DataFrame) -> DataFrame:
    """Every distinct value of a measure with ``reached``, how many rows do not exceed it, and
    ``rows``, how many there are.

    Values are counted first, which combines before the shuffle. The running count is taken in
    ranges of values: within a range by its own task, between ranges over their totals, of which
    there are at most a few thousand. So no task sees all distinct values.
    """
    value = F.col("value")
    size = F.floor(F.log2(F.abs(value)) * RANGES_PER_DOUBLING)
    # A range is known by sign and size; both rise with the value.
    part = F.when(value > 0, F.struct(F.lit(1).alias("sign"), size.alias("size"))).otherwise(
        F.when(value < 0, F.struct(F.lit(-1).alias("sign"), (-size).alias("size"))).otherwise(
            F.struct(F.lit(0).alias("sign"), F.lit(0).cast("long").alias("size"))
        )
    )
    counts = (
        values.filter(value.isNotNull())
        .groupBy("measure", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("part", part)
    )
    own = Window.partitionBy("measure")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("measure", "part").agg(F.sum("n").alias("inPart"))
    placed = totals.select(
        "measure",
        "part",
        F.coalesce(F.sum("inPart").over(before), F.lit(0)).alias("before"),
        F.sum("inPart").over(own).alias("rows"),
    )
    within = Window.partitionBy("measure", "part").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = counts.withColumn("within", F.sum("n").over(within)).join(placed, ["measure", "part"])
    return running.withColumn("reached", F.col("before") + F.col("within"))
