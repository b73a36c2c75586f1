"""Numbers for all rows of a large table, without a window that gathers them.

A row_number over the whole table puts every row into one task. Here rows are range-partitioned by
the order and sorted inside their range; a row's number is its place in the range plus the sizes of
the ranges before. Only these sizes, one per range, are gathered. Numbers inside a group are those
of the whole order less those of the group's first row, so a group that holds a third of all rows is
spread over many ranges.

The order should be total: rows that compare equal are numbered arbitrarily and stay in one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.session import scratch_path

# monotonically_increasing_id() has the partition above these bits and the place below.
PLACE_BITS = 33


def number_rows(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "rank",
    *,
    ranges_by: Sequence[Column] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``df`` with ``name``: 1 for the first row in ``order``, 2 for the second, and so on.

    ``ranges_by`` are the sort keys that cut the ranges, by default those of the order; it may be a
    shorter form of them, such as a prefix of a long text. The sorted rows are stored, because a
    place in a range must not change when a task is repeated.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(partitions, *(ranges_by or order))
        .sortWithinPartitions(*order)
        .withColumn("__place", F.monotonically_increasing_id())
    )
    path = scratch_path(spark, "numbered")
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)

    part = F.shiftright("__place", PLACE_BITS)
    sizes = rows.groupBy(part.alias("__range")).agg(F.count("*").alias("size"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("__start"))
    place = F.col("__place") - F.shiftleft(part, PLACE_BITS)
    return (
        rows.withColumn("__range", part)
        .join(F.broadcast(starts), "__range")  # one row per range
        .withColumn(name, F.col("__start") + place + 1)
        .drop("__range", "__start", "__place")
    )


def number_in_groups(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    name: str = "rank",
    *,
    ranges_by: Sequence[Column] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``df`` with ``name``, the number of a row inside its group, from 1. NULL is a group too."""
    keys = [F.col(g).asc_nulls_first() for g in groups]
    cut = [*keys, *(ranges_by or order)]
    rows = number_rows(df, [*keys, *order], "__number", ranges_by=cut, partitions=partitions)
    firsts = rows.groupBy(*groups).agg(F.min("__number").alias("__first"))
    firsts = firsts.select([F.col(g).alias(f"__group_{g}") for g in groups] + ["__first"])
    condition = F.lit(True)
    for g in groups:
        condition &= F.col(g).eqNullSafe(F.col(f"__group_{g}"))
    return (
        rows.join(firsts, condition)
        .withColumn(name, F.col("__number") - F.col("__first") + 1)
        .drop("__number", "__first", *[f"__group_{g}" for g in groups])
    )
