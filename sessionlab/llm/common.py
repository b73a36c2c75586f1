"""Helpers shared by the text operators.

A row of ``documents`` is known by its ``doc_id`` together with a 64-bit hash of its text
(``version``): repeated rows get the same answer, rows that share an id but not the text get their
own, and a missing id is a value like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.session import scratch_path

# A group is hot when it holds more than this share of all rows or, in large tables, more than
# HOT_ROWS rows, so that what is left for a sort-merge join is bounded. Hot groups are broadcast, and
# there are never more than MOST_HOT of them: beyond HOT_ROWS * MOST_HOT rows the bound rises.
HOT_SHARE = 0.001
HOT_ROWS = 1_000_000
MOST_HOT = 200_000


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends here and nothing is
    computed twice. Lost executors cost only the tasks they ran."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text only; a missing text is empty."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))


def version(text: Column | str = "text") -> Column:
    return F.xxhash64(text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def same_row(left: DataFrame, right: DataFrame, *more: str) -> Column:
    """Join condition on (doc_id, version) and further columns, where NULL equals NULL."""
    condition = left["doc_id"].eqNullSafe(right["doc_id"]) & (left["version"] == right["version"])
    for name in more:
        condition &= left[name] == right[name]
    return condition


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hot_size(total: Column) -> Column:
    """How many of so many rows a group may have without being hot."""
    return F.least(total * HOT_SHARE, F.greatest(F.lit(float(HOT_ROWS)), total / MOST_HOT))


def meet(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Inner join on ``keys``, where ``size`` is how many of the rows a group has.

    Rows of a large group stay where they are, because such groups are few and are broadcast; they
    also leave the other rows before these are shuffled for a sort-merge join. ``rows`` and
    ``groups`` are read several times, so they should be stored frames.
    """
    limit = hot_size(rows.agg(F.count("*")).scalar())
    hot = groups.filter(F.col(size) > limit)
    cold = groups.filter(F.col(size) <= limit)
    others = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(others.join(cold.hint("merge"), keys))


def hash_sample(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    """The ``size`` rows with the least hash of their keys, or all where there are fewer.

    A cut of the hashes that leaves half as many rows again comes first, so that the tasks send
    few rows to the one that picks, however many tasks there are.
    """
    hashed = F.xxhash64(*keys)
    count = df.count()
    if count > 2 * size:
        df = df.filter(hashed < int(-(2**63) + 2**64 * (1.5 * size / count)))
    return df.orderBy(hashed, *keys).limit(size)
