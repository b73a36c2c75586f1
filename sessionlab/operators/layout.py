"""Partition layout, reuse and sampling."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Sizing rule.
USERS_PER_PARTITION = 70
MIN_PARTITIONS = 4
MAX_PARTITIONS = 32
REPARTITION_BELOW = 0.6
REPARTITION_ABOVE = 1.8
BALANCED_USERS = (30, 100)
DEFAULT_USERS = 1000


def partition_advice(
    users: Column | int, cores: int, max_partitions: int = MAX_PARTITIONS
) -> Column:
    """Partitions for a user count: twice the cores or users / 70, between 4 and the maximum.

    A report of the published rule, whose maximum of 32 must not size a job; AQE does that.
    """
    users = F.lit(users) if isinstance(users, int) else users
    by_users = F.floor(users / USERS_PER_PARTITION).cast("int")
    wanted = F.greatest(F.lit(2 * cores), by_users, F.lit(MIN_PARTITIONS))
    return F.least(wanted, F.lit(max_partitions))


def should_repartition(current: Column | int, optimal: Column | int) -> Column:
    current, optimal = (F.lit(c) if isinstance(c, int) else c for c in (current, optimal))
    ratio = current / optimal
    return (ratio < REPARTITION_BELOW) | (ratio > REPARTITION_ABOVE)


def is_balanced(users: Column, partitions: Column | int) -> Column:
    """Between 30 and 100 users per partition."""
    per_partition = users / (F.lit(partitions) if isinstance(partitions, int) else partitions)
    return per_partition.between(*BALANCED_USERS)


def user_count(df: DataFrame, *, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count("userId").alias("users"))


def estimate_users(df: DataFrame, default: int = DEFAULT_USERS) -> int:
    """The number of users, or ``default`` when it cannot be counted."""
    try:
        return user_count(df).first()["users"]
    except PySparkException as error:
        log.warning("could not count users, assuming %d: %s", default, error)
        return default


def by_user(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Bring the rows of a user together.

    Without a count this is a rebalance: AQE picks the number of partitions and splits a user
    that is too large for one. With a count it is a plain hash repartition.
    """
    if partitions is None:
        return df.hint("rebalance", "userId")
    return df.repartition(partitions, "userId")


def round_robin(df: DataFrame, partitions: int) -> DataFrame:
    return df.repartition(partitions)


def fewer_partitions(df: DataFrame, partitions: int) -> DataFrame:
    """Merge partitions without a shuffle. For small results only."""
    return df.coalesce(partitions)


def balance_facts(df: DataFrame) -> DataFrame:
    """One row about how the rows lie: rows, users, partitions, users in more than one partition,
    and partitions whose number of users is balanced."""
    report = balance_report(df)
    places = (
        df.select(F.spark_partition_id().alias("partitionId"), "userId")
        .distinct()
        .groupBy("userId")
        .agg(F.count("*").alias("partitions"))
    )
    return report.agg(
        F.sum("rows").alias("rows"),
        F.count("*").alias("partitions"),
        F.count_if("balanced").alias("balanced"),
    ).withColumns(
        {
            "users": places.agg(F.count("*")).scalar(),
            "splitUsers": places.agg(F.count_if(F.col("partitions") > 1)).scalar(),
        }
    )


def balance_report(df: DataFrame) -> DataFrame:
    """Rows and users of every partition as it lies, and whether the users are balanced."""
    users = F.count_distinct("userId")
    return (
        df.select(F.spark_partition_id().alias("partitionId"), "userId")
        .groupBy("partitionId")
        .agg(F.count("*").alias("rows"), users.alias("users"))
        .withColumn("balanced", F.col("users").between(*BALANCED_USERS))
    )


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a frame while several reports read it. Run the reports inside the block: the frame is
    released at its end."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def bernoulli_sample(df: DataFrame, fraction: float = 0.05, seed: int = 42) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, fraction: float, *columns: str) -> DataFrame:
    """A sample that depends on the row's key only, not on the partitioning."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return df.filter(bits < int(fraction * 2**32))


def sample_per_user(df: DataFrame, size: int, *columns: str, user: str = "userId") -> DataFrame:
    """The ``size`` rows of every user with the least hash of these columns, or all where there are
    fewer; the rows do not depend on the partitioning. Rows with equal columns are taken in any
    order, so the columns should be a key.

    Every task keeps only its ``size`` best rows of a user before the shuffle, so a user with a
    third of all rows sends ``size`` rows per task.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    order = Window.partitionBy(user).orderBy(F.md5(text), *columns)
    return df.withColumn("__place", F.row_number().over(order)).filter(F.col("__place") <= size).drop("__place")
