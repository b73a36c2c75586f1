"""Plays stored by user, so that sessions are cut where the plays lie.

Two tables share a folder. Most users are in buckets of the user, sorted by time: every step of
the session cut is then planned without an exchange. A user with more than ``heavy_plays`` plays
would make one bucket too large; such users are in buckets of (user, block of days). Their plays
are reduced to occupied cells in place, and only these cells, at most a few dozen a day, are moved.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlab.functions.times import seconds
from sessionlab.operators.sessions import (
    DEFAULT_GAP_MINUTES,
    activity_cells,
    sessionize,
    sessions_of_cells,
)
from sessionlab.sources.files import exists

HEAVY_PLAYS = 10_000_000
BLOCK = "timeBlock"


class UserBuckets:
    """Plays below ``path``. Opening a path again with the same number of buckets finds them."""

    def __init__(
        self, spark: SparkSession, path: str, buckets: int, *, heavy_plays: int = HEAVY_PLAYS, gap_minutes: int = DEFAULT_GAP_MINUTES
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.heavy_plays = heavy_plays
        # Whole cells, about a month: a cell never lies in two blocks.
        self.block_seconds = max(30 * 24 * 60 // gap_minutes, 1) * gap_minutes * 60
        self.gap_minutes = gap_minutes
        name = hashlib.md5(self.path.encode()).hexdigest()
        self.light_table, self.heavy_table = f"plays_by_user_{name}", f"plays_by_block_{name}"

    def _create(self, table: str, folder: str, schema: StructType, keys: str, order: str) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({order}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}/{folder}'"
        )

    def write(self, plays: DataFrame) -> UserBuckets:
        """Replace what is stored. Users are counted first; how many are heavy is at most the
        number of plays divided by ``heavy_plays``, so Spark broadcasts them if they are few."""
        counts = plays.groupBy("userId").agg(F.count("*").alias("plays"))
        heavy_users = counts.filter(F.col("plays") > self.heavy_plays).select("userId")
        light = plays.join(heavy_users, "userId", "left_anti").select(plays.columns)
        block = F.floor(seconds("timestamp") / self.block_seconds).cast("long")
        heavy = plays.join(heavy_users, "userId", "left_semi").select(*plays.columns, block.alias(BLOCK))
        for frame, keys, folder in ((light, ["userId"], "light"), (heavy, ["userId", BLOCK], "heavy")):
            (
                frame.repartition(self.buckets, *keys)
                .write.mode("overwrite")
                .bucketBy(self.buckets, *keys)
                .sortBy(*keys, "timestamp")
                .option("path", f"{self.path}/{folder}")
                .saveAsTable(self.light_table if folder == "light" else self.heavy_table)
            )
        return self

    def _open(self, table: str, folder: str, keys: str) -> DataFrame:
        if not self.spark.catalog.tableExists(table):
            if not exists(self.spark, f"{self.path}/{folder}"):
                raise ValueError(f"no plays below {self.path}")
            schema = self.spark.read.parquet(f"{self.path}/{folder}").schema
            self._create(table, folder, schema, keys, f"{keys}, timestamp")
        return self.spark.table(table)

    def light(self) -> DataFrame:
        return self._open(self.light_table, "light", "userId")

    def heavy(self) -> DataFrame:
        return self._open(self.heavy_table, "heavy", f"userId, {BLOCK}")

    def plays(self) -> DataFrame:
        return self.light().unionByName(self.heavy().drop(BLOCK))

    def light_sessions(self) -> DataFrame:
        """Sessions of the users in one bucket: no exchange."""
        return sessionize(self.light(), self.gap_minutes)

    def heavy_sessions(self) -> DataFrame:
        """Sessions of the heavy users: their cells are counted in place and then moved."""
        cells = activity_cells(self.heavy(), self.gap_minutes, layout=(BLOCK,)).drop(BLOCK)
        return sessions_of_cells(cells, self.gap_minutes)

    def sessions(self) -> DataFrame:
        """What :func:`sessionize` gives for all plays."""
        return self.light_sessions().unionByName(self.heavy_sessions())

    def forget(self) -> None:
        """Remove the two tables from the catalog; the files stay."""
        for table in (self.light_table, self.heavy_table):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
