"""Sessions over arriving batches of plays, equal to one run over all of them.

What a batch changes depends on each user's last session only, unless plays come late. So the
store keeps two kinds of rows:

* an *edge* for every user: the last session, which the next plays may extend, and its number;
* *closed* sessions, which nothing but a late play changes.

A batch is reduced to its own sessions first, a few rows per user however many plays it has. Users
whose plays all follow the start of their last session meet their edge alone: what touches is
merged, what no longer is the last session is closed, and numbers go on from the edge. Users with
earlier plays have all their sessions read, merged with the new ones, which may join two of them,
and numbered anew. Users without plays in the batch are not touched, and no play is read again.

Files are only added: every batch writes one folder of closed rows and one of edges, the latter
last. A row carries its batch, an edge also the batch in which its user was last numbered anew
(``rebuilt``). The newest edge of a user counts, and closed rows count that are not older than its
``rebuilt`` and not newer than the edge. A batch that failed half way has no edges, hence no
effect, and is written anew when it is added again; one that is complete is not added twice. Batch
numbers must therefore rise. ``compact`` writes the valid rows to a new store.

The plays of all batches together must hold no copies, as after cleaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlab.operators.sessions import DEFAULT_GAP_MINUTES, describe, merge_sessions, sessionize
from sessionlab.session import scratch_path
from sessionlab.sources.files import children, exists

COLUMNS = ["userId", "sessionNumber", "trackCount", "sessionStart", "sessionEnd"]
NEVER = -1  # of `rebuilt`


class SessionStore:
    def __init__(self, spark: SparkSession, path: str, gap_minutes: int = DEFAULT_GAP_MINUTES) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.gap_minutes = gap_minutes

    def batches(self) -> list[int]:
        """Numbers of the batches that are complete."""
        names = [n for n in children(self.spark, f"{self.path}/edges") if n.startswith("batch=")]
        done = [n for n in names if exists(self.spark, f"{self.path}/edges/{n}/_SUCCESS")]
        return sorted(int(n.removeprefix("batch=")) for n in done)

    def _read(self, kind: str, batches: list[int]) -> DataFrame:
        paths = [f"{self.path}/{kind}/batch={b}" for b in batches]
        return self.spark.read.option("basePath", f"{self.path}/{kind}").parquet(*paths)

    def edges(self) -> DataFrame:
        """The last session of every user, with ``rebuilt`` and ``batch``."""
        rows = self._read("edges", self.batches())
        newest = F.max_by(F.struct(*[c for c in rows.columns if c != "userId"]), "batch")
        return rows.groupBy("userId").agg(newest.alias("newest")).select("userId", "newest.*")

    def _closed(self, edges: DataFrame) -> DataFrame:
        """Valid closed sessions of the users of ``edges``."""
        known = edges.select("userId", "rebuilt", F.col("batch").alias("edgeBatch"))
        valid = (F.col("batch") >= F.col("rebuilt")) & (F.col("batch") <= F.col("edgeBatch"))
        return self._read("closed", self.batches()).join(known, "userId").filter(valid).select(COLUMNS)

    def sessions(self) -> DataFrame:
        """All sessions, with the columns of :func:`sessionize`."""
        edges = self.edges()
        return describe(self._closed(edges).unionByName(edges.select(COLUMNS)))

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def add(self, plays: DataFrame, batch: int) -> None:
        """Add a batch. The arguments are those of a streaming ``foreachBatch``."""
        done = self.batches()
        if batch in done:
            return
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after batch {done[-1]}")
        new = self._stored(sessionize(plays, self.gap_minutes).select(COLUMNS), "batch_sessions")
        if not done:
            merged = new.withColumn("rebuilt", F.lit(NEVER))
        else:
            merged = self._merge(new, batch)
        self._write(merged, batch)

    def _merge(self, new: DataFrame, batch: int) -> DataFrame:
        """Sessions of the users of ``new``: all of them for users with late plays, otherwise those
        from the last known one on."""
        firsts = new.groupBy("userId").agg(F.min("sessionStart").alias("firstNew"))
        is_late = F.coalesce(F.col("firstNew") < F.col("sessionStart"), F.lit(False))
        known = self._stored(
            firsts.join(self.edges(), "userId").withColumn("isLate", is_late), "touched_edges"
        )
        late = known.filter("isLate")
        parts = (
            new.select(COLUMNS)
            .unionByName(known.select(COLUMNS))
            .unionByName(self._closed(late))
            .drop("sessionNumber")
        )
        base = known.select(
            "userId",
            F.when(F.col("isLate"), 0).otherwise(F.col("sessionNumber")).alias("firstNumber"),
            F.when(F.col("isLate"), F.lit(batch)).otherwise(F.col("rebuilt")).alias("rebuilt"),
        )
        return (
            merge_sessions(parts, self.gap_minutes)
            .join(base, "userId", "left")
            .withColumn("sessionNumber", F.col("sessionNumber") + F.coalesce("firstNumber", F.lit(0)))
            .select(*COLUMNS, F.coalesce("rebuilt", F.lit(NEVER)).alias("rebuilt"))
        )

    def _write(self, merged: DataFrame, batch: int) -> None:
        last = F.max("sessionNumber").over(Window.partitionBy("userId"))
        rows = self._stored(merged.withColumn("isLast", F.col("sessionNumber") == last), "merged")
        closed, edges = rows.filter("NOT isLast"), rows.filter("isLast")
        closed.select(COLUMNS).write.mode("overwrite").parquet(f"{self.path}/closed/batch={batch}")
        edges.drop("isLast").write.mode("overwrite").parquet(f"{self.path}/edges/batch={batch}")

    def compact(self, path: str) -> SessionStore:
        """A store at ``path`` with the valid rows only, in one batch: the number of the last one."""
        other = SessionStore(self.spark, path, self.gap_minutes)
        edges = self.edges()
        rows = self._closed(edges).withColumn("rebuilt", F.lit(NEVER)).unionByName(
            edges.select(*COLUMNS, F.lit(NEVER).alias("rebuilt"))
        )
        other._write(rows, self.batches()[-1])
        return other

