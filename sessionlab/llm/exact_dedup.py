"""Exact de-duplication against a persistent digest index.

The index is a Parquet table (digest, keep_id, group_size), bucketed and sorted by the SHA-256 of
the text. A batch is reduced to one row per digest, which combines before the shuffle, so a text
that makes up a third of all rows is one row per task. The reduced batch meets the index in a
sort-merge anti join; with the same number of buckets and shuffle partitions the index side is
read in place. What is new is appended.

Missing texts are empty texts, and empty texts equal each other. Of equal texts the largest
``doc_id`` stays; a missing id counts as the smallest. An empty batch adds nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.llm.common import meet, stored, texts
from sessionlab.session import scratch_path

DIGEST = "digest binary, keep_id bigint, group_size bigint"


class DigestIndex:
    """The digests seen so far, kept at ``path``. Opening a path again continues the index."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None) -> None:
        self.spark = spark
        self.path = path
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = f"digest_index_{hashlib.md5(path.encode()).hexdigest()}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({DIGEST}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{path}'"
        )

    def forget(self) -> None:
        """Remove the index from the catalog; its files stay and can be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, digests: DataFrame) -> None:
        """Append the digests of a batch (doc_id, digest) that the index does not hold yet.

        The groups are stored first: Spark would otherwise move the anti join below the aggregate
        and shuffle every row of a large group."""
        groups = digests.groupBy("digest").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        )
        new = stored(groups, "digest_groups").join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        new.write.insertInto(self.table)

    def classify(self, digests: DataFrame) -> DataFrame:
        """Each (doc_id, digest) with the keep_id and group_size of its digest. The rows of a large
        group stay where they are. ``digests`` is a stored frame."""
        batch = digests.groupBy("digest").agg(F.count("*").alias("in_batch"))
        known = stored(batch.join(self.rows().hint("merge"), "digest"), "known_digests")
        return meet(digests, known, ["digest"], "in_batch").drop("in_batch")


def digests_of(docs: DataFrame) -> DataFrame:
    return texts(docs).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))


def label_copies(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Without an index a new one is made, so the documents are compared with each other only. With
    one, ``keep_id`` and ``group_size`` are those of the batch that brought the text first: later
    copies do not raise them, and rows of this batch that repeat an older text are not kept. Of a
    text whose ids are all missing all rows are kept, because no id tells them apart.
    """
    spark = docs.sparkSession
    digests = stored(digests_of(docs), "digests")
    own = index or DigestIndex(spark, scratch_path(spark, "digest_index"))
    own.add(digests)
    classified = own.classify(digests)
    if index is None:
        own.forget()
    return classified.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The documents that stay, with all their columns; a row that is repeated stays once."""
    kept = (
        label_copies(docs, index)
        .filter("kept")
        .select(F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_digest"))
        .distinct()
    )
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = docs.withColumns({"__kept_id": F.col("doc_id").cast("long"), "__kept_digest": digest})
    same = rows["__kept_id"].eqNullSafe(kept["__kept_id"]) & (
        rows["__kept_digest"] == kept["__kept_digest"]
    )
    return (
        rows.join(kept, same, "left_semi")
        .dropDuplicates(["__kept_id", "__kept_digest"])
        .select(*docs.columns)
    )
