"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, *, partition_by: tuple[str, ...] = ()) -> str:
    """Snappy parquet; replaces what is at ``path``."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_user_partitioned(
    df: DataFrame, path: str, user: str = "userId", *, folders: int | None = None
) -> str:
    """One folder per user or, with ``folders``, that many folders by the user's hash.

    A folder per user suits few users; millions of folders are slow to list, and then the column
    ``userFolder`` tells where a user lies. Rebalancing first keeps the number of files near one
    per folder, while AQE still splits a folder that is larger than the advisory partition size
    over several tasks. Read a folder per user with a schema: see ``readers.read_parquet``.
    """
    if folders is None:
        return write_parquet(df.hint("rebalance", user), path, partition_by=(user,))
    hashed = df.withColumn("userFolder", user_folder(user, folders))
    return write_parquet(hashed.hint("rebalance", "userFolder"), path, partition_by=("userFolder",))


def user_folder(user: str, folders: int) -> Column:
    """The number of the folder that holds a user."""
    return F.pmod(F.xxhash64(user), F.lit(folders)).cast("int")


def write_user_bucketed(df: DataFrame, table: str, buckets: int, *, path: str | None = None) -> str:
    """A table bucketed and sorted by user, so that later per-user work needs no exchange."""
    writer = (
        df.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, "userId")
        .sortBy("userId", "timestamp")
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return table


def write_text_table(
    df: DataFrame, path: str, *, sep: str = "\t", header: bool = False, quote: str = '"'
) -> str:
    """Delimited text, one file per partition.

    Blanks around a value are kept. Missing and empty values are both written as nothing between
    two separators, the form in which raw event files come.
    """
    (
        df.write.mode("overwrite")
        .option("sep", sep)
        .option("header", str(header).lower())
        .option("quote", quote)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
    return path


def write_single_tsv(df: DataFrame, path: str) -> str:
    """One tab-separated file with a header, under exactly the name ``path``.

    For small results such as a ranking: the rows pass through one task. The file is written to
    a folder next to the target and then renamed by the file system of that path, so it works on
    any Hadoop file system. An older result moves aside first and comes back if the rename fails;
    the staging folder goes in any case.
    """
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, staging, aside = (hadoop.Path(path + end) for end in ("", ".staging", ".previous"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        write_text_table(df.coalesce(1), f"{path}.staging", header=True)
        parts = [s.getPath() for s in fs.globStatus(hadoop.Path(staging, "part-*"))]
        if len(parts) != 1:
            raise RuntimeError(f"expected one part file in {path}.staging, found {len(parts)}")
        replaces = fs.exists(target)
        if replaces:
            fs.delete(aside, True)
            if not fs.rename(target, aside):
                raise RuntimeError(f"could not move the older {path} aside")
        if not fs.rename(parts[0], target):
            if replaces:
                fs.rename(aside, target)
            raise RuntimeError(f"could not rename {parts[0]} to {path}")
        fs.delete(aside, True)
    finally:
        fs.delete(staging, True)
    return path


def write_metrics_csv(metrics: DataFrame, path: str) -> str:
    """The long metric table as comma-separated text with a header."""
    return write_text_table(metrics.coalesce(1), path, sep=",", header=True)
