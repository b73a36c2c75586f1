"""Readers. Every schema is given, so no extra pass over the files infers one."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sessionlab import schemas


def read_tsv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    header: bool = False,
    quote: str = '"',
) -> DataFrame:
    """Tab-separated text. ``quote=""`` keeps quote characters that belong to a name."""
    return (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("header", str(header).lower())
        .option("multiLine", "false")
        .option("quote", quote)
        .csv(path)
    )


def read_events(spark: SparkSession, path: str, *, quote: str = '"') -> DataFrame:
    """Raw play events, all columns as text."""
    return read_tsv(spark, path, schemas.PLAY_EVENT, quote=quote)


def read_events_typed(spark: SparkSession, path: str, *, quote: str = '"') -> DataFrame:
    """Raw play events with the time parsed while reading."""
    return read_tsv(spark, path, schemas.PLAY_EVENT_TYPED, quote=quote)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schemas.PROFILE)


def read_parquet(
    spark: SparkSession,
    *paths: str,
    merge_schema: bool = False,
    schema: StructType | str | None = None,
) -> DataFrame:
    """With a ``schema``, values that come from folder names have its types too. Without one Spark
    infers them, and a user ``007`` becomes the number 7."""
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    return (reader.schema(schema) if schema else reader).parquet(*paths)


def read_ranked_songs(
    spark: SparkSession,
    path: str,
    names: Mapping[str, str] | None = None,
    columns: Sequence[str] | None = None,
    file_columns: Sequence[str] | None = None,
) -> DataFrame:
    """A ranked result with a header line.

    ``columns`` are the wanted ones, by default all of a ranked result. ``names`` maps them to
    those in the file, and ``file_columns`` lists the columns of the file in order where it has
    others than the wanted ones. A wanted column that the list does not name raises an error, and
    so does, when the rows are read, a header that differs from the list. Values that do not cast
    become NULL.
    """
    names = names or {}
    fields = {f.name: f for f in schemas.RANKED_SONG}
    wanted = [fields[c] for c in columns or fields]
    in_file = list(file_columns or [names.get(f.name, f.name) for f in wanted])
    missing = [f.name for f in wanted if names.get(f.name, f.name) not in in_file]
    if missing:
        raise ValueError(f"{path} has no column for {missing}")
    text = (
        spark.read.schema(StructType([StructField(c, StringType()) for c in in_file]))
        .option("sep", "\t")
        .option("header", "true")
        .option("enforceSchema", "false")
        .csv(path)
    )
    return text.select(
        *[F.col(names.get(f.name, f.name)).try_cast(f.dataType).alias(f.name) for f in wanted]
    )


def inline_table(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """A small lookup table written in code."""
    return spark.createDataFrame(list(rows), schema)
