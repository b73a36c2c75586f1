"""Parquet files whose columns have grown apart, read as one table.

``mergeSchema`` adds columns but fails where one column has two types. Here the types of a column
are folded to one that holds all of its values: whole numbers widen, whole and decimal numbers
become doubles, a date beside a timestamp becomes a timestamp, and whatever has nothing else in
common becomes text. Files of one schema are read together, cast, and the groups are united; a
column that a group lacks is NULL there. Filters and column choices still reach every scan.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.sources.files import data_files

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def common_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """A type that holds the values of both. Texts of numbers and times are those of a cast."""
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    for family in (WHOLE, TIMES):
        if isinstance(left, family) and isinstance(right, family):
            return max(left, right, key=lambda t: family.index(type(t)))
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        if isinstance(left, T.DecimalType) and isinstance(right, T.DecimalType):
            scale = max(left.scale, right.scale)
            digits = max(left.precision - left.scale, right.precision - right.scale) + scale
            return T.DecimalType(min(digits, 38), scale)
        return T.DoubleType()
    return T.StringType()


def fold(schemas: Sequence[T.StructType]) -> T.StructType:
    """The columns of all schemas in the order in which they first appear, with folded types."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            known = types.get(field.name)
            types[field.name] = field.dataType if known is None else common_type(known, field.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def read_folded(spark: SparkSession, *paths: str, one_schema_per_folder: bool = False) -> DataFrame:
    """The files below ``paths`` as one table.

    The schema of every file comes from its footer, read on the driver. Where every folder was
    written by one job, ``one_schema_per_folder`` reads one footer per folder instead.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    schemas: dict[str, T.StructType] = {}
    by_folder: dict[str, T.StructType] = {}
    for file in sorted(f for path in paths for f in data_files(spark, path)):
        folder = file.rsplit("/", 1)[0]
        schema = by_folder.get(folder) if one_schema_per_folder else None
        if schema is None:
            schema = spark.read.parquet(file).schema
            by_folder[folder] = schema
        schemas[schema.json()] = schema
        groups[schema.json()].append(file)
    if not groups:
        raise ValueError(f"no files below {', '.join(paths)}")
    wanted = fold(list(schemas.values()))

    def part(key: str) -> DataFrame:
        own = {f.name for f in schemas[key]}
        rows = spark.read.schema(schemas[key]).parquet(*groups[key])
        return rows.select(
            *[
                (F.col(f"`{f.name}`") if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in wanted
            ]
        )

    return reduce(DataFrame.unionByName, [part(key) for key in groups])
