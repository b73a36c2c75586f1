"""Explicit schemas of the files that are read; nothing is inferred."""

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _strings(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


# Raw play events: tab separated, no header, an empty field is a missing value.
PLAY_EVENT = _strings("userId", "timestamp", "artistId", "artistName", "trackId", "trackName")

# The same file with the time parsed by the reader; a bad value becomes NULL.
PLAY_EVENT_TYPED = StructType(
    [
        StructField(f.name, TimestampType() if f.name == "timestamp" else f.dataType)
        for f in PLAY_EVENT
    ]
)

PROFILE = StructType(
    [
        StructField("userId", StringType()),
        StructField("gender", StringType()),
        StructField("age", IntegerType()),
        StructField("country", StringType()),
        StructField("signup", StringType()),
    ]
)

RANKED_SONG = StructType(
    [
        StructField("rank", IntegerType()),
        StructField("trackName", StringType()),
        StructField("artistName", StringType()),
        StructField("playCount", LongType()),
        StructField("sessionCount", LongType()),
        StructField("userCount", LongType()),
    ]
)

METRIC = _strings("metric", "value")
