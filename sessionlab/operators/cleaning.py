"""Row rules for play events, and the full clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.functions.keys import NAME_SEPARATOR, has_value, mbid_key, name_key
from sessionlab.functions.text import sanitize
from sessionlab.functions.times import parse_event_time

REQUIRED = ("userId", "timestamp", "artistName", "trackName")
NAMES = ("userId", "artistName", "trackName")


def require_fields(events: DataFrame, columns: tuple[str, ...] = REQUIRED) -> DataFrame:
    for name in columns:
        events = events.filter(F.col(name).isNotNull())
    return events


def require_text(events: DataFrame, columns: tuple[str, ...] = ("artistName", "trackName")) -> DataFrame:
    """Keep rows whose text columns are neither NULL nor empty."""
    for name in columns:
        events = events.filter(F.col(name) != "")
    return events


def parse_times(events: DataFrame, *, keep_invalid: bool = False) -> DataFrame:
    parsed = events.withColumn("timestamp", parse_event_time("timestamp"))
    return parsed if keep_invalid else parsed.filter(F.col("timestamp").isNotNull())


def sanitize_names(events: DataFrame, columns: tuple[str, ...] = NAMES) -> DataFrame:
    return events.withColumns({name: sanitize(name) for name in columns})


def drop_duplicate_plays(events: DataFrame, *, exact: bool = False) -> DataFrame:
    """One row per user, time and track.

    The track is the name key ``artist - track``. The key does not always tell two tracks apart
    ("A - B" by "C" against "B - C" by "A"); of such rows the one with the shortest artist name
    stays. ``exact`` compares the two names themselves instead.

    The key determines the names once the length of the artist name is known, so the aggregate
    carries that one integer: a hash aggregate that combines copies before the shuffle and moves
    each name once.
    """
    if exact:
        rows = events.select("userId", "timestamp", "artistName", "trackName").distinct()
        return rows.withColumn("trackKey", name_key())
    keyed = events.select(
        "userId", "timestamp", name_key().alias("trackKey"), F.length("artistName").alias("artistLength")
    )
    kept = keyed.groupBy("userId", "timestamp", "trackKey").agg(
        F.min("artistLength").alias("artistLength")
    )
    key, artist_length = F.col("trackKey"), F.col("artistLength")
    return kept.select(
        "userId",
        "timestamp",
        F.substring(key, F.lit(1), artist_length).alias("artistName"),
        F.substring(key, artist_length + len(NAME_SEPARATOR) + 1, F.length(key)).alias("trackName"),
        "trackKey",
    )


def clean_events(events: DataFrame, *, exact: bool = False) -> DataFrame:
    """Raw events to plays: required fields, valid time, names not empty, no copies.

    The empty-name rule runs before the copies are dropped, so that it filters at the scan and an
    unusable row never stands in for a usable one. It runs once more on the result, where it costs
    nothing and makes every reader need the names: two readers of different columns then have the
    same shuffle in their plans and Spark runs it once.
    """
    valid = parse_times(require_text(require_fields(events)))
    return require_text(drop_duplicate_plays(valid, exact=exact))


def normalize_events(
    events: DataFrame, *, sanitize_first: bool = True, drop_empty: bool = True
) -> DataFrame:
    """Raw events to plays with all identifiers and an id-based ``trackKey``; copies stay.

    ``sanitize_first=False`` builds the key from the names as read.
    """
    parsed = parse_times(events)
    if sanitize_first:
        rows = sanitize_names(parsed).withColumn("trackKey", mbid_key())
    else:
        rows = sanitize_names(parsed.withColumn("trackKey", mbid_key()))
    return require_text(rows, NAMES) if drop_empty else rows


def missing(column: str):
    return ~has_value(column)
