"""Track identity and identifier checks, as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators and identifier format that results must agree on.
NAME_SEPARATOR = " - "
FALLBACK_SEPARATOR = " — "
UNKNOWN = "?"
MBID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def has_value(name: str) -> Column:
    """True for a non-empty string, false (never NULL) otherwise."""
    return F.coalesce(F.col(name) != "", F.lit(False))


def name_key(artist: str = "artistName", track: str = "trackName") -> Column:
    """``artist - track``; NULL when either side is NULL."""
    return F.concat(F.col(artist), F.lit(NAME_SEPARATOR), F.col(track))


def mbid_key(track_id: str = "trackId", artist: str = "artistName", track: str = "trackName") -> Column:
    """The track id where there is one, else both names with ``?`` for a missing name."""
    names = [F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in (artist, track)]
    return F.when(has_value(track_id), F.col(track_id)).otherwise(
        F.concat_ws(FALLBACK_SEPARATOR, *names)
    )


def is_mbid(name: str) -> Column:
    return F.col(name).rlike(MBID_PATTERN)
