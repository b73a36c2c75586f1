import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sessionlab import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_plays(spark):
    """Plays from (user, "HH:MM[:SS]" or datetime, track[, artist]) tuples."""

    def at(value):
        if isinstance(value, dt.datetime):
            return value
        parts = [int(p) for p in value.split(":")]
        return dt.datetime(2023, 1, 1, *parts)

    def make(rows):
        full = [
            (user, at(time), rest[0], rest[1] if len(rest) > 1 else "artist", None)
            for user, time, *rest in rows
        ]
        full = [(u, t, a, k, f"{a} - {k}") for u, t, k, a, _ in full]
        schema = (
            "userId string, timestamp timestamp_ntz, artistName string, trackName string, "
            "trackKey string"
        )
        return spark.createDataFrame(full, schema)

    return make
