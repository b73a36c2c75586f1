"""Query name → Spark function and SQL text."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.catalog.inputs import Inputs
from sessionlab.catalog.oracle import with_tables

AREAS = ("storage", "rows", "relational", "listening", "time_of_play", "people", "content", "checks", "rollups")


@dataclass(frozen=True)
class Entry:
    build: Callable[[Inputs], DataFrame]
    sql: str | None


_entries: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function ``Inputs -> DataFrame``. Without ``sql`` only the rows are checked."""

    def register(build: Callable[[Inputs], DataFrame]) -> Callable:
        if name in _entries:
            raise ValueError(f"query {name} is registered twice")
        _entries[name] = Entry(build, sql)
        return build

    return register


def _plain_types(df: DataFrame) -> DataFrame:
    """Types that compare across engines: doubles with six digits, timestamps without a zone."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind == "double" or kind.startswith("decimal"):
            column = F.round(column.cast("double"), 6)
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(name))
    return df.select(*columns)


def _load() -> dict[str, Entry]:
    for area in AREAS:
        importlib.import_module(f"sessionlab.catalog.{area}")
    return _entries


def _runner(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _plain_types(entry.build(Inputs(spark, folder)))


def load_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(entry) for name, entry in _load().items()}


def load_sql() -> dict[str, str]:
    return {name: with_tables(entry.sql) for name, entry in _load().items() if entry.sql}
