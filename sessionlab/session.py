"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# UTC makes the date parts of an event independent of where the job runs. AQE sizes the shuffle
# partitions from the data and splits the skewed ones, so no partition count is fixed here. The
# last two save time when many different queries are built in one session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "sessionlab", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin a session that was built elsewhere to UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_run: ContextVar[str | None] = ContextVar("scratch folder of the run", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or the warehouse where it is
    not set. A path without a scheme belongs to the default file system, as everywhere in Spark."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/sessionlab"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`scratch_root`, within a :func:`scratch_run` below its folder."""
    root = _run.get() or scratch_root(spark)
    return f"{root}/{uuid.uuid4().hex}/{name}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """A folder for the intermediate tables of a job, removed when the block ends, however it ends.

    Frames are read when they are used, so a result must be written elsewhere inside the block: to a
    path of the job, or to one taken from :func:`scratch_path` before the block."""
    folder = f"{_run.get() or scratch_root(spark)}/run_{uuid.uuid4().hex}"
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
