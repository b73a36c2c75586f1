"""Listening-log analytics on Spark: cleaning, sessions, rankings and reports."""

from sessionlab.config import JobConfig
from sessionlab.session import build_session

__all__ = ["JobConfig", "build_session"]
