"""Settings of the batch jobs."""

from __future__ import annotations

import logging
import os
from collections.abc import Mapping
from dataclasses import dataclass

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class JobConfig:
    """Parameters shared by the cleaning, session and ranking jobs."""

    session_gap_minutes: int = 20
    top_sessions: int = 50
    top_songs: int = 10
    input_path: str = "data/input"
    output_path: str = "data/output"
    events_file: str = "userid-timestamp-artid-artname-traid-traname.tsv"
    # With buckets the cleaned plays are also stored by user, and sessions are cut from there.
    user_buckets: int = 0

    def __post_init__(self) -> None:
        for name in ("session_gap_minutes", "top_sessions", "top_songs"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        if self.user_buckets < 0:
            raise ValueError("user_buckets must not be negative")
        for name in ("input_path", "output_path"):
            if not getattr(self, name):
                raise ValueError(f"{name} must not be empty")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JobConfig:
        """Read SESSION_GAP_MINUTES, TOP_SESSIONS, TOP_SONGS, USER_BUCKETS, INPUT_PATH and OUTPUT_PATH.

        A value that is not an integer falls back to the default.
        """
        env = os.environ if env is None else env

        def integer(name: str, default: int) -> int:
            text = env.get(name)
            if text is None:
                return default
            try:
                return int(text)
            except ValueError:
                log.warning("%s=%r is not an integer, using %d", name, text, default)
                return default

        return cls(
            session_gap_minutes=integer("SESSION_GAP_MINUTES", cls.session_gap_minutes),
            top_sessions=integer("TOP_SESSIONS", cls.top_sessions),
            top_songs=integer("TOP_SONGS", cls.top_songs),
            user_buckets=integer("USER_BUCKETS", cls.user_buckets),
            input_path=env.get("INPUT_PATH", cls.input_path),
            output_path=env.get("OUTPUT_PATH", cls.output_path),
        )

    @property
    def events_path(self) -> str:
        return f"{self.input_path}/{self.events_file}"

    def output(self, layer: str, name: str) -> str:
        return f"{self.output_path}/{layer}/{name}"
