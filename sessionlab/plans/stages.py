"""The batch jobs: raw events → plays → sessions → ranked songs, each layer stored as files."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sessionlab.config import JobConfig
from sessionlab.operators.cleaning import clean_events
from sessionlab.operators.layout import by_user
from sessionlab.operators.ranking import ranking_metrics, top_songs, track_popularity
from sessionlab.operators.session_store import SessionStore
from sessionlab.operators.sessions import (
    explode_tracks,
    nest_tracks,
    plays_of,
    session_metrics,
    sessionize,
    top_sessions,
)
from sessionlab.plans.quality import clean_metrics, completeness, completeness_counts
from sessionlab.session import use_utc
from sessionlab.sources.readers import read_events, read_parquet
from sessionlab.sources.user_buckets import UserBuckets
from sessionlab.sources.writers import write_parquet, write_single_tsv

log = logging.getLogger(__name__)

PLAYS = ("silver", "listening-events-cleaned.parquet")
SESSIONS = ("silver", "user-sessions.parquet")
TOP_SESSIONS = ("gold", "top-sessions.parquet")
TOP_TRACKS = ("gold", "top-session-tracks.parquet")
TOP_SONGS = ("results", "top_songs.tsv")
PLAYS_BY_USER = ("silver", "plays-by-user")
PLAYS_BY_BATCH = ("silver", "plays-by-batch")
SESSION_STORE = ("silver", "session-store")


def plays_by_user(spark: SparkSession, config: JobConfig) -> UserBuckets:
    return UserBuckets(
        spark,
        config.output(*PLAYS_BY_USER),
        config.user_buckets,
        gap_minutes=config.session_gap_minutes,
    )


def clean(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Store the cleaned plays; returns their metrics, computed from the stored files. The raw
    file is read once: its rows are counted while they are cleaned. With ``user_buckets`` the plays
    are stored a second time, by user."""
    raw = read_events(spark, config.events_path)
    seen = Observation("raw events")
    observed = raw.observe(seen, *completeness_counts())
    path = write_parquet(by_user(clean_events(observed)), config.output(*PLAYS))
    plays = read_parquet(spark, path)
    if config.user_buckets:
        plays_by_user(spark, config).write(plays)
    return clean_metrics(completeness(spark, seen.get), plays)


def analyze_sessions(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Store all sessions, the longest ones and the tracks of these; returns session metrics."""
    gap = config.session_gap_minutes
    plays = read_parquet(spark, config.output(*PLAYS))
    found = plays_by_user(spark, config).sessions() if config.user_buckets else sessionize(plays, gap)
    stored = write_parquet(found, config.output(*SESSIONS))
    sessions = read_parquet(spark, stored)

    best = top_sessions(sessions, config.top_sessions)
    gold = write_parquet(best, config.output(*TOP_SESSIONS))
    tracks = nest_tracks(plays_of(plays, read_parquet(spark, gold), gap))
    write_parquet(tracks, config.output(*TOP_TRACKS))
    return session_metrics(sessions)


def rank_songs(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Store the ranked songs as one TSV file; returns the ranking metrics."""
    tracks = explode_tracks(read_parquet(spark, config.output(*TOP_TRACKS)))
    popularity = track_popularity(tracks)
    ranked = top_songs(popularity, config.top_songs)
    write_single_tsv(ranked, config.output(*TOP_SONGS))
    return ranking_metrics(popularity, ranked)


def session_store(spark: SparkSession, config: JobConfig) -> SessionStore:
    return SessionStore(spark, config.output(*SESSION_STORE), config.session_gap_minutes)


def add_batch(spark: SparkSession, config: JobConfig, batch: int) -> SessionStore:
    """Clean the raw events of ``config.input_path`` as the next batch and bring the sessions up to
    date; batch numbers rise. The store then holds what one run over all batches would find.

    A play that an earlier batch brought too is dropped: of the plays stored before, only those in
    the time range of the new ones are read. A batch that is added again replaces its plays and
    leaves complete sessions alone.
    """
    use_utc(spark)
    key = ["userId", "timestamp", "trackKey"]
    folder, store = config.output(*PLAYS_BY_BATCH), session_store(spark, config)
    if batch in store.batches():
        return store
    new = clean_events(read_events(spark, config.events_path))
    earlier = [f"{folder}/batch={b}" for b in store.batches()]
    if earlier:
        span = new.agg(F.min("timestamp"), F.max("timestamp")).first()
        if span[0] is not None:
            before = spark.read.parquet(*earlier).filter(F.col("timestamp").between(*map(F.lit, span)))
            new = new.join(before.select(key), key, "left_anti")
    path = write_parquet(by_user(new), f"{folder}/batch={batch}")
    store.add(read_parquet(spark, path), batch)
    return store


STAGES: dict[str, Callable[[SparkSession, JobConfig], DataFrame]] = {
    "data-cleaning": clean,
    "session-analysis": analyze_sessions,
    "ranking": rank_songs,
}


def run(spark: SparkSession, config: JobConfig, stage: str = "complete") -> dict[str, DataFrame]:
    """Run one stage, or all of them in order for ``complete`` and any other name.

    Returns the metrics of each stage that ran. The first failure ends the run.
    """
    use_utc(spark)
    chosen = {stage: STAGES[stage]} if stage in STAGES else STAGES
    metrics = {}
    for name, job in chosen.items():
        log.info("stage %s", name)
        metrics[name] = job(spark, config)
    return metrics
