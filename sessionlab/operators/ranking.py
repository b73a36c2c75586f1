"""Track popularity and ranked lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.operators.sessions import (
    DEFAULT_GAP_MINUTES,
    DEFAULT_TOP_SESSIONS,
    plays_of,
    sessionize,
    top_sessions,
)

DEFAULT_TOP_SONGS = 10


def _song_order() -> list[Column]:
    return [
        F.desc("playCount"),
        F.desc("sessionCount"),
        F.desc("userCount"),
        F.asc("firstPlayed"),
        F.asc("artistName"),
        F.asc("trackName"),
    ]


def track_popularity(session_plays: DataFrame) -> DataFrame:
    """Plays, sessions and users of every track, and when it was first and last played.

    Plays are first reduced to one row per track and session. A session has one user, so counting
    these rows gives the sessions and only the users need a distinct count.
    """
    # The number says the same as the longer text of the id.
    number = "sessionNumber" if "sessionNumber" in session_plays.columns else "userSessionId"
    per_session = session_plays.groupBy("trackName", "artistName", "userId", number).agg(
        F.count("*").alias("plays"),
        F.min("timestamp").alias("firstPlayed"),
        F.max("timestamp").alias("lastPlayed"),
    )
    return per_session.groupBy("trackName", "artistName").agg(
        F.sum("plays").alias("playCount"),
        F.count("*").alias("sessionCount"),
        F.count_distinct("userId").alias("userCount"),
        F.min("firstPlayed").alias("firstPlayed"),
        F.max("lastPlayed").alias("lastPlayed"),
    )


def top_songs(popularity: DataFrame, limit: int = DEFAULT_TOP_SONGS) -> DataFrame:
    """The ranked list. Every column of the order counts, so equal plays still rank the same
    way on every run."""
    best = popularity.orderBy(*_song_order()).limit(limit)
    return best.select(
        F.row_number().over(Window.orderBy(*_song_order())).alias("rank"),
        "trackName",
        "artistName",
        "playCount",
        "sessionCount",
        "userCount",
    )


def top_songs_in_top_sessions(
    plays: DataFrame,
    *,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    sessions: int = DEFAULT_TOP_SESSIONS,
    songs: int = DEFAULT_TOP_SONGS,
) -> DataFrame:
    """The most played songs within the longest sessions."""
    chosen = top_sessions(sessionize(plays, gap_minutes), sessions)
    return top_songs(track_popularity(plays_of(plays, chosen, gap_minutes)), songs)


def ranking_metrics(popularity: DataFrame, ranked: DataFrame) -> DataFrame:
    """One row: all tracks, and the ranked ones."""
    best = ranked.agg(
        F.struct(
            F.sum("playCount").alias("total"), F.avg("playCount").alias("mean")
        ).alias("best")
    ).scalar()
    return popularity.agg(
        F.count("*").alias("totalUniqueTracks"),
        F.sum("playCount").alias("totalPlays"),
        F.avg("playCount").alias("avgPlaysPerTrack"),
        F.max("playCount").alias("maxPlaysForTrack"),
    ).select(
        "*",
        best["total"].alias("topSongsTotalPlays"),
        best["mean"].alias("avgPlaysTopSongs"),
    )


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """The first rows of each group, with their ``rank``. Spark cuts each group to ``limit`` rows
    before it shuffles them."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= limit)
