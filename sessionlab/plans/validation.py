"""Checks of stored results against recomputed ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlab.functions.numbers import mean
from sessionlab.operators.ranks import number_rows


def top_session_stats(top: DataFrame) -> DataFrame:
    return top.agg(
        F.count("*").alias("totalSessions"),
        F.avg("trackCount").alias("avgTracks"),
        F.min("trackCount").alias("minTracks"),
        F.max("trackCount").alias("maxTracks"),
        mean("durationMinutes").alias("avgDuration"),
        F.min("durationMinutes").alias("minDuration"),
        F.max("durationMinutes").alias("maxDuration"),
    )


def top_track_stats(ranked: DataFrame) -> DataFrame:
    return ranked.agg(
        F.count("*").alias("totalTracks"),
        F.avg("playCount").alias("avgPlays"),
        F.min("playCount").alias("minPlays"),
        F.max("playCount").alias("maxPlays"),
        F.sum("playCount").alias("totalPlays"),
    )


def artist_diversity(ranked: DataFrame, limit: int | None = None) -> DataFrame:
    """Which artists the ranked list consists of; all of them unless a limit is given."""
    artists = (
        ranked.groupBy("artistName")
        .agg(
            F.count("*").alias("trackCount"),
            F.sum("playCount").alias("totalPlays"),
            F.avg("rank").alias("avgRank"),
        )
        .orderBy(F.desc("trackCount"), F.desc("totalPlays"), "artistName")
    )
    return artists if limit is None else artists.limit(limit)


def recheck_ranks(ranked: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Add the rank by ``order`` and its difference to the stored one. The list may have any
    length: it is numbered in ranges."""
    return number_rows(ranked, order, "calculatedRank").withColumn(
        "rankDifference", F.col("rank") - F.col("calculatedRank")
    )


def rank_errors(rechecked: DataFrame) -> DataFrame:
    return rechecked.filter(F.col("rankDifference") != 0)


def compare_results(computed: DataFrame, stored: DataFrame) -> DataFrame:
    """Songs in both lists, with both ranks and play counts and whether they agree."""
    left = computed.select(F.col("rank").alias("computedRank"), "trackName", "artistName", "playCount")
    right = stored.select(
        F.col("rank").alias("storedRank"),
        F.col("trackName").alias("storedTrackName"),
        F.col("artistName").alias("storedArtistName"),
        F.col("playCount").alias("storedPlayCount"),
    )
    same_song = (F.col("trackName") == F.col("storedTrackName")) & (
        F.col("artistName") == F.col("storedArtistName")
    )
    agree = (F.col("computedRank") == F.col("storedRank")) & (
        F.col("playCount") == F.col("storedPlayCount")
    )
    return (
        left.join(right, same_song)
        .drop("storedTrackName", "storedArtistName")
        .withColumn("consistent", agree)
        .orderBy("computedRank")
    )


def missing_sessions(top: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sessions of the top list that are not among all sessions."""
    return top.select("userSessionId").distinct().join(sessions, "userSessionId", "left_anti")
