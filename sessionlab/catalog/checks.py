"""Data quality and consistency of results."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionlab.catalog.inputs import GAP
from sessionlab.catalog.oracle import big, r6
from sessionlab.catalog.registry import query
from sessionlab.catalog.storage import METRIC_ROWS, METRICS_SQL
from sessionlab.operators.ranking import top_songs_in_top_sessions
from sessionlab.operators.sessions import top_sessions
from sessionlab.plans import quality, validation


@query(
    "clean_metrics",
    f"""SELECT count(*) AS totalRecords, count(DISTINCT userId) AS uniqueUsers,
               min(timestamp) AS firstPlay, max(timestamp) AS lastPlay,
               {r6('count(*) / count(DISTINCT userId)')} AS avgTracksPerUser,
               (SELECT {r6('''count(*) FILTER (userId IS NOT NULL AND timestamp IS NOT NULL
                  AND artistName IS NOT NULL AND trackName IS NOT NULL) * 100 / count(*)''')}
                FROM raw_plays) AS qualityScore
        FROM silver""",
)
def _(t):
    return quality.clean_metrics(t.raw_plays, t.silver)


@query("dq_metrics", METRIC_ROWS)
def _(t):
    return quality.metric_table(quality.quality_counts(t.raw_plays))


@query(
    "dq_warnings",
    f"""WITH {METRICS_SQL}
        SELECT format('High percentage of missing track IDs: {{:.2f}}%', m * 100.0::DOUBLE / v)
                 AS warning,
               'Consider improving track ID matching or using fallback keys' AS recommendation
        FROM counts WHERE m * 100.0 / v > 20""",
)
def _(t):
    return quality.quality_warnings(quality.quality_counts(t.raw_plays), limit_pct=20.0)


@query(
    "dq_report",
    f"""WITH {METRICS_SQL}
        SELECT TIMESTAMP '2024-01-20' AS timestamp, 'plays' AS dataset, r AS rowsRead, v AS rowsValid,
               r - v AS rowsDropped, m AS missingTrackId, {r6('m * 100.0 / v')} AS pctMissingTrackId,
               format('High percentage of missing track IDs: {{:.2f}}%', m * 100.0::DOUBLE / v)
                 AS warnings,
               'Consider improving track ID matching or using fallback keys' AS recommendations
        FROM counts WHERE m * 100.0 / v > 20""",
)
def _(t):
    report = quality.quality_report(
        quality.quality_counts(t.raw_plays),
        "plays",
        limit_pct=20.0,
        as_of=dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc),
    )
    return report.select(
        "timestamp",
        "dataset",
        "metrics.*",
        F.array_join("warnings", "; ").alias("warnings"),
        F.array_join("recommendations", "; ").alias("recommendations"),
    )


@query(
    "dq_sanity_issues",
    """SELECT 'future_timestamps' AS issue, count(*) AS offending FROM id_plays
       WHERE timestamp > TIMESTAMP '2024-01-20'
       UNION ALL SELECT 'very_old_timestamps', count(*) FROM id_plays
       WHERE timestamp < TIMESTAMP '2024-01-03'
       UNION ALL SELECT 'suspicious_users', count(*) FROM (
         SELECT userId FROM id_plays GROUP BY userId HAVING count(*) > 80)""",
)
def _(t):
    # Limits inside the range of the data, so that every rule finds something.
    return quality.sanity_issues(
        t.id_plays,
        as_of=dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc),
        earliest="2024-01-03",
        max_user_plays=80,
    )


@query(
    "dq_empty_fields",
    """SELECT count(*) FILTER (coalesce(userId, '') = '') AS emptyUsers,
              count(*) FILTER (coalesce(artistName, '') = '') AS emptyArtists,
              count(*) FILTER (coalesce(trackName, '') = '') AS emptyTracks,
              (SELECT count(*) FROM id_plays) AS rowsKept FROM sanitized""",
)
def _(t):
    return quality.empty_fields(t.raw_plays)


DUPLICATES = """SELECT userId, timestamp, trackKey, count(*) AS copies FROM id_plays
GROUP BY ALL HAVING count(*) > 1"""


@query("dq_duplicates", DUPLICATES)
def _(t):
    return quality.duplicate_keys(t.id_plays)


@query(
    "dq_duplicate_totals",
    f"""SELECT count(*) AS duplicateKeys, {big('coalesce(sum(copies), 0)')} AS duplicatedRows
        FROM ({DUPLICATES})""",
)
def _(t):
    return quality.duplicate_totals(quality.duplicate_keys(t.id_plays))


@query(
    "top_list_stats",
    f"""SELECT 'sessions' AS list, count(*) AS entries, {r6('avg(trackCount)')} AS mean,
               min(trackCount) AS lowest, max(trackCount) AS highest FROM best_sessions
        UNION ALL SELECT 'songs', count(*), {r6('avg(playCount)')}, min(playCount), max(playCount)
        FROM best_songs""",
)
def _(t):
    sessions = validation.top_session_stats(top_sessions(t.sessions()))
    songs = validation.top_track_stats(top_songs_in_top_sessions(t.silver, gap_minutes=GAP))
    return sessions.select(
        F.lit("sessions").alias("list"),
        F.col("totalSessions").alias("entries"),
        F.col("avgTracks").alias("mean"),
        F.col("minTracks").alias("lowest"),
        F.col("maxTracks").alias("highest"),
    ).union(songs.select(F.lit("songs"), "totalTracks", "avgPlays", "minPlays", "maxPlays"))


@query(
    "top_list_durations",
    f"""SELECT {r6('avg(durationMinutes)')} AS avgDuration, {r6('min(durationMinutes)')}
               AS minDuration, {r6('max(durationMinutes)')} AS maxDuration FROM best_sessions""",
)
def _(t):
    return validation.top_session_stats(top_sessions(t.sessions())).select(
        "avgDuration", "minDuration", "maxDuration"
    )


@query(
    "top_list_artists",
    f"""SELECT artistName, count(*) AS trackCount, {big('sum(playCount)')} AS totalPlays,
               {r6('avg(rank)')} AS avgRank FROM best_songs GROUP BY artistName""",
)
def _(t):
    return validation.artist_diversity(top_songs_in_top_sessions(t.silver, gap_minutes=GAP))


@query(
    "validate_session_rank",
    """SELECT userSessionId, trackCount, rank, calculatedRank, rank - calculatedRank AS rankDifference
       FROM (SELECT *, row_number() OVER (ORDER BY trackCount DESC, durationMinutes DESC,
                         sessionStart, userId, sessionNumber) AS calculatedRank,
                       row_number() OVER (ORDER BY trackCount DESC, userSessionId) AS rank
             FROM best_sessions)""",
)
def _(t):
    # The stored ranks break ties by session id, so some of them differ from the rule's.
    best = top_sessions(t.sessions())
    stored = F.row_number().over(Window.orderBy(F.desc("trackCount"), "userSessionId"))
    order = [
        F.desc("trackCount"),
        F.desc("durationMinutes"),
        F.asc("sessionStart"),
        F.asc("userId"),
        F.asc("sessionNumber"),
    ]
    return validation.recheck_ranks(best.withColumn("rank", stored), order).select(
        "userSessionId", "trackCount", "rank", "calculatedRank", "rankDifference"
    )


@query(
    "validate_track_rank",
    """SELECT trackName, artistName, playCount, rank, calculatedRank,
              rank - calculatedRank AS rankDifference
       FROM (SELECT *, row_number() OVER (ORDER BY playCount DESC, sessionCount DESC,
                         userCount DESC, trackName, artistName) AS calculatedRank FROM best_songs)
       WHERE rank <> calculatedRank""",
)
def _(t):
    ranked = top_songs_in_top_sessions(t.silver, gap_minutes=GAP)
    order = [
        F.desc("playCount"),
        F.desc("sessionCount"),
        F.desc("userCount"),
        F.asc("trackName"),
        F.asc("artistName"),
    ]
    return validation.rank_errors(validation.recheck_ranks(ranked, order)).select(
        "trackName", "artistName", "playCount", "rank", "calculatedRank", "rankDifference"
    )
