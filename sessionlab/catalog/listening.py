"""Sessions, song rankings and what sessions look like."""

from pyspark.sql import functions as F

from sessionlab.catalog.inputs import GAP
from sessionlab.catalog.oracle import cases, r6, rd
from sessionlab.catalog.registry import query
from sessionlab.operators import gaps, ranking
from sessionlab.operators import sessions as ops
from sessionlab.operators.ranks import number_in_groups
from sessionlab.operators.session_store import SessionStore
from sessionlab.plans import session_reports as reports
from sessionlab.sources.user_buckets import UserBuckets

SESSION_COLUMNS = """userId, userSessionId, trackCount, sessionStart, sessionEnd,
    CAST(durationMinutes AS DOUBLE) AS durationMinutes"""
COLUMNS = ("userId", "userSessionId", "trackCount", "sessionStart", "sessionEnd", "durationMinutes")


@query("sessionize", f"SELECT {SESSION_COLUMNS} FROM sessions_20")
def _(t):
    return t.sessions(ops.DEFAULT_GAP_MINUTES).select(*COLUMNS)


def _in_batches(t):
    """The plays in three batches: one half of every month, the other, and a tenth that comes late."""
    store = SessionStore(t.spark, t.scratch("session_store"), GAP)
    late = F.pmod(F.xxhash64("userId", "timestamp", "trackKey"), F.lit(10)) == 0
    number = F.when(late, 2).when(F.dayofmonth("timestamp") > 15, 1).otherwise(0)
    plays = t.silver.withColumn("number", number)
    for batch in range(3):
        store.add(plays.filter(F.col("number") == batch), batch)
    return store


@query("sessions_in_batches", f"SELECT {SESSION_COLUMNS} FROM sessions")
def _(t):
    return _in_batches(t).sessions().select(*COLUMNS)


@query(
    "session_edges",
    """SELECT userId, sessionNumber, trackCount, sessionStart, sessionEnd FROM sessions
       QUALIFY row_number() OVER (PARTITION BY userId ORDER BY sessionNumber DESC) = 1""",
)
def _(t):
    edges = _in_batches(t).edges()
    return edges.select("userId", "sessionNumber", "trackCount", "sessionStart", "sessionEnd")


@query("sessions_in_place", f"SELECT {SESSION_COLUMNS} FROM sessions")
def _(t):
    # Some users of these tables count as heavy.
    stored = UserBuckets(t.spark, t.scratch("by_user"), 8, heavy_plays=85, gap_minutes=GAP)
    return stored.write(t.silver).sessions().select(*COLUMNS)


@query(
    "rank_sessions_of_user",
    """SELECT userId, userSessionId, trackCount,
              row_number() OVER (PARTITION BY userId ORDER BY trackCount DESC, sessionNumber) AS rank
       FROM sessions""",
)
def _(t):
    ranked = number_in_groups(t.sessions(), ["userId"], [F.desc("trackCount"), F.asc("sessionNumber")])
    return ranked.select("userId", "userSessionId", "trackCount", "rank")


@query("session_aggregate", f"SELECT {SESSION_COLUMNS}, uniqueTracks FROM sessions")
def _(t):
    return t.track_sessions.select(*COLUMNS, "uniqueTracks")


@query("top_sessions", f"SELECT {SESSION_COLUMNS} FROM best_sessions")
def _(t):
    return ops.top_sessions(t.sessions()).select(*COLUMNS)


@query(
    "explode_tracks",
    """SELECT userId, concat(userId, '_', sessionNumber) AS userSessionId, trackName, artistName,
              timestamp, row_number() OVER (PARTITION BY userId, sessionNumber
                                            ORDER BY timestamp, trackName, artistName) - 1 AS position
       FROM session_plays""",
)
def _(t):
    # Short parts, so that sessions of these tables have several.
    return ops.explode_tracks(ops.nest_tracks(ops.assign_sessions(t.silver, GAP), block=2))


@query("track_popularity", "SELECT * FROM popularity")
def _(t):
    chosen = ops.top_sessions(t.sessions())
    return ranking.track_popularity(ops.plays_of(t.silver, chosen, GAP))


@query(
    "top_songs",
    """SELECT row_number() OVER (ORDER BY playCount DESC, sessionCount DESC, userCount DESC,
                firstPlayed, artistName, trackName) AS rank, trackName, artistName, playCount,
              sessionCount, userCount
       FROM (SELECT trackName, artistName, count(*) AS playCount,
                    count(DISTINCT concat(userId, '_', sessionNumber)) AS sessionCount,
                    count(DISTINCT userId) AS userCount, min(timestamp) AS firstPlayed
             FROM session_plays GROUP BY trackName, artistName) QUALIFY rank <= 25""",
)
def _(t):
    return ranking.top_songs(ranking.track_popularity(ops.assign_sessions(t.silver, GAP)), 25)


@query("flagship_top_songs", "SELECT * FROM best_songs")
def flagship(t):
    return ranking.top_songs_in_top_sessions(t.silver, gap_minutes=GAP)


@query(
    "session_metrics",
    f"""SELECT count(*) AS sessionCount, CAST(sum(trackCount) AS BIGINT) AS totalTracks,
               {r6('avg(trackCount)')} AS avgTracksPerSession, min(trackCount) AS minTracksInSession,
               max(trackCount) AS maxTracksInSession, {r6('avg(durationMinutes)')}
               AS avgSessionDuration FROM sessions""",
)
def _(t):
    return ops.session_metrics(t.sessions())


@query(
    "ranking_metrics",
    f"""SELECT count(*) AS totalUniqueTracks, CAST(sum(playCount) AS BIGINT) AS totalPlays,
               {r6('avg(playCount)')} AS avgPlaysPerTrack, max(playCount) AS maxPlaysForTrack,
               (SELECT CAST(sum(playCount) AS BIGINT) FROM best_songs) AS topSongsTotalPlays,
               (SELECT {r6('avg(playCount)')} FROM best_songs) AS avgPlaysTopSongs
        FROM popularity""",
)
def _(t):
    popularity = ranking.track_popularity(ops.plays_of(t.silver, ops.top_sessions(t.sessions()), GAP))
    return ranking.ranking_metrics(popularity, ranking.top_songs(popularity))


@query(
    "dq_session_checks",
    """SELECT count(*) AS totalSessions, count(*) FILTER (userId IS NULL OR userId = '') AS nullUserIds,
              count(*) FILTER (sessionStart IS NULL) AS nullStartTimes,
              count(*) FILTER (sessionEnd IS NULL) AS nullEndTimes,
              count(*) FILTER (trackCount <= 0) AS invalidTrackCounts,
              count(*) FILTER (sessionStart > sessionEnd) AS invalidTimeOrder FROM sessions""",
)
def _(t):
    return ops.session_checks(t.sessions())


@query(
    "check_chronology",
    """SELECT userId, count(*) AS rows, count(*) FILTER (timestamp < previous) AS stepsBack,
              count(*) FILTER (timestamp < previous) = 0 AS inOrder
       FROM (SELECT *, lag(timestamp) OVER (PARTITION BY userId ORDER BY hour(timestamp), seq)
                       AS previous FROM plays)
       GROUP BY userId""",
)
def _(t):
    # Read by hour of day, then event number: an order in which time does go back.
    position = F.hour("timestamp") * F.lit(10**13) + F.col("seq")
    return gaps.check_chronology(t.plays.withColumn("position", position), "userId", "position")


@query(
    "check_chronology_by_event",
    """SELECT userId, count(*) AS rows, count(*) FILTER (timestamp < previous) AS stepsBack,
              count(*) FILTER (timestamp < previous) = 0 AS inOrder
       FROM (SELECT *, lag(timestamp) OVER (PARTITION BY userId ORDER BY seq) AS previous FROM plays)
       GROUP BY userId""",
)
def _(t):
    return gaps.check_chronology(t.plays, "userId", "seq")


@query(
    "gap_stats",
    f"""SELECT userId, count(*) AS totalPlays, CAST(sum(isSessionBreak) AS BIGINT) AS breaks,
               CAST(sum(isSessionBreak) + 1 AS BIGINT) AS sessions,
               {r6('avg(gapSeconds / 60)')} AS avgGapMinutes,
               {r6('quantile_disc(gapSeconds / 60, 0.5)')} AS medianGapMinutes,
               {r6('count(*) / (sum(isSessionBreak) + 1)')} AS playsPerSession
        FROM gaps GROUP BY userId""",
)
def _(t):
    return gaps.gap_stats(t.silver, GAP)


@query(
    "gap_summary",
    f"""SELECT {r6('avg(breaks)')} AS avgBreaksPerUser, {r6('avg(breaks + 1)')} AS avgSessionsPerUser,
               {r6('avg(n / (breaks + 1))')} AS avgPlaysPerSession, {r6('avg(gap)')} AS avgGapBetweenPlays
        FROM (SELECT count(*) AS n, sum(isSessionBreak) AS breaks, avg(gapSeconds / 60) AS gap
              FROM gaps GROUP BY userId)""",
)
def _(t):
    return gaps.gap_summary(gaps.gap_stats(t.silver, GAP))


@query(
    "gap_distribution",
    f"""SELECT {cases([('gapSeconds <= 60', '≤1 min'), ('gapSeconds <= 300', '1-5 min'),
        ('gapSeconds <= 1200', '5-20 min'), ('gapSeconds <= 3600', '20-60 min'),
        ('gapSeconds <= 86400', '1-24 hours')], '>24 hours')} AS gapCategory, count(*) AS gapCount
        FROM gaps WHERE gapSeconds > 0 GROUP BY 1""",
)
def _(t):
    return gaps.gap_distribution(t.silver, GAP)


DURATION_CASES = cases(
    [
        ("durationMinutes <= 1", "Very Short (≤1min)"),
        ("durationMinutes <= 15", "Short (1-15min)"),
        ("durationMinutes <= 60", "Medium (15-60min)"),
        ("durationMinutes <= 180", "Long (1-3hrs)"),
    ],
    "Very Long (>3hrs)",
)


@query(
    "session_duration_buckets",
    f"""SELECT {DURATION_CASES} AS durationCategory, count(*) AS sessionCount,
               {rd('avg(durationMinutes)', 2)} AS avgDurationMin, {rd('avg(trackCount)', 2)} AS avgTracks
        FROM sessions GROUP BY 1""",
)
def _(t):
    return reports.duration_buckets(t.sessions())


@query(
    "top_session_duration_buckets",
    f"""SELECT {cases([('durationMinutes < 900', 'Short (<15h)'), ('durationMinutes < 1200', 'Medium (15-20h)'),
        ('durationMinutes < 1500', 'Long (20-25h)')], 'Very Long (>25h)')} AS durationCategory,
        count(*) AS sessionCount, {r6('avg(durationMinutes)')} AS avgDuration,
        {r6('avg(trackCount)')} AS avgTracks, {rd('count(*) * 100 / sum(count(*)) OVER ()', 2)} AS percentage
        FROM best_sessions GROUP BY 1""",
)
def _(t):
    rules = ((900, "Short (<15h)"), (1200, "Medium (15-20h)"), (1500, "Long (20-25h)"))
    return reports.top_duration_buckets(ops.top_sessions(t.sessions()), rules, "Very Long (>25h)")


@query(
    "session_outliers_simple",
    f"""SELECT count(*) AS totalSessions, count(*) FILTER (trackCount = 1) AS singleTrackSessions,
               {r6('count(*) FILTER (trackCount = 1) * 100.0::DOUBLE / count(*)')} AS singleTrackPct,
               count(*) FILTER (durationHours > 6) AS longSessions FROM sessions""",
)
def _(t):
    return reports.simple_outliers(t.sessions())


@query(
    "longest_sessions",
    """SELECT userId, userSessionId, CAST(durationHours AS DOUBLE) AS durationHours, trackCount,
              sessionStart FROM sessions WHERE durationHours > 6""",
)
def _(t):
    return reports.longest_sessions(t.sessions())


@query(
    "session_diversity",
    f"""SELECT diversityCategory, count(*) AS sessionCount, {rd('avg(trackCount)', 1)} AS avgTracks,
               {rd('avg(diversityRatio)', 3)} AS avgDiversityRatio FROM diverse GROUP BY 1""",
)
def _(t):
    return reports.diversity_summary(reports.with_diversity(t.track_sessions))


@query(
    "session_repetition",
    f"""SELECT diversityCategory, {rd('avg(repetitionsPerTrack)', 2)} AS avgRepetitions,
               CAST(min(repetitionsPerTrack) AS DOUBLE) AS minRepetitions,
               CAST(max(repetitionsPerTrack) AS DOUBLE) AS maxRepetitions
        FROM diverse GROUP BY diversityCategory""",
)
def _(t):
    return reports.repetition_summary(reports.with_diversity(t.track_sessions))


@query(
    "session_extreme_repetition",
    """SELECT userSessionId, userId, trackCount, uniqueTracks,
              CAST(diversityRatio AS DOUBLE) AS diversityRatio
       FROM diverse WHERE trackCount > 3 AND diversityRatio < 0.9""",
)
def _(t):
    return reports.extreme_repetition(
        reports.with_diversity(t.track_sessions), min_tracks=3, max_ratio=0.9
    )


@query(
    "session_most_diverse",
    """SELECT userSessionId, userId, trackCount, uniqueTracks FROM diverse
       WHERE diversityRatio = 1 AND trackCount > 5""",
)
def _(t):
    return reports.most_diverse(reports.with_diversity(t.track_sessions), min_tracks=5)


ANOMALIES = cases(
    [
        ("durationHours > 12", "Extremely Long Duration"),
        ("trackCount > 5", "Extremely High Track Count"),
        ("durationMinutes = 0 AND trackCount > 1", "Zero Duration Multi-Track"),
        ("trackCount > 3", "Potential Repeat Loop"),
    ],
    "Normal",
)


@query(
    "session_anomalies",
    f"""SELECT anomaly, count(*) AS sessionCount, count(DISTINCT userId) AS affectedUsers
        FROM (SELECT *, {ANOMALIES} AS anomaly FROM sessions) WHERE anomaly <> 'Normal'
        GROUP BY anomaly""",
)
def _(t):
    return reports.anomaly_summary(reports.with_anomaly(t.sessions(), max_tracks=5, loop_tracks=3))


@query(
    "user_features",
    """SELECT userId, CAST(avgTracksPerSession AS DOUBLE) AS avgTracksPerSession,
              CAST(avgDurationMinutes AS DOUBLE) AS avgDurationMinutes,
              CAST(avgDiversityRatio AS DOUBLE) AS avgDiversityRatio,
              CAST(avgTracksPerMinute AS DOUBLE) AS avgTracksPerMinute, sessionCount
       FROM user_features""",
)
def _(t):
    return _features(t)


def _features(t):
    return reports.user_features(reports.session_features(reports.with_diversity(t.track_sessions)))


@query(
    "feature_correlations",
    f"""SELECT {r6('corr(avgTracksPerSession, avgDurationMinutes)')} AS tracksVsDuration,
               {r6('corr(avgTracksPerSession, avgDiversityRatio)')} AS tracksVsDiversity
        FROM user_features""",
)
def _(t):
    return reports.feature_correlations(_features(t))


FEATURES = (
    "avgTracksPerSession", "avgDurationMinutes", "avgDiversityRatio", "avgTracksPerMinute", "sessionCount",
)


@query(
    "feature_correlation_matrix",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS leftFeature, '{b}' AS rightFeature, count(*) AS users,
                   {r6(f'corr({a}, {b})')} AS correlation FROM user_features"""
        for i, a in enumerate(FEATURES)
        for b in FEATURES[i + 1 :]
    ),
)
def _(t):
    return reports.correlation_matrix(_features(t), FEATURES)


@query(
    "behaviour_patterns",
    f"""SELECT {cases([('avgTracksPerMinute > 0.02', 'Fast Listener'),
        ('avgDiversityRatio > 0.999', 'Explorer'), ('avgDiversityRatio < 0.99', 'Repeater'),
        ('avgDurationMinutes > 160', 'Marathon Listener')], 'Balanced Listener')} AS behaviorPattern,
        count(*) AS userCount, {rd('avg(sessionCount)', 0)} AS avgSessions,
        {rd('avg(avgTracksPerSession)', 1)} AS avgTracks
        FROM user_features GROUP BY 1""",
)
def _(t):
    labelled = reports.with_behaviour(
        _features(t), fast=0.02, explorer=0.999, repeater=0.99, marathon=160.0
    )
    return reports.behaviour_patterns(labelled)
