"""Joins, aggregates, windows and orderings, one operator per query."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionlab.catalog.inputs import GAP, REFERENCE_USER
from sessionlab.catalog.oracle import cases, r6, rd
from sessionlab.catalog.registry import query
from sessionlab.functions import buckets
from sessionlab.functions.keys import has_value
from sessionlab.functions.numbers import correlation
from sessionlab.operators import gaps, ranking, shares
from sessionlab.operators.sessions import assign_sessions, top_sessions
from sessionlab.plans import profiles, session_reports, users, validation
from sessionlab.sources import readers, writers


@query(
    "join_profile_inner",
    """SELECT seq, userId, artistName, gender, country FROM plays JOIN profiles USING (userId)""",
)
def _(t):
    return profiles.enrich(t.plays, t.profiles, "inner").select(
        "seq", "userId", "artistName", "gender", "country"
    )


@query(
    "join_profile_left",
    """SELECT seq, userId, gender, country FROM plays
       LEFT JOIN (SELECT * FROM profiles WHERE gender IS NOT NULL) USING (userId)""",
)
def _(t):
    known = t.profiles.filter(F.col("gender").isNotNull())
    return profiles.enrich(t.plays, known).select("seq", "userId", "gender", "country")


@query(
    "join_lineage_anti",
    """SELECT userSessionId FROM best_sessions
       WHERE userSessionId NOT IN (SELECT userSessionId FROM sessions_720)""",
)
def _(t):
    return validation.missing_sessions(top_sessions(t.sessions()), t.sessions(720))


@query(
    "join_users_semi",
    """SELECT userId, timestamp, trackKey FROM silver
       WHERE userId IN (SELECT userId FROM best_sessions)""",
)
def _(t):
    chosen = top_sessions(t.sessions()).select("userId").distinct()
    return t.silver.join(chosen, "userId", "left_semi").select("userId", "timestamp", "trackKey")


@query(
    "join_result_compare",
    """SELECT b.rank AS computedRank, b.trackName, b.artistName, b.playCount,
              s.rank AS storedRank, s.playCount AS storedPlayCount,
              b.rank = s.rank AND b.playCount = s.playCount AS consistent
       FROM best_songs b JOIN (
         SELECT row_number() OVER (ORDER BY playCount DESC, sessionCount DESC, userCount DESC,
                  firstPlayed, artistName, trackName) AS rank, trackName, artistName, playCount
         FROM (SELECT trackName, artistName, count(*) AS playCount,
                 count(DISTINCT concat(userId, '_', sessionNumber)) AS sessionCount,
                 count(DISTINCT userId) AS userCount, min(timestamp) AS firstPlayed
               FROM session_plays WHERE concat(userId, '_', sessionNumber) IN (
                 SELECT userSessionId FROM sessions ORDER BY trackCount DESC, durationMinutes DESC,
                   sessionStart, userId, sessionNumber LIMIT 300)
               GROUP BY trackName, artistName) QUALIFY rank <= 200) s
       USING (trackName, artistName)""",
)
def _(t):
    # The stored list comes from more sessions, so ranks and counts differ.
    earlier = ranking.top_songs_in_top_sessions(t.silver, gap_minutes=GAP, sessions=300, songs=200)
    path = writers.write_single_tsv(earlier, t.scratch("stored.tsv"))
    current = ranking.top_songs_in_top_sessions(t.silver, gap_minutes=GAP)
    return validation.compare_results(current, readers.read_ranked_songs(t.spark, path))


@query(
    "join_session_features",
    """SELECT s.userSessionId, s.userId, s.trackCount, CAST(s.durationMinutes AS DOUBLE)
              AS durationMinutes, CAST(diversityRatio AS DOUBLE) AS diversityRatio
       FROM sessions s JOIN diverse d USING (userSessionId)""",
)
def _(t):
    ratios = session_reports.with_diversity(t.track_sessions).select("userSessionId", "diversityRatio")
    return (
        t.sessions()
        .join(ratios, "userSessionId")
        .select("userSessionId", "userId", "trackCount", "durationMinutes", "diversityRatio")
    )


@query(
    "join_user_segments",
    """SELECT s.userId, s.totalSessions, s.totalTracks, userType
       FROM user_stats s JOIN typed_users USING (userId)""",
)
def _(t):
    types = t.typed_users.select("userId", "userType")
    return t.user_stats.join(types, "userId").select(
        "userId", "totalSessions", "totalTracks", "userType"
    )


@query("agg_count", "SELECT artistName, count(*) AS plays FROM raw_plays GROUP BY artistName")
def _(t):
    return t.raw_plays.groupBy("artistName").agg(F.count("*").alias("plays"))


@query(
    "agg_global_counts",
    """SELECT count(*) AS plays, count(DISTINCT userId) AS users,
              count(DISTINCT artistName) AS artists FROM plays""",
)
def _(t):
    per_user = t.plays.groupBy("userId", "artistName").agg(F.count("*").alias("plays"))
    return per_user.agg(
        F.sum("plays").alias("plays"),
        F.count_distinct("userId").alias("users"),
        F.count_distinct("artistName").alias("artists"),
    )


@query(
    "agg_count_distinct",
    """SELECT userId, count(*) AS plays, count(DISTINCT trackKey) AS tracks,
              count(DISTINCT artistName) AS artists FROM silver GROUP BY userId""",
)
def _(t):
    return (
        users.listening(t.silver)
        .groupBy("userId")
        .agg(
            F.sum("plays").alias("plays"),
            F.count_distinct("trackKey").alias("tracks"),
            F.count_distinct("artistName").alias("artists"),
        )
    )


@query(
    "agg_stats",
    f"""SELECT event_type, min(value) AS lowest, max(value) AS highest, {r6('avg(value)')} AS mean,
               {r6('sum(value)')} AS total FROM events GROUP BY event_type""",
)
def _(t):
    value = F.col("value")
    return (
        t.table("events")
        .groupBy("event_type")
        .agg(
            F.min(value).alias("lowest"),
            F.max(value).alias("highest"),
            F.avg(value).alias("mean"),
            F.sum(value).alias("total"),
        )
    )


@query(
    "agg_collect_set",
    """SELECT userId, string_agg(day, ',' ORDER BY day) AS weekdays
       FROM (SELECT DISTINCT userId, CAST(dayofweek(timestamp) + 1 AS VARCHAR) AS day FROM plays)
       GROUP BY userId""",
)
def _(t):
    # At most seven values per user, so the set has a fixed bound.
    days = F.array_sort(F.collect_set(F.dayofweek("timestamp").cast("string")))
    return t.plays.groupBy("userId").agg(F.array_join(days, ",").alias("weekdays"))


@query(
    "agg_conditional",
    """SELECT userId, count(*) FILTER (trackId IS NULL) AS withoutTrackId,
              count(*) FILTER (hour(timestamp) < 6) AS nightPlays,
              CAST(sum(CASE WHEN artistName = 'artist click' THEN 2 ELSE 1 END) AS BIGINT) AS weight
       FROM plays GROUP BY userId""",
)
def _(t):
    return t.plays.groupBy("userId").agg(
        F.count_if(F.col("trackId").isNull()).alias("withoutTrackId"),
        F.count_if(F.hour("timestamp") < 6).alias("nightPlays"),
        F.sum(F.when(F.col("artistName") == "artist click", 2).otherwise(1)).alias("weight"),
    )


@query(
    "agg_rate",
    f"""SELECT artistName, {r6('avg(CASE WHEN trackId IS NOT NULL THEN 1 ELSE 0 END) * 100')}
               AS trackIdPct FROM plays GROUP BY artistName""",
)
def _(t):
    flag = has_value("trackId").cast("int")
    return t.plays.groupBy("artistName").agg((F.avg(flag) * 100).alias("trackIdPct"))


@query(
    "agg_stddev",
    f"SELECT {r6('stddev(totalPlays)')} AS deviation FROM activity",
)
def _(t):
    return t.activity.agg(F.stddev("totalPlays").alias("deviation"))


@query(
    "agg_percentiles",
    "SELECT "
    + ", ".join(
        f"CAST(quantile_disc(durationMinutes, {p}) AS DOUBLE) AS p{round(p * 100)}"
        for p in session_reports.DURATION_PERCENTILES
    )
    + " FROM sessions",
)
def _(t):
    return session_reports.duration_percentiles(t.sessions())


@query(
    "agg_corr",
    f"""SELECT {r6('corr(totalPlays, uniqueTracks)')} AS playsVsTracks,
               {r6('corr(totalPlays, listeningSpanDays)')} AS playsVsSpan FROM activity""",
)
def _(t):
    return t.activity.agg(
        correlation("totalPlays", "uniqueTracks").alias("playsVsTracks"),
        correlation("totalPlays", "listeningSpanDays").alias("playsVsSpan"),
    )


@query(
    "agg_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, {r6(f'avg({c})')} AS mean,
            {r6(f'stddev({c})')} AS stddev, {r6(f'min({c})')} AS min, {r6(f'max({c})')} AS max
            FROM sessions"""
        for c in ("trackCount", "durationMinutes")
    ),
)
def _(t):
    return session_reports.describe(t.sessions(), "trackCount", "durationMinutes")


@query(
    "agg_having",
    """SELECT userId, trackName, count(*) AS plays FROM plays GROUP BY ALL HAVING count(*) > 2""",
)
def _(t):
    return (
        t.plays.groupBy("userId", "trackName")
        .agg(F.count("*").alias("plays"))
        .filter(F.col("plays") > 2)
    )


@query(
    "agg_two_level",
    f"""SELECT userId, count(*) AS repeatedTracks, max(n) AS maxRepeats, {r6('avg(n)')} AS avgRepeats
        FROM (SELECT userId, trackKey, count(*) AS n FROM id_plays GROUP BY ALL HAVING count(*) > 1)
        GROUP BY userId""",
)
def _(t):
    return users.repeats_per_user(t.id_plays)


@query(
    "agg_ratio_of_sums",
    f"""SELECT userType, {r6('sum(totalTracks) / sum(totalSessions)')} AS tracksPerSession
        FROM typed_users GROUP BY userType""",
)
def _(t):
    ratio = F.try_divide(F.sum("totalTracks"), F.sum("totalSessions"))
    return t.typed_users.groupBy("userType").agg(ratio.alias("tracksPerSession"))


@query(
    "agg_pct_of_total",
    f"""SELECT artistName, count(*) AS plays,
               {rd('count(*) * 100 / sum(count(*)) OVER ()', 2)} AS percentage,
               {r6('count(*) / (SELECT count(*) FROM plays)')} AS share
        FROM plays GROUP BY artistName""",
)
def _(t):
    counts = t.plays.groupBy("artistName").agg(F.count("*").alias("plays"))
    total = t.plays.agg(F.count("*")).scalar()
    return shares.with_percentage(counts, "plays").withColumn("share", F.col("plays") / total)


@query(
    "win_lag_gap",
    "SELECT userId, timestamp, trackKey, previousTimestamp, gapSeconds FROM gaps",
)
def _(t):
    return gaps.with_previous_play(t.silver, "trackKey", gap_minutes=GAP).select(
        "userId", "timestamp", "trackKey", "previousTimestamp", "gapSeconds"
    )


@query("win_session_flag", "SELECT userId, timestamp, trackKey, isSessionBreak FROM gaps")
def _(t):
    return gaps.with_previous_play(t.silver, "trackKey", gap_minutes=GAP).select(
        "userId", "timestamp", "trackKey", "isSessionBreak"
    )


@query("win_session_number", "SELECT userId, timestamp, trackKey, sessionNumber FROM session_plays")
def _(t):
    return assign_sessions(t.silver, GAP).select("userId", "timestamp", "trackKey", "sessionNumber")


@query(
    "win_session_id",
    """SELECT userId, timestamp, trackKey, concat(userId, '_', sessionNumber) AS userSessionId
       FROM session_plays_20""",
)
def _(t):
    return assign_sessions(t.silver, 20).select("userId", "timestamp", "trackKey", "userSessionId")


@query(
    "rank_global",
    """SELECT row_number() OVER (ORDER BY totalPlays DESC, userId) AS rank, userId, totalPlays
       FROM activity QUALIFY rank <= 25""",
)
def _(t):
    order = [F.desc("totalPlays"), F.asc("userId")]
    best = t.activity.select("userId", "totalPlays").orderBy(*order).limit(25)
    return best.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), "userId", "totalPlays")


@query(
    "top_n_per_group",
    """SELECT userId, artistName, plays,
              row_number() OVER (PARTITION BY userId ORDER BY plays DESC, artistName) AS rank
       FROM (SELECT userId, artistName, count(*) AS plays FROM plays GROUP BY ALL)
       QUALIFY rank <= 2""",
)
def _(t):
    counts = t.plays.groupBy("userId", "artistName").agg(F.count("*").alias("plays"))
    return ranking.top_per_group(counts, ["userId"], [F.desc("plays"), F.asc("artistName")], 2)


@query(
    "sort_multi",
    """SELECT userId, totalPlays, uniqueTracks FROM activity
       ORDER BY totalPlays DESC, uniqueTracks, userId""",
)
def _(t):
    return t.activity.select("userId", "totalPlays", "uniqueTracks").orderBy(
        F.desc("totalPlays"), F.asc("uniqueTracks"), F.asc("userId")
    )


@query(
    "limit_rows",
    "SELECT least(count(*), 15) AS rows, least(count(*), 15) AS sessions FROM sessions",
)
def _(t):
    # Any 15 sessions will do, so it is counted how many rows there are and how many of them are
    # sessions, each once.
    columns = ["userSessionId", "trackCount"]
    first = t.sessions().select(columns).limit(15)
    found = first.distinct().join(t.sessions().select(columns), columns, "left_semi")
    return first.agg(F.count("*").alias("rows")).withColumn(
        "sessions", found.agg(F.count("*")).scalar()
    )


@query(
    "sort_case",
    f"""SELECT {cases([('hour(timestamp) < 6', 'night'), ('hour(timestamp) < 12', 'morning'),
                       ('hour(timestamp) < 18', 'afternoon')], 'evening')} AS partOfDay,
               count(*) AS plays FROM plays GROUP BY 1
        ORDER BY CASE partOfDay WHEN 'night' THEN 1 WHEN 'morning' THEN 2
                 WHEN 'afternoon' THEN 3 ELSE 4 END""",
)
def _(t):
    part = buckets.below(
        F.hour("timestamp"), ((6, "night"), (12, "morning"), (18, "afternoon")), "evening"
    )
    position = buckets.first_match(
        [
            (F.col("partOfDay") == "night", "1"),
            (F.col("partOfDay") == "morning", "2"),
            (F.col("partOfDay") == "afternoon", "3"),
        ],
        "4",
    )
    return t.plays.groupBy(part.alias("partOfDay")).agg(F.count("*").alias("plays")).orderBy(position)


@query("distinct_users", "SELECT DISTINCT userId FROM raw_plays")
def _(t):
    return t.raw_plays.select("userId").distinct()


@query(
    "similar_users",
    f"""SELECT u.userId, u.userType, u.totalSessions,
               CAST(u.avgTracksPerSession AS DOUBLE) AS avgTracksPerSession,
               CAST(u.avgSessionDuration AS DOUBLE) AS avgSessionDuration,
               CAST(abs(u.avgTracksPerSession - r.avgTracksPerSession) AS DOUBLE) AS distance
        FROM typed_users u JOIN (SELECT * FROM typed_users WHERE userId = '{REFERENCE_USER}') r
          ON u.userId <> r.userId
         AND abs(u.avgTracksPerSession - r.avgTracksPerSession) <= 0.2
         AND abs(u.totalSessions - r.totalSessions) <= r.totalSessions * 0.1""",
)
def _(t):
    return users.similar_users(
        t.typed_users, REFERENCE_USER, max_tracks=0.2, max_sessions_share=0.1
    )
