"""Users: activity, segments, comparisons and profiles."""

from pyspark.sql import functions as F

from sessionlab.catalog.inputs import PLAY_RULES, RETENTION_RULES
from sessionlab.catalog.oracle import big, cases, r6, rd
from sessionlab.catalog.registry import query
from sessionlab.operators.layout import hash_sample, sample_per_user
from sessionlab.operators.neighbours import near_names, near_points
from sessionlab.operators.ranks import number_rows
from sessionlab.operators.sessions import top_sessions
from sessionlab.plans import profiles, users

PLAY_CASES = cases([(f"totalPlays >= {n}", label) for n, label in PLAY_RULES], "Casual User")


@query("user_activity", "SELECT * FROM activity")
def _(t):
    return t.activity


@query(
    "rank_all_users",
    """SELECT userId, totalPlays, row_number() OVER (ORDER BY totalPlays DESC, userId) AS rank
       FROM activity""",
)
def _(t):
    ranked = number_rows(t.activity, [F.desc("totalPlays"), F.asc("userId")])
    return ranked.select("userId", "totalPlays", "rank")


@query(
    "similar_users_of_all",
    """SELECT u.userId, count(r.userId) AS similarUsers,
              CAST(min(abs(u.avgTracksPerSession - r.avgTracksPerSession)) AS DOUBLE) AS closestTracks
       FROM typed_users u LEFT JOIN typed_users r
         ON u.userId <> r.userId AND abs(u.avgTracksPerSession - r.avgTracksPerSession) <= 0.2
        AND abs(u.totalSessions - r.totalSessions) <= u.totalSessions * 0.1
       GROUP BY u.userId""",
)
def _(t):
    return near_points(t.typed_users, 0.2, 0.1)


@query(
    "track_name_variants",
    """SELECT a.trackName AS name, b.trackName AS otherName,
              CAST(levenshtein(a.trackName, b.trackName) AS INTEGER) AS distance
       FROM (SELECT DISTINCT trackName FROM id_plays) a JOIN (SELECT DISTINCT trackName FROM id_plays) b
         ON a.trackName < b.trackName AND levenshtein(a.trackName, b.trackName) <= 1""",
)
def _(t):
    return near_names(t.id_plays, "trackName", 1)


@query(
    "plays_per_user_sample",
    """SELECT userId, seq FROM (SELECT DISTINCT userId, seq FROM id_plays)
       QUALIFY row_number() OVER (PARTITION BY userId ORDER BY md5(CAST(seq AS VARCHAR)), seq) <= 5""",
)
def _(t):
    return sample_per_user(t.id_plays.select("userId", "seq").distinct(), 5, "seq")


@query(
    "user_activity_dist",
    f"""SELECT count(*) AS totalUsers, {r6('avg(totalPlays)')} AS avgPlays,
               {r6('stddev(totalPlays)')} AS stddevPlays, min(totalPlays) AS minPlays,
               max(totalPlays) AS maxPlays, quantile_disc(totalPlays, 0.5) AS medianPlays,
               quantile_disc(totalPlays, 0.9) AS p90Plays,
               quantile_disc(totalPlays, 0.95) AS p95Plays FROM activity""",
)
def _(t):
    return users.activity_distribution(t.activity)


@query(
    "user_segments_plays",
    f"""SELECT {PLAY_CASES} AS userSegment, count(*) AS userCount, {r6('avg(totalPlays)')} AS avgPlays,
               {big('sum(totalPlays)')} AS totalSegmentPlays FROM activity GROUP BY 1""",
)
def _(t):
    return users.play_segments(t.activity, PLAY_RULES)


@query(
    "user_diversity",
    f"""SELECT {r6('avg(uniqueTracks)')} AS avgUniqueTracks, {r6('avg(uniqueArtists)')}
               AS avgUniqueArtists, {r6('avg(uniqueTracks / totalPlays)')} AS avgTrackDiversityRatio,
               {r6('avg(uniqueArtists / totalPlays)')} AS avgArtistDiversityRatio FROM activity""",
)
def _(t):
    return users.diversity(t.activity)


@query(
    "repeat_listening",
    f"""SELECT {r6('avg(tracks)')} AS avgRepeatedTracksPerUser, {r6('avg(most)')} AS avgMaxRepeats,
               max(most) AS globalMaxRepeats
        FROM (SELECT userId, count(*) AS tracks, max(n) AS most
              FROM (SELECT userId, trackKey, count(*) AS n FROM id_plays GROUP BY ALL
                    HAVING count(*) > 1) GROUP BY userId)""",
)
def _(t):
    return users.repeat_listening(users.repeats_per_user(t.id_plays))


@query(
    "user_session_stats",
    """SELECT userId, totalSessions, CAST(avgSessionDuration AS DOUBLE) AS avgSessionDuration,
              totalTracks, CAST(avgTracksPerSession AS DOUBLE) AS avgTracksPerSession,
              maxTracksInSession, CAST(minDurationMinutes AS DOUBLE) AS minDurationMinutes,
              CAST(maxDurationMinutes AS DOUBLE) AS maxDurationMinutes FROM user_stats""",
)
def _(t):
    return t.user_stats


@query(
    "user_types",
    f"""SELECT userType, count(*) AS userCount, {rd('avg(totalSessions)', 0)} AS avgSessions,
               {rd('avg(avgSessionDuration)', 1)} AS avgDurationMin,
               {rd('avg(avgTracksPerSession)', 1)} AS avgTracksPerSession,
               {rd('avg(totalTracks)', 0)} AS avgTotalTracks
        FROM typed_users GROUP BY userType""",
)
def _(t):
    return users.user_type_summary(t.typed_users)


BOARDS = (
    ("sessions", "user_stats", "totalSessions"),
    ("tracks per session", "user_stats", "avgTracksPerSession"),
    ("plays", "activity", "totalPlays"),
    ("unique tracks", "activity", "uniqueTracks"),
)


@query(
    "user_leaderboards",
    " UNION ALL ".join(
        f"""(SELECT '{board}' AS board, userId, CAST({measure} AS DOUBLE) AS score FROM {table}
             ORDER BY {measure} DESC, userId LIMIT 10)"""
        for board, table, measure in BOARDS
    ),
)
def _(t):
    source = {"user_stats": t.user_stats, "activity": t.activity}
    boards = [
        users.leaderboard(source[table], measure).select(
            F.lit(board).alias("board"), "userId", F.col(measure).cast("double").alias("score")
        )
        for board, table, measure in BOARDS
    ]
    first, *rest = boards
    for other in rest:
        first = first.union(other)
    return first


@query(
    "retention_risk",
    f"""SELECT {cases([(f'totalSessions < {n}', label) for n, label in RETENTION_RULES], 'Low Risk')}
               AS retentionRisk, count(*) AS userCount, {rd('avg(totalTracks)', 0)} AS avgTotalTracks
        FROM user_stats GROUP BY 1""",
)
def _(t):
    return users.retention_risk(t.user_stats, RETENTION_RULES)


@query(
    "engagement_summary",
    f"""SELECT count(*) AS totalUsers, {rd('avg(totalSessions)', 2)} AS avgSessionsPerUser,
               {rd('avg(avgTracksPerSession)', 2)} AS avgTracksPerSession,
               {rd('sum(totalTracks) / sum(totalSessions)', 2)} AS overallAvgTracksPerSession,
               max(totalSessions) AS maxSessionsByUser,
               {rd('stddev(totalSessions)', 2)} AS sessionCountStdDev FROM user_stats""",
)
def _(t):
    return users.engagement_summary(t.user_stats)


@query(
    "outlier_users",
    f"""WITH rates AS (SELECT *, totalPlays / (listeningSpanDays + 1) AS perDay,
                              totalPlays / uniqueTracks AS repetition FROM activity),
        limits AS (SELECT quantile_disc(totalPlays, 0.5) AS l1, quantile_disc(perDay, 0.5) AS l2,
                          quantile_disc(repetition, 0.5) AS l3 FROM rates)
        SELECT userId, totalPlays, {r6('perDay')} AS playsPerDay, {r6('repetition')}
               AS trackRepetitionRate,
               CASE WHEN totalPlays > l1 * 1.2 THEN 'Extreme play count'
                    WHEN perDay > l2 * 1.2 THEN 'Extreme daily activity'
                    ELSE 'Extreme repetition' END AS outlierReason
        FROM rates, limits WHERE totalPlays > l1 * 1.2 OR perDay > l2 * 1.2 OR repetition > l3 * 1.2""",
)
def _(t):
    return users.outlier_users(t.activity, factor=1.2, percentile=0.5).select(
        "userId", "totalPlays", "playsPerDay", "trackRepetitionRate", "outlierReason"
    )


SAMPLE = """
SELECT userId, count(*) AS totalEvents, count(DISTINCT trackName) AS uniqueTracks,
       count(DISTINCT artistName) AS uniqueArtists,
       CAST(round(CAST(count(DISTINCT trackName) / count(*) AS DECIMAL(38,12)), 3) AS DECIMAL(18,3))
         AS trackDiversity
FROM silver
WHERE CAST(concat('0x', substr(md5(concat_ws('|', userId, strftime(timestamp, '%Y-%m-%d %H:%M:%S'),
        trackKey)), 1, 8)) AS BIGINT) < 1073741824
  AND userId IN (SELECT userId FROM best_sessions)
GROUP BY userId"""


def _sampled(t):
    sample = hash_sample(t.silver, 0.25, "userId", "timestamp", "trackKey")
    return users.sampled_behaviour(sample, top_sessions(t.sessions()))


@query(
    "sampled_user_behaviour",
    f"SELECT * REPLACE (CAST(trackDiversity AS DOUBLE) AS trackDiversity) FROM ({SAMPLE})",
)
def _(t):
    return _sampled(t)


@query(
    "sampled_most_diverse",
    f"""SELECT * REPLACE (CAST(trackDiversity AS DOUBLE) AS trackDiversity) FROM ({SAMPLE})
        ORDER BY trackDiversity DESC, totalEvents DESC, userId LIMIT 10""",
)
def _(t):
    return users.most_diverse(_sampled(t))


@query(
    "sampled_behaviour_summary",
    f"""SELECT count(*) AS totalUsers, {r6('avg(totalEvents)')} AS avgEvents,
               {r6('avg(uniqueTracks)')} AS avgUniqueTracks, {r6('avg(trackDiversity)')} AS avgDiversity
        FROM ({SAMPLE})""",
)
def _(t):
    return users.behaviour_summary(_sampled(t))


@query(
    "country_stats",
    f"""SELECT country, count(*) AS userCount, {big('sum(totalPlays)')} AS totalCountryPlays,
               {r6('avg(totalPlays)')} AS avgPlaysPerUser
        FROM activity JOIN profiles USING (userId) WHERE country <> '' GROUP BY country""",
)
def _(t):
    return profiles.country_stats(t.activity, t.profiles)


@query(
    "gender_stats",
    f"""SELECT gender, count(*) AS userCount, {r6('avg(totalPlays)')} AS avgPlays,
               {r6('avg(uniqueArtists)')} AS avgUniqueArtists
        FROM activity JOIN profiles USING (userId) WHERE gender <> '' GROUP BY gender""",
)
def _(t):
    return profiles.gender_stats(t.activity, t.profiles)


SCORE = """(CASE WHEN gender <> '' THEN 1 ELSE 0 END + CASE WHEN age IS NOT NULL THEN 1 ELSE 0 END
            + CASE WHEN country <> '' THEN 1 ELSE 0 END)"""


@query(
    "profile_completeness",
    f"""SELECT {cases([(f'{SCORE} = 3', 'Complete (3/3)'), (f'{SCORE} = 2', 'Mostly Complete (2/3)'),
        (f'{SCORE} = 1', 'Incomplete (1/3)')], 'Empty (0/3)')} AS profileCompleteness,
        count(*) AS userCount, {r6('avg(totalPlays)')} AS avgPlays,
        {r6('avg(uniqueArtists)')} AS avgUniqueArtists,
        {r6('avg(listeningSpanDays)')} AS avgListeningSpanDays
        FROM activity JOIN profiles USING (userId) GROUP BY 1""",
)
def _(t):
    return profiles.profile_completeness(t.activity, t.profiles)


@query(
    "top_artists_by_country",
    """SELECT country, artistName, plays,
              row_number() OVER (PARTITION BY country ORDER BY plays DESC, artistName) AS rank
       FROM (SELECT country, artistName, count(*) AS plays
             FROM id_plays JOIN profiles USING (userId)
             WHERE country IN (SELECT country FROM profiles WHERE country <> '' GROUP BY country
                               HAVING count(*) >= 50)
             GROUP BY ALL) QUALIFY rank <= 3""",
)
def _(t):
    return profiles.top_artists_by_country(t.id_plays, t.profiles, min_users=50)


@query(
    "top_artists_by_gender",
    """SELECT gender, artistName, plays,
              row_number() OVER (PARTITION BY gender ORDER BY plays DESC, artistName) AS rank
       FROM (SELECT gender, artistName, count(*) AS plays
             FROM id_plays JOIN profiles USING (userId) WHERE gender IN ('m', 'f') GROUP BY ALL)
       QUALIFY rank <= 5""",
)
def _(t):
    return profiles.top_artists_by_gender(t.id_plays, t.profiles)


@query(
    "profile_distributions",
    """SELECT 'age' AS trait, CAST(age AS VARCHAR) AS value, count(*) AS userCount
       FROM profiles WHERE age IS NOT NULL GROUP BY age
       UNION ALL SELECT 'country', country, count(*) FROM profiles WHERE country <> '' GROUP BY country
       UNION ALL SELECT 'gender', coalesce(nullif(trim(gender), ''), 'Unknown'), count(*)
       FROM profiles GROUP BY ALL""",
)
def _(t):
    def rows(df, trait):
        return df.select(
            F.lit(trait).alias("trait"), F.col(trait).cast("string").alias("value"), "userCount"
        )

    return (
        rows(profiles.age_distribution(t.profiles), "age")
        .union(rows(profiles.country_distribution(t.profiles), "country"))
        .union(rows(profiles.gender_distribution(t.profiles), "gender"))
    )


@query(
    "suspicious_country",
    """SELECT country, count(*) AS userCount FROM profiles
       WHERE country <> '' AND (length(trim(country)) > 50 OR regexp_matches(trim(country), '[0-9]')
             OR trim(country) = upper(trim(country))) GROUP BY country""",
)
def _(t):
    return profiles.suspicious_country(t.profiles)


@query(
    "age_validation",
    f"""SELECT count(*) AS totalWithAge, count(*) FILTER (age < 13 OR age > 100) AS suspiciousAges,
               min(age) AS minAge, max(age) AS maxAge, {r6('avg(age)')} AS avgAge,
               {r6('count(*) FILTER (age < 13 OR age > 100) * 100.0::DOUBLE / count(*)')}
               AS suspiciousAgePct
        FROM profiles WHERE age IS NOT NULL""",
)
def _(t):
    return profiles.age_validation(t.profiles)


@query(
    "top_in_country",
    """(SELECT 'track' AS kind, trackName AS name, count(*) AS plays
        FROM id_plays JOIN profiles USING (userId) WHERE country = 'Country C'
        GROUP BY trackName ORDER BY plays DESC, trackName LIMIT 10)
       UNION ALL
       (SELECT 'artist', artistName, count(*) AS plays
        FROM id_plays JOIN profiles USING (userId) WHERE country = 'Country C'
        GROUP BY artistName ORDER BY plays DESC, artistName LIMIT 10)""",
)
def _(t):
    def named(kind, item):
        top = profiles.top_in_country(t.id_plays, t.profiles, "Country C", item)
        return top.select(F.lit(kind).alias("kind"), F.col(item).alias("name"), "plays")

    return named("track", "trackName").union(named("artist", "artistName"))


@query(
    "night_songs",
    """SELECT trackName, count(*) AS plays FROM id_plays WHERE hour(timestamp) BETWEEN 0 AND 5
       GROUP BY trackName ORDER BY plays DESC, trackName LIMIT 10""",
)
def _(t):
    return profiles.night_songs(t.id_plays)


@query(
    "artists_by_age",
    """SELECT age, artistName, count(*) AS plays FROM id_plays JOIN profiles USING (userId)
       WHERE age IS NOT NULL GROUP BY ALL""",
)
def _(t):
    return profiles.artists_by_age(t.id_plays, t.profiles)


@query(
    "top_user_artists",
    """SELECT userId, artistName, plays, gender, CAST(age AS VARCHAR) AS age, country
       FROM (SELECT userId, artistName, count(*) AS plays FROM id_plays
             WHERE userId = (SELECT userId FROM id_plays GROUP BY userId
                             ORDER BY count(*) DESC, userId LIMIT 1)
             GROUP BY ALL) LEFT JOIN profiles USING (userId)
       ORDER BY plays DESC, artistName LIMIT 10""",
)
def _(t):
    artists = profiles.top_user_artists(t.id_plays, t.profiles)
    return artists.withColumn("age", F.col("age").cast("string"))
