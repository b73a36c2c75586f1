"""SQL building blocks for the queries' counterparts.

The SQL is written independently of the Spark code: sessions, for example, come from one window
over all plays of a user.
"""

from __future__ import annotations

import re

from sessionlab.catalog.inputs import GAP, TYPE_RULES


def r6(expression: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6)"


def dec(expression: str, digits: int) -> str:
    """Rounded half up to a decimal."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,12)), {digits}) AS DECIMAL(18,{digits}))"


def rd(expression: str, digits: int) -> str:
    return f"CAST({dec(expression, digits)} AS DOUBLE)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def cases(rules: list[tuple[str, str]], otherwise: str) -> str:
    whens = " ".join(f"WHEN {condition} THEN '{label}'" for condition, label in rules)
    return f"CASE {whens} ELSE '{otherwise}' END"


def _numbered(plays: str, gap: int) -> str:
    return f"""
SELECT userId, timestamp, artistName, trackName, trackKey,
       CAST(sum(opens) OVER (PARTITION BY userId ORDER BY timestamp, trackKey
                             ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sessionNumber
FROM (SELECT *, CASE WHEN epoch(timestamp) - epoch(lag(timestamp) OVER (
                              PARTITION BY userId ORDER BY timestamp, trackKey)) > {gap} * 60
                     THEN 1 ELSE 0 END AS opens
      FROM {plays})"""


def _sessions(numbered: str) -> str:
    length = "(epoch(max(timestamp)) - epoch(min(timestamp)))"
    return f"""
SELECT userId, sessionNumber, concat(userId, '_', sessionNumber) AS userSessionId,
       count(*) AS trackCount, count(DISTINCT trackKey) AS uniqueTracks,
       min(timestamp) AS sessionStart, max(timestamp) AS sessionEnd,
       {dec(length + ' / 60', 2)} AS durationMinutes, {dec(length + ' / 3600', 2)} AS durationHours
FROM {numbered} GROUP BY userId, sessionNumber"""


TABLES = {
    "plays": """
SELECT concat('user_', lpad(CAST(user_id AS VARCHAR), 6, '0')) AS userId,
       CAST(date_trunc('SECOND', ts) AS TIMESTAMP) + to_days(CAST(user_id % 4 * 200 AS INTEGER))
         AS timestamp,
       CASE WHEN event_type <> 'error' OR event_id % 53 = 0 THEN
         substr(concat_ws('-', substr(md5(event_type),1,8),
            substr(md5(event_type),9,4), substr(md5(event_type),13,4), substr(md5(event_type),17,4),
            substr(md5(event_type),21,12)), CASE WHEN event_id % 53 = 0 THEN 2 ELSE 1 END) END AS artistId,
       concat('artist ', event_type) AS artistName,
       CASE WHEN CAST(json_extract_string(props,'$.k') AS INT) % 3 <> 0
            THEN concat('t-', md5(concat(event_type, json_extract_string(props,'$.k')))) END AS trackId,
       concat('track ', json_extract_string(props,'$.k')) AS trackName,
       event_id AS seq
FROM events""",
    "raw_plays": r"""
SELECT userId,
       CASE WHEN seq % 97 = 0 THEN 'not-a-date'
            ELSE strftime(timestamp, '%Y-%m-%dT%H:%M:%SZ') END AS timestamp,
       artistId,
       CASE WHEN seq % 89 = 0 THEN NULL ELSE artistName END AS artistName,
       trackId,
       CASE WHEN seq % 83 = 0 THEN '' WHEN seq % 79 = 0 THEN concat(chr(1), trackName, ' ')
            ELSE trackName END AS trackName,
       seq
FROM (SELECT * FROM plays UNION ALL SELECT * FROM plays WHERE seq % 10 = 0)""",
    "profiles": """
SELECT concat('user_', lpad(CAST(c_custkey AS VARCHAR), 6, '0')) AS userId,
       CASE c_custkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'f' END AS gender,
       CASE WHEN c_custkey % 5 <> 0 THEN CAST(floor(c_acctbal / 100) AS INT) END AS age,
       CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_nationkey % 4 = 0 THEN n_name
            ELSE concat('Country ', chr(65 + c_nationkey)) END AS country,
       CAST(NULL AS VARCHAR) AS signup
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "parsed": """
SELECT * REPLACE (try_strptime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS timestamp) FROM raw_plays""",
    "silver": """
SELECT userId, timestamp, artistName, trackName, trackKey
FROM (SELECT *, row_number() OVER (PARTITION BY userId, timestamp, trackKey
                                   ORDER BY length(artistName)) AS copy
      FROM (SELECT *, artistName || ' - ' || trackName AS trackKey FROM parsed
            WHERE userId IS NOT NULL AND timestamp IS NOT NULL
              AND length(artistName) > 0 AND length(trackName) > 0))
WHERE copy = 1""",
    "sanitized": """
SELECT * REPLACE (trim(regexp_replace(userId, '[[:cntrl:]]', '', 'g')) AS userId,
                  trim(regexp_replace(artistName, '[[:cntrl:]]', '', 'g')) AS artistName,
                  trim(regexp_replace(trackName, '[[:cntrl:]]', '', 'g')) AS trackName)
FROM parsed WHERE timestamp IS NOT NULL""",
    "id_plays": """
SELECT *, CASE WHEN length(trackId) > 0 THEN trackId
               ELSE coalesce(artistName, '?') || ' — ' || coalesce(trackName, '?') END AS trackKey
FROM sanitized WHERE userId <> '' AND artistName <> '' AND trackName <> ''""",
    "session_plays": _numbered("silver", GAP),
    "session_plays_20": _numbered("silver", 20),
    "session_plays_720": _numbered("silver", 720),
    "sessions": _sessions("session_plays"),
    "sessions_20": _sessions("session_plays_20"),
    "sessions_720": _sessions("session_plays_720"),
    "best_sessions": """
SELECT * FROM sessions
ORDER BY trackCount DESC, durationMinutes DESC, sessionStart, userId, sessionNumber LIMIT 50""",
    "popularity": """
SELECT trackName, artistName, count(*) AS playCount,
       count(DISTINCT concat(p.userId, '_', p.sessionNumber)) AS sessionCount,
       count(DISTINCT p.userId) AS userCount,
       min(timestamp) AS firstPlayed, max(timestamp) AS lastPlayed
FROM session_plays p JOIN best_sessions b
  ON p.userId = b.userId AND p.sessionNumber = b.sessionNumber
GROUP BY trackName, artistName""",
    "best_songs": """
SELECT row_number() OVER (ORDER BY playCount DESC, sessionCount DESC, userCount DESC, firstPlayed,
                          artistName, trackName) AS rank,
       trackName, artistName, playCount, sessionCount, userCount
FROM popularity QUALIFY rank <= 10""",
    "activity": """
SELECT userId, count(*) AS totalPlays, count(DISTINCT trackKey) AS uniqueTracks,
       count(DISTINCT artistName) AS uniqueArtists, min(timestamp) AS firstPlay,
       max(timestamp) AS lastPlay,
       date_diff('day', CAST(min(timestamp) AS DATE), CAST(max(timestamp) AS DATE))
         AS listeningSpanDays
FROM id_plays GROUP BY userId""",
    "user_stats": f"""
SELECT userId, count(*) AS totalSessions,
       {dec('avg(durationMinutes)', 2)} AS avgSessionDuration,
       CAST(sum(trackCount) AS BIGINT) AS totalTracks,
       {dec('avg(trackCount)', 2)} AS avgTracksPerSession,
       max(trackCount) AS maxTracksInSession,
       min(durationMinutes) AS minDurationMinutes, max(durationMinutes) AS maxDurationMinutes
FROM sessions GROUP BY userId""",
    "typed_users": f"""
SELECT *, {cases([(f'totalSessions >= {s} AND avgTracksPerSession >= {t}', label)
                  for s, t, label in TYPE_RULES], 'Minimal User')} AS userType
FROM user_stats""",
    "diverse": f"""
SELECT *, {cases([('diversityRatio >= 1.0', 'All Unique'), ('diversityRatio >= 0.8', 'High Diversity'),
                  ('diversityRatio >= 0.6', 'Medium Diversity'),
                  ('diversityRatio >= 0.4', 'Low Diversity')], 'Very Low Diversity')} AS diversityCategory
FROM (SELECT *, {dec('uniqueTracks / trackCount', 3)} AS diversityRatio,
             {dec('(trackCount - uniqueTracks) / greatest(uniqueTracks, 1)', 2)} AS repetitionsPerTrack
      FROM sessions)""",
    "user_features": f"""
SELECT userId, {dec('avg(trackCount)', 2)} AS avgTracksPerSession,
       {dec('avg(durationMinutes)', 2)} AS avgDurationMinutes,
       {dec('avg(diversityRatio)', 3)} AS avgDiversityRatio,
       {dec('avg(tracksPerMinute)', 3)} AS avgTracksPerMinute, count(*) AS sessionCount
FROM (SELECT *, CASE WHEN durationMinutes > 0
                     THEN {dec('trackCount / CAST(durationMinutes AS DOUBLE)', 3)}
                     ELSE 0 END AS tracksPerMinute FROM diverse)
GROUP BY userId""",
    "gaps": """
SELECT *, CASE WHEN gapSeconds > 21600 THEN 1 ELSE 0 END AS isSessionBreak
FROM (SELECT *, lag(timestamp) OVER (PARTITION BY userId ORDER BY timestamp, trackKey)
                AS previousTimestamp,
             CAST(coalesce(epoch(timestamp) - epoch(lag(timestamp) OVER (
                  PARTITION BY userId ORDER BY timestamp, trackKey)), 0) AS BIGINT) AS gapSeconds
      FROM silver)""",
    "artists": """
SELECT artistName, artistId, count(*) AS totalPlays, count(DISTINCT userId) AS uniqueListeners,
       count(DISTINCT trackKey) AS uniqueTracks
FROM id_plays GROUP BY artistName, artistId""",
}


def with_tables(sql: str) -> str:
    """Put the tables that a statement names in front of it, in the order they build on each
    other."""
    needed: set[str] = set()

    def collect(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                collect(TABLES[name])

    collect(sql)
    head = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in TABLES if name in needed)
    body = sql.strip()
    if not head:
        return body
    return f"WITH {head},\n{body[4:]}" if body.startswith("WITH") else f"WITH {head}\n{body}"
