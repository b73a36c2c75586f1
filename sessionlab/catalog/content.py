"""Artists, tracks and identifier coverage."""

from pyspark.sql import functions as F

from sessionlab.catalog.inputs import GAP
from sessionlab.catalog.oracle import big, cases, r6, rd
from sessionlab.catalog.registry import query
from sessionlab.operators.ranking import top_songs_in_top_sessions
from sessionlab.operators.shares import long_tail
from sessionlab.plans import content

TIERS = ((2100, "Very Popular"), (2050, "Popular"), (2000, "Moderate"))
TRACK_TIERS = ((28, "Popular (28+)"), (24, "Well-Known (24-27)"), (20, "Moderate (20-23)"), (16, "Low (16-19)"))


@query("artist_popularity", "SELECT * FROM artists")
def _(t):
    return content.artist_popularity(t.id_plays)


@query(
    "track_popularity_all",
    """SELECT trackKey, artistName, trackName, count(*) AS totalPlays,
              count(DISTINCT userId) AS uniqueListeners FROM id_plays GROUP BY ALL""",
)
def _(t):
    return content.track_popularity_all(t.id_plays)


@query(
    "content_metrics",
    f"""SELECT a AS uniqueArtists, k AS uniqueTracks, n AS totalPlays, {r6('n / a')}
               AS avgPlaysPerArtist, {r6('n / k')} AS avgPlaysPerTrack, {r6('k / a')} AS avgTracksPerArtist
        FROM (SELECT count(DISTINCT artistName) AS a, count(DISTINCT trackKey) AS k, count(*) AS n
              FROM id_plays)""",
)
def _(t):
    return content.content_metrics(t.id_plays)


def _tail(items: str) -> str:
    return f"""
WITH items AS ({items}),
target AS (SELECT count(*) AS c, sum(n) AS s, floor(CAST(sum(n) AS DOUBLE) * 0.8::DOUBLE) AS goal
           FROM items),
running AS (SELECT sum(n) OVER (ORDER BY n DESC ROWS UNBOUNDED PRECEDING) AS so_far,
                   row_number() OVER (ORDER BY n DESC) AS position FROM items)
SELECT {big('any_value(c)')} AS totalItems, {big('any_value(s)')} AS totalPlays,
       {big('any_value(goal)')} AS targetPlays, {big('min(position)')} AS itemsForShare,
       {rd('min(position) * 100 / any_value(c)', 2)} AS pctOfItems
FROM running, target WHERE so_far >= goal"""


@query(
    "long_tail_artists",
    _tail("SELECT artistName, artistId, count(*) AS n FROM id_plays GROUP BY ALL"),
)
def _(t):
    return long_tail(content.artist_popularity(t.id_plays))


@query(
    "long_tail_tracks",
    _tail("SELECT trackKey, artistName, trackName, count(*) AS n FROM id_plays GROUP BY ALL"),
)
def _(t):
    return long_tail(content.track_popularity_all(t.id_plays))


@query(
    "mbid_by_tier",
    f"""SELECT {cases([(f'totalPlays >= {n}', label) for n, label in TIERS], 'Niche')}
               AS popularityTier, count(*) AS artistCount, count(artistId) AS artistsWithMbid,
               {r6('count(artistId) / count(*) * 100')} AS mbidCoveragePct,
               {big('sum(totalPlays)')} AS totalTierPlays FROM artists GROUP BY 1""",
)
def _(t):
    return content.mbid_by_tier(content.artist_popularity(t.id_plays), TIERS, "Niche")


@query(
    "mbid_overall",
    f"""SELECT count(*) AS totalPlays, count(artistId) AS playsWithArtistMbid,
               {r6('count(artistId) / count(*) * 100')} AS artistMbidPct,
               count(trackId) AS playsWithTrackMbid,
               {r6('count(trackId) / count(*) * 100')} AS trackMbidPct FROM id_plays""",
)
def _(t):
    return content.mbid_overall(t.id_plays)


@query(
    "mbid_by_year",
    f"""SELECT year(timestamp) AS year, count(*) AS totalPlays,
               {r6('count(artistId) / count(*) * 100')} AS artistMbidPct,
               {r6('count(trackId) / count(*) * 100')} AS trackMbidPct,
               count(DISTINCT userId) AS activeUsers FROM id_plays GROUP BY 1""",
)
def _(t):
    return content.mbid_by_year(t.id_plays)


@query(
    "user_quality_segments",
    f"""SELECT {cases([('rate >= 0.85', 'High'), ('rate >= 0.8', 'Medium'), ('rate >= 0.75', 'Low')],
                      'Very Low')} AS qualitySegment, count(*) AS userCount,
               {r6('avg(n)')} AS avgPlaysPerUser, {big('sum(n)')} AS segmentTotalPlays
        FROM (SELECT count(*) AS n, CAST(count(artistId) AS DOUBLE) / count(*) AS rate
              FROM id_plays GROUP BY userId) GROUP BY 1""",
)
def _(t):
    rules = ((0.85, "High"), (0.8, "Medium"), (0.75, "Low"))
    return content.user_quality_segments(t.id_plays, rules, "Very Low")


@query(
    "artist_name_variants",
    """WITH named AS (SELECT artistId, CASE WHEN hour(timestamp) < 4 THEN upper(artistName)
                        ELSE artistName END AS artistName FROM id_plays WHERE artistId <> '')
       SELECT artistId, nameVariations, totalPlays, artistName, plays
       FROM (SELECT artistId, artistName, count(*) AS plays FROM named GROUP BY ALL)
       JOIN (SELECT artistId, count(DISTINCT artistName) AS nameVariations, count(*) AS totalPlays
             FROM named GROUP BY artistId HAVING count(DISTINCT artistName) > 1) USING (artistId)""",
)
def _(t):
    # Night plays spell the artist in capitals, so ids have more than one name.
    night = F.hour("timestamp") < 4
    spelled = F.when(night, F.upper("artistName")).otherwise(F.col("artistName"))
    return content.artist_name_variants(t.id_plays.withColumn("artistName", spelled))


@query(
    "matching_quality",
    f"""SELECT {cases([("trackId <> ''", 'High (Track MBID)'),
                       ("artistId <> ''", 'Medium (Artist MBID only)')], 'Low (Name matching only)')}
               AS matchingQuality, count(*) AS playCount, count(DISTINCT userId) AS affectedUsers,
               count(DISTINCT trackKey) AS affectedTracks,
               {r6('count(*) * 100 / sum(count(*)) OVER ()')} AS playPercentage
        FROM id_plays GROUP BY 1""",
)
def _(t):
    return content.matching_quality(t.id_plays)


AMBIGUOUS = """SELECT artistName, count(*) AS playsWithoutMbid, count(DISTINCT userId) AS usersAffected
FROM id_plays WHERE coalesce(artistId, '') = '' GROUP BY artistName HAVING count(*) >= 100"""


@query("ambiguous_artists", AMBIGUOUS)
def _(t):
    return content.ambiguous_artists(t.id_plays)


@query(
    "ambiguous_summary",
    f"""SELECT count(*) AS artistsNeedingDisambiguation, {big('sum(playsWithoutMbid)')}
               AS totalAmbiguousPlays, {big('sum(usersAffected)')} AS totalAffectedUsers,
               {r6('avg(playsWithoutMbid)')} AS avgPlaysPerAmbiguousArtist,
               max(playsWithoutMbid) AS maxPlaysAmbiguousArtist FROM ({AMBIGUOUS})""",
)
def _(t):
    return content.ambiguous_summary(content.ambiguous_artists(t.id_plays))


PATTERN = "'^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$'"


@query(
    "mbid_format",
    " UNION ALL ".join(
        f"""SELECT '{kind}' AS idKind, count(*) AS withId,
            count(*) FILTER (regexp_matches({column}, {PATTERN})) AS validFormat,
            {r6(f'count(*) FILTER (regexp_matches({column}, {PATTERN})) * 100 / count(*)')}
            AS validFormatPct FROM id_plays WHERE {column} <> ''"""
        for kind, column in (("artist", "artistId"), ("track", "trackId"))
    ),
)
def _(t):
    return content.mbid_format(t.id_plays)


@query(
    "popularity_tiers",
    f"""SELECT {cases([(f'n >= {n}', label) for n, label in TRACK_TIERS], 'Rare (1-15)')} AS tier,
               count(*) AS trackCount, {rd('count(*) * 100 / sum(count(*)) OVER ()', 2)} AS percentage
        FROM (SELECT count(*) AS n FROM silver GROUP BY trackName, artistName) GROUP BY 1""",
)
def _(t):
    return content.popularity_tiers(t.silver, TRACK_TIERS, "Rare (1-15)")


@query(
    "list_coverage",
    f"""SELECT n AS totalTracks, r AS rankedTracks, {r6('r * 100 / n')} AS coveragePct
        FROM (SELECT (SELECT count(*) FROM (SELECT DISTINCT trackName, artistName FROM silver)) AS n,
                     (SELECT count(*) FROM best_songs) AS r)""",
)
def _(t):
    return content.list_coverage(t.silver, top_songs_in_top_sessions(t.silver, gap_minutes=GAP))
