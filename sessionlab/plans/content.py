"""Artists, tracks and identifier coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlab.functions import buckets
from sessionlab.functions.buckets import Rules
from sessionlab.functions.keys import has_value, is_mbid
from sessionlab.operators.shares import with_percentage

# Rule limits and labels.
AMBIGUOUS_MIN_PLAYS = 100
MATCH_BY_TRACK = "High (Track MBID)"
MATCH_BY_ARTIST = "Medium (Artist MBID only)"
MATCH_BY_NAME = "Low (Name matching only)"


def _flag(name: str) -> Column:
    return has_value(name).cast("int")


def artist_popularity(plays: DataFrame) -> DataFrame:
    """Plays, listeners and tracks per artist name and id.

    Plays are reduced to one row per artist, user and track before the two distinct counts.
    """
    reduced = plays.groupBy("artistName", "artistId", "userId", "trackKey").agg(
        F.count("*").alias("plays")
    )
    return reduced.groupBy("artistName", "artistId").agg(
        F.sum("plays").alias("totalPlays"),
        F.count_distinct("userId").alias("uniqueListeners"),
        F.count_distinct("trackKey").alias("uniqueTracks"),
    )


def track_popularity_all(plays: DataFrame) -> DataFrame:
    """Plays and listeners per track; one row per track and user is counted in between."""
    per_user = plays.groupBy("trackKey", "artistName", "trackName", "userId").agg(
        F.count("*").alias("plays")
    )
    return per_user.groupBy("trackKey", "artistName", "trackName").agg(
        F.sum("plays").alias("totalPlays"), F.count("*").alias("uniqueListeners")
    )


def content_metrics(plays: DataFrame) -> DataFrame:
    catalog = plays.groupBy("artistName", "trackKey").agg(F.count("*").alias("plays"))
    totals = catalog.agg(
        F.count_distinct("artistName").alias("uniqueArtists"),
        F.count_distinct("trackKey").alias("uniqueTracks"),
        F.sum("plays").alias("totalPlays"),
    )
    return totals.withColumns(
        {
            "avgPlaysPerArtist": F.try_divide("totalPlays", "uniqueArtists"),
            "avgPlaysPerTrack": F.try_divide("totalPlays", "uniqueTracks"),
            "avgTracksPerArtist": F.try_divide("uniqueTracks", "uniqueArtists"),
        }
    )


def mbid_by_tier(
    artists: DataFrame,
    rules: Rules = buckets.ARTIST_TIERS,
    otherwise: str = buckets.ARTIST_TIER_ELSE,
) -> DataFrame:
    """How many artists of each popularity tier have an id."""
    flag = _flag("artistId")
    return (
        artists.groupBy(buckets.at_least("totalPlays", rules, otherwise).alias("popularityTier"))
        .agg(
            F.count("*").alias("artistCount"),
            F.sum(flag).alias("artistsWithMbid"),
            (F.avg(flag) * 100).alias("mbidCoveragePct"),
            F.sum("totalPlays").alias("totalTierPlays"),
        )
        .orderBy(F.desc("totalTierPlays"))
    )


def mbid_overall(plays: DataFrame) -> DataFrame:
    return plays.agg(
        F.count("*").alias("totalPlays"),
        F.sum(_flag("artistId")).alias("playsWithArtistMbid"),
        (F.avg(_flag("artistId")) * 100).alias("artistMbidPct"),
        F.sum(_flag("trackId")).alias("playsWithTrackMbid"),
        (F.avg(_flag("trackId")) * 100).alias("trackMbidPct"),
    )


def _coverage_per_user(plays: DataFrame, *groups: Column) -> DataFrame:
    return plays.groupBy(*groups, "userId").agg(
        F.count("*").alias("plays"),
        F.sum(_flag("artistId")).alias("artistIds"),
        F.sum(_flag("trackId")).alias("trackIds"),
    )


def mbid_by_year(plays: DataFrame) -> DataFrame:
    per_user = _coverage_per_user(plays, F.year("timestamp").alias("year"))
    total = F.sum("plays")
    return (
        per_user.groupBy("year")
        .agg(
            total.alias("totalPlays"),
            (F.sum("artistIds") / total * 100).alias("artistMbidPct"),
            (F.sum("trackIds") / total * 100).alias("trackMbidPct"),
            F.count("*").alias("activeUsers"),
        )
        .orderBy("year")
    )


def user_quality_segments(
    plays: DataFrame,
    rules: Rules = buckets.MBID_RATE,
    otherwise: str = buckets.MBID_RATE_ELSE,
) -> DataFrame:
    """Users grouped by the share of their plays that have an artist id."""
    rate = F.col("artistIds") / F.col("plays")
    return (
        _coverage_per_user(plays)
        .groupBy(buckets.at_least(rate, rules, otherwise).alias("qualitySegment"))
        .agg(
            F.count("*").alias("userCount"),
            F.avg("plays").alias("avgPlaysPerUser"),
            F.sum("plays").alias("segmentTotalPlays"),
        )
        .orderBy(F.desc("avgPlaysPerUser"))
    )


def artist_name_variants(plays: DataFrame) -> DataFrame:
    """Names of the artist ids that come with more than one: a row per id and name.

    The number of names of an id has no bound, so they are rows and not one array.
    """
    names = (
        plays.filter(has_value("artistId"))
        .groupBy("artistId", "artistName")
        .agg(F.count("*").alias("plays"))
    )
    ids = (
        names.groupBy("artistId")
        .agg(F.count("*").alias("nameVariations"), F.sum("plays").alias("totalPlays"))
        .filter(F.col("nameVariations") > 1)
    )
    return names.join(ids, "artistId").select(
        "artistId", "nameVariations", "totalPlays", "artistName", "plays"
    )


def matching_quality(plays: DataFrame) -> DataFrame:
    """How well plays can be matched to a catalogue, with the share of all plays."""
    quality = buckets.first_match(
        [(has_value("trackId"), MATCH_BY_TRACK), (has_value("artistId"), MATCH_BY_ARTIST)], MATCH_BY_NAME
    )
    reduced = plays.groupBy(quality.alias("matchingQuality"), "userId", "trackKey").agg(
        F.count("*").alias("plays")
    )
    groups = reduced.groupBy("matchingQuality").agg(
        F.sum("plays").alias("playCount"),
        F.count_distinct("userId").alias("affectedUsers"),
        F.count_distinct("trackKey").alias("affectedTracks"),
    )
    return with_percentage(groups, "playCount", "playPercentage", digits=None).orderBy(
        F.desc("playCount")
    )


def ambiguous_artists(plays: DataFrame, min_plays: int = AMBIGUOUS_MIN_PLAYS) -> DataFrame:
    """Artists without an id that are played often."""
    return (
        plays.filter(~has_value("artistId"))
        .groupBy("artistName", "userId")
        .agg(F.count("*").alias("plays"))
        .groupBy("artistName")
        .agg(F.sum("plays").alias("playsWithoutMbid"), F.count("*").alias("usersAffected"))
        .filter(F.col("playsWithoutMbid") >= min_plays)
    )


def ambiguous_summary(artists: DataFrame) -> DataFrame:
    return artists.agg(
        F.count("*").alias("artistsNeedingDisambiguation"),
        F.sum("playsWithoutMbid").alias("totalAmbiguousPlays"),
        F.sum("usersAffected").alias("totalAffectedUsers"),
        F.avg("playsWithoutMbid").alias("avgPlaysPerAmbiguousArtist"),
        F.max("playsWithoutMbid").alias("maxPlaysAmbiguousArtist"),
    )


def mbid_format(plays: DataFrame) -> DataFrame:
    """Ids present and ids in the right format, for artists and tracks, in one pass."""

    def checked(kind: str, column: str) -> Column:
        present = F.count_if(has_value(column))
        valid = F.count_if(has_value(column) & is_mbid(column))
        return F.struct(
            F.lit(kind).alias("idKind"),
            present.alias("withId"),
            valid.alias("validFormat"),
            F.try_divide(valid * F.lit(100.0), present).alias("validFormatPct"),
        )

    both = plays.agg(
        F.array(checked("artist", "artistId"), checked("track", "trackId")).alias("checks")
    )
    return both.select(F.inline("checks"))


def popularity_tiers(
    plays: DataFrame,
    rules: Rules = buckets.TRACK_TIERS,
    otherwise: str = buckets.TRACK_TIER_ELSE,
) -> DataFrame:
    """Tracks by number of plays, with the share of all tracks."""
    tracks = plays.groupBy("trackName", "artistName").agg(F.count("*").alias("playCount"))
    tiers = tracks.groupBy(buckets.at_least("playCount", rules, otherwise).alias("tier")).agg(
        F.count("*").alias("trackCount")
    )
    return with_percentage(tiers, "trackCount").orderBy(F.desc("trackCount"), "tier")


def list_coverage(plays: DataFrame, ranked: DataFrame) -> DataFrame:
    """What part of all tracks the ranked list covers."""
    listed = ranked.agg(F.count("*").alias("n")).scalar()
    tracks = plays.groupBy("trackName", "artistName").agg(F.count("*").alias("plays"))
    return (
        tracks.agg(F.count("*").alias("totalTracks"))
        .withColumn("rankedTracks", listed)
        .withColumn(
            "coveragePct", F.try_divide(F.col("rankedTracks") * F.lit(100.0), "totalTracks")
        )
    )
