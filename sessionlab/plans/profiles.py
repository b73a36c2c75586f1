"""Plays and activity together with user profiles.

Plays are always reduced to one row per user (and artist or track) before the join, so a user
with very many plays is one small row when the profiles are joined. Whether the profile side is
broadcast is left to Spark, which knows its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.functions import buckets
from sessionlab.functions.keys import has_value
from sessionlab.operators.ranking import top_per_group

# Rule limits and labels.
MIN_COUNTRY_USERS = 10
LONG_COUNTRY_NAME = 50
AGE_RANGE = (13, 100)
NIGHT_HOURS = (0, 5)
UNKNOWN_GENDER = "Unknown"


def enrich(plays: DataFrame, profiles: DataFrame, how: str = "left") -> DataFrame:
    """Every play with the profile of its user."""
    return plays.join(profiles, "userId", how)


def country_stats(activity: DataFrame, profiles: DataFrame) -> DataFrame:
    return (
        activity.join(profiles.filter(has_value("country")), "userId")
        .groupBy("country")
        .agg(
            F.count("*").alias("userCount"),
            F.sum("totalPlays").alias("totalCountryPlays"),
            F.avg("totalPlays").alias("avgPlaysPerUser"),
        )
        .orderBy(F.desc("userCount"), "country")
    )


def gender_stats(activity: DataFrame, profiles: DataFrame) -> DataFrame:
    return (
        activity.join(profiles.filter(has_value("gender")), "userId")
        .groupBy("gender")
        .agg(
            F.count("*").alias("userCount"),
            F.avg("totalPlays").alias("avgPlays"),
            F.avg("uniqueArtists").alias("avgUniqueArtists"),
        )
    )


def profile_completeness(activity: DataFrame, profiles: DataFrame) -> DataFrame:
    """Activity by how many of gender, age and country are filled in."""
    score = (
        has_value("gender").cast("int")
        + F.col("age").isNotNull().cast("int")
        + has_value("country").cast("int")
    )
    label = buckets.at_least(score, buckets.PROFILE_SCORE, buckets.PROFILE_SCORE_ELSE)
    return (
        activity.join(profiles, "userId")
        .groupBy(label.alias("profileCompleteness"))
        .agg(
            F.count("*").alias("userCount"),
            F.avg("totalPlays").alias("avgPlays"),
            F.avg("uniqueArtists").alias("avgUniqueArtists"),
            F.avg("listeningSpanDays").alias("avgListeningSpanDays"),
        )
        .orderBy(F.desc("avgPlays"))
    )


def _plays_per(plays: DataFrame, profiles: DataFrame, trait: str, item: str) -> DataFrame:
    per_user = plays.groupBy("userId", item).agg(F.count("*").alias("plays"))
    return (
        per_user.join(profiles.select("userId", trait), "userId")
        .groupBy(trait, item)
        .agg(F.sum("plays").alias("plays"))
    )


def top_artists_by_country(
    plays: DataFrame, profiles: DataFrame, *, min_users: int = MIN_COUNTRY_USERS, limit: int = 3
) -> DataFrame:
    """The most played artists of every country with enough users."""
    known = profiles.filter(has_value("country"))
    large = (
        known.groupBy("country").agg(F.count("*").alias("users")).filter(F.col("users") >= min_users)
    )
    counts = _plays_per(plays, known, "country", "artistName").join(large, "country", "left_semi")
    return top_per_group(counts, ["country"], [F.desc("plays"), F.asc("artistName")], limit)


def top_artists_by_gender(
    plays: DataFrame, profiles: DataFrame, *, genders: tuple[str, ...] = ("m", "f"), limit: int = 5
) -> DataFrame:
    chosen = profiles.filter(F.col("gender").isin(*genders))
    counts = _plays_per(plays, chosen, "gender", "artistName")
    return top_per_group(counts, ["gender"], [F.desc("plays"), F.asc("artistName")], limit)


def artists_by_age(plays: DataFrame, profiles: DataFrame) -> DataFrame:
    counts = _plays_per(plays, profiles.filter(F.col("age").isNotNull()), "age", "artistName")
    return counts.orderBy("age", F.desc("plays"), "artistName")


def top_in_country(
    plays: DataFrame, profiles: DataFrame, country: str, item: str = "trackName", limit: int = 10
) -> DataFrame:
    """The most played tracks, or artists, of one country."""
    counts = _plays_per(plays, profiles.filter(F.col("country") == country), "country", item)
    return counts.drop("country").orderBy(F.desc("plays"), item).limit(limit)


def night_songs(plays: DataFrame, hours: tuple[int, int] = NIGHT_HOURS, limit: int = 10) -> DataFrame:
    """The tracks played most in the night hours, first and last hour included."""
    return (
        plays.filter(F.hour("timestamp").between(*hours))
        .groupBy("trackName")
        .agg(F.count("*").alias("plays"))
        .orderBy(F.desc("plays"), "trackName")
        .limit(limit)
    )


def top_user(plays: DataFrame) -> DataFrame:
    """The user with the most plays, as one row."""
    return (
        plays.groupBy("userId")
        .agg(F.count("*").alias("plays"))
        .orderBy(F.desc("plays"), "userId")
        .limit(1)
    )


def top_user_artists(plays: DataFrame, profiles: DataFrame, limit: int = 10) -> DataFrame:
    """The favourite artists of the most active user, next to that user's profile."""
    artists = (
        plays.join(top_user(plays).select("userId"), "userId", "left_semi")
        .groupBy("userId", "artistName")
        .agg(F.count("*").alias("plays"))
        .orderBy(F.desc("plays"), "artistName")
        .limit(limit)
    )
    return artists.join(profiles.select("userId", "gender", "age", "country"), "userId", "left")


def age_distribution(profiles: DataFrame) -> DataFrame:
    return (
        profiles.filter(F.col("age").isNotNull())
        .groupBy("age")
        .agg(F.count("*").alias("userCount"))
        .orderBy("age")
    )


def country_distribution(profiles: DataFrame) -> DataFrame:
    return (
        profiles.filter(has_value("country"))
        .groupBy("country")
        .agg(F.count("*").alias("userCount"))
        .orderBy(F.desc("userCount"), "country")
    )


def gender_distribution(profiles: DataFrame) -> DataFrame:
    known = F.coalesce(F.trim("gender") != "", F.lit(False))
    gender = F.when(known, F.col("gender")).otherwise(UNKNOWN_GENDER)
    return (
        profiles.groupBy(gender.alias("gender"))
        .agg(F.count("*").alias("userCount"))
        .orderBy(F.desc("userCount"), "gender")
    )


def suspicious_country(profiles: DataFrame, max_length: int = LONG_COUNTRY_NAME) -> DataFrame:
    """Country names that are too long, contain a digit or are all capitals."""
    name = F.trim("country")
    suspicious = (F.length(name) > max_length) | name.rlike("[0-9]") | (name == F.upper(name))
    return (
        profiles.filter(has_value("country") & suspicious)
        .groupBy("country")
        .agg(F.count("*").alias("userCount"))
        .orderBy(F.desc("userCount"), "country")
    )


def age_validation(profiles: DataFrame, ages: tuple[int, int] = AGE_RANGE) -> DataFrame:
    outside = F.count_if(~F.col("age").between(*ages))
    total = F.count("age")
    return profiles.agg(
        total.alias("totalWithAge"),
        outside.alias("suspiciousAges"),
        F.min("age").alias("minAge"),
        F.max("age").alias("maxAge"),
        F.avg("age").alias("avgAge"),
        F.try_divide(outside * F.lit(100.0), total).alias("suspiciousAgePct"),
    )
