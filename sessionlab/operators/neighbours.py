"""Rows that lie close to each other, found without comparing all pairs.

``near_points``: users by tracks per session and number of sessions. Users with equal figures are one
point with a weight, so a crowd of alike users is one row. Points are dealt to cells as wide as the
allowed distance, and a point meets only the points of its own and the neighbouring cells; a cell of
many points is dealt to several tasks.

``near_names``: names within an edit distance, by deletion neighbourhoods. If two names are d edits
apart, some string is left of both when at most d characters are deleted from each, and the same
holds for their first characters alone. So names meet on the hashes of what is left of their
beginnings, and the exact distance decides.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_POINTS = 2000
PREFIX = 24
MILLION = 1_000_000
LEAST_STEP = 0.01  # of the sessions in a row of cells


def _steps(count: int) -> Column:
    return F.array(*[F.lit(n) for n in range(-count, count + 1)])


def near_points(
    users: DataFrame, max_tracks: float, max_sessions_share: float, cell_points: int = CELL_POINTS
) -> DataFrame:
    """userId, similarUsers and closestTracks of every user with both figures: how many other users
    differ by at most ``max_tracks`` tracks per session and by at most ``max_sessions_share`` of the
    user's own sessions, and the least difference in tracks among them (NULL without any).

    Sessions are dealt by their logarithm: a share of the sessions is a fixed number of steps.
    """
    tracks, sessions = F.col("avgTracksPerSession"), F.col("totalSessions")
    if not 0 <= max_sessions_share < 1:
        raise ValueError("the share of sessions must be at least 0 and less than 1")
    step = math.log1p(max(max_sessions_share, LEAST_STEP))
    known = users.filter(tracks.isNotNull() & (sessions > 0)).select("userId", tracks.alias("t"), sessions.alias("s"))
    points = known.groupBy("t", "s").agg(F.count("*").alias("weight"))
    # Sessions between s (1 - share) and s (1 + share): the lower bound may lie more steps away.
    below = math.ceil(-math.log1p(-max_sessions_share) / step)
    # Tracks in millionths, so that cell borders are not blurred; cells are one wider than asked.
    width = round(max_tracks * MILLION) + 1
    millionths = F.round(F.col("t").cast("double") * MILLION).cast("long")
    placed = points.withColumns(
        {
            "column": F.call_function("div", millionths - F.pmod(millionths, F.lit(width)), F.lit(width)),
            "row": F.floor(F.ln(F.col("s").cast("double")) / step).cast("long"),
        }
    )
    # A point asks its neighbourhood; the asking points of a crowded cell go to several tasks.
    crowds = placed.groupBy("column", "row").agg(
        F.ceil(F.count("*") / cell_points).cast("int").alias("parts")
    )
    asks = (
        placed.join(crowds, ["column", "row"])
        .withColumn("part", F.pmod(F.xxhash64("t", "s"), F.col("parts")).cast("int"))
        .drop("parts", "weight")
    )
    # One more on both sides than the logarithms say, which are rounded.
    rows_apart = F.array(*[F.lit(n) for n in range(-2, below + 2)])
    answers = (
        placed.select(
            F.col("t").alias("otherT"),
            F.col("s").alias("otherS"),
            "weight",
            F.explode(F.transform(_steps(1), lambda d: F.col("column") + d)).alias("column"),
            "row",
        )
        .withColumn("row", F.explode(F.transform(rows_apart, lambda d: F.col("row") + d)))
        .join(crowds, ["column", "row"])
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .drop("parts")
    )
    apart = F.abs(F.col("otherT") - F.col("t"))
    is_near = (apart <= max_tracks) & (F.abs(F.col("otherS") - F.col("s")) <= F.col("s") * max_sessions_share)
    is_self = (F.col("otherT") == F.col("t")) & (F.col("otherS") == F.col("s"))
    others = F.col("weight") - F.when(is_self, 1).otherwise(0)
    near = (
        asks.join(answers, ["column", "row", "part"])
        .filter(is_near)
        .groupBy("t", "s")
        .agg(F.sum(others).alias("similarUsers"), F.min(F.when(others > 0, apart)).alias("closestTracks"))
    )
    return known.join(near, ["t", "s"]).select("userId", "similarUsers", "closestTracks")


def _left_of(name: Column, deletions: int) -> Column:
    """All strings that are left when up to so many characters are deleted."""
    every = F.array(name)
    last = every
    for _ in range(deletions):
        last = F.array_distinct(
            F.flatten(
                F.transform(
                    last,
                    lambda text: F.when(
                        F.char_length(text) > 0,
                        F.transform(
                            F.sequence(F.lit(1), F.greatest(F.char_length(text), F.lit(1))),
                            lambda i: F.concat(
                                F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.char_length(text))
                            ),
                        ),
                    ).otherwise(F.array().cast("array<string>")),
                )
            )
        )
        every = F.array_union(every, last)
    return every


def near_names(names: DataFrame, column: str, distance: int = 1, prefix: int = PREFIX) -> DataFrame:
    """(name, otherName, distance) of all pairs of different names at most ``distance`` edits apart,
    each pair once, ``name`` being the lesser one.

    A name has about prefix^distance / distance! hashes, whatever its length. Names that share all
    their first characters meet on every hash, so a longer ``prefix`` suits names with common
    beginnings; pairs are made distinct before the distance is computed.
    """
    if distance < 1 or prefix <= distance:
        raise ValueError("the distance must be positive and less than the prefix")
    distinct = names.select(F.col(column).alias("name")).filter(F.col("name").isNotNull()).distinct()
    start = F.substring("name", 1, prefix)
    keyed = distinct.select("name", F.explode(_left_of(start, distance)).alias("left")).select(
        F.xxhash64("left").alias("key"), "name"
    )
    # A hash that only one name has leads nowhere and goes before the join.
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("key")
    kept = keyed.join(shared, "key", "left_semi")
    other = kept.select("key", F.col("name").alias("otherName"))
    # levenshtein with a limit gives -1 beyond it and stops early.
    apart = F.levenshtein("name", "otherName", distance)
    lengths = F.abs(F.char_length("name") - F.char_length("otherName")) <= distance
    return (
        kept.join(other, "key")
        .filter((F.col("name") < F.col("otherName")) & lengths)
        .select("name", "otherName")
        .distinct()
        .withColumn("distance", apart)
        .filter(F.col("distance") >= 0)
    )
