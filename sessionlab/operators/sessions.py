"""Sessions: plays of one user with no gap longer than N minutes.

The usual form, a window over all plays of a user, puts a user's whole history into one task.
Here time is cut into cells as long as the allowed gap. Two plays in one cell are always less
than a gap apart, so a cell never holds a session boundary and only its first play, last play
and number of plays matter. These are plain aggregates that combine before the shuffle. The
window then runs over a user's cells, whose number is bounded by the calendar (72 a day at 20
minutes) however many plays the user has. Counts, start and end of a session follow without
moving the plays at all; where plays need their session, an equi-join on (user, cell) brings it,
which also splits a heavy user by time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.functions.numbers import mean
from sessionlab.functions.times import hours_between, minutes_between, seconds, seconds_between

DEFAULT_GAP_MINUTES = 20
DEFAULT_TOP_SESSIONS = 50
TRACKS_PER_PART = 1000


def _cell(column: Column | str, gap_minutes: int) -> Column:
    return F.floor(seconds(column) / (gap_minutes * 60))


def activity_cells(
    plays: DataFrame, gap_minutes: int = DEFAULT_GAP_MINUTES, layout: tuple[str, ...] = ()
) -> DataFrame:
    """One row per user and occupied cell.

    ``layout`` names further columns that a cell determines. Where the plays are stored in buckets
    of the user and these columns, the cells are counted in place."""
    return (
        plays.withColumn("cell", _cell("timestamp", gap_minutes))
        .filter(F.col("userId").isNotNull() & F.col("cell").isNotNull())
        .groupBy("userId", *layout, "cell")
        .agg(
            F.count("*").alias("plays"),
            F.min("timestamp").alias("firstPlay"),
            F.max("timestamp").alias("lastPlay"),
        )
    )


def number_cells(cells: DataFrame, gap_minutes: int = DEFAULT_GAP_MINUTES) -> DataFrame:
    """Add the previous play before each cell and the running session number, from 0."""
    user = Window.partitionBy("userId").orderBy("cell")
    so_far = user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = seconds_between("previousPlay", "firstPlay") > gap_minutes * 60
    return (
        cells.withColumn("previousPlay", F.lag("lastPlay").over(user))
        .withColumn("opensSession", F.when(opens, 1).otherwise(0))
        .withColumn("sessionNumber", F.sum("opensSession").over(so_far))
    )


def _session_id() -> Column:
    return F.concat_ws("_", "userId", F.col("sessionNumber").cast("string"))


def describe(sessions: DataFrame) -> DataFrame:
    """Add userSessionId and the durations."""
    return sessions.withColumns(
        {
            "userSessionId": _session_id(),
            "durationMinutes": minutes_between("sessionStart", "sessionEnd"),
            "durationHours": hours_between("sessionStart", "sessionEnd"),
        }
    )


def sessionize(plays: DataFrame, gap_minutes: int = DEFAULT_GAP_MINUTES) -> DataFrame:
    """userId, sessionNumber, userSessionId, trackCount, sessionStart, sessionEnd, durations.

    A gap of exactly ``gap_minutes`` stays in the session; seconds are compared as whole numbers.
    """
    return sessions_of_cells(activity_cells(plays, gap_minutes), gap_minutes)


def sessions_of_cells(cells: DataFrame, gap_minutes: int = DEFAULT_GAP_MINUTES) -> DataFrame:
    sessions = number_cells(cells, gap_minutes).groupBy("userId", "sessionNumber").agg(
        F.sum("plays").alias("trackCount"),
        F.min("firstPlay").alias("sessionStart"),
        F.max("lastPlay").alias("sessionEnd"),
    )
    return describe(sessions.filter(F.col("trackCount") > 0))


def merge_sessions(parts: DataFrame, gap_minutes: int = DEFAULT_GAP_MINUTES) -> DataFrame:
    """userId, sessionNumber, trackCount, sessionStart, sessionEnd from sessions of parts of the
    plays, which may overlap or lie within the allowed gap of each other.

    A session is an interval without a longer gap, so the sessions of all plays are the unions of
    intervals that touch: the result is that of one run over all plays.
    """
    before = Window.partitionBy("userId").orderBy("sessionStart", "sessionEnd")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    so_far = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = seconds_between("reach", "sessionStart") > gap_minutes * 60
    return (
        parts.withColumn("reach", F.max("sessionEnd").over(earlier))
        .withColumn("opensSession", F.when(opens, 1).otherwise(0))
        .withColumn("sessionNumber", F.sum("opensSession").over(so_far))
        .groupBy("userId", "sessionNumber")
        .agg(
            F.sum("trackCount").alias("trackCount"),
            F.min("sessionStart").alias("sessionStart"),
            F.max("sessionEnd").alias("sessionEnd"),
        )
    )


def assign_sessions(plays: DataFrame, gap_minutes: int = DEFAULT_GAP_MINUTES) -> DataFrame:
    """Every play with its sessionNumber and userSessionId."""
    cells = number_cells(activity_cells(plays, gap_minutes), gap_minutes)
    return (
        plays.withColumn("cell", _cell("timestamp", gap_minutes))
        .join(cells.select("userId", "cell", "sessionNumber"), ["userId", "cell"])
        .drop("cell")
        .withColumn("userSessionId", _session_id())
    )


def sessionize_with_tracks(plays: DataFrame, gap_minutes: int = DEFAULT_GAP_MINUTES) -> DataFrame:
    """Sessions with ``uniqueTracks``, the number of distinct ``trackKey`` values.

    The plays move once, to their (user, cell), and are reduced there to one row per track; the
    cells are counted in the same place, and what moves afterwards are cells and reduced rows.
    """
    dealt = (
        plays.select("userId", "timestamp", "trackKey", _cell("timestamp", gap_minutes).alias("cell"))
        .filter(F.col("userId").isNotNull() & F.col("cell").isNotNull())
        .repartition("userId", "cell")
    )
    tracks = dealt.groupBy("userId", "cell", "trackKey").agg(
        F.count("*").alias("plays"),
        F.min("timestamp").alias("firstPlay"),
        F.max("timestamp").alias("lastPlay"),
    )
    cells = tracks.groupBy("userId", "cell").agg(
        F.min("firstPlay").alias("firstPlay"), F.max("lastPlay").alias("lastPlay")
    )
    numbers = number_cells(cells, gap_minutes).select("userId", "cell", "sessionNumber")
    sessions = (
        tracks.join(numbers, ["userId", "cell"])
        .groupBy("userId", "sessionNumber")
        .agg(
            F.sum("plays").alias("trackCount"),
            F.count_distinct("trackKey").alias("uniqueTracks"),
            F.min("firstPlay").alias("sessionStart"),
            F.max("lastPlay").alias("sessionEnd"),
        )
    )
    return describe(sessions)


def plays_of(plays: DataFrame, sessions: DataFrame, gap_minutes: int = DEFAULT_GAP_MINUTES) -> DataFrame:
    """The plays of the given sessions (userId, sessionNumber, userSessionId), with their session.

    The sessions name their occupied cells, and no other session has a play in them, so the join
    is an equi-join with one match per play. How many cells there are depends on the sessions; the
    cells come out of a shuffle, so Spark knows their size when it chooses the join.
    """
    key = ["userId", "sessionNumber"]
    occupied = (
        number_cells(activity_cells(plays, gap_minutes), gap_minutes)
        .select(*key, "cell")
        .join(sessions.select(*key, "userSessionId"), key)
        .drop("sessionNumber")
    )
    return (
        plays.withColumn("cell", _cell("timestamp", gap_minutes))
        .join(occupied, ["userId", "cell"])
        .drop("cell")
    )


def with_positions(session_plays: DataFrame, cell_minutes: int = DEFAULT_GAP_MINUTES) -> DataFrame:
    """Add ``position``, the number of a play in its session, from 0 in order of time, then track
    and artist. Plays are numbered inside (session, cell); the plays of earlier cells are added."""
    key = ["userId", "userSessionId"]
    plays = session_plays.withColumn("cell", _cell("timestamp", cell_minutes))
    earlier = Window.partitionBy(*key).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        plays.groupBy(*key, "cell")
        .agg(F.count("*").alias("inCell"))
        .withColumn("before", F.coalesce(F.sum("inCell").over(earlier), F.lit(0)))
        .drop("inCell")
    )
    own = Window.partitionBy(*key, "cell").orderBy("timestamp", "trackName", "artistName")
    return (
        plays.withColumn("own", F.row_number().over(own))
        .join(cells, [*key, "cell"])
        .withColumn("position", F.col("before") + F.col("own") - 1)
        .drop("cell", "own", "before")
    )


def nest_tracks(session_plays: DataFrame, block: int = TRACKS_PER_PART) -> DataFrame:
    """The ordered track list of each session, as arrays of structs.

    A session has no upper size, so its list comes in parts of ``block`` tracks: one row per
    session and part. Every play is there, with its position in the session.
    """
    track = F.struct("position", "timestamp", "trackName", "artistName")
    return (
        with_positions(session_plays)
        .withColumn("part", F.floor(F.col("position") / block))
        .groupBy("userId", "userSessionId", "part")
        .agg(F.array_sort(F.collect_list(track)).alias("tracks"))
    )


def explode_tracks(nested: DataFrame) -> DataFrame:
    return nested.select("userId", "userSessionId", F.explode("tracks").alias("track")).select(
        "userId", "userSessionId", "track.trackName", "track.artistName", "track.timestamp", "track.position"
    )


def top_sessions(sessions: DataFrame, limit: int = DEFAULT_TOP_SESSIONS) -> DataFrame:
    """Most tracks first, then longest, then earliest; user and number settle what is left."""
    return sessions.orderBy(
        F.desc("trackCount"),
        F.desc("durationMinutes"),
        F.asc("sessionStart"),
        F.asc("userId"),
        F.asc("sessionNumber"),
    ).limit(limit)


def session_metrics(sessions: DataFrame) -> DataFrame:
    return sessions.agg(
        F.count("*").alias("sessionCount"),
        F.sum("trackCount").alias("totalTracks"),
        F.avg("trackCount").alias("avgTracksPerSession"),
        F.min("trackCount").alias("minTracksInSession"),
        F.max("trackCount").alias("maxTracksInSession"),
        mean("durationMinutes").alias("avgSessionDuration"),
    )


def session_checks(sessions: DataFrame) -> DataFrame:
    """How many sessions break a structural rule."""
    user, start, end = F.col("userId"), F.col("sessionStart"), F.col("sessionEnd")
    return sessions.agg(
        F.count("*").alias("totalSessions"),
        F.count_if(user.isNull() | (user == "")).alias("nullUserIds"),
        F.count_if(start.isNull()).alias("nullStartTimes"),
        F.count_if(end.isNull()).alias("nullEndTimes"),
        F.count_if(F.col("trackCount") <= 0).alias("invalidTrackCounts"),
        F.count_if(start > end).alias("invalidTimeOrder"),
    )
