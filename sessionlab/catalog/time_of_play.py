"""When plays and sessions happen."""

from sessionlab.catalog.oracle import cases, dec, r6, rd
from sessionlab.catalog.registry import query
from sessionlab.functions.times import DAY_NAMES
from sessionlab.plans import temporal


def _plays_by(expression: str, name: str) -> str:
    return f"""SELECT {expression} AS {name}, count(*) AS plays, count(DISTINCT userId) AS activeUsers
               FROM id_plays GROUP BY 1"""


@query("plays_by_year", _plays_by("year(timestamp)", "year"))
def _(t):
    return temporal.plays_by_year(t.id_plays)


@query("plays_by_hour", _plays_by("hour(timestamp)", "hour"))
def _(t):
    return temporal.plays_by_hour(t.id_plays)


@query("plays_by_weekday", _plays_by("dayofweek(timestamp) + 1", '"dayOfWeek"'))
def _(t):
    return temporal.plays_by_weekday(t.id_plays)


@query(
    "plays_by_month",
    "SELECT strftime(timestamp, '%Y-%m') AS yearMonth, count(*) AS plays FROM id_plays GROUP BY 1",
)
def _(t):
    return temporal.plays_by_month(t.id_plays)


@query(
    "low_activity_days",
    f"""WITH days AS (SELECT strftime(timestamp, '%Y-%m-%d') AS date, count(*) AS dailyPlays
                      FROM id_plays GROUP BY 1)
        SELECT date, dailyPlays, {r6('(SELECT avg(dailyPlays) FROM days)')} AS avgDailyPlays
        FROM days WHERE dailyPlays < (SELECT avg(dailyPlays) FROM days) * 0.97""",
)
def _(t):
    days = temporal.low_activity_days(t.id_plays, share=0.97)
    return days.withColumn("date", days["date"].cast("string"))


@query(
    "hour_outliers",
    f"""WITH hours AS (SELECT hour(timestamp) AS hour, count(*) AS plays FROM id_plays GROUP BY 1)
        SELECT hour, plays, {r6('m')} AS avgPlays, {r6('s')} AS stddevPlays
        FROM hours, (SELECT avg(plays) AS m, stddev(plays) AS s FROM hours)
        WHERE abs(plays - m) > s * 1.0::DOUBLE""",
)
def _(t):
    return temporal.hour_outliers(t.id_plays, deviations=1.0)


AVERAGES = f"""count(*) AS sessionCount, {rd('avg(durationMinutes)', 2)} AS avgDurationMin,
               {rd('avg(trackCount)', 1)} AS avgTracks"""


@query("sessions_by_hour", f"SELECT hour(sessionStart) AS hour, {AVERAGES} FROM sessions GROUP BY 1")
def _(t):
    return temporal.sessions_by_hour(t.sessions())


@query(
    "peak_hours",
    f"""SELECT hour(sessionStart) AS hour, {AVERAGES} FROM sessions GROUP BY 1
        ORDER BY sessionCount DESC, hour LIMIT 5""",
)
def _(t):
    return temporal.peak_hours(temporal.sessions_by_hour(t.sessions()))


@query(
    "sessions_by_weekday",
    f"""SELECT dayofweek(sessionStart) + 1 AS "dayOfWeek",
               {cases([(f'dayofweek(sessionStart) = {i}', d) for i, d in enumerate(DAY_NAMES)], '')}
               AS "dayName", {AVERAGES}
        FROM sessions GROUP BY ALL""",
)
def _(t):
    return temporal.sessions_by_weekday(t.sessions())


@query(
    "sessions_weekend",
    f"""SELECT CASE WHEN dayofweek(sessionStart) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END
               AS periodType, {AVERAGES}, count(DISTINCT userId) AS uniqueUsers
        FROM sessions GROUP BY 1""",
)
def _(t):
    return temporal.sessions_weekend(t.sessions())


@query(
    "sessions_by_month",
    f"""SELECT year(sessionStart) AS year, month(sessionStart) AS month, count(*) AS sessionCount,
               count(DISTINCT userId) AS activeUsers, {rd('avg(durationMinutes)', 2)} AS avgDurationMin
        FROM sessions GROUP BY ALL""",
)
def _(t):
    return temporal.sessions_by_month(t.sessions())


@query(
    "hour_utilization",
    f"""WITH hours AS (
          SELECT hour(sessionStart) AS hour, count(*) AS sessionCount,
                 count(DISTINCT userId) AS activeUsers, {dec('avg(trackCount)', 1)} AS avgTracks
          FROM sessions GROUP BY 1),
        ranked AS (
          SELECT *, sessionCount * avgTracks AS score,
                 row_number() OVER (ORDER BY sessionCount * avgTracks DESC, hour) AS best,
                 row_number() OVER (ORDER BY sessionCount * avgTracks, hour) AS worst FROM hours)
        SELECT CASE WHEN best <= 3 THEN 'peak' ELSE 'low' END AS usage, hour, sessionCount,
               activeUsers, CAST(avgTracks AS DOUBLE) AS avgTracks, CAST(score AS DOUBLE)
               AS utilizationScore
        FROM ranked WHERE best <= 3 OR worst <= 3""",
)
def _(t):
    return temporal.hour_utilization(t.sessions())
