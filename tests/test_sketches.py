"""Sketches against exact figures."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_plans import final_plan, plan

from sessionlab.operators import sketches
from sessionlab.operators.sessions import sessionize
from sessionlab.plans import rollups
from sessionlab.session import scratch_path


@pytest.fixture(scope="module")
def values(spark):
    random.seed(11)
    rows = [
        (i % 40, i % 3 == 0 and "hot" or f"a{i % 17}", int(random.lognormvariate(5, 2)), random.randrange(20_000))
        for i in range(60_000)
    ]
    return rows, spark.createDataFrame(rows, "day int, artist string, v long, u long").repartition(7)


@pytest.mark.parametrize("k", [200, 800])
def test_quantiles_lie_within_the_stated_error_on_every_level(values, k):
    rows, frame = values
    fine = sketches.build(frame, ["day", "artist"], {"v": "v"}, k=k)
    shares = (0.01, 0.1, 0.5, 0.9, 0.99)
    for groups in (["artist"], []):
        merged = sketches.merge(sketches.merge(fine, ["day", *groups]), groups)  # two levels
        for row in merged.select(*groups, "n", sketches.quantiles("v", shares).alias("q")).collect():
            own = np.array([v for _, a, v, _ in rows if not groups or a == row.artist])
            assert row.n == len(own)
            for share, value in zip(shares, row.q):
                error = 3 * sketches.rank_error(k)
                assert (own < value).mean() - error <= share <= (own <= value).mean() + error


def test_a_larger_k_has_a_smaller_error():
    assert 0.012 < sketches.rank_error(200) < 0.0145 and sketches.rank_error(400) < 0.55 * sketches.rank_error(200)
    assert 0.04 < sketches.count_error() < 0.05


def test_distinct_counts_lie_within_the_stated_error(values):
    rows, frame = values
    fine = sketches.build(frame, ["day", "artist"], distinct={"u": "u"})
    for groups in (["artist"], ["day"], []):
        merged = sketches.merge(fine, groups)
        for row in merged.select(*groups, sketches.distinct_count("u").alias("users")).collect():
            exact = len({u for d, a, _, u in rows if ("artist" not in groups or a == row.artist) and ("day" not in groups or d == row.day)})
            assert abs(row.users - exact) <= sketches.count_error() * exact


def test_share_below(values):
    rows, frame = values
    own = np.array([r[2] for r in rows])
    got = sketches.merge(sketches.build(frame, ["day"], {"v": "v"})).select(sketches.share_below("v", 150)).first()[0]
    assert abs(got - (own <= 150).mean()) <= 3 * sketches.rank_error()


def test_missing_values_and_no_rows(spark):
    frame = spark.createDataFrame([(1, None, None), (1, 5.0, "x"), (2, None, None)], "g int, v double, u string")
    made = sketches.build(frame, ["g"], {"v": "v"}, {"u": "u"})
    got = made.select("g", "n", sketches.quantiles("v", [0.5]).alias("q"), sketches.distinct_count("u").alias("c"))
    assert sorted(map(tuple, got.collect())) == [(1, 2, [5.0], 1), (2, 1, None, 0)]
    assert sketches.merge(made.limit(0), ["g"]).count() == 0


def test_sketches_combine_before_the_shuffle(values):
    text = plan(sketches.merge(sketches.build(values[1], ["day"], {"v": "v"}, {"u": "u"})))
    for name in ("kll_sketch_agg_double", "hll_sketch_agg", "kll_merge_agg_double", "hll_union_agg"):
        assert f"partial_{name}" in text


def test_months_and_years_read_only_stored_sketches(spark, make_plays):
    rows = [(f"u{i % 50}", f"{i % 24}:{i % 60}", f"t{i % 9}", f"a{i % 4}") for i in range(900)]
    plays = make_plays(rows).withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(days=F.pmod(F.xxhash64("trackName", "userId"), F.lit(500)).cast("int")))
    path = scratch_path(spark, "daily")
    halves = F.pmod(F.xxhash64("userId"), F.lit(2))
    for batch in (0, 1, 1):  # the second batch is written twice
        rollups.store_daily(rollups.daily_artists(plays.filter(halves == batch)), path, batch)
    months = rollups.by_month(rollups.read_daily(spark, path))
    years = rollups.by_year(months)
    text = final_plan(years)
    assert re.findall(r"ReadSchema: (\S+)", text) == [
        "struct<day:date,n:bigint,plays_kll:binary,users_hll:binary,tracks_hll:binary>"
    ]
    users = plays.groupBy(F.trunc("timestamp", "year").alias("year")).agg(
        F.count_distinct("userId").alias("users"), F.count_distinct("trackKey").alias("tracks")
    )
    got = rollups.distinct_report(years).select("year", "users", "tracks")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, users.collect()))  # small counts are exact
    days = plays.select(F.to_date("timestamp"), "artistName", "userId").distinct().count()
    assert years.agg(F.sum("n")).first()[0] == days


def test_session_quantiles(spark, make_plays):
    plays = make_plays([(f"u{i % 30}", f"{i % 24}:{i * 7 % 60}", f"t{i}") for i in range(400)])
    sessions = sessionize(plays)
    report = rollups.quantile_report(rollups.by_month(rollups.daily_sessions(sessions)), "tracks", (0.5, 1.0))
    counts = sorted(r.trackCount for r in sessions.collect())
    assert [(r.n, r.share) for r in report.collect()] == [(len(counts), 0.5), (len(counts), 1.0)]
    assert report.filter("share = 1").first().value == counts[-1]
