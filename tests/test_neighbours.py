"""Close users, close names, per-user samples, correlations and files of several schemas."""

import datetime as dt
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_plans import plan

from sessionlab.operators import neighbours
from sessionlab.operators.layout import sample_per_user
from sessionlab.operators.percentiles import percentile_of_each, percentiles
from sessionlab.plans.session_reports import correlation_matrix
from sessionlab.plans.users import outlier_users
from sessionlab.session import scratch_path
from sessionlab.sources.folded import common_type, fold, read_folded


@pytest.mark.parametrize("tracks, share, cell", [(2.0, 0.3, 2000), (0.2, 0.1, 3), (0.3, 0.9, 5), (1.0, 0.0, 2)])
def test_similar_users_equal_brute_force(spark, tracks, share, cell):
    random.seed(8)
    rows = [(f"u{i}", round(random.gauss(5, 1.5), 2), random.choice([40, 41, 44, 50, random.randint(1, 300)])) for i in range(250)]
    rows += [(f"crowd{i}", 5.0, 44) for i in range(150)] + [("none", None, 5), ("zero", 1.0, 0)]
    frame = spark.createDataFrame(rows, "userId string, avgTracksPerSession double, totalSessions long")
    frame = frame.withColumn("avgTracksPerSession", F.col("avgTracksPerSession").cast("decimal(18,2)"))
    got = {r.userId: (r.similarUsers, r.closestTracks) for r in neighbours.near_points(frame, tracks, share, cell).collect()}
    known = [r for r in rows if r[1] is not None and r[2] > 0]
    assert set(got) == {r[0] for r in known}
    for user, t, s in known:
        apart = [round(abs(t - other), 2) for name, other, n in known if name != user and round(abs(t - other), 2) <= tracks and abs(s - n) <= s * share]
        similar, closest = got[user]
        assert similar == len(apart)
        assert (closest is None) == (not apart) and (not apart or abs(float(closest) - min(apart)) < 1e-9)


def test_a_crowded_cell_is_dealt_out(spark):
    rows = [(f"u{i}", 1 + i / 10_000, 100) for i in range(900)]
    frame = spark.createDataFrame(rows, "userId string, avgTracksPerSession double, totalSessions long")
    text = plan(neighbours.near_points(frame, 2.0, 0.3, 100))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "part" in text
    assert neighbours.near_points(frame, 2.0, 0.3, 100).agg(F.min("similarUsers")).first()[0] == 899


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("distance, prefix", [(1, 24), (2, 24), (1, 4), (2, 6), (3, 8)])
def test_no_pair_of_names_is_lost(spark, distance, prefix):
    random.seed(distance * 100 + prefix)
    names = {"", "a", "b", "ab", "é", "The Beatles", "Beatles", "the beatles", "x" * 70, "x" * 71}
    while len(names) < 90:
        name = random.choice(sorted(names)) if random.random() < 0.6 else "".join(random.choices("abcé ", k=random.randint(0, 40)))
        letters = list(name)
        for _ in range(random.randint(0, 3)):
            at = random.randint(0, len(letters))
            random.choice([lambda: letters.insert(at, "q"), lambda: letters.pop(at) if at < len(letters) else None, lambda: letters.__setitem__(slice(at, at + 1), ["z"])])()
        names.add("".join(letters))
    frame = spark.createDataFrame([(n,) for n in names] + [(None,), ("a",)], "name string")
    got = {(r.name, r.otherName): r.distance for r in neighbours.near_names(frame, "name", distance, prefix).collect()}
    order = lambda n: n.encode()
    want = {
        (a, b): d for a, b in itertools.combinations(sorted(names, key=order), 2) if (d := levenshtein(a, b)) <= distance
    }
    assert got == want and len(want) > 10


def test_wrong_distances_are_refused(spark):
    for distance, prefix in ((0, 5), (5, 5)):
        with pytest.raises(ValueError):
            neighbours.near_names(spark.createDataFrame([("a",)], "name string"), "name", distance, prefix)


def test_a_sample_per_user_is_the_same_for_any_partitioning(spark):
    rows = [("hot" if i % 2 else f"u{i % 30}", i) for i in range(5000)]
    frame = spark.createDataFrame(rows, "userId string, seq long")
    picks = [sorted(map(tuple, sample_per_user(frame.repartition(n), 7, "seq").collect())) for n in (1, 3, 11)]
    assert picks[0] == picks[1] == picks[2]
    assert Counter(user for user, _ in picks[0]) == {user: 7 for user, _ in rows}
    # A task sends its seven best rows of a user, not all of them.
    text = plan(sample_per_user(frame, 7, "seq"))
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning(userId") < text.rindex("WindowGroupLimit")


def test_correlation_matrix_is_one_pass(spark):
    random.seed(4)
    rows = [(random.gauss(0, 1), random.choice([None, random.gauss(3, 2)]), 5.0, i) for i in range(400)]
    rows = [(a, b, c, int(a * 10) + d % 7) for a, b, c, d in rows]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d long")
    matrix = correlation_matrix(frame.repartition(5), ["a", "b", "c", "d"])
    got = {(r.leftFeature, r.rightFeature): (r.users, r.correlation) for r in matrix.collect()}
    for i, j in itertools.combinations(range(4), 2):
        both = np.array([(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None])
        users, value = got["abcd"[i], "abcd"[j]]
        assert users == len(both)
        if 2 in (i, j):
            assert value is None
        else:
            assert math.isclose(value, np.corrcoef(both.T)[0, 1], abs_tol=1e-9)
    assert plan(correlation_matrix(frame, ["a", "b", "c", "d"])).count("Exchange SinglePartition") == 1


def test_percentiles_of_several_columns_in_one_pass(spark):
    random.seed(2)
    rows = [(random.randint(-50, 50), random.choice([None, random.random() * 9]), float(i)) for i in range(700)]
    frame = spark.createDataFrame(rows, "a long, b double, c double")
    for share in (0.05, 0.5, 0.95):
        got = percentile_of_each(frame, ["a", "b", "c"], share).first()
        for name in "abc":
            assert got[name] == percentiles(frame, name, (share,), ("p",)).first()["p"]
    assert list(percentile_of_each(frame.limit(0), ["a", "b"], 0.5).first()) == [None, None]


def test_outliers_take_their_limits_in_one_pass(spark):
    path = scratch_path(spark, "activity")
    spark.createDataFrame(
        [(f"u{i}", i, 1 + i % 5, i % 9) for i in range(1, 300)] + [("big", 90_000, 3, 1)],
        "userId string, totalPlays long, uniqueTracks long, listeningSpanDays int",
    ).write.parquet(path)
    found = outlier_users(spark.read.parquet(path))
    assert "big" in {r.userId for r in found.collect()}
    # One count of values serves all three limits, and all mentions of them.
    text = plan(found)
    assert "ReusedSubquery" in text and "ReusedExchange" in text
    assert "totalPlays, value" in text and "playsPerDay, value" in text


def test_types_are_folded():
    whole, long, double, text = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert common_type(whole, long) == long and common_type(long, double) == double
    assert common_type(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    assert common_type(whole, text) == text and common_type(T.BooleanType(), long) == text
    assert common_type(T.DecimalType(10, 2), T.DecimalType(6, 4)) == T.DecimalType(12, 4)
    assert common_type(T.NullType(), whole) == whole
    folded = fold([T.StructType().add("a", whole).add("b", text), T.StructType().add("c", long).add("a", long)])
    assert [(f.name, f.dataType) for f in folded] == [("a", long), ("b", text), ("c", long)]


@pytest.mark.parametrize("per_folder", [False, True])
def test_files_of_different_types_are_read_together(spark, per_folder):
    path = scratch_path(spark, "mixed")
    day = dt.date(2023, 5, 1)
    spark.createDataFrame([(1, 10, day)], "id int, n int, at date").write.parquet(f"{path}/a")
    spark.createDataFrame([(2, 2**40, None)], "id int, n long, at timestamp_ntz").write.parquet(f"{path}/b")
    spark.createDataFrame([(3, "x7", True)], "id long, n string, extra boolean").write.parquet(f"{path}/c")
    with pytest.raises(Exception):
        spark.read.option("mergeSchema", "true").parquet(f"{path}/a", f"{path}/c").collect()
    rows = read_folded(spark, path, one_schema_per_folder=per_folder)
    assert [f.dataType.simpleString() for f in rows.schema] == ["bigint", "string", "timestamp_ntz", "boolean"]
    assert sorted(map(tuple, rows.collect())) == [
        (1, "10", dt.datetime(2023, 5, 1), None), (2, str(2**40), None, None), (3, "x7", None, True),
    ]
    text = plan(rows.filter("id > 1").select("id"))
    assert text.count("ReadSchema: struct<id:") == 3 and text.count("PushedFilters: [IsNotNull(id)") == 3
    with pytest.raises(ValueError, match="no files"):
        read_folded(spark)
