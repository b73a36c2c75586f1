"""Sessions over batches, sessions without an exchange, and ranks for all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_plans import exchanges, final_plan, plan

from sessionlab import JobConfig
from sessionlab.operators import sessions as ops
from sessionlab.operators.cleaning import clean_events
from sessionlab.operators.ranks import number_in_groups, number_rows
from sessionlab.operators.session_store import SessionStore
from sessionlab.plans import stages
from sessionlab.plans.validation import rank_errors, recheck_ranks
from sessionlab.session import scratch_path
from sessionlab.sources.readers import read_events
from sessionlab.sources.user_buckets import UserBuckets

START = dt.datetime(2023, 1, 1)


def times(rows):
    return sorted((r.userId, r.sessionNumber, r.trackCount, r.sessionStart, r.sessionEnd) for r in rows)


def plays_of_some_users(make_plays, seed, users=6, plays=300):
    random.seed(seed)
    rows = [
        (f"u{random.randrange(users)}", START + dt.timedelta(seconds=random.randrange(4 * 86400)), f"t{i}")
        for i in range(plays)
    ]
    return make_plays(rows), rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batches_equal_one_run_in_any_split(spark, make_plays, seed):
    plays, rows = plays_of_some_users(make_plays, seed)
    random.seed(seed)
    number = {1: lambda r: r[1].day, 2: lambda r: random.randrange(4), 3: lambda r: -r[1].day % 3}[seed]
    parts = {}
    for row in rows:
        parts.setdefault(number(row), []).append(row)
    store = SessionStore(spark, scratch_path(spark, "store"), 20)
    for batch, part in enumerate(parts[k] for k in sorted(parts)):
        store.add(make_plays(part), batch)
    want = times(ops.sessionize(plays, 20).collect())
    assert times(store.sessions().collect()) == want
    compact = store.compact(scratch_path(spark, "compact"))
    assert times(compact.sessions().collect()) == want and len(compact.batches()) == 1
    assert set(store.sessions().columns) == set(ops.sessionize(plays, 20).columns)


def test_late_plays_join_two_sessions(spark, make_plays):
    store = SessionStore(spark, scratch_path(spark, "store"), 20)
    store.add(make_plays([("a", "10:00", "x"), ("a", "10:30", "y"), ("a", "15:00", "z"), ("b", "9:00", "x")]), 0)
    assert [s[1:3] for s in times(store.sessions().collect())] == [(0, 1), (1, 1), (2, 1), (0, 1)]
    store.add(make_plays([("a", "10:15", "late"), ("b", "9:20", "next")]), 1)
    got = [(s[0], s[1], s[2], s[3].hour, s[4].minute) for s in times(store.sessions().collect())]
    assert got == [("a", 0, 3, 10, 30), ("a", 1, 1, 15, 0), ("b", 0, 2, 9, 20)]
    # An on-time batch after the sessions were numbered anew goes on from there.
    store.add(make_plays([("a", "16:00", "w"), ("c", "1:00", "x")]), 2)
    assert [s[:3] for s in times(store.sessions().collect())] == [
        ("a", 0, 3), ("a", 1, 1), ("a", 2, 1), ("b", 0, 2), ("c", 0, 1),
    ]


def test_only_users_with_new_plays_are_written(spark, make_plays):
    store = SessionStore(spark, scratch_path(spark, "store"), 20)
    store.add(make_plays([(f"u{i}", "10:00", "x") for i in range(50)]), 3)
    store.add(make_plays([("u7", "10:10", "y"), ("u8", "12:00", "y")]), 4)
    written = lambda kind: {
        r.userId for r in spark.read.parquet(f"{store.path}/{kind}/batch=4").collect()
    }
    assert written("edges") == {"u7", "u8"} and written("closed") == {"u8"}
    assert store.edges().count() == 50


def test_repeated_failed_empty_and_early_batches(spark, make_plays):
    store = SessionStore(spark, scratch_path(spark, "store"), 20)
    first, second = make_plays([("a", "10:00", "x")]), make_plays([("a", "12:00", "y"), ("a", "13:00", "y")])
    store.add(first, 0)
    # A batch that broke off before its edges were complete has no effect and can be added again.
    ops.sessionize(second).select("userId", "sessionNumber", "trackCount", "sessionStart", "sessionEnd").write.parquet(
        f"{store.path}/closed/batch=1"
    )
    assert len(store.sessions().collect()) == 1
    store.add(second, 1)
    store.add(second, 1)
    store.add(first.limit(0), 2)
    assert [s[1:3] for s in times(store.sessions().collect())] == [(0, 1), (1, 1), (2, 1)]
    assert store.batches() == [0, 1, 2]
    with pytest.raises(ValueError, match="after"):
        SessionStore(spark, store.path).add(first, -1)


def test_store_takes_the_batches_of_a_stream(spark, make_plays):
    plays, _ = plays_of_some_users(make_plays, 9, plays=60)
    source = scratch_path(spark, "arriving")
    plays.repartition(3).write.parquet(source)
    store = SessionStore(spark, scratch_path(spark, "store"), 20)
    stream = spark.readStream.schema(plays.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        stream.writeStream.foreachBatch(store.add)
        .option("checkpointLocation", scratch_path(spark, "stream"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    assert len(store.batches()) == 3
    assert times(store.sessions().collect()) == times(ops.sessionize(plays, 20).collect())


@pytest.fixture(scope="module")
def bucketed(spark, make_plays):
    rows = [(f"u{i % 7}", START + dt.timedelta(minutes=i * i % 90_000), f"t{i}") for i in range(400)]
    rows += [("heavy", START + dt.timedelta(minutes=7 * i), f"t{i}") for i in range(9000)]
    plays = make_plays(rows)
    return plays, UserBuckets(spark, scratch_path(spark, "by_user"), 4, heavy_plays=100).write(plays)


def test_sessions_of_bucketed_users_need_no_exchange(bucketed):
    plays, stored = bucketed
    light = stored.light_sessions()
    assert exchanges(plan(light)) == [] and "Exchange" not in final_plan(light)
    assert times(stored.sessions().collect()) == times(ops.sessionize(plays).collect())
    assert sorted(map(tuple, stored.plays().collect())) == sorted(map(tuple, plays.collect()))


def test_heavy_users_move_only_their_cells(bucketed):
    _, stored = bucketed
    text = plan(stored.heavy_sessions())
    # One exchange, on the user, above both halves of the aggregate that counts the cells.
    assert [e.startswith("hashpartitioning(userId") for e in exchanges(text)] == [True]
    below = text[text.index("Exchange hashpartitioning") :]
    assert "partial_count" in below and below.count("HashAggregate") == 2
    assert stored.heavy().select("timeBlock").distinct().count() > 1


def test_buckets_are_found_again(spark, bucketed):
    plays, stored = bucketed
    stored.forget()
    again = UserBuckets(spark, stored.path, 4)
    assert exchanges(plan(again.light_sessions())) == []
    assert again.sessions().count() == ops.sessionize(plays).count()
    again.forget()
    with pytest.raises(ValueError, match="no plays"):
        UserBuckets(spark, scratch_path(spark, "nothing"), 4).light()


def test_every_row_gets_its_rank(spark):
    rows = [(i * 7919 % 500 if i % 3 else 0, f"u{i:04d}", i % 5 or None) for i in range(3000)]
    frame = spark.createDataFrame(rows, "plays long, userId string, country int")
    order = [F.desc("plays"), F.asc("userId")]
    ranked = number_rows(frame, order, partitions=16)
    want = frame.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    assert sorted(map(str, ranked.collect())) == sorted(map(str, want.collect()))
    # The only window over one partition sees one row per range.
    text = final_plan(ranked)
    assert "Exchange SinglePartition" in text and text.count("Window [") == 1
    assert "userId" not in text[text.index("Window [") : text.index("Exchange SinglePartition")]
    grouped = number_in_groups(frame, ["country"], order, partitions=16)
    want = frame.withColumn("rank", F.row_number().over(Window.partitionBy("country").orderBy(*order)))
    assert sorted(map(str, grouped.collect())) == sorted(map(str, want.collect()))
    assert number_rows(frame.limit(0), order).count() == 0


def test_ranks_are_rechecked_in_ranges(spark):
    frame = spark.createDataFrame([(i, f"u{i}", 1000 - i) for i in range(1, 900)], "rank int, userId string, n int")
    wrong = frame.withColumn("rank", F.when(F.col("rank") == 7, 8).when(F.col("rank") == 8, 7).otherwise(F.col("rank")))
    assert rank_errors(recheck_ranks(frame, [F.desc("n")])).count() == 0
    assert sorted(r.rankDifference for r in rank_errors(recheck_ranks(wrong, [F.desc("n")])).collect()) == [-1, 1]


def test_raw_batches_equal_one_cleaned_run(spark, tmp_path):
    """Raw files that overlap: copies of earlier plays, late plays, bad rows."""
    random.seed(6)
    lines = [
        (f"u{i % 4}", f"2009-05-{1 + i % 3:02}T{i * 7 % 24:02}:{i * 13 % 60:02}:00Z", "", f"A{i % 3}", "", f"t{i % 5}")
        for i in range(120)
    ] + [("u1", "never", "", "A", "", "x")]
    parts = {0: lines[:60], 1: lines[40:90], 2: lines[80:] + lines[:10], 3: []}

    def config(name, rows):
        (tmp_path / name).mkdir()
        made = JobConfig(input_path=str(tmp_path / name), output_path=str(tmp_path / "out"))
        (tmp_path / name / made.events_file).write_text("".join("\t".join(r) + "\n" for r in rows))
        return made

    for batch, rows in parts.items():
        store = stages.add_batch(spark, config(f"in{batch}", rows), batch)
    stages.add_batch(spark, JobConfig(input_path=str(tmp_path / "in1"), output_path=str(tmp_path / "out")), 1)
    whole = clean_events(read_events(spark, config("all", lines).events_path))
    assert times(store.sessions().collect()) == times(ops.sessionize(whole).collect())
    stored = spark.read.parquet(str(tmp_path / "out" / "silver" / "plays-by-batch"))
    assert stored.count() == whole.count()
