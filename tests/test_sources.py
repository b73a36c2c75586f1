import datetime as dt
import re
import sys

import pytest
from pyspark.sql import functions as F

from sessionlab import JobConfig
from sessionlab.operators import layout
from sessionlab.operators.sessions import sessionize
from sessionlab.plans import stages
from sessionlab.schemas import METRIC
from sessionlab.session import scratch_path, scratch_run
from sessionlab.sources import readers, writers
from sessionlab.sources.files import exists


def write(path, lines):
    path.write_text("".join("\t".join(line) + "\n" for line in lines), encoding="utf-8")
    return str(path)


def test_events_are_read_as_text_and_empty_fields_are_missing(spark, tmp_path):
    path = write(tmp_path / "e.tsv", [("u", "2009-05-04T23:08:57Z", "", "A", "", "x")])
    assert tuple(readers.read_events(spark, path).first()) == ("u", "2009-05-04T23:08:57Z", None, "A", None, "x")


def test_typed_read_turns_bad_times_into_null(spark, tmp_path):
    path = write(
        tmp_path / "e.tsv",
        [("u", "2009-05-04T23:08:57Z", "", "A", "", "x"), ("u", "never", "", "A", "", "x")],
    )
    times = [r.timestamp for r in readers.read_events_typed(spark, path).collect()]
    assert times == [dt.datetime(2009, 5, 4, 23, 8, 57), None]


def test_quotes_can_be_kept(spark, tmp_path):
    path = write(tmp_path / "e.tsv", [("u", "t", "", 'the "A" side', "", '"open quote')])
    kept = readers.read_events(spark, path, quote="").first()
    assert (kept.artistName, kept.trackName) == ('the "A" side', '"open quote')


def test_profiles(spark, tmp_path):
    path = write(tmp_path / "p.tsv", [("u1", "m", "", "Japan", "Aug 13, 2006"), ("u2", "", "25", "", "")])
    assert [tuple(r) for r in readers.read_profiles(spark, path).collect()] == [
        ("u1", "m", None, "Japan", "Aug 13, 2006"),
        ("u2", None, 25, None, None),
    ]


def test_merged_parquet_schemas(spark, tmp_path):
    a = writers.write_parquet(spark.range(2).withColumn("x", F.lit("a")), str(tmp_path / "a"))
    b = writers.write_parquet(spark.range(2, 4), str(tmp_path / "b"))
    rows = readers.read_parquet(spark, a, b, merge_schema=True).orderBy("id").collect()
    assert [(r.id, r.x) for r in rows] == [(0, "a"), (1, "a"), (2, None), (3, None)]


def test_single_tsv_is_one_file_with_that_name(spark, tmp_path):
    path = tmp_path / "results" / "top.tsv"
    for track in ("first", "second"):  # the second write replaces the first
        ranked = spark.createDataFrame(
            [(1, track, "A", 3, 2, 1)],
            "rank int, trackName string, artistName string, playCount long, sessionCount long, userCount long",
        )
        writers.write_single_tsv(ranked.repartition(3), str(path))
    assert path.is_file()
    assert [p.name for p in path.parent.iterdir() if not p.name.startswith(".")] == ["top.tsv"]
    assert path.read_text().splitlines() == [
        "rank\ttrackName\tartistName\tplayCount\tsessionCount\tuserCount",
        "1\tsecond\tA\t3\t2\t1",
    ]
    assert tuple(readers.read_ranked_songs(spark, str(path)).first()) == (1, "second", "A", 3, 2, 1)


def test_an_older_result_survives_a_failed_write(spark, tmp_path):
    path = tmp_path / "top.tsv"
    writers.write_single_tsv(spark.sql("SELECT 1 AS a"), str(path))
    with pytest.raises(Exception):
        writers.write_single_tsv(spark.sql("SELECT raise_error('no') AS a"), str(path))
    assert path.read_text().splitlines() == ["a", "1"]
    writers.write_single_tsv(spark.sql("SELECT 2 AS a"), str(path))
    assert path.read_text().splitlines() == ["a", "2"]
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["top.tsv"]


def test_cached_frames_are_released(spark):
    frame = spark.range(10)
    with layout.cached(frame) as kept:
        assert kept.count() == 10 and kept.is_cached
    assert not frame.is_cached


def test_results_with_other_names_and_bad_numbers(spark, tmp_path):
    path = write(tmp_path / "r.tsv", [("rank", "track_name", "artist_name", "play_count"), ("1", "x", "A", "many")])
    names = {"trackName": "track_name", "artistName": "artist_name", "playCount": "play_count"}
    assert readers.read_ranked_songs(spark, path, names, ["rank", *names]).first().asDict() == {
        "rank": 1, "trackName": "x", "artistName": "A", "playCount": None,
    }
    in_file = ["rank", "track_name", "artist_name", "play_count"]
    some = readers.read_ranked_songs(spark, path, names, ["rank", "trackName"], in_file)
    assert tuple(some.first()) == (1, "x")


def test_results_without_a_wanted_column_raise(spark, tmp_path):
    path = write(tmp_path / "r.tsv", [("rank", "trackName", "playCount"), ("1", "x", "2")])
    with pytest.raises(ValueError, match="artistName"):
        readers.read_ranked_songs(spark, path, file_columns=["rank", "trackName", "playCount"])
    with pytest.raises(Exception, match="header"):
        readers.read_ranked_songs(spark, path).collect()


def test_user_partitions_and_metrics(spark, make_plays, tmp_path):
    plays = make_plays([("u1", "10:00", "a"), ("u2", "10:00", "b"), ("u1", "11:00", "c")])
    path = writers.write_user_partitioned(plays, str(tmp_path / "by_user"))
    folders = sorted(p.name for p in (tmp_path / "by_user").iterdir() if p.name.startswith("userId="))
    assert folders == ["userId=u1", "userId=u2"]
    assert readers.read_parquet(spark, path).count() == 3

    ids = ["007", "2024-01-01", "a/b", "000123"]
    plays = make_plays([(user, "10:00", "a") for user in ids])
    path = writers.write_user_partitioned(plays, str(tmp_path / "odd"))
    back = readers.read_parquet(spark, path, schema=plays.schema)
    assert sorted(r.userId for r in back.collect()) == sorted(ids)
    path = writers.write_user_partitioned(plays, str(tmp_path / "hashed"), folders=2)
    hashed = readers.read_parquet(spark, path)
    assert sorted(r.userId for r in hashed.collect()) == sorted(ids)
    assert hashed.filter(F.col("userFolder") != writers.user_folder("userId", 2)).count() == 0

    metrics = spark.createDataFrame([("rows_read", "3")], METRIC)
    path = writers.write_metrics_csv(metrics, str(tmp_path / "metrics"))
    (part,) = (tmp_path / "metrics").glob("part-*")
    assert part.read_text().splitlines() == ["metric,value", "rows_read,3"]


def test_bucketed_table_needs_no_exchange(spark, make_plays):
    plays = make_plays([(f"u{i % 9}", f"{i % 24}:{i % 60}", f"t{i}") for i in range(200)])
    writers.write_user_bucketed(plays, "plays_by_user", 4)
    per_user = spark.table("plays_by_user").groupBy("userId").count()
    assert "Exchange" not in per_user._jdf.queryExecution().executedPlan().toString()
    assert per_user.count() == 9


def test_partition_rules(spark):
    def value(column):
        return spark.range(1).select(column).first()[0]

    assert [value(layout.partition_advice(users, cores)) for users, cores in
            ((1000, 8), (1000, 1), (100, 1), (10**6, 8))] == [16, 14, 4, 32]
    assert value(layout.partition_advice(10**6, 8, max_partitions=5000)) == 5000
    assert [value(layout.should_repartition(n, 10)) for n in (5, 6, 10, 18, 19)] == [
        True, False, False, False, True,
    ]
    assert [value(layout.is_balanced(F.lit(u), 10)) for u in (299, 300, 1000, 1001)] == [
        False, True, True, False,
    ]


def test_user_estimate_falls_back(spark, make_plays):
    plays = make_plays([("u1", "10:00", "a"), ("u2", "10:00", "b")])
    assert layout.estimate_users(plays) == 2
    assert layout.estimate_users(plays.drop("userId")) == 1000
    assert layout.user_count(plays, approximate=True).first().users == 2


def test_hash_sample_does_not_depend_on_partitions(spark):
    rows = spark.range(5000)
    a = {r.id for r in layout.hash_sample(rows, 0.1, "id").collect()}
    b = {r.id for r in layout.hash_sample(rows.repartition(7), 0.1, "id").collect()}
    assert a == b and 400 < len(a) < 600


def test_balance_report(spark, make_plays):
    plays = make_plays([(f"u{i}", "10:00", "a") for i in range(50)])
    report = layout.balance_report(plays.coalesce(1)).collect()
    assert [(r.rows, r.users, r.balanced) for r in report] == [(50, 50, True)]


def test_config():
    config = JobConfig.from_env({"SESSION_GAP_MINUTES": "30", "TOP_SONGS": "ten", "OUTPUT_PATH": "/x"})
    assert (config.session_gap_minutes, config.top_songs, config.output_path) == (30, 10, "/x")
    for bad in ({"TOP_SESSIONS": "0"}, {"SESSION_GAP_MINUTES": "-1"}, {"INPUT_PATH": ""}, {"USER_BUCKETS": "-1"}):
        with pytest.raises(ValueError):
            JobConfig.from_env(bad)


def test_scratch_paths_are_fresh_and_below_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("buckets", [0, 3])
def test_complete_run(spark, tmp_path, buckets):
    """One user, sessions of 3, 2 and 1 plays; the first two are the longest."""
    lines = []
    for day, minutes, tracks in ((1, (0, 10, 30), "xyx"), (2, (0, 20), "xz"), (3, (0,), "z")):
        for minute, track in zip(minutes, tracks):
            lines.append(("u", f"2009-05-0{day}T10:{minute:02}:00Z", "", "A", "", track))
    lines += [lines[0], ("u", "bad time", "", "A", "", "x"), ("u", "2009-05-01T10:00:00Z", "", "", "", "x")]
    (tmp_path / "in").mkdir()
    config = JobConfig(top_sessions=2, top_songs=2, input_path=str(tmp_path / "in"),
                       output_path=str(tmp_path / "out"), user_buckets=buckets)
    write(tmp_path / "in" / config.events_file, lines)

    metrics = stages.run(spark, config)
    assert list(metrics) == ["data-cleaning", "session-analysis", "ranking"]
    assert metrics["data-cleaning"].first().totalRecords == 6
    assert metrics["session-analysis"].first().sessionCount == 3
    assert metrics["ranking"].first().totalPlays == 5
    assert (tmp_path / "out" / "results" / "top_songs.tsv").read_text().splitlines() == [
        "rank\ttrackName\tartistName\tplayCount\tsessionCount\tuserCount",
        "1\tx\tA\t3\t2\t1",
        "2\ty\tA\t1\t1\t1",
    ]
    assert list(stages.run(spark, config, "ranking")) == ["ranking"]
    assert len(stages.run(spark, config, "no such stage")) == 3

    plays = readers.read_parquet(spark, config.output(*stages.PLAYS))
    assert sorted(r.trackCount for r in sessionize(plays).collect()) == [1, 2, 3]
    if buckets:
        stored = stages.plays_by_user(spark, config)
        assert stored.plays().count() == 6
        stored.forget()


def test_a_run_leaves_no_scratch_tables(spark):
    keep = scratch_path(spark, "result")
    with pytest.raises(ValueError, match="stop"), scratch_run(spark) as folder:
        spark.range(5).write.parquet(scratch_path(spark, "inner"))
        with scratch_run(spark) as nested:
            spark.range(5).write.parquet(scratch_path(spark, "innermost"))
        assert nested.startswith(folder) and exists(spark, folder) and not exists(spark, nested)
        spark.range(3).write.parquet(keep)
        raise ValueError("stop")
    assert not exists(spark, folder) and spark.read.parquet(keep).count() == 3
    assert not scratch_path(spark, "later").startswith(folder)


def test_entry_survives_a_missing_package(monkeypatch):
    import __spark_entry__

    monkeypatch.setitem(sys.modules, "sessionlab.llm.registry", None)
    with pytest.warns(UserWarning, match="cannot be loaded"):
        names = set(__spark_entry__.queries())
    assert len(names) > 170 and not any(re.match(r"op\d+_|pipeline$", n) for n in names)
