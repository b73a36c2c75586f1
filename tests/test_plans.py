"""What Spark actually plans."""

import re

import pytest

from sessionlab.operators import gaps, ranking
from sessionlab.operators import sessions as ops
from sessionlab.operators.cleaning import clean_events
from sessionlab.plans import profiles, users
from sessionlab.schemas import PLAY_EVENT
from sessionlab.sources import readers, writers


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.collect()
    return plan(frame).split("Initial Plan")[0]


@pytest.fixture(scope="module")
def stored(spark, make_plays, tmp_path_factory):
    rows = [(f"u{i % 7}", f"{i % 24}:{i % 60}", f"t{i % 13}") for i in range(400)]
    path = str(tmp_path_factory.mktemp("plans") / "plays")
    writers.write_parquet(make_plays(rows), path)
    return readers.read_parquet(spark, path)


def exchanges(text):
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning)", text)


def test_sessions_move_only_cells(stored):
    text = plan(ops.sessionize(stored, 20))
    # Partial aggregate, exchange on (user, cell), exchange on user for the window; none after it.
    assert len(exchanges(text)) == 2
    assert "cell" in exchanges(text)[1] and "cell" not in exchanges(text)[0]
    assert "ReadSchema: struct<userId:string,timestamp:timestamp_ntz>" in text
    assert text.index("partial_count") > text.index("Exchange hashpartitioning")


def test_one_sort_serves_both_windows(stored):
    assert plan(ops.number_cells(ops.activity_cells(stored, 20), 20)).count("Sort [") == 1


def test_top_lists_keep_only_k_rows_per_task(stored):
    assert "TakeOrderedAndProject(limit=50" in plan(ops.top_sessions(ops.sessionize(stored, 20)))


def test_plays_of_broadcasts_only_what_is_small(spark, stored):
    """The sessions' cells are no larger than the plays they come from, and are planned as such;
    when they turn out to be few, the join becomes a broadcast while it runs."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "2000",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    }
    for name, value in limits.items():
        spark.conf.set(name, value)
    try:
        chosen = ops.top_sessions(ops.sessionize(stored, 20))
        frame = ops.plays_of(stored, chosen, 20)
        joins = re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan(frame))
        assert not any("cell" in keys for keys in joins)
        final = re.findall(r"BroadcastHashJoin \[([^\]]*)\]", final_plan(frame))
        assert any("cell" in keys for keys in final)
    finally:
        for name in limits:
            spark.conf.unset(name)


def test_cleaning_shuffle_is_shared(spark, tmp_path):
    path = tmp_path / "events.tsv"
    path.write_text("u\t2009-05-04T23:08:57Z\t\tA\t\tx\n" * 50)
    plays = clean_events(readers.read_events(spark, str(path)))
    for frame in (ranking.top_songs_in_top_sessions(plays), ops.assign_sessions(plays)):
        text = final_plan(frame)
        assert text.count("FileScan csv") == 1
        assert text.count("ReusedExchange") >= 1


def test_deduplication_is_a_hash_aggregate_with_map_side_combine(spark):
    text = plan(clean_events(spark.createDataFrame([], PLAY_EVENT)))
    assert "SortAggregate" not in text and "partial_min" in text and len(exchanges(text)) == 1


def test_previous_play_windows_are_cut_by_time(stored):
    text = plan(gaps.with_previous_play(stored, "trackKey"))
    windows = re.findall(r"lag\([^)]*\) windowspecdefinition\(([^)]*)", text)
    over_plays = [w for w in windows if "timestamp" in w]
    assert over_plays and all(re.match(r"userId#\d+, cell#\d+", w) for w in over_plays)


def test_top_n_per_group_cuts_before_the_shuffle(stored):
    counts = stored.groupBy("userId", "artistName").count()
    text = plan(ranking.top_per_group(counts, ["artistName"], [counts["count"].desc()], 3))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_profiles_join_reduced_rows(spark, stored):
    people = spark.createDataFrame([("u1", "m", 20, "Japan")], "userId string, gender string, age int, country string")
    text = plan(profiles.top_artists_by_country(stored, people, min_users=1))
    below_join = text[text.index("Join") :]
    assert "partial_count" in below_join


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(stored.filter("artistName = 'artist'").groupBy("userId").count())
    assert "EqualTo(artistName,artist)" in text
    assert "ReadSchema: struct<userId:string,artistName:string>" in text


def test_no_python_in_any_plan(stored):
    frames = [
        ops.sessionize_with_tracks(stored), ops.assign_sessions(stored), gaps.gap_stats(stored),
        users.user_activity(stored), ranking.track_popularity(ops.assign_sessions(stored)),
    ]
    for frame in frames:
        assert not re.search("Python|Pandas|CartesianProduct|NestedLoop", plan(frame))
