import datetime as dt
import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sessionlab.operators import gaps
from sessionlab.operators import sessions as ops

BASE = dt.datetime(2023, 1, 1)


def brute_sessions(rows, gap_minutes):
    """Sort each user's plays and cut where the whole-second gap is too long."""
    users = defaultdict(list)
    for user, time, track in rows:
        users[user].append((time, track))
    found = {}
    for user, plays in users.items():
        number, last = 0, None
        for time, track in sorted(plays):
            second = time.replace(microsecond=0)
            if last is not None and (second - last).total_seconds() > gap_minutes * 60:
                number += 1
            last = second
            found.setdefault((user, number), []).append((time, track))
    return found


def as_sets(frame):
    return {(r.userId, r.sessionNumber): r for r in frame.collect()}


def test_plays_within_gap_form_one_session(make_plays):
    plays = make_plays([("u1", "10:00", "a"), ("u1", "10:15", "b"), ("u1", "10:25", "c")])
    (session,) = ops.sessionize(plays, 20).collect()
    assert session.trackCount == 3
    assert session.userSessionId == "u1_0"
    assert float(session.durationMinutes) == 25.0


def test_longer_gap_splits(make_plays):
    plays = make_plays([("u1", "10:00", "a"), ("u1", "10:25", "b")])
    assert sorted(r.trackCount for r in ops.sessionize(plays, 20).collect()) == [1, 1]


def test_exact_gap_stays_and_one_second_more_splits(make_plays):
    plays = make_plays(
        [
            ("u1", "10:00:00", "A"),
            ("u1", "10:20:00", "B"),
            ("u1", "10:40:01", "C"),
            ("u2", "09:00", "X"),
            ("u2", "09:15", "Y"),
        ]
    )
    tracks = defaultdict(set)
    for r in ops.assign_sessions(plays, 20).collect():
        tracks[r.userSessionId].add(r.trackName)
    assert tracks == {"u1_0": {"A", "B"}, "u1_1": {"C"}, "u2_0": {"X", "Y"}}


def test_single_play_and_no_plays(make_plays):
    (one,) = ops.sessionize(make_plays([("u1", "10:00", "a")]), 20).collect()
    assert (one.trackCount, float(one.durationMinutes)) == (1, 0.0)
    empty = make_plays([("u1", "10:00", "a")]).filter(F.lit(False))
    assert ops.sessionize(empty, 20).count() == 0


def test_duration(make_plays):
    plays = make_plays([("u", "10:00", "a"), ("u", "10:20", "b"), ("u", "10:40", "c"), ("u", "10:45", "d")])
    assert float(ops.sessionize(plays, 20).first().durationMinutes) == 45.0


def test_gap_ignores_fractions_of_a_second(make_plays):
    start = dt.datetime(2023, 1, 1, 10, 0, 0, 100_000)
    late = dt.datetime(2023, 1, 1, 10, 20, 0, 900_000)
    plays = make_plays([("u", start, "a"), ("u", late, "b")])
    assert ops.sessionize(plays, 20).count() == 1


def test_cells_at_the_edge_of_the_epoch(make_plays):
    times = [dt.datetime(1969, 12, 31, 23, 50), dt.datetime(1970, 1, 1, 0, 5), dt.datetime(1970, 1, 1, 0, 26)]
    plays = make_plays([("u", t, str(i)) for i, t in enumerate(times)])
    assert sorted(r.trackCount for r in ops.sessionize(plays, 20).collect()) == [1, 2]


PLAY = st.tuples(
    st.sampled_from(["u1", "u2", "u3"]),
    st.integers(min_value=0, max_value=40_000),
    st.integers(min_value=0, max_value=999_999),
    st.sampled_from("abcd"),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PLAY, min_size=1, max_size=60, unique=True), st.sampled_from([1, 20, 90]))
def test_matches_brute_force(make_plays, rows, gap):
    rows = [(u, BASE + dt.timedelta(seconds=s, microseconds=us), k) for u, s, us, k in rows]
    want = brute_sessions(rows, gap)
    plays = make_plays(rows)

    got = as_sets(ops.sessionize(plays, gap))
    assert set(got) == set(want)
    for key, members in want.items():
        times = [t for t, _ in members]
        assert got[key].trackCount == len(members)
        assert (got[key].sessionStart, got[key].sessionEnd) == (min(times), max(times))

    unique = as_sets(ops.sessionize_with_tracks(plays, gap))
    assert {k: r.uniqueTracks for k, r in unique.items()} == {
        k: len({t for _, t in m}) for k, m in want.items()
    }

    assigned = defaultdict(list)
    for r in ops.assign_sessions(plays, gap).collect():
        assigned[(r.userId, r.sessionNumber)].append((r.timestamp, r.trackName))
    assert {k: sorted(v) for k, v in assigned.items()} == {k: sorted(v) for k, v in want.items()}


def random_rows(n=3000, users=5, seed=7):
    rng = random.Random(seed)
    # Half of the plays belong to one user.
    return [
        (
            "hot" if rng.random() < 0.5 else f"u{rng.randrange(users)}",
            BASE + dt.timedelta(seconds=rng.randrange(20 * 86400)),
            f"t{rng.randrange(40)}",
        )
        for _ in range(n)
    ]


def test_session_invariants(make_plays):
    plays = make_plays(random_rows())
    sessions = ops.sessionize(plays, 20).collect()
    assert sum(s.trackCount for s in sessions) == plays.count()
    per_user = defaultdict(list)
    for s in sessions:
        per_user[s.userId].append(s)
    for own in per_user.values():
        own.sort(key=lambda s: s.sessionNumber)
        assert [s.sessionNumber for s in own] == list(range(len(own)))
        for before, after in zip(own, own[1:]):
            assert (after.sessionStart - before.sessionEnd).total_seconds() > 1200


@pytest.mark.parametrize("partitions", [1, 3, 11])
def test_result_does_not_depend_on_row_order(make_plays, partitions):
    rows = random_rows(600)
    expected = sorted(map(tuple, ops.sessionize(make_plays(rows), 20).collect()))
    random.Random(partitions).shuffle(rows)
    shuffled = make_plays(rows).repartition(partitions)
    assert sorted(map(tuple, ops.sessionize(shuffled, 20).collect())) == expected


def test_top_sessions_order_and_limit(make_plays):
    rows = []
    for n in range(1, 6):
        start = BASE + dt.timedelta(days=n)
        rows += [("u", start + dt.timedelta(minutes=i), f"t{i}") for i in range(n)]
    top = ops.top_sessions(ops.sessionize(make_plays(rows), 20), 3).collect()
    assert [r.trackCount for r in top] == [5, 4, 3]


def test_top_sessions_ties(make_plays):
    day = [BASE + dt.timedelta(days=d) for d in range(3)]
    minute = dt.timedelta(minutes=1)
    rows = [
        ("b", day[0], "x"), ("b", day[0] + 5 * minute, "y"),
        ("a", day[0], "x"), ("a", day[0] + 5 * minute, "y"),
        ("c", day[1], "x"), ("c", day[1] + 9 * minute, "y"),
    ]
    top = ops.top_sessions(ops.sessionize(make_plays(rows), 20), 3).collect()
    assert [r.userId for r in top] == ["c", "a", "b"]


def test_plays_of_returns_exactly_the_plays_of_the_sessions(make_plays):
    rows = random_rows(800)
    plays = make_plays(rows)
    chosen = ops.top_sessions(ops.sessionize(plays, 20), 7)
    want = brute_sessions(rows, 20)
    keys = {(r.userId, r.sessionNumber) for r in chosen.collect()}
    expected = sorted((u, t, k) for key in keys for u in [key[0]] for t, k in want[key])
    got = sorted((r.userId, r.timestamp, r.trackName) for r in ops.plays_of(plays, chosen, 20).collect())
    assert got == expected


def test_nested_tracks_come_back_in_order(make_plays):
    rows = random_rows(300)
    assigned = ops.assign_sessions(make_plays(rows), 20)
    nested = ops.nest_tracks(assigned, block=3)
    for r in nested.collect():
        times = [t.timestamp for t in r.tracks]
        assert times == sorted(times)
        assert [t.position for t in r.tracks] == list(range(3 * r.part, 3 * r.part + len(times)))
        assert len(times) <= 3
    columns = ["userId", "userSessionId", "trackName", "artistName", "timestamp"]
    back = sorted(map(tuple, ops.explode_tracks(nested).select(columns).collect()))
    assert back == sorted(map(tuple, assigned.select(columns).collect()))


def test_session_checks_count_bad_rows(spark):
    time = dt.datetime(2023, 1, 1)
    later = time + dt.timedelta(hours=1)
    rows = [("u", 1, time, later), (None, 0, None, later), ("", 2, later, time), ("v", 1, time, None)]
    sessions = spark.createDataFrame(
        rows, "userId string, trackCount long, sessionStart timestamp, sessionEnd timestamp"
    )
    assert ops.session_checks(sessions).first().asDict() == {
        "totalSessions": 4,
        "nullUserIds": 2,
        "nullStartTimes": 1,
        "nullEndTimes": 1,
        "invalidTrackCounts": 1,
        "invalidTimeOrder": 1,
    }


def test_previous_play_matches_brute_force(make_plays):
    rows = sorted(set(random_rows(1500)))
    want = {}
    last = {}
    for user, time, track in rows:
        want[(user, time, track)] = last.get(user)
        last[user] = time
    got = gaps.with_previous_play(make_plays(rows), "trackName", gap_minutes=20).collect()
    assert {(r.userId, r.timestamp, r.trackName): r.previousTimestamp for r in got} == want
    for r in got:
        gap = 0 if r.previousTimestamp is None else (r.timestamp - r.previousTimestamp).total_seconds()
        assert r.gapSeconds == gap
        assert r.isSessionBreak == (1 if gap > 1200 else 0)


def test_gap_stats_of_a_user_with_one_session(make_plays):
    stats = {r.userId: r for r in gaps.gap_stats(
        make_plays([("one", "10:00", "a"), ("two", "10:00", "a"), ("two", "10:10", "b"), ("two", "12:00", "c")]), 20
    ).collect()}
    assert (stats["one"].breaks, stats["one"].sessions, stats["one"].playsPerSession) == (0, 1, 1.0)
    assert (stats["two"].breaks, stats["two"].sessions, stats["two"].playsPerSession) == (1, 2, 1.5)
    assert stats["two"].avgGapMinutes == pytest.approx(40.0)
    assert stats["two"].medianGapMinutes == pytest.approx(10.0)


def test_gap_distribution_limits_are_inclusive(make_plays):
    seconds = [60, 61, 300, 1200, 3600, 86400, 86401]
    time, rows = BASE, [("u", BASE, "t")]
    for s in seconds:
        time += dt.timedelta(seconds=s)
        rows.append(("u", time, "t"))
    rows.append(("u", time, "other"))  # a gap of zero is not counted
    got = [(r.gapCategory, r.gapCount) for r in gaps.gap_distribution(make_plays(rows)).collect()]
    assert got == [
        ("≤1 min", 1), ("1-5 min", 2), ("5-20 min", 1), ("20-60 min", 1), ("1-24 hours", 1), (">24 hours", 1),
    ]


@pytest.mark.parametrize("block", [1, 2, 3, 1000])
def test_chronology(spark, block):
    def frame(minutes):
        rows = [("k", i, BASE + dt.timedelta(minutes=m)) for i, m in enumerate(minutes)]
        return spark.createDataFrame(rows, "key string, seq long, timestamp timestamp_ntz")

    good = gaps.check_chronology(frame([0, 5, 10, 10]), "key", "seq", block=block).first()
    assert (good.inOrder, good.stepsBack, good.rows) == (True, 0, 4)
    bad = gaps.check_chronology(frame([0, 10, 5, 6, 1]), "key", "seq", block=block).first()
    assert (bad.inOrder, bad.stepsBack) == (False, 2)
