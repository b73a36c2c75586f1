import datetime as dt
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sessionlab.operators import ranking
from sessionlab.operators.percentiles import percentiles
from sessionlab.operators.sessions import assign_sessions, sessionize, sessionize_with_tracks, top_sessions
from sessionlab.operators.shares import long_tail, with_percentage
from sessionlab.plans import content, profiles, session_reports, temporal, users, validation


def by(frame, key):
    return {r[key]: r for r in frame.collect()}


# Rankings


def test_popularity_counts(make_plays):
    plays = make_plays(
        [("u", "10:00", "t1", "a1"), ("u", "10:05", "t1", "a1"), ("u", "12:00", "t1", "a1"),
         ("v", "10:00", "t1", "a1"), ("v", "10:01", "t2", "a2")]
    )
    got = by(ranking.track_popularity(assign_sessions(plays, 20)), "trackName")
    assert (got["t1"].playCount, got["t1"].sessionCount, got["t1"].userCount) == (4, 3, 2)
    assert (got["t2"].playCount, got["t2"].sessionCount, got["t2"].userCount) == (1, 1, 1)
    assert (got["t1"].firstPlayed.hour, got["t1"].lastPlayed.hour) == (10, 12)


def test_top_songs_order(spark):
    first = dt.datetime(2023, 1, 1)
    later = dt.datetime(2023, 1, 2)
    rows = [
        ("A", "x", 10, 1, 1, first), ("B", "x", 5, 1, 1, first), ("C", "x", 15, 1, 1, first),
        ("D", "x", 10, 2, 1, later), ("E", "x", 10, 2, 2, later), ("F", "w", 10, 2, 2, later),
        ("G", "x", 10, 2, 2, first),
    ]
    popularity = spark.createDataFrame(
        rows,
        "trackName string, artistName string, playCount long, sessionCount long, userCount long, "
        "firstPlayed timestamp",
    )
    got = ranking.top_songs(popularity, 6).orderBy("rank").collect()
    assert [r.trackName for r in got] == ["C", "G", "F", "E", "D", "A"]
    assert [r["rank"] for r in got] == [1, 2, 3, 4, 5, 6]
    metrics = ranking.ranking_metrics(popularity, ranking.top_songs(popularity, 2)).first()
    assert (metrics.totalPlays, metrics.topSongsTotalPlays, metrics.avgPlaysTopSongs) == (70, 25, 12.5)


def test_top_per_group(spark):
    rows = spark.createDataFrame([("g", "a", 3), ("g", "b", 5), ("g", "c", 5), ("h", "a", 1)], "k string, i string, n int")
    got = ranking.top_per_group(rows, ["k"], [F.desc("n"), F.asc("i")], 2).orderBy("k", "rank").collect()
    assert [(r.k, r.i, r["rank"]) for r in got] == [("g", "b", 1), ("g", "c", 2), ("h", "a", 1)]


# Shares


def brute_long_tail(counts, share):
    goal = int(sum(counts) * share)
    so_far = 0
    for position, n in enumerate(sorted(counts, reverse=True), start=1):
        so_far += n
        if so_far >= goal:
            return position


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60), st.sampled_from([0.1, 0.5, 0.8, 1.0]))
def test_long_tail_matches_brute_force(spark, counts, share):
    items = spark.createDataFrame([(n,) for n in counts], "totalPlays long")
    row = long_tail(items, share=share).first()
    assert (row.totalItems, row.totalPlays) == (len(counts), sum(counts))
    assert row.itemsForShare == brute_long_tail(counts, share)


def test_percentage(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    assert {r.k: r.percentage for r in with_percentage(rows, "n").collect()} == {"a": 33.33, "b": 66.67}


# Users


def activity(spark, rows):
    return spark.createDataFrame(
        rows, "userId string, totalPlays long, uniqueTracks long, uniqueArtists long, listeningSpanDays int"
    )


def test_play_segments_at_their_limits(spark):
    rows = [(str(n), n, 1, 1, 0) for n in (99, 100, 999, 1000, 9999, 10000)]
    got = by(users.play_segments(activity(spark, rows)), "userSegment")
    assert {k: (r.userCount, r.totalSegmentPlays) for k, r in got.items()} == {
        "Casual User": (1, 99), "Regular User": (2, 1099), "Active User": (2, 10999), "Power User": (1, 10000),
    }


def test_user_types_at_their_limits(spark):
    cases = [
        (5000, 25.0, "Power User"), (5000, 24.9, "Heavy Listener"), (999, 15.0, "Regular User"),
        (500, 9.9, "Casual Listener"), (100, 4.9, "Light User"), (9, 50.0, "Minimal User"),
    ]
    stats = spark.createDataFrame([(s, t) for s, t, _ in cases], "totalSessions long, avgTracksPerSession double")
    got = {(r.totalSessions, r.avgTracksPerSession): r.userType for r in users.user_types(stats).collect()}
    assert got == {(s, t): label for s, t, label in cases}


def test_similar_users(spark):
    rows = [("ref", 100, 10.0), ("near", 110, 11.0), ("edge", 130, 12.0), ("far", 131, 10.0), ("other", 100, 12.1)]
    typed = spark.createDataFrame(rows, "userId string, totalSessions long, avgTracksPerSession double").withColumns(
        {"userType": F.lit("x"), "avgSessionDuration": F.lit(1.0)}
    )
    assert [r.userId for r in users.similar_users(typed, "ref").collect()] == ["near", "edge"]
    assert users.similar_users(typed, "nobody").count() == 0


def test_outliers_name_the_first_reason(spark):
    rows = [(f"u{i}", 10, 10, 1, 9) for i in range(50)]
    rows += [("plays", 100, 100, 1, 99), ("daily", 18, 18, 1, 0), ("repeat", 10, 2, 1, 9)]
    got = by(users.outlier_users(activity(spark, rows), factor=2.0, percentile=0.5), "userId")
    assert {u: r.outlierReason for u, r in got.items()} == {
        "plays": "Extreme play count", "daily": "Extreme daily activity", "repeat": "Extreme repetition",
    }


def test_repeat_listening(make_plays):
    plays = make_plays([("u", f"10:0{i}", "a") for i in range(3)] + [("u", "11:00", "b"), ("v", "10:00", "a")])
    repeats = users.repeats_per_user(plays)
    assert [(r.userId, r.repeatedTracks, r.maxRepeats) for r in repeats.collect()] == [("u", 1, 3)]
    assert users.repeat_listening(repeats).first().globalMaxRepeats == 3


def test_user_activity(make_plays):
    plays = make_plays([("u", "10:00", "a", "x"), ("u", "10:00", "a", "y"), ("u", "11:00", "a", "x")])
    row = users.user_activity(plays).first()
    assert (row.totalPlays, row.uniqueTracks, row.uniqueArtists, row.listeningSpanDays) == (3, 2, 2, 0)


# Sessions


def described(spark, rows):
    return spark.createDataFrame(
        rows,
        "userId string, userSessionId string, trackCount long, uniqueTracks long, durationMinutes double, "
        "durationHours double, sessionStart timestamp",
    )


def test_anomalies_apply_in_order(spark):
    start = dt.datetime(2023, 1, 1)
    rows = [
        ("u", "1", 600, 600, 800.0, 13.0, start), ("u", "2", 501, 501, 100.0, 2.0, start),
        ("u", "3", 2, 2, 0.0, 0.0, start), ("u", "4", 21, 3, 60.0, 1.0, start),
        ("u", "5", 20, 20, 60.0, 1.0, start), ("u", "6", 1, 1, 0.0, 0.0, start),
        ("u", "7", 21, 21, 60.0, 1.0, start),
    ]
    sessions = described(spark, rows)
    got = by(session_reports.with_anomaly(sessions), "userSessionId")
    assert {k: r.anomaly for k, r in got.items()} == {
        "1": "Extremely Long Duration", "2": "Extremely High Track Count", "3": "Zero Duration Multi-Track",
        "4": "Potential Repeat Loop", "7": "Potential Repeat Loop",
    }
    strict = session_reports.with_anomaly(session_reports.with_diversity(sessions), loop_max_diversity=0.5)
    assert "7" not in by(strict, "userSessionId") and "4" in by(strict, "userSessionId")


def test_diversity_and_extremes(spark):
    start = dt.datetime(2023, 1, 1)
    rows = [("u", str(u), 50, u, 10.0, 0.1, start) for u in (50, 40, 30, 20, 4)]
    diverse = session_reports.with_diversity(described(spark, rows))
    got = by(diverse, "userSessionId")
    assert [got[k].diversityCategory for k in ("50", "40", "30", "20", "4")] == [
        "All Unique", "High Diversity", "Medium Diversity", "Low Diversity", "Very Low Diversity",
    ]
    assert float(got["4"].repetitionsPerTrack) == 11.5
    assert [r.userSessionId for r in session_reports.extreme_repetition(diverse).collect()] == ["4"]
    assert [r.userSessionId for r in session_reports.most_diverse(diverse).collect()] == ["50"]


def test_duration_limits(spark):
    start = dt.datetime(2023, 1, 1)
    rows = [("u", str(m), 1, 1, float(m), m / 60, start) for m in (1, 15, 60, 180, 181)]
    got = by(session_reports.duration_buckets(described(spark, rows)), "durationCategory")
    assert all(r.sessionCount == 1 for r in got.values()) and len(got) == 5
    top = by(session_reports.top_duration_buckets(described(spark, rows)), "durationCategory")
    assert {k: r.percentage for k, r in top.items()} == {
        "Short (<30min)": 40.0, "Medium (30min-2h)": 20.0, "Long (2h-5h)": 40.0,
    }


def test_behaviour_rules(spark):
    rows = [(2.1, 0.9, 200.0), (1.0, 0.9, 200.0), (1.0, 0.2, 200.0), (1.0, 0.5, 121.0), (1.0, 0.5, 120.0)]
    features = spark.createDataFrame(
        rows, "avgTracksPerMinute double, avgDiversityRatio double, avgDurationMinutes double"
    )
    assert [r.behaviorPattern for r in session_reports.with_behaviour(features).collect()] == [
        "Fast Listener", "Explorer", "Repeater", "Marathon Listener", "Balanced Listener",
    ]


def test_features_of_sessions_without_length(make_plays):
    diverse = session_reports.with_diversity(sessionize_with_tracks(make_plays([("u", "10:00", "a")]), 20))
    assert float(session_reports.session_features(diverse).first().tracksPerMinute) == 0.0


def test_percentiles_and_description(spark):
    values = spark.range(1, 101).withColumnRenamed("id", "durationMinutes")
    row = session_reports.duration_percentiles(values).first()
    assert (row.p10, row.p50, row.p99) == (10, 50, 99)
    got = session_reports.describe(values, "durationMinutes").first()
    assert (got["count"], got["mean"], got["min"], got["max"]) == (100, 50.5, 1.0, 100.0)


# Time


@pytest.mark.parametrize("seed", [1, 2])
def test_percentiles_equal_the_sorted_list(spark, seed):
    random.seed(seed)
    values = [random.choice([0.0, -3.5, 1e-9, 7.25, 1e6, random.uniform(-5, 5)]) for _ in range(200)]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    shares = (0.0, 0.01, 0.5, 0.95, 1.0)
    got = percentiles(frame, "x", shares, [f"p{i}" for i in range(5)]).first()
    ordered = sorted(values)
    assert list(got) == [ordered[max(math.ceil(200 * s), 1) - 1] for s in shares]
    assert percentiles(frame.limit(0), "x", (0.5,), ("m",)).first().m is None


def test_low_activity_and_hour_outliers(make_plays):
    start = dt.datetime(2023, 1, 2)
    rows = [("u", start + dt.timedelta(days=d, minutes=i), f"{i}") for d in range(5) for i in range(40)]
    rows.append(("u", start + dt.timedelta(days=6, hours=5), "x"))
    assert [str(r.date) for r in temporal.low_activity_days(make_plays(rows)).collect()] == ["2023-01-08"]
    rng = random.Random(1)
    rows = [("u", start + dt.timedelta(hours=h, seconds=i), str(i)) for h in range(24) for i in range(rng.randint(5, 7))]
    rows += [("u", start + dt.timedelta(hours=3, minutes=10, seconds=i), str(i)) for i in range(60)]
    assert [r.hour for r in temporal.hour_outliers(make_plays(rows)).collect()] == [3]


def test_weekend_and_active_users(make_plays):
    plays = make_plays([("u", dt.datetime(2023, 1, d, 10), "t") for d in (1, 2, 7)] + [("v", dt.datetime(2023, 1, 1, 10), "t")])
    got = by(temporal.sessions_weekend(sessionize(plays)), "periodType")
    assert (got["Weekend"].sessionCount, got["Weekend"].uniqueUsers) == (3, 2)
    assert by(temporal.plays_by_weekday(plays), "dayOfWeek")[1].activeUsers == 2


# Content and profiles


@pytest.fixture(scope="module")
def id_plays(spark):
    rows = [
        ("u", "a1", "id1", "t1", "k1"), ("u", "A1", "id1", None, "k2"), ("v", "a1", "id1", "t1", "k1"),
        ("v", "a2", None, None, "k3"), ("w", "a2", "", "", "k3"),
    ]
    return spark.createDataFrame(
        rows, "userId string, artistName string, artistId string, trackId string, trackKey string"
    ).withColumn("timestamp", F.lit(dt.datetime(2023, 1, 1)))


def test_matching_and_ambiguity(id_plays):
    got = by(content.matching_quality(id_plays), "matchingQuality")
    assert {k: (r.playCount, r.affectedUsers, r.affectedTracks, r.playPercentage) for k, r in got.items()} == {
        "High (Track MBID)": (2, 2, 1, 40.0),
        "Medium (Artist MBID only)": (1, 1, 1, 20.0),
        "Low (Name matching only)": (2, 2, 1, 40.0),
    }
    (artist,) = content.ambiguous_artists(id_plays, min_plays=2).collect()
    assert tuple(artist) == ("a2", 2, 2)


def test_name_variants(id_plays):
    rows = {(r.artistId, r.artistName, r.nameVariations, r.totalPlays) for r in content.artist_name_variants(id_plays).collect()}
    assert rows == {("id1", "a1", 2, 3), ("id1", "A1", 2, 3)}


def test_coverage_rates(id_plays):
    row = content.mbid_overall(id_plays).first()
    assert (row.playsWithArtistMbid, row.playsWithTrackMbid, row.artistMbidPct) == (3, 2, pytest.approx(60.0))
    assert content.mbid_by_year(id_plays).first().activeUsers == 3
    segments = by(content.user_quality_segments(id_plays), "qualitySegment")
    assert {k: r.userCount for k, r in segments.items()} == {
        "High Quality (80%+ MBID)": 1, "Medium Quality (50-80% MBID)": 1, "Very Low Quality (<20% MBID)": 1,
    }


def people(spark, rows):
    return spark.createDataFrame(rows, "userId string, gender string, age int, country string")


def test_profile_reports(spark):
    profile = people(spark, [("u", "m", 20, "Japan"), ("v", None, None, ""), ("w", "", 12, "UK"), ("x", " ", 101, "Area 51")])
    got = {r.country for r in profiles.suspicious_country(profile).collect()}
    assert got == {"UK", "Area 51"}
    ages = profiles.age_validation(profile).first()
    assert (ages.totalWithAge, ages.suspiciousAges, ages.minAge, ages.maxAge) == (3, 2, 12, 101)
    assert {r.gender: r.userCount for r in profiles.gender_distribution(profile).collect()} == {"m": 1, "Unknown": 3}
    seen = activity(spark, [(u, 10, 5, 2, 3) for u in "uvwx"])
    score = by(profiles.profile_completeness(seen, profile), "profileCompleteness")
    assert {k: r.userCount for k, r in score.items()} == {
        "Complete (3/3)": 2, "Mostly Complete (2/3)": 1, "Empty (0/3)": 1,
    }


def test_favourites(spark, make_plays):
    plays = make_plays([("u", f"10:0{i}", f"t{i}", "a1") for i in range(3)] + [("v", "23:00", "t9", "a2"), ("u", "12:00", "t1", "a2")])
    profile = people(spark, [("u", "m", 20, "Japan"), ("v", "f", 30, "Japan")])
    assert [(r.artistName, r.plays) for r in profiles.top_user_artists(plays, profile).orderBy("artistName").collect()] == [
        ("a1", 3), ("a2", 1),
    ]
    top = profiles.top_artists_by_country(plays, profile, min_users=2, limit=1).collect()
    assert [(r.country, r.artistName, r.plays) for r in top] == [("Japan", "a1", 3)]
    assert profiles.top_artists_by_country(plays, profile, min_users=3).count() == 0
    assert profiles.top_in_country(plays, profile, "Japan").first().trackName == "t1"
    assert profiles.night_songs(plays).count() == 0


# Validation


def test_rank_recheck_finds_swapped_ranks(spark):
    ranked = spark.createDataFrame([(1, "a", 5), (3, "b", 4), (2, "c", 3)], "rank int, trackName string, playCount long")
    errors = validation.rank_errors(validation.recheck_ranks(ranked, [F.desc("playCount")]))
    assert {r.trackName: r.rankDifference for r in errors.collect()} == {"b": 1, "c": -1}


def test_result_comparison_and_lineage(spark, make_plays):
    schema = "rank int, trackName string, artistName string, playCount long"
    computed = spark.createDataFrame([(1, "a", "x", 5), (2, "b", "x", 4)], schema)
    stored = spark.createDataFrame([(1, "a", "x", 5), (2, "b", "x", 3), (3, "b", "y", 1)], schema)
    assert [r.consistent for r in validation.compare_results(computed, stored).collect()] == [True, False]

    sessions = sessionize(make_plays([("u", "10:00", "a"), ("u", "12:00", "b")]))
    top = top_sessions(sessions, 2)
    assert validation.missing_sessions(top, sessions).count() == 0
    kept = sessions.filter(F.col("sessionNumber") == 0)
    assert [r.userSessionId for r in validation.missing_sessions(top, kept).collect()] == ["u_1"]
