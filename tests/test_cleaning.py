import datetime as dt

import pytest
from pyspark.sql import functions as F

from sessionlab.functions import buckets, keys
from sessionlab.functions.numbers import correlation, rounded_avg
from sessionlab.functions.text import sanitize
from sessionlab.functions.times import day_name, hours_between, minutes_between, period_type
from sessionlab.operators import cleaning
from sessionlab.plans import quality
from sessionlab.schemas import PLAY_EVENT

T1, T2 = "2009-05-04T23:08:57Z", "2009-05-04T23:09:57Z"


@pytest.fixture(scope="module")
def events(spark):
    return lambda rows: spark.createDataFrame(rows, PLAY_EVENT)


def names(frame):
    return sorted((r.userId, r.artistName, r.trackName) for r in frame.collect())


def test_clean_drops_unusable_rows_and_copies(events):
    raw = events(
        [
            ("u", T1, None, "A", None, "x"),
            ("u", T1, "id", "A", "t", "x"),
            ("u", T2, None, "A", None, "x"),
            ("u", "yesterday", None, "A", None, "x"),
            ("u", None, None, "A", None, "x"),
            (None, T1, None, "A", None, "x"),
            ("u", T1, None, None, None, "x"),
            ("u", T1, None, "", None, "x"),
            ("u", T1, None, "A", None, ""),
        ]
    )
    got = cleaning.clean_events(raw).orderBy("timestamp").collect()
    assert [(r.userId, r.trackKey) for r in got] == [("u", "A - x")] * 2
    assert got[0].timestamp == dt.datetime(2009, 5, 4, 23, 8, 57)
    assert got[0].asDict().keys() == {"userId", "timestamp", "artistName", "trackName", "trackKey"}


@pytest.mark.parametrize("position", [0, 3, 5])
def test_empty_text_is_rejected(events, position):
    row = ["u", T1, "", "A", "", "x"]
    row[position] = ""
    assert cleaning.normalize_events(events([tuple(row)])).count() == 0


def test_key_collision_keeps_the_shortest_artist_and_exact_keeps_both(events):
    raw = events([("u", T1, None, "A - B", None, "C"), ("u", T1, None, "A", None, "B - C")])
    assert names(cleaning.clean_events(raw)) == [("u", "A", "B - C")]
    assert names(cleaning.clean_events(raw, exact=True)) == [("u", "A", "B - C"), ("u", "A - B", "C")]


def test_deduplication_restores_names_with_any_characters(events):
    odd = [("Sigur Rós", "Ágætis — byrjun"), ('"quoted', 'say "hi"'), (" - ", " - "), ("𝄞 clef", "x")]
    raw = events([("u", T1, None, a, None, t) for a, t in odd] * 2)
    assert names(cleaning.drop_duplicate_plays(cleaning.parse_times(raw))) == sorted(
        ("u", a, t) for a, t in odd
    )


def test_name_key(events):
    rows = events([("u", T1, None, "The Beatles", None, "Hey Jude"), ("u", T1, None, None, None, "x")])
    assert [r[0] for r in rows.select(keys.name_key()).collect()] == ["The Beatles - Hey Jude", None]


def test_id_key_prefers_the_id(events):
    rows = events(
        [
            ("u", T1, None, "A", "id-1", "x"),
            ("u", T1, None, "A", "", "x"),
            ("u", T1, None, None, None, "x"),
        ]
    )
    assert [r[0] for r in rows.select(keys.mbid_key()).collect()] == ["id-1", "A — x", "? — x"]


def test_sanitize(spark):
    rows = spark.createDataFrame([("\x01 a\tb \x7f",), (None,), ("\x02",)], "s string")
    assert [r[0] for r in rows.select(sanitize("s")).collect()] == ["ab", None, ""]


def test_key_is_built_from_sanitized_names_unless_asked_otherwise(events):
    raw = events([("u", T1, None, "A", None, "x\x01")])
    assert cleaning.normalize_events(raw).first().trackKey == "A — x"
    assert cleaning.normalize_events(raw, sanitize_first=False).first().trackKey == "A — x\x01"


def test_mbid_pattern(spark):
    good = "0383dadf-2a4e-4d10-a46a-e9e041da8eb3"
    rows = spark.createDataFrame([(good,), (good.upper(),), (good[:-1],), (None,)], "id string")
    assert [r[0] for r in rows.select(keys.is_mbid("id")).collect()] == [True, False, False, None]


def test_bucket_limits(spark):
    rows = spark.createDataFrame([(9999,), (10000,), (100,), (99,)], "n int")
    label = buckets.at_least("n", buckets.PLAY_SEGMENTS, buckets.PLAY_SEGMENT_ELSE)
    assert [r[0] for r in rows.select(label).collect()] == [
        "Active User", "Power User", "Regular User", "Casual User",
    ]
    label = buckets.below("n", buckets.RETENTION_RISK, buckets.RETENTION_RISK_ELSE)
    assert [r[0] for r in rows.select(label).collect()] == ["Low Risk", "Low Risk", "Low Risk", "Medium Risk"]


def test_durations_and_days(spark):
    start, end = dt.datetime(2023, 1, 1, 10), dt.datetime(2023, 1, 1, 10, 0, 18)
    row = spark.createDataFrame([(start, end)], "a timestamp, b timestamp").select(
        minutes_between("a", "b"), hours_between("a", "b"), day_name(F.dayofweek("a")), period_type(F.dayofweek("a"))
    ).first()
    assert [float(row[0]), float(row[1]), row[2], row[3]] == [0.3, 0.01, "Sunday", "Weekend"]


def test_average_is_rounded_half_up(spark):
    rows = spark.range(34).selectExpr("cast(if(id = 0, 129.49, 130) as decimal(18,2)) AS d")
    assert float(rows.agg(rounded_avg("d", 2)).first()[0]) == 129.99  # the mean is 129.985


def test_correlation_of_a_constant_is_null(spark):
    rows = spark.range(5).selectExpr("id AS a", "2 * id AS b", "1 AS c")
    assert rows.agg(correlation("a", "b")).first()[0] == pytest.approx(1.0)
    assert rows.agg(correlation("a", "c")).first()[0] is None


def test_quality_metrics(events):
    raw = events(
        [
            ("u", T1, None, "A", None, "x"),
            ("u", T1, None, "A", "t", "x"),
            ("u", "bad", None, "A", "t", "x"),
            ("u", T1, None, "A", None, "\x01"),
        ]
    )
    counts = quality.quality_counts(raw)
    assert {r.metric: r.value for r in quality.metric_table(counts).collect()} == {
        "rows_read": "4",
        "rows_valid": "2",
        "rows_dropped": "2",
        "missing_track_id": "1",
        "pct_missing_track_id": "50.00%",
    }
    assert quality.quality_warnings(counts).count() == 0
    (warning,) = quality.quality_warnings(counts, limit_pct=49).collect()
    assert warning.warning == "High percentage of missing track IDs: 50.00%"
    report = quality.quality_report(counts, "plays", limit_pct=49).first()
    assert report.metrics.rowsRead == 4 and len(report.warnings) == len(report.recommendations) == 1


def test_quality_of_no_rows(events):
    counts = quality.quality_counts(events([])).first()
    assert (counts.rowsRead, counts.pctMissingTrackId) == (0, 0.0)


def test_completeness_is_measured_before_cleaning(events):
    raw = events([("u", T1, None, "A", None, "x"), ("u", T2, None, None, None, "x")])
    metrics = quality.clean_metrics(raw, cleaning.clean_events(raw)).first()
    assert (metrics.totalRecords, metrics.qualityScore) == (1, 50.0)


def test_sanity_rules(spark):
    rows = [("u", dt.datetime(1999, 12, 31)), ("u", dt.datetime(2010, 1, 1)), ("v", dt.datetime(2030, 1, 1))]
    plays = spark.createDataFrame(rows, "userId string, timestamp timestamp")
    as_of = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
    got = quality.sanity_issues(plays, as_of=as_of, max_user_plays=1).collect()
    assert {r.issue: r.offending for r in got} == {
        "future_timestamps": 1, "very_old_timestamps": 1, "suspicious_users": 1,
    }


def test_duplicates_and_empty_fields(events):
    raw = events([("u", T1, None, "A", None, "x")] * 3 + [("u", T2, None, None, None, "x")])
    plays = cleaning.normalize_events(raw)
    totals = quality.duplicate_totals(quality.duplicate_keys(plays)).first()
    assert (totals.duplicateKeys, totals.duplicatedRows) == (1, 3)
    assert quality.empty_fields(raw).first().asDict() == {
        "emptyUsers": 0, "emptyArtists": 1, "emptyTracks": 0, "rowsKept": 3,
    }


def test_null_profile(events):
    raw = events([("u", T1, None, "", None, "x"), (None, T1, None, "A", None, "x")])
    got = {r.column: (r.nulls, r.empty, r.rows) for r in quality.null_profile(raw).collect()}
    assert got["userId"] == (1, 0, 2) and got["artistName"] == (0, 1, 2) and got["trackId"] == (2, 0, 2)
