"""Round 4: op6 fits its model and cut on every document, not on a sample."""

import random

import numpy as np
import pytest

from sessionlab.llm import quality


def test_the_cut_found_by_spark_is_that_of_all_scores(spark):
    random.seed(4)
    for good, bad in (
        ([5, 6], [1, 2]),
        ([2, 5, 6, 7], [1, 1, 3]),
        ([1, 2], [8, 9]),
        ([3, 3], [3]),
        ([random.gauss(1, 1) for _ in range(3000)], [random.gauss(-1, 1) for _ in range(2000)]),
        ([round(random.gauss(1, 1), 1) for _ in range(3000)], [round(random.gauss(0, 1), 1) for _ in range(3000)]),
    ):
        rows = [(True, float(x)) for x in good] + [(False, float(x)) for x in bad]
        scores = spark.createDataFrame(rows, "is_good boolean, score double")
        want = quality.cut_between(np.array(good, float), np.array(bad, float))
        assert quality.cut_of(scores, ranges=5, per_range=500) == want
    assert quality.cut_of(spark.createDataFrame([(True, 4.0), (True, 6.0)], "is_good boolean, score double")) == 5 - quality.DEVIATIONS


def test_every_judged_and_trusted_document_counts(spark, frame, monkeypatch):
    """With the old caps of one judged document of each kind and one trusted document, the cut and
    the ratios came from a sample; all of them must count."""
    monkeypatch.setattr(quality, "MAX_JUDGED", 1, raising=False)
    random.seed(7)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(random.choice(words[:20] if i % 2 else words[20:]) for _ in range(60))) for i in range(40)]
    docs = frame(rows)
    good = docs.filter("doc_id % 2 = 1").select("doc_id")
    bad = docs.filter("doc_id % 2 = 0").select("doc_id")
    ratios = np.array(quality.log_ratios(docs, good, 64, max_trusted=1).first()["log_ratios"])
    full = np.array(quality.log_ratios(docs, good, 64, max_trusted=10**9).first()["log_ratios"])
    assert np.allclose(ratios, full)
    scored = quality._scored(docs, ratios, 64).filter("NOT base_failed").collect()
    score = {r.doc_id: r.score for r in scored}
    want = quality.cut_between(
        np.array([score[i] for i in score if i % 2]), np.array([score[i] for i in score if i % 2 == 0])
    )
    assert quality.fit_cut(docs, ratios, good, bad, 64) == pytest.approx(want)
