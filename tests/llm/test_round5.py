import re

import numpy as np

from sessionlab.llm import quality


def test_trusted_texts_are_not_shuffled_and_pieces_count_alike(spark, frame, monkeypatch):
    words = [f"w{i % 17} x{i % 5}" for i in range(300)]
    docs = frame([(i, " ".join(words[i : i + 60])) for i in range(40)] + [(None, "w1 x1"), (3, "w2 x2"), (50, None)])
    good = spark.createDataFrame([(i,) for i in (1, 3, 3, 5, 8, 13, 21, 34, None, 99)], "doc_id long")
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = quality.log_ratios(docs, good, 64)
        plan = whole._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"(SortMergeJoin|ShuffledHashJoin) \[doc_id", plan)
        monkeypatch.setattr(quality, "TRUSTED_PIECE", 2)
        pieces = quality.log_ratios(docs, good, 64)
        assert np.allclose(whole.first()["log_ratios"], pieces.first()["log_ratios"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
