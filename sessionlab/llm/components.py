"""Connected parts of a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import meet, stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); the label is the least node of its part.

    Every round a node takes the least label among its own, its neighbours' and its label's label,
    until nothing changes. Each round is written to the shared folder. Labels go to neighbours by
    :func:`meet`, so a hub's neighbours are never gathered.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.filter("a != b").distinct(), "edges")
    labels = stored(
        edges.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.first("a")).alias("label"), F.count("*").alias("degree")
        ),
        "labels",
    )
    while True:
        told = meet(edges, labels.select(F.col("node").alias("a"), "label", "degree"), ["a"], "degree")
        offers = told.groupBy(F.col("b").alias("node")).agg(F.min("label").alias("offer"))
        nearer = stored(
            labels.join(offers, "node", "left").select(
                "node", "label", F.least("label", "offer").alias("near"), "degree"
            ),
            "nearer",
        )
        roots = nearer.groupBy("near").agg(F.count("*").alias("followers"))
        jump = nearer.select(F.col("node").alias("near"), F.col("near").alias("far")).join(roots, "near")
        moved = stored(
            meet(nearer, jump, ["near"], "followers").select(
                "node",
                F.least("near", "far").alias("label"),
                "degree",
                (F.least("near", "far") != F.col("label")).alias("changed"),
            ),
            "labels",
        )
        labels = moved.drop("changed")
        if moved.filter("changed").isEmpty():
            return labels.select("node", "label")
