"""Similarity join on word shingles: MinHash candidates, Bayesian pruning, exact check.

Two documents are linked when the Jaccard similarity of their sets of five-word shingles is at
least 0.8. The result is a class id per document (the classes are the connected parts of the link
graph) and the number of its links.

1. Documents with equal shingle sets are one node; copies are never compared with each other.
2. Every node has ``HASHES`` MinHash values in bands of four; nodes that share a band are
   candidates. Two nodes at the threshold share none with probability 3e-6.
3. The nodes of all buckets with one least node, the centre, are a family. Candidates share a
   family; of several, the one whose centre has the least hash owns the pair.
4. All nodes of a family are compared with each other, in blocks of ``BLOCK`` nodes against blocks,
   first on their MinHash values, 16 at a time. With m matches among n values the posterior
   probability (uniform prior) that the similarity reaches the threshold is that of at most m
   successes in n + 1 trials; the pair is dropped when this falls below ``TOLERANCE``. The nodes
   that have a likely partner go on.
5. These are compared in blocks with their shingle sets in the task, so that pairs are pruned and
   checked where they meet: every likely pair in the family that owns it. A task returns how many
   links each node has, and only those links that join nodes it has not joined yet. So every link
   is counted, and the classes are whole, but pairs are never listed.

Large buckets, families and classes never meet in one task: counts combine before the shuffle, groups
above a fixed share of all rows are broadcast, and blocks bound what a task compares.

Words are runs of anything but ASCII white space, with A-Z as a-z. A text of one to four words has
one shingle; a text without words (missing or empty) is linked to nothing and its own class.
Repeated rows are equal sets. A missing doc_id counts as the smallest id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.llm import hashing
from sessionlab.llm.common import meet, same_row, stored, texts, version
from sessionlab.llm.components import connected_components

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-4
BLOCK = 256
CHUNK = 1 << 20  # bytes of text that are hashed at a time

FLIP, TURN = hashing.numbers(HASHES, 3), hashing.numbers(HASHES, 4)
BAND = hashing.numbers(BANDS, 5)
SIGNATURE = (
    "doc_id long, version long, shingles int, set_a long, set_b long, "
    "signature binary, bands array<long>"
)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For 16, 32, … compared values: the fewest matches with which a pair goes on."""

    def posterior(m: int, n: int) -> float:
        return sum(
            math.comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k) for k in range(m + 1)
        )

    return {
        n: next(m for m in range(n + 1) if posterior(m, n) >= tolerance)
        for n in range(STEP, HASHES + 1, STEP)
    }


def prune(left: np.ndarray, right: np.ndarray, limits: dict[int, int]) -> np.ndarray:
    """Which rows of two signature tables stay."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int16)
    for n, least in limits.items():
        part = slice(n - STEP, n)
        matches = matches + (left[alive, part] == right[alive, part]).sum(axis=1, dtype=np.int16)
        good = matches >= least
        alive, matches = alive[good], matches[good]
    return alive


def _chunks(data: list[bytes]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, text in enumerate(data):
        size += len(text)
        if size >= CHUNK:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(data):
        yield first, len(data)


def _signatures(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    data = batch["data"].to_pylist()
    for first, last in _chunks(data):
        owner, names = hashing.shingle_sets(data[first:last], WIDTH)
        begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else owner
        if not len(begins):
            continue
        counts = np.diff(np.append(begins, len(owner)))
        least = np.empty((len(begins), HASHES), np.uint64)
        for k in range(HASHES):
            least[:, k] = np.minimum.reduceat((names ^ FLIP[k]) * TURN[k], begins)
        bands = np.empty((len(begins), BANDS), np.uint64)
        for b in range(BANDS):
            name = least[:, b * ROWS] ^ BAND[b]
            for k in range(1, ROWS):
                name = hashing.pair(name, least[:, b * ROWS + k])
            bands[:, b] = name
        short = (least >> np.uint64(48)).astype(np.uint16)
        rows = pa.array(owner[begins] + first)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch["doc_id"].take(rows),
                "version": batch["version"].take(rows),
                "shingles": pa.array(counts.astype(np.int32)),
                "set_a": pa.array(np.add.reduceat(names, begins).view(np.int64)),
                "set_b": pa.array(np.add.reduceat(hashing.pair(names, names), begins).view(np.int64)),
                "signature": pa.array([row.tobytes() for row in short], pa.binary()),
                "bands": pa.ListArray.from_arrays(
                    pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)),
                    pa.array(bands.ravel().view(np.int64)),
                ),
            }
        )


def _sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    data = batch["data"].to_pylist()
    for first, last in _chunks(data):
        owner, names = hashing.shingle_sets(data[first:last], WIDTH)
        bounds = np.searchsorted(owner, np.arange(last - first + 1))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch["doc_id"].slice(first, last - first),
                "version": batch["version"].slice(first, last - first),
                "names": pa.array(
                    [names[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()
                ),
            }
        )


def _over(function):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES)


NODE = "struct<doc_id:bigint,version:bigint>"
# How many links ``a`` has among the compared nodes; or, with ``b``, a link that joins two nodes.
FOUND = f"a {NODE}, b {NODE}, n long"


def _linked(left: np.ndarray, right: np.ndarray, threshold: float) -> bool:
    """Whether two sorted shingle sets are similar enough."""
    short, long = (left, right) if len(left) < len(right) else (right, left)
    if len(short) < threshold * len(long):
        return False
    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
    common = int((long[at] == short).sum())
    return common >= threshold * (len(left) + len(right) - common)


def _in_blocks(members: DataFrame, function, schema: str) -> DataFrame:
    """``function(left rows, right rows, whether they are the same block)`` for every pair of
    blocks of every family.

    ``members``: (center, size, node, ...). The nodes of a family are dealt into blocks by hash;
    every pair of blocks is one group of rows, read in order from a sorted partition, so a task
    holds two blocks however large the family is.
    """
    blocks = F.floor((F.col("size") + (BLOCK - 1)) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node", "center"), F.col("blocks")).cast("int")
    values = [c for c in members.columns if c != "size"]
    keys = ["center_id", "center_version", "low", "high"]
    dealt = (
        members.withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.coalesce("center.doc_id", F.lit(-1)).alias("center_id"),
            F.col("center.version").alias("center_version"),
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "own",
            *values,
        )
    )
    count = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(count, *keys).sortWithinPartitions(*keys)

    def apply(waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        low, high, own = (group[c].to_numpy() for c in ("low", "high", "own"))
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        yield from function(group, left, right, low[0] == high[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        last_key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch[k].to_numpy() for k in keys]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            edges = [0, *cuts.tolist(), batch.num_rows]
            for first, last in zip(edges[:-1], edges[1:]):
                key = tuple(c[first] for c in columns)
                if waiting and key != last_key:
                    yield from apply(waiting)
                    waiting = []
                last_key = key
                waiting.append(batch.slice(first, last - first))
        if waiting:
            yield from apply(waiting)

    return ordered.mapInArrow(run, schema)


def _lesser_centers(group: pa.RecordBatch) -> list[frozenset]:
    """For every node, its centres with a lesser hash than the family's. Of a pair that has one in
    common another family is the owner."""
    both = zip(group["centers"].to_pylist(), group["center_hash"].to_pylist())
    return [frozenset(c for c in centers if c < own) for centers, own in both]


def _likely_partners(group, left, right, same, limits) -> Iterator[tuple[int, np.ndarray]]:
    """(node, its likely partners) for the pairs that this family owns."""
    signatures, lesser = _matrix(group["signature"]), _lesser_centers(group)
    for i in left:
        others = right[right > i] if same else right
        if len(others):
            stay = prune(np.broadcast_to(signatures[i], (len(others), HASHES)), signatures[others], limits)
            owned = [j for j in others[stay] if lesser[i].isdisjoint(lesser[j])]
            if owned:
                yield i, np.array(owned)


def _likely_members(members: DataFrame, threshold: float) -> DataFrame:
    """(center, node) of the nodes with a likely partner in a pair that the family owns."""
    limits = least_matches(threshold)

    def compare(group, left, right, same) -> Iterator[pa.RecordBatch]:
        likely = np.zeros(group.num_rows, bool)
        for i, partners in _likely_partners(group, left, right, same, limits):
            likely[partners] = True
            likely[i] = True
        rows = pa.array(np.flatnonzero(likely))
        yield pa.RecordBatch.from_arrays([group[c].take(rows) for c in ("center", "node")], ["center", "node"])

    return _in_blocks(members, compare, f"center {NODE}, node {NODE}").distinct()


def _checked_links(members: DataFrame, threshold: float) -> DataFrame:
    """The links of the pairs that a family owns, checked on their sets: their number per node, and
    those that join nodes of a pair of blocks."""
    limits = least_matches(threshold)

    def compare(group, left, right, same) -> Iterator[pa.RecordBatch]:
        sets = [np.frombuffer(names, np.uint64) for names in group["names"].to_pylist()]
        joined = list(range(group.num_rows))

        def root(i: int) -> int:
            while joined[i] != i:
                joined[i] = joined[joined[i]]
                i = joined[i]
            return i

        counts = np.zeros(group.num_rows, np.int64)
        links = []
        for i, partners in _likely_partners(group, left, right, same, limits):
            for j in partners:
                if _linked(sets[i], sets[j], threshold):
                    counts[[i, j]] += 1
                    a, b = root(i), root(j)
                    if a != b:
                        joined[a] = b
                        links.append((i, j))
        if links:
            counted = np.flatnonzero(counts)
            first = np.append(counted, [i for i, _ in links])
            second = pa.array([None] * len(counted) + [j for _, j in links], pa.int64())
            n = np.append(counts[counted], np.zeros(len(links), np.int64))
            nodes = group["node"]
            yield pa.RecordBatch.from_arrays(
                [nodes.take(pa.array(first)), nodes.take(second), pa.array(n)], ["a", "b", "n"]
            )

    return _in_blocks(members, compare, FOUND)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, version, class_node, n_links, class_size, copies) of every document."""
    rows = texts(docs).select("doc_id", version().alias("version"), F.encode("text", "UTF-8").alias("data"))
    signed = stored(rows.mapInArrow(_over(_signatures), SIGNATURE), "signatures")
    same_set = ["set_a", "set_b", "shingles"]
    groups = stored(
        signed.groupBy(same_set).agg(
            F.count("*").alias("copies"), F.min(F.struct("doc_id", "version")).alias("node")
        ),
        "sets",
    )
    keys = groups.select("node.*", "node")
    nodes = stored(
        signed.join(keys, same_row(signed, keys)).select("node", "signature", "bands").dropDuplicates(["node"]),
        "nodes",
    )

    banded = stored(nodes.select("node", F.explode("bands").alias("bucket")), "bands")
    buckets = stored(
        banded.groupBy("bucket")
        .agg(F.count("*").alias("bucket_size"), F.min("node").alias("center"))
        .filter("bucket_size > 1"),
        "buckets",
    )
    members = stored(meet(banded, buckets, ["bucket"], "bucket_size"), "members")
    families = stored(
        members.select("center", "node").distinct().withColumn("center_hash", F.xxhash64("center")), "families"
    )
    sizes = stored(families.groupBy("center").agg(F.count("*").alias("size")), "family_sizes")
    # At most one centre for every band.
    centers = families.groupBy("node").agg(F.collect_list("center_hash").alias("centers"))
    profiles = stored(nodes.select("node", "signature").join(centers, "node"), "profiles")
    compared = meet(families, sizes, ["center"], "size").join(profiles, "node")
    likely = stored(_likely_members(compared, threshold), "likely")
    likely_sizes = stored(likely.groupBy("center").agg(F.count("*").alias("size")), "likely_sizes")
    wanted = likely.select("node").distinct().select("node.*", "node")
    sets = stored(
        rows.join(wanted.hint("merge"), same_row(rows, wanted))
        .select(rows["doc_id"], rows["version"], "data")
        .mapInArrow(_over(_sets), "doc_id long, version long, names binary")
        .select(F.struct("doc_id", "version").alias("node"), "names")
        .dropDuplicates(["node"]),
        "names",
    )
    checked = (
        meet(likely, likely_sizes, ["center"], "size")
        .withColumn("center_hash", F.xxhash64("center"))
        .join(profiles, "node")
        .join(sets, "node")
    )
    found = stored(_checked_links(checked, threshold), "links")
    final = connected_components(_ordered(found.filter("b IS NOT NULL")))
    counts = (
        found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links"))
    )
    named = stored(
        groups.join(counts, "node", "left")
        .join(final, "node", "left")
        .select(
            *same_set,
            "copies",
            F.coalesce("label", "node").alias("class_node"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        ),
        "named",
    )
    sizes = named.groupBy("class_node").agg(
        F.sum("copies").alias("class_size"), F.count("*").alias("members")
    )
    described = stored(meet(named, sizes, ["class_node"], "members"), "described")
    with_words = meet(signed.select("doc_id", "version", *same_set), described, same_set, "copies").select(
        "doc_id",
        "version",
        "class_node",
        F.col("n_links").cast("long").alias("n_links"),
        "class_size",
        "copies",
    )
    wordless = rows.filter(~F.col("data").cast("string").rlike(r"[^\x20\x09-\x0D]")).select(
        "doc_id",
        "version",
        F.struct("doc_id", "version").alias("class_node"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("class_size"),
        F.lit(1).cast("long").alias("copies"),
    )
    return with_words.unionByName(wordless)


def link_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (the least doc_id of the class), n_links (links of
    the document's shingle set to different sets), class_size and copies (documents with
    the same set)."""
    return _classes(docs, threshold).select(
        "doc_id", F.col("class_node.doc_id").alias("class_id"), "n_links", "class_size", "copies"
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that stay, with all their columns: the one with the least doc_id of every
    class."""
    own = F.struct("doc_id", "version") == F.col("class_node")
    kept = (
        _classes(docs, threshold)
        .filter(own)
        .select(F.col("doc_id").alias("__kept_id"), F.col("version").alias("__kept_version"))
        .distinct()
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__kept_id")) & (
        version(F.coalesce("text", F.lit(""))) == F.col("__kept_version")
    )
    return docs.join(kept, same, "left_semi")
