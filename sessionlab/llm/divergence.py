"""How far the sources of a language diverge in their use of words.

Terms are runs of ASCII letters and of all other characters beyond ASCII, with A-Z as a-z. A
language keeps the terms found in at least ``MIN_DOCS`` of its documents. Each (language, source)
and each language gives every kept term a weight p = 1 + floor(10^9 (count + 1) / (N + V)), and two
weights p and q of a term diverge by floor((p - q)^2 / q).

Kept terms come from iceberg prefix refinement. A term ends with a blank, which no term holds, so
it is complete when its prefix has the blank. Level by level, documents are counted for the
prefixes of 4, 16, 64, ... bytes of the terms that are still open; a prefix in fewer than
``MIN_DOCS`` documents is discarded with everything below it, complete prefixes are kept terms, and
the others are extended, until none is open. A rare word is thus dropped at the first level at
which it is rare, and levels go on only for the blocks that still have open prefixes.

Tasks hold documents in blocks of about ``BLOCK_BYTES``: the sorted vocabulary of the block, and
for every document the places of its terms with their counts. A prefix is a range of the
vocabulary, so a level costs a few passes over integers. Blocks share no document, hence the
documents of a prefix are the sum over blocks, and a prefix moves at most once per block however
frequent it is. Blocks are stored once, bucketed by number, and every level reads them in place.

Sources are compared on the terms that they use: a term that neither of two sources uses adds the
same for all such terms, and a term that one of them uses adds the same for all terms with that
weight. Only terms that both use are compared one by one. All arithmetic is on integers.

A row is a document, so a repeated row counts again. Missing text, lang and source are empty. A
(language, source) without terms is still a group. Without kept terms all divergences are 0. A
long text is one document of one block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.llm.common import stored
from sessionlab.session import scratch_path

MIN_DOCS = 3
FIRST_PREFIX, GROWTH = 4, 4  # bytes of the first level, and how many times longer the next one is
TOP_TERMS = 200
ONE = 1_000_000_000
BLOCK_BYTES = 8 << 20
END = b" "

# A-Z to a-z; every other byte that is no part of a term to a blank.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

HEAD = 8  # leading bytes of a term that are also kept as one number
# A term is known by its first block and its place there. A block's number is its task's number
# times BLOCKS plus its own.
BLOCKS, PLACES = 1 << 14, 1 << 25

BLOCK = (
    "block long, langs array<string>, lang_ends array<int>, terms binary, heads binary, "
    "groups array<struct<lang:string,source:string>>, doc_group binary, doc_ends binary, "
    "places binary, counts binary"
)
BLOCK_COLUMNS = [
    "block", "langs", "lang_ends", "terms", "heads", "groups", "doc_group", "doc_ends", "places", "counts",
]
PREFIXES = "block long, lang string, prefix binary, lo int, hi int, docs long"


def terms_of(data: bytes) -> list[bytes]:
    # The only white space that is left is the blank.
    return data.translate(FOLD).split()


def in_order(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(places of the words in ascending order, their heads in that order).

    Numbers made of the first sixteen bytes order nearly all; words that share these follow."""
    first = np.array(words, f"S{2 * HEAD}").view(np.uint8).reshape(len(words), 2 * HEAD).copy()
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    short = np.flatnonzero(lengths < 2 * HEAD)
    first[short, lengths[short]] = END[0]
    high, low = (first[:, k : k + HEAD].copy().view(">u8").ravel().astype(np.uint64) for k in (0, HEAD))
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    same = np.flatnonzero((high[1:] == high[:-1]) & (low[1:] == low[:-1]))
    for run in np.split(same, np.flatnonzero(np.diff(same) > 1) + 1):
        if len(run):
            own = slice(int(run[0]), int(run[-1]) + 2)
            order[own] = sorted(order[own].tolist(), key=words.__getitem__)
    return order, high


class _Numbers(dict):
    """Numbers terms as they come."""

    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


class BlockBuilder:
    """Gathers documents; terms are numbered as they come, by language, and renumbered in order at
    the end."""

    def __init__(self) -> None:
        self.terms: dict[str, _Numbers] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.doc_group: list[int] = []
        self.tokens: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, source: str, data: bytes) -> None:
        words = terms_of(data)
        own = self.terms.setdefault(lang, _Numbers())
        self.tokens.append(np.fromiter(map(own.__getitem__, words), np.int32, len(words)))
        self.doc_group.append(self.groups.setdefault((lang, source), len(self.groups)))
        self.size += len(data)

    def row(self, number: int) -> pa.RecordBatch:
        langs = sorted(self.terms)
        words, ends, heads, ranks = [], [], [], []
        for lang in langs:
            own = list(self.terms[lang])  # in the order of their numbers
            order, head = in_order(own)
            rank = np.empty(len(own), np.int64)
            rank[order] = np.arange(len(words), len(words) + len(own))
            ranks.append(rank)
            words += map(own.__getitem__, order.tolist())
            heads.append(head.astype(">u8").tobytes())
            ends.append(len(words))
        firsts = dict(zip(langs, [0, *ends[:-1]]))
        group_first = np.array([firsts[lang] for lang, _ in self.groups])
        sizes = np.array([len(t) for t in self.tokens])
        doc = np.repeat(np.arange(len(sizes)), sizes)
        numbers = np.concatenate(self.tokens) + np.repeat(group_first[self.doc_group], sizes)
        keys = doc * (len(words) + 1) + np.concatenate(ranks)[numbers]
        keys.sort()
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        counts = np.diff(first, append=len(keys))
        doc, places = np.divmod(keys[first], len(words) + 1)
        doc_ends = np.cumsum(np.bincount(doc, minlength=len(sizes)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([langs], pa.list_(pa.string())),
                pa.array([ends], pa.list_(pa.int32())),
                pa.array([END.join(words)], pa.binary()),
                pa.array([b"".join(heads)], pa.binary()),
                pa.array(
                    [[{"lang": a, "source": b} for a, b in self.groups]],
                    pa.list_(pa.struct([("lang", pa.string()), ("source", pa.string())])),
                ),
                pa.array([np.array(self.doc_group, "<i4").tobytes()], pa.binary()),
                pa.array([doc_ends.astype("<i8").tobytes()], pa.binary()),
                pa.array([places.astype("<i4").tobytes()], pa.binary()),
                pa.array([counts.astype("<i4" if counts.max(initial=0) > 255 else "u1").tobytes()], pa.binary()),
            ],
            names=BLOCK_COLUMNS,
        )


class Block:
    """A stored block as arrays."""

    def __init__(self, row: dict) -> None:
        self.number = row["block"]
        self.langs, self.lang_ends = row["langs"], np.array(row["lang_ends"])
        self.text = row["terms"]
        # Big-endian numbers compare like the bytes.
        self.heads = np.frombuffer(row["heads"], ">u8").astype(np.uint64)
        self.groups = row["groups"]
        self.doc_group = np.frombuffer(row["doc_group"], "<i4")
        ends = np.frombuffer(row["doc_ends"], "<i8")
        self.places = np.frombuffer(row["places"], "<i4")
        wide = len(row["counts"]) > len(self.places)
        self.counts = np.frombuffer(row["counts"], "<i4" if wide else "u1")
        self.doc = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=0))

    def prefixes(self, lo: np.ndarray, hi: np.ndarray, length: int) -> pa.RecordBatch:
        """The prefixes of the terms in the ranges [lo, hi), which ascend, with the documents that
        hold them. No range reaches from one language to the next."""
        sizes = hi - lo
        is_first = np.zeros(int(sizes.sum()), bool)
        is_first[np.cumsum(sizes) - sizes] = True
        place = np.arange(len(is_first)) + np.repeat(lo - (np.cumsum(sizes) - sizes), sizes)
        if length <= HEAD:
            key = self.heads[place] >> np.uint64(8 * (HEAD - length))
            is_first[1:] |= key[1:] != key[:-1]
            first = np.flatnonzero(is_first)
            prefix = (key[first] << np.uint64(8 * (HEAD - length))).astype(">u8").view(f"S{HEAD}").tolist()
        else:  # few terms are still open
            terms = self.text.split(END)
            every = [(terms[p] + END)[:length] for p in place.tolist()]
            is_first[1:] |= np.array([a != b for a, b in zip(every, every[1:])], bool)
            first = np.flatnonzero(is_first)
            prefix = [every[i] for i in first.tolist()]
        run = np.full(len(self.heads) + 1, -1, np.int32)
        run[place] = np.cumsum(is_first) - 1
        runs = run[self.places]
        is_open = runs >= 0
        runs, doc = runs[is_open], self.doc[is_open]
        # Places ascend within a document, so a prefix that a document has twice stands side by side.
        new = np.ones(len(runs), bool)
        new[1:] = (runs[1:] != runs[:-1]) | (doc[1:] != doc[:-1])
        starts = place[first]
        langs = pa.array(self.langs, pa.string())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(first), self.number)),
                langs.take(pa.array(np.searchsorted(self.lang_ends, starts, side="right"))),
                pa.array(prefix, pa.binary()),
                pa.array(starts.astype(np.int32)),
                pa.array((starts + np.diff(first, append=len(place))).astype(np.int32)),
                pa.array(np.bincount(runs[new], minlength=len(first)).astype(np.int64)),
            ],
            names=["block", "lang", "prefix", "lo", "hi", "docs"],
        )

    def group_counts(self, places: np.ndarray, term_ids: np.ndarray) -> pa.RecordBatch:
        """How often the sources use the terms at these places."""
        sources = sorted({g["source"] for g in self.groups})
        number = {source: i for i, source in enumerate(sources)}
        doc_source = np.array([number[g["source"]] for g in self.groups])[self.doc_group]
        kept = np.full(len(self.heads) + 1, -1, np.int64)
        kept[places] = np.arange(len(places))
        own = kept[self.places]
        used = own >= 0
        key = doc_source[self.doc[used]] * max(len(places), 1) + own[used]
        if len(sources) * len(places) <= 8 * len(key):
            dense = np.bincount(key, self.counts[used]).astype(np.int64)
            key = np.flatnonzero(dense)
            sums = dense[key]
        else:  # many sources that use few terms each
            order = np.argsort(key)
            key, counts = key[order], self.counts[used][order].astype(np.int64)
            first = np.flatnonzero(np.diff(key, prepend=-1))
            key, sums = key[first], np.add.reduceat(counts, first) if len(first) else counts
        return pa.RecordBatch.from_arrays(
            [
                pa.array(sources, pa.string()).take(pa.array(key // max(len(places), 1))),
                pa.array(term_ids[key % max(len(places), 1)]),
                pa.array(sums),
            ],
            names=["source", "term_id", "n"],
        )


def write_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents as stored blocks, bucketed by block."""
    spark = docs.sparkSession
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(empty("lang"), empty("source"), F.encode(empty("text"), "UTF-8").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * BLOCKS
        block = BlockBuilder()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for row in zip(*(part[c].to_pylist() for c in ("lang", "source", "data"))):
                    block.add(*row)
                    if block.size >= block_bytes:
                        yield block.row(number)
                        number, block = number + 1, BlockBuilder()
        if block.doc_group:
            yield block.row(number)

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"term_blocks_{uuid.uuid4().hex}"
    writer = rows.mapInArrow(run, BLOCK).repartition(buckets, "block").write.bucketBy(buckets, "block")
    writer.option("compression", "zstd").option("path", scratch_path(spark, "term_blocks")).saveAsTable(name)
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the entry of the catalog; the frame knows its files
    return blocks


def _blocks(batches: Iterator[pa.RecordBatch], *fields: str) -> Iterator[tuple]:
    """One block at a time, with these fields of the structs in its ``list``, in the order of the
    first of them."""
    for batch in batches:
        for at in range(batch.num_rows):
            block = Block({name: batch[name][at].as_py() for name in BLOCK_COLUMNS})
            if not fields:
                yield (block,)
                continue
            structs = batch["list"][at].values
            columns = [structs.field(f).to_numpy(zero_copy_only=False) for f in fields]
            order = np.argsort(columns[0])
            yield block, *(c[order] for c in columns)


def level(blocks: DataFrame, ranges: DataFrame | None, length: int) -> DataFrame:
    """(block, lang, prefix, lo, hi, docs) of the prefixes of ``length`` bytes in the open ranges
    (block, list of lo and hi); at the first level everything is open."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block,) in _blocks(batches):
            lo, hi = np.append(0, block.lang_ends[:-1]), block.lang_ends
            yield block.prefixes(lo[lo < hi], hi[lo < hi], length)

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, lo, hi in _blocks(batches, "lo", "hi"):
            yield block.prefixes(lo, hi, length)

    if ranges is None:
        return blocks.mapInArrow(first, PREFIXES)
    return blocks.join(ranges.hint("shuffle_hash"), "block").mapInArrow(later, PREFIXES)


def kept_terms(blocks: DataFrame, min_docs: int = MIN_DOCS, first: int = FIRST_PREFIX) -> DataFrame:
    """(lang, term, term_id, block, place): the terms in enough documents, once for every block
    that holds them. Stored frames, one for every level."""
    same = Window.partitionBy("prefix", "lang")  # in this order, few rows compare equal at first
    found, ranges, length = [], None, first
    while True:
        parts = level(blocks, ranges, length)
        frequent = (
            parts.withColumn("all_docs", F.sum("docs").over(same))
            .withColumn("term_id", F.min(F.col("block") * PLACES + F.col("lo")).over(same))
            .filter(F.col("all_docs") >= min_docs)
            .withColumn("complete", F.substring("prefix", -1, 1) == F.lit(END))
            .select("block", "lang", "prefix", "lo", "hi", "term_id", "complete")
        )
        frequent = stored(frequent, f"frequent_{length}")
        found.append(
            frequent.filter("complete").select(
                "lang",
                F.expr("CAST(substring(prefix, 1, length(prefix) - 1) AS STRING)").alias("term"),
                "term_id",
                "block",
                F.col("lo").alias("place"),
            )
        )
        still_open = frequent.filter("NOT complete")
        if still_open.isEmpty():
            break
        ranges = still_open.groupBy("block").agg(F.collect_list(F.struct("lo", "hi")).alias("list"))
        length *= GROWTH
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def count_terms(blocks: DataFrame, kept: DataFrame) -> DataFrame:
    """(term_id, users, in_lang): the sources that use a kept term, with how often, and the sum.
    Sources of different languages may have one name; the term tells the language. A term has a
    row per block and source on the way, which few terms share, so nothing is combined before."""
    own = kept.groupBy("block").agg(F.collect_list(F.struct("place", "term_id")).alias("list"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, places, term_ids in _blocks(batches, "place", "term_id"):
            yield block.group_counts(places, term_ids)

    joined = blocks.join(own.hint("shuffle_hash"), "block")
    parts = joined.mapInArrow(run, "source string, term_id long, n long")
    count = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_source = parts.repartition(count, "term_id").groupBy("source", "term_id").agg(F.sum("n").alias("n"))
    return by_source.groupBy("term_id").agg(
        F.collect_list(F.struct("source", "n")).alias("users"), F.sum("n").alias("in_lang")
    )


def weight(count: Column, tokens: Column, types: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (tokens + types)), exact for every count: beyond 2^33 the
    product no longer fits into 64 bits."""
    below = tokens + types
    wide = F.lit(ONE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return 1 + F.when(
        count < F.lit(1 << 33), F.call_function("div", F.lit(ONE).cast("long") * (count + 1), below)
    ).otherwise(F.call_function("div", wide, below.cast("decimal(20,0)")))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def source_pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language.

    ``counts`` has (lang, term_id, source, p) and ``groups`` (lang, source, p0, types), where p0
    is the weight of a term that the source does not use."""
    one = groups.select("lang", "source", "p0", "types")
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    both = F.col("source") != F.col("item")
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    pairs = one.join(other, "lang").filter(both)
    unused = divergence(p0, q0)

    # Terms that the first source uses, by weight, as if no other source used them; and the reverse.
    weights = counts.groupBy("lang", "source", "p").agg(F.count("*").alias("terms"))
    first = weights.join(pairs, ["lang", "source"]).select(
        "lang", "source", "item", (F.col("terms") * (divergence(p, q0) - unused)).alias("value")
    )
    second = (
        weights.select("lang", F.col("source").alias("item"), F.col("p").alias("q"), "terms")
        .join(pairs, ["lang", "item"])
        .select("lang", "source", "item", (F.col("terms") * (divergence(p0, q) - unused)).alias("value"))
    )
    # Terms that both use: what the two steps above have added for them gives way to the true value.
    users = F.struct("source", "p", "p0")
    term = counts.join(one.drop("types"), ["lang", "source"]).groupBy("lang", "term_id").agg(
        F.collect_list(users).alias("users")
    )
    shared = (
        term.filter(F.size("users") > 1)
        .select("lang", "users", F.explode("users").alias("a"))
        .select("lang", "a", F.explode("users").alias("b"))
        .filter("a.source != b.source")
        .select(
            "lang",
            F.col("a.source").alias("source"),
            F.col("b.source").alias("item"),
            (
                divergence(F.col("a.p"), F.col("b.p"))
                - divergence(F.col("a.p"), F.col("b.p0"))
                - divergence(F.col("a.p0"), F.col("b.p"))
                + divergence(F.col("a.p0"), F.col("b.p0"))
            ).alias("value"),
        )
    )
    ground = pairs.select("lang", "source", "item", (F.col("types") * unused).alias("value"))
    parts = ground.unionByName(first).unionByName(second).unionByName(shared)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair`` has every other source of the language, part ``term`` the ``top`` terms that a
    source uses more than its language does."""
    blocks = write_blocks(docs)
    kept = kept_terms(blocks, min_docs)
    sources = stored(
        blocks.select(F.explode("groups").alias("g")).select("g.lang", "g.source").distinct(), "sources"
    )

    # One row per term: that of its first block.
    terms = kept.filter(F.col("term_id") == F.col("block") * PLACES + F.col("place")).select(
        "term_id", "lang", F.col("term").alias("item")
    )
    usage = stored(count_terms(blocks, kept).join(terms, "term_id"), "usage")
    types = usage.groupBy("lang").agg(F.count("*").alias("types"), F.sum("in_lang").alias("lang_tokens"))
    tokens = usage.select("lang", F.inline("users")).groupBy("lang", "source").agg(F.sum("n").alias("tokens"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    groups = sources.join(tokens, ["lang", "source"], "left").join(types, "lang", "left").select(
        "lang", "source", zero("tokens"), zero("types"), zero("lang_tokens")
    )
    no_use = F.when(F.col("types") > 0, weight(F.lit(0).cast("long"), F.col("tokens"), F.col("types")))
    # Without kept terms no weight is needed; 1 keeps the sums at 0.
    groups = stored(groups.withColumn("p0", F.coalesce(no_use, F.lit(1).cast("long"))), "source_totals")
    weighed = stored(
        usage.select("lang", "term_id", "item", "in_lang", F.inline("users"))
        .join(groups, ["lang", "source"])
        .select(
            "lang",
            "source",
            "term_id",
            "item",
            weight(F.col("n"), F.col("tokens"), F.col("types")).alias("p"),
            weight(F.col("in_lang"), F.col("lang_tokens"), F.col("types")).alias("q"),
        ),
        "weights",
    )
    top_terms = weighed.filter("p > q").select(
        "lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value")
    )
    pairs = source_pairs(weighed.select("lang", "source", "term_id", "p"), groups)
    return _ranked(pairs, "pair").unionByName(_ranked(top_terms, "term", top))
