"""Removal of long repeated byte strings by distributed prefix doubling.

A byte goes when a string of ``threshold`` bytes that covers it also starts somewhere else. Texts
are UTF-8 bytes, matches never cross documents, and strings are judged on the input.

Prefix doubling ranks all suffixes by their first h bytes, then by pairs of ranks at offset h,
until a suffix is unique or h passes the threshold. Two things are changed so that the shuffle
stays below the size of the text:

* A rank is a name: the 64-bit name of 2h bytes comes from the pair of names of h bytes at offset
  h, so equal strings get equal names in every task without a sort of all suffixes. Spark
  shuffles and sorts names only to tell which occur again.
* Positions move in groups. Of the short strings (seeds) inside a window of ``threshold`` bytes the
  one with the least name (the leftmost of equals) is the window's anchor; equal windows have equal
  anchors at equal distance. All windows with one anchor form one row: at 400 bytes, with seeds of
  64, one row per 170 bytes; at 200 bytes, with seeds of 32, one per 85.

The rows of one round carry the name of the string that all their windows share (the core, which
grows 64, 337, 393, 400 bytes at a threshold of 400) and of the string that the windows cover together. A core that
occurs once is unique: its windows repeat nowhere. A covered string that occurs again is settled:
all its bytes go. Cores whose rows are all settled are done. What is left, the ends of repeated
stretches, is split (64, 8, 1 windows to a row) and ranked again; of equal settled rows one stays
to be compared with.

Every round joins small lists of places to the text, which is stored once, bucketed by document.
Counts combine before the shuffle, and names of large groups, of which there are few, are
broadcast, so a string that makes up a third of all rows is never gathered. Missing texts are
empty; texts shorter than the threshold lose nothing; repeated rows repeat each other and go as a
whole if they are long enough.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlab.llm import hashing
from sessionlab.llm.common import meet, stored
from sessionlab.llm.hashing import pair
from sessionlab.session import scratch_path

THRESHOLD = 400
SHORTEST = 100  # the least threshold: the first core must be longer than the seed
ROUNDS = (64, 8, 1)  # windows to a row after the first round
SEGMENT = 1 << 19  # window starts that a task holds in memory at a time
PLACE = ["doc_id", "version", "anchor"]
CLASS = ["seed", "block", "core"]
ROW = "anchor long, lo int, hi int, seed long, block int, core long, covered long"

# Bits that hold a place in a buffer, which is never longer than two segments and a bit.
PLACE_MASK = np.uint64((1 << 22) - 1)


def seed_bytes(threshold: int) -> int:
    """Bytes of an anchor: the largest power of two up to a sixth of the threshold. Shorter ones
    repeat by chance and longer ones make more rows."""
    if threshold < SHORTEST:
        raise ValueError(f"strings of {threshold} bytes are shorter than {SHORTEST}")
    return 1 << ((threshold // 6).bit_length() - 1)


class Names:
    """Names of the strings of a buffer, by doubling."""

    def __init__(self, data: np.ndarray) -> None:
        start = (data.astype(np.uint64) + np.uint64(1)) * hashing.MIX_B
        self.by_length = {1: start ^ (start >> hashing.SHIFT)}

    def of_length(self, length: int) -> np.ndarray:
        """Names of all strings of a length that is a power of two."""
        if length not in self.by_length:
            half = self.of_length(length // 2)
            at = max(len(half) - length // 2, 0)
            self.by_length[length] = pair(half[:at], half[length // 2 :])
        return self.by_length[length]

    def at(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Names of strings of any length: two that overlap and, so that lengths differ, the length."""
        names = np.zeros(len(starts), np.uint64)
        powers = 1 << (np.frexp(lengths.astype(np.float64))[1] - 1)
        for power in np.unique(powers):
            own = np.flatnonzero(powers == power)
            all_names = self.of_length(int(power))
            first, last = starts[own], starts[own] + lengths[own] - power
            names[own] = pair(
                pair(all_names[first], all_names[last]), lengths[own].astype(np.uint64)
            )
        return names.view(np.int64)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, by doubling."""
    span, least = 1, values
    while 2 * span <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _anchors(valid: np.ndarray, names: Names, threshold: int) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window) of every run of valid windows with one anchor."""
    seed = seed_bytes(threshold)
    seeds = names.of_length(seed)
    # Place in the low bits: the leftmost of equal names is the least.
    keys = (seeds & ~PLACE_MASK) | np.arange(len(seeds), dtype=np.uint64)
    least = _sliding_min(keys, threshold - seed + 1)
    windows = np.flatnonzero(valid[: len(least)])
    anchors = (least[windows] & PLACE_MASK).astype(np.int64)
    opens = np.ones(len(windows), bool)
    opens[1:] = (anchors[1:] != anchors[:-1]) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(windows)) - 1
    return anchors[first], windows[first], windows[last]


def _buffers(rows: list[tuple[int, bytes]], overlap: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, offset of the part in its text, part) in lists of about SEGMENT bytes; long texts come
    in parts that overlap."""
    parts, size = [], 0
    for row, data in rows:
        for at in range(0, max(len(data) - overlap, 1), SEGMENT):
            part = data[at : at + SEGMENT + overlap]
            parts.append((row, at, part))
            size += len(part)
            if size >= SEGMENT:
                yield parts
                parts, size = [], 0
    if parts:
        yield parts


def _first_rows(
    doc_ids: pa.Array, versions: pa.Array, data: list[bytes], threshold: int
) -> Iterator[pa.RecordBatch]:
    long_enough = [(i, d) for i, d in enumerate(data) if len(d) >= threshold]
    for parts in _buffers(long_enough, threshold - 1):
        sizes = np.array([len(p) for *_, p in parts])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        joined = np.frombuffer(b"".join(p for *_, p in parts), np.uint8)
        # The windows of a long text's next part belong to that part.
        own = np.minimum(sizes - threshold + 1, SEGMENT)
        edges = np.zeros(len(joined) + 1, np.int8)
        np.add.at(edges, starts[own > 0], 1)
        np.add.at(edges, (starts + own)[own > 0], -1)
        valid = np.cumsum(edges[:-1]) > 0
        names = Names(joined)
        anchor, first, last = _anchors(valid, names, threshold)
        part = np.searchsorted(ends, first, side="right")
        shift = np.array([at for _, at, _ in parts])[part] - starts[part]
        row = np.array([r for r, *_ in parts])[part]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": doc_ids.take(pa.array(row)),
                "version": versions.take(pa.array(row)),
                "anchor": pa.array(anchor + shift, pa.int64()),
                "lo": pa.array((anchor - last).astype(np.int32)),
                "hi": pa.array((anchor - first).astype(np.int32)),
                "seed": pa.array(names.of_length(seed_bytes(threshold))[anchor].view(np.int64)),
                "block": pa.array(np.zeros(len(anchor), np.int32)),
                "core": pa.array(np.zeros(len(anchor), np.int64)),
                "covered": pa.array(names.at(first, last - first + threshold)),
                "done": pa.array(np.zeros(len(anchor), bool)),
            }
        )


def _split_rows(batch: pa.RecordBatch, windows: int, threshold: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch of (doc_id, version, data, places) cut into blocks of ``windows``."""
    data = batch["data"].to_pylist()
    bounds = batch["places"].offsets.to_numpy()
    flat = batch["places"].values
    anchor, lo, hi, seed, done = (
        flat.field(n).to_numpy(zero_copy_only=False) for n in ("anchor", "lo", "hi", "seed", "done")
    )
    overlap = 3 * threshold
    for parts in _buffers(list(enumerate(data)), overlap):
        sizes = np.array([len(p) for *_, p in parts])
        starts = np.cumsum(sizes) - sizes
        chosen, shifts, rows = [], [], []
        for (row, at, _), start in zip(parts, starts):
            own = np.arange(bounds[row], bounds[row + 1])
            if len(data[row]) > SEGMENT + overlap:  # several parts: the last one that holds it all
                last_part = (len(data[row]) - overlap - 1) // SEGMENT
                part = np.minimum(np.maximum(anchor[own] - threshold, 0) // SEGMENT, last_part)
                own = own[part * SEGMENT == at]
            chosen.append(own)
            shifts.append(np.full(len(own), start - at))
            rows.append(np.full(len(own), row))
        own, shift, row = (np.concatenate(x) for x in (chosen, shifts, rows))
        names = Names(np.frombuffer(b"".join(p for *_, p in parts), np.uint8))
        blocks = hi[own] // windows - lo[own] // windows + 1
        which = np.repeat(np.arange(len(own)), blocks)
        place = own[which]
        step = np.arange(len(place)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        block = lo[place] // windows + step
        low = np.maximum(lo[place], block * windows)
        high = np.minimum(hi[place], block * windows + windows - 1)
        here = anchor[place] + shift[which]
        core_length = np.full(len(place), threshold - windows + 1)
        source = pa.array(row[which])
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch["doc_id"].take(source),
                "version": batch["version"].take(source),
                "anchor": pa.array(anchor[place], pa.int64()),
                "lo": pa.array(low.astype(np.int32)),
                "hi": pa.array(high.astype(np.int32)),
                "seed": pa.array(seed[place], pa.int64()),
                "block": pa.array(block.astype(np.int32)),
                "core": pa.array(names.at(here - block * windows, core_length)),
                "covered": pa.array(names.at(here - high, high - low + threshold)),
                "done": pa.array(done[place], pa.bool_()),
            }
        )


ROWS = f"doc_id long, version long, {ROW}, done boolean"


def first_rows(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row per anchor: its windows lie ``lo`` to ``hi`` bytes before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch["data"].to_pylist()
            yield from _first_rows(batch["doc_id"], batch["version"], data, threshold)

    return docs.select("doc_id", "version", "data").mapInArrow(run, ROWS)


def split_rows(joined: DataFrame, windows: int, threshold: int = THRESHOLD) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _split_rows(batch, windows, threshold)

    return joined.select("doc_id", "version", "data", "places").mapInArrow(run, ROWS)


def settle(rows: DataFrame, name: str, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """One round: (spans that go, rows to split).

    ``rows`` is a stored frame.
    """
    repeated = rows.groupBy(CLASS).agg(F.count("*").alias("members")).filter("members > 1")
    again = stored(
        meet(rows, stored(repeated, f"{name}_classes"), CLASS, "members").drop("members"), f"{name}_again"
    )
    string = [*CLASS, "lo", "hi", "covered"]
    strings = stored(
        again.groupBy(string).agg(
            F.count("*").alias("copies"),
            F.min(F.struct(*PLACE)).alias("place"),
            F.max("done").alias("was_done"),
        ),
        f"{name}_strings",
    )
    gone = meet(again, strings.filter("copies > 1").select(*string, "copies"), string, "copies").select(
        "doc_id",
        "version",
        (F.col("anchor") - F.col("hi")).alias("start"),
        (F.col("anchor") - F.col("lo") + threshold).alias("end"),
    )
    is_open = (F.col("copies") == 1) & ~F.col("was_done")
    classes = strings.groupBy(CLASS).agg(
        F.count("*").alias("strings"), F.count_if(is_open).alias("open")
    )
    unsettled = classes.filter("open > 0 AND strings > 1").drop("open")
    left = meet(strings, unsettled, CLASS, "strings").select(
        "place.*", "lo", "hi", "seed", (~is_open).alias("done")
    )
    return stored(gone, f"{name}_gone"), stored(left, f"{name}_left")


KEY = ["doc_id", "version"]


def _bucketed(docs: DataFrame) -> DataFrame:
    """(doc_id, version, data, rest): the texts by document, so that every later join on the
    document reads them in place. The key has no NULL, because a NULL-safe join could not use the
    buckets: a missing id is 0 and shows in the version. ``rest`` has the other columns."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"texts_{uuid.uuid4().hex}"
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("doc_id"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("version"),
        F.encode(text, "UTF-8").alias("data"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest"),
    )
    writer = rows.repartition(buckets, *KEY).write.bucketBy(buckets, *KEY)
    writer.option("path", scratch_path(spark, "texts")).saveAsTable(table)
    data = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the entry of the catalog; the frame knows its files
    return data


def repeated_spans(docs: DataFrame, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(texts as in :func:`_bucketed`; spans: doc_id, version, start, end). Spans may overlap."""
    data = _bucketed(docs)
    gone, left = settle(stored(first_rows(data, threshold), "round_0"), "round_0", threshold)
    spans = [gone]
    for number, windows in enumerate(ROUNDS, start=1):
        places = left.groupBy(KEY).agg(
            F.collect_list(F.struct("anchor", "lo", "hi", "seed", "done")).alias("places")
        )
        joined = data.join(places.hint("shuffle_hash"), KEY)
        rows = stored(split_rows(joined, windows, threshold), f"round_{number}")
        gone, left = settle(rows, f"round_{number}", threshold)
        spans.append(gone)
    all_spans = spans[0]
    for more in spans[1:]:
        all_spans = all_spans.unionByName(more)
    return data, all_spans


def _cut(data: bytes, spans: list[dict]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs removed, bytes kept)."""
    kept, removed, runs, at = [], 0, 0, 0
    reach = -1
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if start > reach:
            if runs:
                removed += reach - begin
                at = reach
            kept.append(data[at:start])
            begin, runs = start, runs + 1
        reach = max(reach, end)
    if runs:
        removed += reach - begin
        at = reach
    kept.append(data[at:])
    return removed, runs, b"".join(kept)


def cut_texts(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per document: ``rest`` (its other columns), n_bytes, n_removed, n_spans, kept (the bytes
    that stay) and kept_text, which has no character that lost some of its bytes."""
    data, spans = repeated_spans(docs, threshold)
    lists = spans.groupBy(KEY).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = data.join(lists.hint("shuffle_hash"), KEY, "left").select("rest", "data", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                data, spans = part["data"].to_pylist(), part["spans"].to_pylist()
                cuts = [_cut(d, s or []) for d, s in zip(data, spans)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "rest": part["rest"],
                        "n_bytes": pa.array([len(d) for d in data], pa.int64()),
                        "n_removed": pa.array([c[0] for c in cuts], pa.int64()),
                        "n_spans": pa.array([c[1] for c in cuts], pa.int64()),
                        "kept": pa.array([c[2] for c in cuts], pa.binary()),
                        "kept_text": pa.array(
                            [c[2].decode(errors="ignore") for c in cuts], pa.string()
                        ),
                    }
                )

    schema = (
        StructType()
        .add("rest", joined.schema["rest"].dataType)
        .add("n_bytes", "long")
        .add("n_removed", "long")
        .add("n_spans", "long")
        .add("kept", "binary")
        .add("kept_text", "string")
    )
    return joined.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay) and kept_text."""
    cut = cut_texts(docs.select(F.col("doc_id").cast("long"), "text"), threshold)
    return cut.select("rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_text")


def strip_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The documents with what stays of their texts when every string of ``threshold`` bytes that
    also starts elsewhere goes. ``n_chars``, where there is one, follows."""
    columns = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return cut_texts(docs, threshold).select(
        *[columns.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns]
    )
