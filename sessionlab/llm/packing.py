"""Best-fit packing of documents into sequences of a fixed number of tokens.

How long the pieces are is all that packing needs, and there are only ``capacity`` different
lengths. So the plan is made from a table of counts: which lengths share a sequence, and how many
sequences look alike. Its size depends on the capacity alone. Every piece then finds its place by
its length and its number among the pieces of that length.

Large items first: pieces above a third of the capacity fit at most twice into one sequence, so
they are matched greedily, the longest with the longest partner that fits. The others follow in
descending length, each into the smallest gap that takes it; sequences are opened when no gap does.

A length may hold any share of all rows: pieces are numbered inside (length, salt) and the counts
of the salts before are added. A missing or empty text is a document of one token, the end mark.
Repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sessionlab.llm.bytes_bpe import byte_characters, slices
from sessionlab.llm.common import stored

CAPACITY = 4096
END_ID = 1
MEMO = 150_000  # words in each of two generations
LONGEST_KEPT = 64  # bytes of a word that is kept
ROWS_AT_A_TIME = 500
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLAN = "length long, first_rank long, items long, first_bin long, per_bin long, first_offset long"


class WordCodec:
    """Ids of a text as little-endian unsigned 32-bit numbers, those of the whole tokenizer.

    The vocabulary's normaliser and splitter never look across white space, so a text is encoded
    word by word and known words are looked up; a stop or comma behind a letter is a word of its own.
    Words of Latin letters are split here and go to the BPE model directly; all others, and texts
    that hold a special token, go through the tokenizer.

    Known words are kept in two generations. When the young one is full it becomes the old one, and
    words that are met again come back from there, so frequent words are never encoded twice.
    """

    stops = re.compile(rb"(?<=[a-z])[.,](?=\s|\Z)")
    plain = regex.compile(r"[\x21-\x7e¡-įı-ɏ]*")
    matches = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}]+")

    def __init__(self, vocabulary: str) -> None:
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.characters = {b: c for b, c in enumerate(byte_characters())}
        self.words: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _encode_word(self, word: bytes) -> bytes:
        if word.isalpha():  # bytes: ASCII letters only
            return self._pack(self.model.tokenize(word.decode()))
        return self._encode_other(word)

    @staticmethod
    def _pack(tokens: list) -> bytes:
        return array("I", [token.id for token in tokens]).tobytes()

    def _encode_other(self, word: bytes) -> bytes:
        text = word.decode()
        if self.plain.fullmatch(text):
            ids = [
                token.id
                for match in self.matches.findall(text.lower())
                for token in self.model.tokenize(
                    match.encode().decode("latin-1").translate(self.characters)
                )
            ]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _find(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of these words that are too long to be kept; all others are known afterwards."""
        long = {}
        for word in words:
            ids = self.old.get(word)
            if ids is None:
                ids = self._encode_word(word)
            (self.words if len(word) <= LONGEST_KEPT else long)[word] = ids
        return long

    def encode(self, text: str) -> bytes:
        if any(mark in text for mark in self.specials):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        words = self.stops.sub(lambda m: b" " + m.group(), text.encode().lower()).split()
        new = set(words).difference(self.words)
        if len(self.words) + len(new) > MEMO:
            self.old, self.words = self.words, {}
            new = set(words)
        long = self._find(new)
        if long:
            return b"".join(long[w] if w in long else self.words[w] for w in words)
        return b"".join(map(self.words.__getitem__, words))


@cache
def word_codec(vocabulary: str) -> WordCodec:
    return WordCodec(vocabulary)


def cut(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, *, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents; only documents longer than the capacity have several.
    ``with_ids`` adds the ids of a piece as unsigned 32-bit numbers."""
    end = struct.pack("<I", END_ID)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_codec(vocabulary)
        for batch in slices(batches, ROWS_AT_A_TIME):
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = codec.encode(text or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row = (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column, field.type)
                    for column, field in zip(zip(*rows), schema)
                ] if rows else [pa.array([], field.type) for field in schema],
                schema=schema,
            )

    fields = [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
    schema = pa.schema(fields + [("ids", pa.binary())] * with_ids)
    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return rows.mapInArrow(run, PIECES + ", ids binary" * with_ids)


class Plan:
    """Sequences for a table of counts by length. Sequences that look alike have consecutive
    numbers and are handled as one class."""

    def __init__(self, counts: Mapping[int, int], capacity: int = CAPACITY) -> None:
        self.capacity = capacity
        self.left = dict(counts)
        self.placed = dict.fromkeys(counts, 0)
        self.bins = 0
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.gap_sizes: list[int] = []
        self.segments: list[tuple[int, int, int, int, int, int]] = []
        large = sorted(n for n in counts if 3 * n > capacity)
        small = sorted(n for n in counts if 3 * n <= capacity)
        self._match_large(large)
        for length in reversed(small):
            self._best_fit(length)

    def _place(self, length: int, items: int, first_bin: int, per_bin: int, offset: int) -> None:
        self.segments.append((length, self.placed[length], items, first_bin, per_bin, offset))
        self.placed[length] += items
        self.left[length] -= items

    def _add_gap(self, size: int, first_bin: int, bins: int) -> None:
        if size and bins:
            if size not in self.gaps:
                insort(self.gap_sizes, size)
            self.gaps.setdefault(size, []).append((first_bin, bins))

    def _take_gap(self, size: int) -> tuple[int, int]:
        classes = self.gaps[size]
        taken = classes.pop()
        if not classes:
            del self.gaps[size]
            self.gap_sizes.remove(size)
        return taken

    def _open(self, bins: int) -> int:
        first = self.bins
        self.bins += bins
        return first

    def _match_large(self, lengths: list[int]) -> None:
        while lengths:
            length = lengths[-1]
            fitting = lengths[: bisect_left(lengths, self.capacity - length + 1)]
            partner = fitting[-1] if fitting else None
            if partner == length and self.left[length] == 1:
                partner = fitting[-2] if len(fitting) > 1 else None
            if partner is None:
                bins = self.left[length]
                first = self._open(bins)
                self._place(length, bins, first, 1, 0)
                self._add_gap(self.capacity - length, first, bins)
            elif partner == length:
                bins = self.left[length] // 2
                first = self._open(bins)
                self._place(length, 2 * bins, first, 2, 0)
                self._add_gap(self.capacity - 2 * length, first, bins)
            else:
                bins = min(self.left[length], self.left[partner])
                first = self._open(bins)
                self._place(length, bins, first, 1, 0)
                self._place(partner, bins, first, 1, length)
                self._add_gap(self.capacity - length - partner, first, bins)
                if not self.left[partner]:
                    lengths.remove(partner)
            if not self.left[length]:
                lengths.pop()

    def _best_fit(self, length: int) -> None:
        while self.left[length]:
            at = bisect_left(self.gap_sizes, length)
            if at == len(self.gap_sizes):
                bins = -(-self.left[length] // (self.capacity // length))
                self._add_gap(self.capacity, self._open(bins), bins)
                continue
            gap = self.gap_sizes[at]
            first, bins = self._take_gap(gap)
            fit = gap // length
            full = min(bins, self.left[length] // fit)
            offset = self.capacity - gap
            if full:
                self._place(length, full * fit, first, fit, offset)
                self._add_gap(gap - fit * length, first, full)
                first, bins = first + full, bins - full
            rest = self.left[length]
            if bins and rest:  # fewer than fit one more sequence
                self._place(length, rest, first, rest, offset)
                self._add_gap(gap - rest * length, first, 1)
                first, bins = first + 1, bins - 1
            self._add_gap(gap, first, bins)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset. ``pieces`` is read several times, so it should be a
    stored frame; besides ``length`` it needs doc_id and piece to number the rows."""
    spark = pieces.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    by_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("items"))
    counts = {
        row["length"]: row["items"]  # at most `capacity` rows
        for row in pieces.groupBy("length").agg(F.count("*").alias("items")).collect()
    }
    plan = spark.createDataFrame(Plan(counts, capacity).segments, PLAN)

    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_salt.select(
        "length", "salt", F.coalesce(F.sum("items").over(before), F.lit(0)).alias("before")
    )
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    numbered = (
        salted.withColumn("own_rank", F.row_number().over(own) - 1)
        .join(offsets, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("own_rank"))
    )
    here = F.col("rank") - F.col("first_rank")
    places = F.broadcast(plan.withColumnRenamed("length", "plan_length"))
    within = (F.col("length") == F.col("plan_length")) & (here >= 0) & (here < F.col("items"))
    return numbered.join(places, within).select(
        *pieces.columns,
        (F.col("first_bin") + F.floor(here / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + F.pmod(here, "per_bin") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(stored(cut(docs, vocabulary, capacity), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and the ids of its pieces, one after the
    other. ``packed`` has the ``ids`` of the pieces; a sequence is never longer than the capacity."""
    part = F.struct("offset", "ids")
    return packed.groupBy("sequence_id").agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(part)), lambda p: F.hex(p["ids"]))).alias("h")
    ).select("sequence_id", F.unhex("h").alias("ids"))
