"""Scores of texts under a hidden Markov language model and under word counts.

Words are runs of anything but ASCII white space, with A-Z as a-z; every text ends with one end
mark, which counts as a token. The documents that are not held out are the training documents.

Tables. Documents are stored in blocks of about ``BLOCK_BYTES`` of text: the words of the block and,
for every document, its tokens as places among them. A word of the corpus is a row per block that
has it, not per document, whenever words meet their counts.

The model. A text is a walk through ``STATES`` hidden states; a state emits a token. Baum-Welch starts
from a fixed random model, which breaks the symmetry, and runs for ``ROUNDS`` rounds, each over all
training documents: a round is one Spark job in which every partition adds up its expected counts
and Spark adds up the partitions. In all rounds but the last the ``HEAD`` most frequent words are
symbols of their own and all others share one, because every task holds the emissions of all
symbols. The last round gathers the expected counts of every state for every word of the corpus in
a Spark table, which grows with the vocabulary. With E(w, s) of them for word w and state s, E(s) for
the state, N training tokens, V of them distinct, and the state's share P(s) = E(s) / N,

    p(w | s) = (E(w, s) + P(s)) / (E(s) + P(s) (V + 1)),

which is the base estimate (c(w) + 1) / (N + V + 1) where a state says nothing about a word, also
for words that were never seen. What a word has in the states is kept in 1023rds, so the
probabilities add up to 1 within 10^-3. The words of a block then get their probabilities, and the scaled
forward recursion computes the exact likelihood of every text.

Recursions run along many texts side by side, one step for the next symbol of each. So that a few
long texts do not make thousands of steps for themselves, rounds learn from stretches of at most
``STRETCH`` symbols; every symbol is in one of them, and stretches that begin inside a text have a
first state of their own (``enter``). Scores follow every text from beginning to end: a text of a
million words is a million steps of one row, about ten seconds.

A missing or empty text is the end mark alone. Rows are scored one by one and each counts in
training, so repeated rows have equal scores. A missing id is never held out. Without training
documents N and V are 0 and every token has probability 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.llm.chains import SideBySide
from sessionlab.llm.common import stored, texts

HEAD = 1 << 14  # a task sends as many rows in every round
STRETCH = 512
STATES = 6
ROUNDS = 8
SMOOTH = 0.01
END, TAIL = 0, 1  # symbols; the head follows
FIRST = 2
BLOCK_BYTES = 16 << 20
BLOCKS = 1 << 20  # of a task at most
TOKENS_AT_A_TIME = 400_000
LOG10 = np.log(10)
SHARE_BITS = 10
SHARES = (1 << SHARE_BITS) - 1


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % folds == fold, F.lit(False))


def words_of(text: bytes) -> list[bytes]:
    """``bytes`` lower-cases A-Z only and splits at ASCII white space only."""
    return text.lower().split()


BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("words", pa.binary()),
        ("doc_id", pa.list_(pa.int64())),
        ("held_out", pa.list_(pa.bool_())),
        ("sizes", pa.binary()),
        ("places", pa.binary()),
    ]
)
BLOCK_TYPE = "block long, words binary, doc_id array<bigint>, held_out array<boolean>, sizes binary, places binary"


class _Places(dict):
    """Numbers words as they come, from 1; 0 is the end mark."""

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self) + 1
        return place


def _block(number: int, rows: list[tuple], words: _Places) -> pa.RecordBatch:
    ids, held, places = zip(*rows)
    return pa.RecordBatch.from_pylist(
        [
            {
                "block": number,
                "words": b"\n".join(words),
                "doc_id": ids,
                "held_out": held,
                "sizes": np.array([len(p) for p in places], "<i8").tobytes(),
                "places": np.concatenate(places).astype("<i4").tobytes(),
            }
        ],
        schema=BLOCK,
    )


def to_blocks(docs: DataFrame, block_bytes: int | None = None) -> DataFrame:
    """Blocks of rows (doc_id, held_out, data)."""
    size_limit = block_bytes or BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * BLOCKS
        rows, words, size = [], _Places(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for row in zip(*(part[c].to_pylist() for c in ("doc_id", "held_out", "data"))):
                    own = words_of(row[2])
                    places = np.zeros(len(own) + 1, np.int32)
                    places[:-1] = np.fromiter(map(words.__getitem__, own), np.int32, len(own))
                    rows.append((row[0], row[1], places))
                    size += len(row[2])
                    if size >= size_limit:
                        yield _block(number, rows, words)
                        number, rows, words, size = number + 1, [], _Places(), 0
        if rows:
            yield _block(number, rows, words)

    return docs.select("doc_id", "held_out", "data").mapInArrow(run, BLOCK_TYPE)


class Block:
    """A stored block as arrays. ``words`` has the empty word, the end mark, at place 0."""

    def __init__(self, batch: pa.RecordBatch, at: int) -> None:
        self.number = batch["block"][at].as_py()
        text = batch["words"][at].as_py()
        self.words = [b"", *(text.split(b"\n") if text else [])]
        self.doc_id = batch["doc_id"][at].values
        self.held_out = batch["held_out"][at].values
        self.sizes = np.frombuffer(batch["sizes"][at].as_py(), "<i8")
        self.places = np.frombuffer(batch["places"][at].as_py(), "<i4")
        self.ends = np.cumsum(self.sizes)
        self.training = ~self.held_out.to_numpy(zero_copy_only=False).astype(bool)

    def training_counts(self) -> np.ndarray:
        own = self.places[np.repeat(self.training, self.sizes)]
        return np.bincount(own, minlength=len(self.words))

    def pieces(self, stretch: int | None, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first token, length, begins inside a text) of the chosen documents, or their stretches."""
        starts, sizes = (self.ends - self.sizes)[chosen], self.sizes[chosen]
        if not stretch:
            return starts, sizes, np.zeros(len(starts), bool)
        parts = -(-sizes // stretch)
        step = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(starts, parts) + step * stretch
        return first, np.minimum(stretch, np.repeat(starts + sizes, parts) - first), step > 0


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, pa.RecordBatch, int]]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield Block(batch, at), batch, at


def count_words(blocks: DataFrame) -> DataFrame:
    """(word, n) over the training documents; the end mark is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, *_ in _blocks(batches):
            counts = block.training_counts()
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.words, pa.binary()).take(pa.array(used)), pa.array(counts[used])],
                names=["word", "n"],
            )

    return blocks.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Head:
    """The frequent words by symbol, and the totals of the counts."""

    words: list[bytes]
    counts: np.ndarray
    ends: int
    tokens: int
    types: int

    @property
    def tail_tokens(self) -> int:
        return self.tokens - self.ends - int(self.counts.sum())


def head_of(counts: DataFrame, size: int | None = None) -> Head:
    """The most frequent words. Words are first counted by the size of their count, which says how
    frequent a word of the head is at least; so only few words are sorted."""
    size = HEAD if size is None else size
    is_end = F.octet_length("word") == 0
    total = counts.agg(
        F.sum("n").alias("n"), F.count("*").alias("types"), F.sum(F.when(is_end, F.col("n"))).alias("ends")
    ).first()
    words = counts.filter(~is_end)
    level = F.floor(F.log2("n") * 8)
    least, found = 0, 0
    levels = words.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()
    for row in sorted(levels, key=lambda r: -r["level"]):  # a few hundred rows
        least, found = row["level"], found + row["words"]
        if found >= size:
            break
    rows = words.filter(level >= least).orderBy(F.desc("n"), "word").limit(size).collect()
    return Head(
        [bytes(r["word"]) for r in rows],
        np.array([r["n"] for r in rows], np.int64),
        total["ends"] or 0,
        total["n"] or 0,
        total["types"],
    )


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # (states)
    enter: np.ndarray  # (states)
    moves: np.ndarray  # (states, states)
    emits: np.ndarray  # (symbols, states)


def _random_model(symbols: int, counts: np.ndarray) -> Model:
    """Symbol frequencies, turned up or down in every state by fixed random factors."""
    random = np.random.default_rng(1)
    emits = (counts[:, None] + SMOOTH) * random.uniform(0.5, 1.5, (symbols, STATES))
    moves = np.eye(STATES) * 0.8 + 0.2 / STATES
    first = np.full(STATES, 1 / STATES)
    return Model(first, first, moves, emits / emits.sum(axis=0))


def _forward(
    symbols: np.ndarray, layout: SideBySide, model: Model, inner: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward probabilities of every item, and its scale. ``inner`` marks the sequences that
    begin inside a text, in the order of the layout."""
    emitted = model.emits[symbols]
    alpha, scale = np.empty_like(emitted), np.empty(len(symbols))
    for number, step in enumerate(layout.steps):
        if number:
            now = alpha[layout.steps[number - 1]][: step.stop - step.start] @ model.moves
            now *= emitted[step]
        else:
            now = emitted[step] * np.where(inner[:, None], model.enter, model.start)
        total = now.sum(axis=1)
        alpha[step] = now / total[:, None]
        scale[step] = total
    return alpha, scale


def _groups(
    places: np.ndarray, starts: np.ndarray, lengths: np.ndarray, inner: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, SideBySide, np.ndarray]]:
    """(sequences, places, layout, inner) of about TOKENS_AT_A_TIME tokens at a time, laid out side by
    side. Sequences of like length go together, so that few groups have many steps."""
    order = np.argsort(-lengths, kind="stable")
    group = np.cumsum(lengths[order]) // TOKENS_AT_A_TIME
    for own in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        if len(own):
            layout = SideBySide(lengths[own])
            token = np.arange(int(lengths[own].sum())) + np.repeat(starts[own] - layout.first, lengths[own])
            laid = np.empty(len(token), np.int64)
            laid[layout.place] = places[token]
            yield own, laid, layout, inner[own][layout.order]


def _expected(
    symbols: np.ndarray, layout: SideBySide, model: Model, inner: np.ndarray, sums: dict
) -> np.ndarray:
    """The probability of every state at every item, given the whole text. Adds the expected moves
    and first states to ``sums``."""
    alpha, scale = _forward(symbols, layout, model, inner)
    emitted = model.emits[symbols]
    emitted /= scale[:, None]
    steps = layout.steps
    beta = None
    for number in range(len(steps) - 1, -1, -1):
        step = steps[number]
        n = step.stop - step.start
        own = np.ones((n, STATES))
        if number + 1 < len(steps):
            after = steps[number + 1]
            reach = after.stop - after.start
            ahead = emitted[after] * beta
            own[:reach] = ahead @ model.moves.T
            sums["moves"] += alpha[step][:reach].T @ ahead
        beta = own
        alpha[step] *= own
    sums["start"] += alpha[steps[0]][~inner].sum(axis=0)
    sums["enter"] += alpha[steps[0]][inner].sum(axis=0)
    return alpha


def _add_by(places: np.ndarray, states: np.ndarray, total: np.ndarray) -> None:
    for state in range(STATES):
        total[:, state] += np.bincount(places, states[:, state], len(total))


def _no_sums() -> dict:
    return {"moves": np.zeros((STATES, STATES)), "start": np.zeros(STATES), "enter": np.zeros(STATES)}


def _symbols(block: Block, symbol: dict[bytes, int]) -> np.ndarray:
    """The symbol of every word of the block."""
    found = np.fromiter((symbol.get(w, TAIL) for w in block.words), np.int32, len(block.words))
    found[0] = END
    return found


def baum_welch_round(blocks: DataFrame, model: Model, head: list[bytes]) -> Model:
    """One round: every partition adds up its expected counts, Spark adds up the partitions."""
    size = len(model.emits)
    shared = blocks.sparkSession.sparkContext.broadcast((model, head))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, words = shared.value
        symbol = {word: i + FIRST for i, word in enumerate(words)}
        sums, emits = _no_sums(), np.zeros((size, STATES))
        for block, *_ in _blocks(batches):
            symbols = _symbols(block, symbol)[block.places]
            for _, laid, layout, inner in _groups(symbols, *block.pieces(STRETCH, block.training)):
                _add_by(laid, _expected(laid, layout, own, inner, sums), emits)
        sums["moves"] *= own.moves
        rows = np.concatenate([emits, sums["moves"], [sums["start"], sums["enter"]]])
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used)] + [pa.array(rows[used, s]) for s in range(STATES)],
            names=["place", *(f"s{s}" for s in range(STATES))],
        )

    schema = "place long, " + ", ".join(f"s{s} double" for s in range(STATES))
    added = blocks.mapInArrow(run, schema).groupBy("place").agg(
        *[F.sum(f"s{s}").alias(f"s{s}") for s in range(STATES)]
    )
    table = np.zeros((size + STATES + 2, STATES))
    for place, *values in added.collect():  # at most symbols + states + 2 rows
        table[place] = values
    shared.unpersist()
    emits = table[:size] + SMOOTH
    moves = table[size : size + STATES] + SMOOTH
    start, enter = table[size + STATES :] + SMOOTH
    return Model(
        start / start.sum(),
        enter / enter.sum(),
        moves / moves.sum(axis=1, keepdims=True),
        emits / emits.sum(axis=0),
    )


def fit(blocks: DataFrame, head: Head) -> Model:
    """All rounds but the last."""
    counts = np.concatenate([[head.ends, head.tail_tokens], head.counts]).astype(float)
    model = _random_model(len(counts), counts)
    for _ in range(ROUNDS - 1):
        model = baum_welch_round(blocks, model, head.words)
    return model


def pack(shares: np.ndarray) -> np.ndarray:
    """Rows of shares that add up to 1 as one number each."""
    parts = np.rint(shares * SHARES).astype(np.int64)
    return (parts << (SHARE_BITS * np.arange(STATES))).sum(axis=1)


def unpack(packed: np.ndarray) -> np.ndarray:
    parts = (packed[:, None] >> (SHARE_BITS * np.arange(STATES))) & SHARES
    return parts / np.maximum(parts.sum(axis=1, keepdims=True), 1)


def _unpacked(packed: Column) -> list[Column]:
    parts = [F.shiftright(packed, SHARE_BITS * s).bitwiseAND(F.lit(SHARES)) for s in range(STATES)]
    return [part / F.greatest(sum(parts[1:], parts[0]), F.lit(1)) for part in parts]


def word_states(blocks: DataFrame, model: Model, head: list[bytes]) -> DataFrame:
    """The last round: (block, place, n, packed, is_first) for every word of every block, with the
    count of the word in the whole corpus and its shares of the states there. A word has one row
    that is the first."""
    shared = blocks.sparkSession.sparkContext.broadcast((model, head))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, words = shared.value
        symbol = {word: i + FIRST for i, word in enumerate(words)}
        for block, *_ in _blocks(batches):
            symbols = _symbols(block, symbol)
            states = np.zeros((len(block.words), STATES))
            for _, laid, layout, inner in _groups(block.places, *block.pieces(STRETCH, block.training)):
                _add_by(laid, _expected(symbols[laid], layout, own, inner, _no_sums()), states)
            counts = block.training_counts()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(counts), block.number)),
                    pa.array(np.arange(len(counts), dtype=np.int32)),
                    pa.array(block.words, pa.binary()),
                    pa.array(counts),
                    pa.array(pack(states / np.maximum(counts, 1)[:, None])),
                ],
                names=["block", "place", "word", "n", "packed"],
            )

    parts = blocks.mapInArrow(run, "block long, place int, word binary, n long, packed long")
    word = Window.partitionBy("word")
    sums = [F.sum(F.col("n") * share).over(word) for share in _unpacked(F.col("packed"))]
    names = [f"s{s}" for s in range(STATES)]
    added = parts.select(
        "block",
        "place",
        F.sum("n").over(word).alias("n"),
        (F.col("block") == F.min("block").over(word)).alias("is_first"),
        *[value.alias(name) for value, name in zip(sums, names)],
    )
    parted = [
        F.shiftleft(F.round(F.col(name) / F.greatest(F.col("n"), F.lit(1)) * SHARES).cast("long"), SHARE_BITS * s)
        for s, name in enumerate(names)
    ]
    return added.select("block", "place", "n", "is_first", sum(parted[1:], parted[0]).alias("packed"))


def state_totals(words: DataFrame) -> np.ndarray:
    """E(s), from one row of every word."""
    shares = _unpacked(F.col("packed"))
    sums = words.filter("is_first").agg(*[F.sum(F.col("n") * share) for share in shares]).first()
    return np.array([x or 0.0 for x in sums])


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score_blocks(blocks: DataFrame, words: DataFrame, model: Model, head: Head) -> DataFrame:
    """Every document of the blocks with its scores."""
    totals = state_totals(words)
    shared = blocks.sparkSession.sparkContext.broadcast((model.start, model.moves, totals))
    tokens, types = head.tokens, head.types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, moves, in_state = shared.value
        share = in_state / max(tokens, 1)
        for block, batch, at in _blocks(batches):
            own = batch["known"][at].values
            place = own.field("place").to_numpy(zero_copy_only=False)
            n = np.zeros(len(block.words), np.int64)
            n[place] = own.field("n").to_numpy(zero_copy_only=False)
            emits = np.zeros((len(n), STATES))
            emits[place] = unpack(own.field("packed").to_numpy(zero_copy_only=False))
            emits = (emits * n[:, None] + share) / np.maximum(in_state + share * (types + 1), 1e-300)
            if not tokens:
                emits[:] = 1.0
            own_model = Model(start, start, moves, emits)
            firsts = block.ends - block.sizes
            score = np.empty(len(firsts))
            everything = np.ones(len(firsts), bool)
            for rows, laid, layout, inner in _groups(block.places, *block.pieces(None, everything)):
                _, scale = _forward(laid, layout, own_model, inner)
                score[rows] = np.add.reduceat(np.log(scale)[layout.place], layout.first) / LOG10
            base = np.log10((n + 1) / (tokens + types + 1))[block.places]
            yield pa.RecordBatch.from_arrays(
                [
                    block.doc_id,
                    block.held_out,
                    pa.array(block.sizes),
                    pa.array(np.add.reduceat((n > 0)[block.places].astype(np.int64), firsts)),
                    pa.array(np.add.reduceat(base, firsts)),
                    pa.array(score),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    lists = words.groupBy("block").agg(F.collect_list(F.struct("place", "n", "packed")).alias("known"))
    return blocks.join(lists.hint("shuffle_hash"), "block").mapInArrow(run, SCORED)


def score_texts(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = texts(docs).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.encode("text", "UTF-8").alias("data")
    )
    blocks = stored(to_blocks(rows), "word_blocks", "zstd")
    head = head_of(stored(count_words(blocks), "word_counts"))
    model = fit(blocks, head)
    words = stored(word_states(blocks, model, head.words), "word_states")
    return score_blocks(blocks, words, model, head).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(head.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
