"""Byte-level BPE: texts to token ids and back, with the ``tokenizers`` library over Arrow batches.

The vocabulary is a rank file (base64 token, rank). ``tokenizers`` works on characters, so every
byte is written as one character; the rank file becomes a BPE model whose merges are all splits of
a token into two tokens, in rank order, which is how ranks themselves decide. Each match of the
pattern is encoded separately, and a match that is a token is that token.

A worker keeps the ids of words it has met, up to ``MEMO`` of them. A word that is not yet known
is split by the pattern and encoded by the model. Texts in which every white space is a single
blank or line end can be cut at these, because no match of the pattern reaches across; all other
texts are matched as a whole.

A missing or empty text has no tokens. Ids outside the vocabulary raise an error when decoded.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import models

MEMO = 400_000
ROWS_AT_A_TIME = 200
UNEVEN_SPACE = re.compile(r"[^\S \n]|[ \n][ \n]")


@cache
def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else the next free
    one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder for one rank file and pattern."""

    def __init__(self, rank_file: str, pattern: str) -> None:
        with open(rank_file, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.characters = {b: c for b, c in enumerate(byte_characters())}
        self.pattern = regex.compile(pattern)
        self.is_match = self.pattern.fullmatch
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        merges = [
            (rank, ranks[token[:i]], ranks[token[i:]], token[:i], token[i:])
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        merges.sort()
        self.model = models.BPE(
            vocab={self.as_characters(token): rank for token, rank in ranks.items()},
            merges=[(self.as_characters(a), self.as_characters(b)) for *_, a, b in merges],
            ignore_merges=True,
        )
        self.words: dict[str, bytes] = {}
        tokens = [self.token_bytes.get(i, b"") for i in range(max(self.token_bytes, default=-1) + 1)]
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.table = np.frombuffer(b"".join(tokens), np.uint8)

    def as_characters(self, data: bytes) -> str:
        return data.decode("latin-1").translate(self.characters)

    def _match(self, match: str) -> bytes:
        tokens = self.model.tokenize(self.as_characters(match.encode()))
        return array("i", [token.id for token in tokens]).tobytes()

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= MEMO:
                self.words.clear()
            core = word.rstrip(".,")
            if len(core) < len(word) and core.isascii() and self.is_match(core) and core[1:].isalpha():
                ids = self._word(core) + self._match(word[len(core) :])
            else:
                ids = b"".join(map(self._match, self.pattern.findall(word)))
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        if UNEVEN_SPACE.search(text):
            return np.frombuffer(b"".join(map(self._match, self.pattern.findall(text))), np.int32)
        ids: list[bytes] = []
        add, known, find = ids.append, self.words.get, self._word
        for number, line in enumerate(text.split("\n")):
            if number:
                add(find("\n"))
            first, *rest = line.split(" ")
            add(find(first))
            for word in rest:
                word = " " + word
                found = known(word)
                add(find(word) if found is None else found)
        return np.frombuffer(b"".join(ids), np.int32)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, one after the other."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes) or not self.sizes[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.places[ids] - (ends - sizes), sizes)
        return self.table[shift + np.arange(len(shift))]

    def spans(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each token starts, in bytes and in characters. A token that begins inside a
        character has the place of that character."""
        sizes = self.sizes[ids]
        starts = np.cumsum(sizes) - sizes
        character = np.cumsum((self.decode(ids) & 0xC0) != 0x80) - 1
        return starts, character[starts]


@cache
def codec(rank_file: str, pattern: str) -> Codec:
    """One per worker process; the words it knows serve all tasks that run there."""
    return Codec(rank_file, pattern)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows), kind))


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_A_TIME) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, which bounds what a worker holds besides one batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode(docs: DataFrame, rank_file: str, pattern: str, *, offsets: bool = False) -> DataFrame:
    """doc_id and ``ids``; with ``offsets`` also ``byte_starts`` and ``char_starts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_file, pattern)
        for batch in slices(batches):
            ids = [own.encode(text or "") for text in batch["text"].to_pylist()]
            columns = {"doc_id": batch["doc_id"], "ids": _lists(ids, pa.int32())}
            if offsets:
                spans = [own.spans(row) for row in ids]
                columns["byte_starts"] = _lists([s[0] for s in spans], pa.int64())
                columns["char_starts"] = _lists([s[1] for s in spans], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, ids array<int>"
    if offsets:
        schema += ", byte_starts array<bigint>, char_starts array<bigint>"
    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, rank_file: str, pattern: str, *, text: bool = False) -> DataFrame:
    """Rows of (doc_id, ids) with ``bytes`` added, and ``text`` where it is asked for.

    The ids may end or begin inside a character, as after a cut; ``bytes`` is exact then, and
    ``text`` has the replacement character in that place. Missing ids are no ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_file, pattern)
        for batch in slices(batches):
            ids = [
                row.values.to_numpy() if row.is_valid else np.zeros(0, np.int32)
                for row in batch["ids"]
            ]
            data = [own.decode(row).tobytes() for row in ids]
            columns = {"doc_id": batch["doc_id"], "ids": batch["ids"], "bytes": pa.array(data, pa.binary())}
            if text:
                columns["text"] = pa.array([d.decode(errors="replace") for d in data], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, ids array<int>, bytes binary" + ", text string" * text
    return tokens.select("doc_id", "ids").mapInArrow(run, schema)
