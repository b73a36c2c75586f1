"""Product codes of vectors, in exact integer arithmetic.

Components become integers, floor(``SCALE`` * x), and a vector is cut into ``PARTS`` equal parts.
Every part position has a codebook of at most ``ENTRIES`` entries, which starts as that part of the
vectors with the smallest ids. A round assigns every part to its nearest entry and moves every
entry to the floor of the mean of its parts; entries without parts stay.

Nearest entries come from |v|^2 - 2 v.c + |c|^2, where the dot products are matrix products on
float64 BLAS. They are exact: integers are broken into limbs of so few bits that a sum of products
of two limbs stays below 2^53, and the products of limbs are put together in int64. The number of
limbs follows from the largest component, so small integers need one product. The first of equal
distances is taken.

A round is one Spark job: every task adds up its parts by entry, Spark adds up the tasks, and what
reaches the driver is one number for every codebook component. The integers are stored once.

A vector that is missing, or holds a missing or non-finite component, is dropped, and so is one
whose number of components is not that of most vectors (of equally frequent ones the largest).
Parts are equal when that number is a multiple of ``PARTS``; otherwise zeros are added at the end.
Repeated rows each count, and equal ids are taken in the order of their vectors; a missing id comes
last. Without vectors the codebooks have no entries. Scaled components must lie within 2^28, so
that squared distances fit into 64 bits; larger ones raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import meet, stored

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LARGEST = 1 << 28
MANTISSA = 53
ROWS_AT_A_TIME = 4096
RATED = "vec_id long, label int, code string, error long"


def limb_bits(width: int) -> int:
    """Bits of a limb such that ``width`` products of two limbs sum to less than 2^53."""
    return (MANTISSA - max(width - 1, 0).bit_length()) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 limbs, the lowest first: the values are the sum of limb k times 2^(bits * k). All
    limbs lie within 2^bits; the last one has the sign."""
    parts = []
    rest = np.asarray(values, np.int64)
    while rest.size and (np.abs(rest) >> bits).any():
        parts.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    parts.append(rest.astype(np.float64))
    return parts


def exact_products(left: np.ndarray, right: np.ndarray, bits: int | None = None) -> np.ndarray:
    """``left @ right.T`` of two integer matrices, exact as long as the result fits into int64."""
    bits = bits or limb_bits(left.shape[1])
    total = np.zeros((len(left), len(right)), np.int64)
    right_limbs = limbs(right, bits)
    for i, a in enumerate(limbs(left, bits)):
        for j, b in enumerate(right_limbs):
            total += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return total


@dataclass(frozen=True)
class Codebooks:
    """``entries`` has the shape (parts, entries, components of a part)."""

    entries: np.ndarray

    @property
    def width(self) -> int:
        """Components of a whole vector."""
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every part: two arrays (vectors, parts)."""
        cut = vectors.reshape(len(vectors), len(self.entries), -1)
        codes = np.empty(cut.shape[:2], np.int64)
        errors = np.empty(cut.shape[:2], np.int64)
        for part, book in enumerate(self.entries):
            own = cut[:, part]
            distance = -2 * exact_products(own, book) + (book * book).sum(axis=1)
            codes[:, part] = distance.argmin(axis=1)
            errors[:, part] = distance[np.arange(len(own)), codes[:, part]] + (own * own).sum(axis=1)
        return codes, errors


def integer_vectors(embeddings: DataFrame, scale: int = SCALE, parts: int = PARTS) -> DataFrame:
    """(vec_id, label, ints) of the vectors that stay, padded to a multiple of ``parts``."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = embeddings.select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("int"),
        F.col("embedding").cast("array<double>").alias("vector"),
    ).filter(F.col("vector").isNotNull() & F.forall("vector", finite))
    size = F.size("vector")
    usual = (
        rows.groupBy(size.alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    )
    width = usual["size"] if usual else 0
    filled = max(-(-width // parts), 0) * parts

    def to_integer(x: Column) -> Column:
        scaled = F.floor(x * scale)
        too_large = F.raise_error(F.lit(f"a component is larger than {LARGEST} after scaling"))
        return F.when(F.abs(x * scale) < LARGEST, scaled).otherwise(too_large.cast("long")).cast("int")

    ints = F.concat(F.transform("vector", to_integer), F.array_repeat(F.lit(0), filled - width))
    return rows.filter(size == width).select("vec_id", "label", ints.alias("ints"))


def _matrices(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
        part = batch.slice(at, ROWS_AT_A_TIME)
        flat = part["ints"].flatten().to_numpy(zero_copy_only=False)
        yield part, flat.astype(np.int64).reshape(part.num_rows, width)


def first_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
    chosen = np.array([r["ints"] for r in rows], np.int64).reshape(len(rows), parts, -1) if rows else None
    return Codebooks(np.zeros((parts, 0, 0), np.int64) if chosen is None else chosen.swapaxes(0, 1).copy())


def refine(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round. Tasks send one row for every (part, entry, component)."""
    shape = books.entries.shape
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        sums, counts = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for batch in batches:
            for _, matrix in _matrices(batch, own.width):
                codes, _ = own.nearest(matrix)
                cut = matrix.reshape(len(matrix), shape[0], shape[2])
                for part in range(shape[0]):
                    np.add.at(sums[part], codes[:, part], cut[:, part])
                    counts[part] += np.bincount(codes[:, part], minlength=shape[1])
        yield pa.RecordBatch.from_pydict(
            {
                "place": pa.array(np.arange(sums.size)),
                "total": pa.array(sums.ravel()),
                "n": pa.array(np.repeat(counts.ravel(), shape[2])),
            }
        )

    added = (
        vectors.select("ints")
        .mapInArrow(run, "place long, total long, n long")
        .groupBy("place")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    flat = books.entries.ravel().copy()
    for place, total, n in added.collect():  # one row for every codebook component
        if n:
            flat[place] = total // n
    shared.unpersist()
    return Codebooks(flat.reshape(shape))


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """``vectors`` (see :func:`integer_vectors`) is read once a round, so it should be stored."""
    books = first_codebooks(vectors, parts, entries)
    for _ in range(rounds if books.entries.size else 0):
        books = refine(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of every vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part, matrix in _matrices(batch, own.width):
                if own.entries.size:
                    codes, errors = own.nearest(matrix)
                else:  # vectors without components
                    codes = errors = np.zeros((len(matrix), len(own.entries)), np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": part["vec_id"],
                        "label": part["label"],
                        "code": pa.array([row.tobytes().hex() for row in codes.astype(np.uint8)], pa.string()),
                        "error": pa.array(errors.sum(axis=1)),
                    }
                )

    return vectors.mapInArrow(run, RATED)


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with ``ints``, the integer vector that the code stands for."""
    parts = [
        F.element_at(
            F.lit(book.tolist()),
            F.conv(F.substring("code", 2 * part + 1, 2), 16, 10).cast("int") + 1,
        )
        for part, book in enumerate(books.entries)
    ]
    return codes.withColumn("ints", F.concat(*parts))


def with_label_errors(rated: DataFrame) -> DataFrame:
    """``rated`` (a stored frame) with ``label_error``, the sum over the rows of a label. Labels are
    summed up before they meet the rows again, and the rows of a large label stay where they are."""
    key = {"label_key": F.coalesce("label", F.lit(0)), "no_label": F.col("label").isNull()}
    keyed = rated.withColumns(key)
    sums = keyed.groupBy(*key).agg(F.sum("error").alias("label_error"), F.count("*").alias("in_label"))
    return meet(keyed, sums, [*key], "in_label").drop(*key, "in_label")


def compress(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every vector that stays."""
    vectors = stored(integer_vectors(embeddings, parts=parts), "integer_vectors")
    books = fit(vectors, parts, entries, rounds)
    rated = stored(encode(vectors, books), "vector_codes")
    return with_label_errors(rated).withColumn("codebooks_sha256", F.lit(books.sha256()))
