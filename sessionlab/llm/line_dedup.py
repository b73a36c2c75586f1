"""Lines that several documents share, dropped from all documents but one.

Only line hashes move. They are range-partitioned by (hash, document) and sorted by position, so a
line that stands in a third of all documents is spread over many tasks; each task streams over its
range and yields one row per hash, and these few rows are combined. What comes back to a document
is a keep bitmap: 64-line words in which a bit marks a dropped line, with only the words that have
such a bit. A document without an entry keeps all lines.

A line's key is the line without ASCII white space at both ends and with A-Z in lower case. Keys
of at least ``MIN_CHARS`` code points in at least ``MIN_DOCS`` documents (distinct ids) lose all
their lines except in the largest doc_id that holds them; a missing id counts as the smallest. A
missing or empty text is one empty line. Rows that share id and text get the same answer.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import let, meet, same_row, stored, texts, version

MIN_CHARS = 20
MIN_DOCS = 3
BLANKS = " \t\n\x0b\x0c\r"
WORD = 64


def line_key(line: Column) -> Column:
    """Blank-stripped line with A-Z lower-cased. ``lower`` would also change other letters, so it
    serves lines of plain ASCII only, where it is much faster than ``translate``."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    )


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, version, pos) of every line whose key is long enough; 128 bits of hash."""
    lines = texts(docs).select(
        "doc_id", version().alias("version"), F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )
    keyed = lines.select("doc_id", "version", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key").alias("h2"),
        "doc_id",
        "version",
        "pos",
    )


def shared_lines(hashes: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, docs, keep_id, lines) of the keys found in at least ``min_docs`` documents."""
    ranges = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    streams = hashes.repartitionByRange(ranges, "h1", "h2", "doc_id").sortWithinPartitions(
        "h1", "h2", "doc_id", "pos"
    )
    # The first aggregate needs no exchange: a range holds all rows of a (hash, document).
    per_document = streams.groupBy("h1", "h2", "doc_id").agg(F.count("*").alias("lines"))
    return (
        per_document.groupBy("h1", "h2")
        .agg(
            F.count("*").alias("docs"),
            F.max("doc_id").alias("keep_id"),
            F.sum("lines").alias("lines"),
        )
        .filter(F.col("docs") >= min_docs)
    )


def dropped_lines(hashes: DataFrame, shared: DataFrame) -> DataFrame:
    """(doc_id, version, pos) of the lines that go. The lines of a frequent key are not gathered."""
    met = meet(hashes, shared, ["h1", "h2"], "lines")
    return met.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "version", "pos")


def drop_bitmaps(dropped: DataFrame) -> DataFrame:
    """(doc_id, version, bitmap): word number → bits of the dropped lines, empty words left out."""
    bit = F.expr(f"shiftleft(1L, pos % {WORD})")
    return (
        dropped.groupBy("doc_id", "version", F.floor(F.col("pos") / WORD).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .groupBy("doc_id", "version")
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("bitmap"))
    )


def apply_bitmap(lines: Column, bitmap: Column) -> Column:
    """The lines without a bit. The map is laid out as an array first, for one step per line."""
    count = F.floor((F.size(lines) + (WORD - 1)) / WORD).cast("int")
    words = F.transform(
        F.sequence(F.lit(0), count - 1), lambda w: F.coalesce(F.try_element_at(bitmap, w), F.lit(0).cast("long"))
    )
    return let(
        words,
        lambda dense: F.filter(
            lines,
            lambda _, i: F.bit_get(F.element_at(dense, F.floor(i / WORD).cast("int") + 1), i % WORD) == 0,
        ),
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, version, bitmap) for the documents that lose lines."""
    hashes = stored(line_hashes(docs, min_chars), "line_hashes")
    shared = stored(shared_lines(hashes, min_docs), "shared_lines")
    return drop_bitmaps(dropped_lines(hashes, shared))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_text."""
    bitmaps = keep_bitmaps(docs, min_chars, min_docs)
    rows = texts(docs).withColumn("version", version())
    joined = rows.join(bitmaps, same_row(rows, bitmaps), "left").select(
        rows["doc_id"], "text", "bitmap"
    )
    lines = F.split("text", "\n")
    dropped = F.aggregate(
        F.map_values("bitmap"), F.lit(0).cast("long"), lambda n, bits: n + F.bit_count(bits)
    )
    kept = F.when(F.col("bitmap").isNull(), F.col("text")).otherwise(
        F.array_join(let(lines, lambda all_lines: apply_bitmap(all_lines, F.col("bitmap"))), "\n")
    )
    return joined.select(
        "doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(dropped, F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
    )
