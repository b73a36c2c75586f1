"""Documents to packed training sequences, stage by stage.

Every stage but the last returns rows with the columns of ``documents``; each is written to the
shared folder and read again as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sessionlab.llm import exact_dedup, ngram_join, packing, repeats, toxicity
from sessionlab.llm.common import stored, table


# A passage of more than 50 words has 51 words and 50 blanks at least: 203 bytes with words of three
# letters on average, and words of running text are longer. A shorter length would also cut set
# phrases, a longer one would miss passages of short words.
PASSAGE_BYTES = 200


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic. The field is learnt from ``labels``."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near copies the document with the least doc_id."""
    return ngram_join.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of ``PASSAGE_BYTES`` that stand elsewhere too."""
    return repeats.strip_repeats(docs, PASSAGE_BYTES)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in the sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_filter),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", packed_sequences),
]

# Learning, similarity and tokens cannot be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage_{number}")
    return docs
