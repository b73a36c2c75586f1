"""The operators as named queries, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.llm import (
    bytes_bpe,
    chat_windows,
    divergence,
    exact_dedup,
    html_text,
    language_model,
    line_dedup,
    ngram_join,
    oracles,
    packing,
    quality,
    repeats,
    toxicity,
    vector_codes,
)
from sessionlab.llm.common import table

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


@query(
    "op2_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
              doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
       FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
       WINDOW same AS (PARTITION BY body)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.label_copies(table(spark, sf_dir, "documents"))


@query(
    "op4_line_dedup",
    r"""WITH lines AS (
          SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
        bare AS (
          SELECT doc_id, pos, line,
                 trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
          FROM lines),
        keyed AS (
          SELECT doc_id, pos, line,
                 translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM bare),
        shared AS (
          SELECT key, max(doc_id) AS keep_id FROM keyed WHERE length(key) >= 20
          GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        marked AS (
          SELECT k.doc_id, pos, line, s.key IS NOT NULL AND k.doc_id <> keep_id AS gone
          FROM keyed k LEFT JOIN shared s ON k.key = s.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
                 AS kept_sha256
        FROM marked GROUP BY doc_id""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query("op8_byte_bpe")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = public_tokenizers.PATTERN
    tokens = bytes_bpe.encode(table(spark, sf_dir, "documents"), vocabulary, pattern)
    return bytes_bpe.decode(tokens, vocabulary, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query("op10_best_fit_packing")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary)


@query("op6_quality_rules")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    good, bad = (labels.filter(F.col("quality") == q).select("doc_id") for q in (1, 0))
    return quality.judge(table(spark, sf_dir, "documents"), good, bad)


@query("op3_suffix_dedup")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        F.col("kept_text").alias("text"),
    )


@query("op1_ngram_jaccard_join")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_classes(table(spark, sf_dir, "documents"))


@query("op7_toxicity")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.rate(docs, labels).drop("spans")


@query("op9_lm_scoring")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"))


@query("op5_html_extraction")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


# A conversation whose texts are made of control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query("op11_chat_formatting")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]
    every = given.unionByName(spark.createDataFrame(control, "conv_id long, turn long, role string, text string"))
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return chat_windows.digests(*chat_windows.windows(every, vocabulary, public_tokenizers.PATTERN))


@query("op12_source_divergence", oracles.SOURCE_DIVERGENCE)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op13_vector_codes", oracles.vector_codes())
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))
