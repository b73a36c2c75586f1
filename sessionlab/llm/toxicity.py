"""Toxic spans with a linear-chain conditional random field.

Tags are O and T. Documents are labelled, tokens are not, so tokens get their training labels from
the documents: a word is telling when it stands in ``MIN_TIMES`` toxic training documents, in as
many different contexts (the words before and after, which copies of a document repeat), and in
hardly any clean one. The support is a number, not a share of the toxic documents: a share of all of
them would leave out the words of every language but the most frequent one. The tokens of telling
words in toxic documents are T. The
field learns weights of features (the word, its beginning and ending, the words before and after),
of which it knows those that stand at least twice with a T, and of the four transitions. Every iteration of
the gradient ascent is one Spark job that sums the gradients of the partitions. Learning uses at
most ``MAX_TRAIN`` documents of each label, those with the smallest hash, so that their ids can be
broadcast; contexts are counted over the same documents.

Every document is then scored whole: forward and backward recursions give each token's
probability of T. What a probability exceeds ``FLOOR`` by counts, so that thousands of nearly
certain O do not add up; a document's evidence is minus the log of the probability that no token
is T, taken over the tokens as if independent. The cut between the evidence of toxic and clean
documents is the one with the fewest errors on the training documents, because a word that is rare
in clean documents says little alone and much beside others. The score is one half at the cut.
Tokens above one half are a document's spans, in characters.

A missing or empty text, or one without a word, has score 0 and no spans. Without toxic training
documents all scores are 0. Repeated rows are scored alike; a missing id is never held out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlab.llm import hashing
from sessionlab.llm.chains import SideBySide
from sessionlab.llm.common import hash_sample, stored

MAX_TRAIN = 3000
BITS = 18
FEATURES = 1 << BITS
KINDS = 5
ITERATIONS = 12
STEP = 1.0
DECAY = 0.01
MIN_TIMES = 5  # toxic training documents and contexts of a telling word
MIN_RATIO = 20.0
FLOOR = 0.05
STEEPNESS = 4
BEGINNING = 6  # bytes
CHUNK = 1 << 20

SALTS = hashing.numbers(KINDS, 6)
LETTER = np.zeros(256, bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass(frozen=True)
class Field:
    """Known features by hash, their weights for tag T against O (one more for all unknown ones,
    which stays 0), a bias, log transitions OO, OT, TO, TT, and the evidence that makes a document
    toxic."""

    known: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray
    cut: float = np.log(2)


@dataclass(frozen=True)
class Tokens:
    """Tokens of some texts: owner, byte span in the joined buffer, word name, feature names."""

    owner: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    names: np.ndarray
    features: np.ndarray
    counts: np.ndarray


def tokens_of(texts: list[bytes]) -> Tokens:
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    starts, ends, names = hashing.word_names(data, ~LETTER)
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    ending = np.zeros(len(starts), np.uint64)
    for back in (1, 2, 3):
        value = hashing.BYTE[data[np.maximum(ends - back, 0)]]
        ending = np.where(ends - back >= starts, hashing.pair(ending, value), ending)
    beginning = np.zeros(len(starts), np.uint64)
    for ahead in range(BEGINNING):
        value = hashing.BYTE[data[np.minimum(starts + ahead, len(data) - 1)]]
        beginning = np.where(starts + ahead < ends, hashing.pair(beginning, value), beginning)
    before, after = np.zeros_like(names), np.zeros_like(names)
    if len(names):
        same = owner[1:] == owner[:-1]
        before[1:] = np.where(same, names[:-1], 0)
        after[:-1] = np.where(same, names[1:], 0)
    features = np.stack(
        [hashing.pair(values, salt) for values, salt in zip((names, ending, before, after, beginning), SALTS)]
    )
    return Tokens(owner, starts, ends, names, features, np.bincount(owner, minlength=len(texts)))


def places(features: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The place of every feature in the table of known ones, FEATURES for the others."""
    at = (features >> np.uint64(64 - BITS)).astype(np.int64)
    return np.where(known[at] == features, at, FEATURES)


def marginals(tokens: Tokens, field: Field) -> tuple[np.ndarray, np.ndarray]:
    """(probability of T of every token, its probability of the moves OO, OT, TO, TT from the
    token before; rows of first tokens are 0).

    With two tags both recursions are recursions of one ratio, T against O, which needs no scaling
    beyond a clip.
    """
    layout = SideBySide(tokens.counts)
    score = field.weights[places(tokens.features, field.known)].sum(axis=0) + field.bias
    odds = np.empty(len(score))
    odds[layout.place] = np.exp(np.clip(score, -40, 40))
    oo, ot, to, tt = np.exp(field.moves)
    forward, backward = np.empty_like(odds), np.ones_like(odds)
    for number, step in enumerate(layout.steps):
        if number == 0:
            forward[step] = odds[step]
            continue
        n = step.stop - step.start
        past = forward[layout.steps[number - 1]][:n]
        forward[step] = np.clip(odds[step] * (ot + past * tt) / (oo + past * to), 1e-30, 1e30)
    for number in range(len(layout.steps) - 2, -1, -1):
        step, after = layout.steps[number], layout.steps[number + 1]
        n = after.stop - after.start
        ahead = odds[after] * backward[after]
        backward[step.start : step.start + n] = np.clip(
            (to + tt * ahead) / (oo + ot * ahead), 1e-30, 1e30
        )
    both = np.clip(forward * backward, 1e-30, 1e30)
    tag = (both / (1 + both))[layout.place]
    forward, ahead = forward[layout.place], np.clip(odds * backward, 1e-30, 1e30)[layout.place]
    moves = np.zeros((len(score), 4))
    if len(score):
        inner = np.flatnonzero(tokens.owner[1:] == tokens.owner[:-1]) + 1
        past, now = forward[inner - 1], ahead[inner]
        joint = np.stack([np.full(len(inner), oo), ot * now, to * past, tt * past * now], axis=1)
        moves[inner] = joint / joint.sum(axis=1, keepdims=True)
    return tag, moves


def _evidence(texts: list[bytes], field: Field) -> tuple[np.ndarray, Tokens, np.ndarray]:
    """Evidence of texts, their tokens and the tokens' probabilities of T."""
    tokens = tokens_of(texts)
    tag, _ = marginals(tokens, field)
    counted = np.clip((tag - FLOOR) / (1 - FLOOR), 0, 1 - 1e-12)
    return np.bincount(tokens.owner, -np.log1p(-counted), len(texts)), tokens, tag


def document_scores(texts: list[bytes], field: Field) -> tuple[np.ndarray, Tokens, np.ndarray]:
    """Scores of texts, their tokens and the tokens' probabilities of T."""
    evidence, tokens, tag = _evidence(texts, field)
    odds = (evidence / field.cut) ** STEEPNESS
    return odds / (1 + odds), tokens, tag


def _groups(data: list[bytes]) -> Iterator[np.ndarray]:
    """Row numbers in groups of about CHUNK bytes. Texts of like length go together, so that few
    groups have many steps; a group is as small as the longest text allows."""
    sizes = np.array([len(text) for text in data], np.int64)
    order = np.argsort(-sizes, kind="stable")
    group = np.cumsum(sizes[order]) // CHUNK
    for rows in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        if len(rows):
            yield rows


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % folds == fold, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(toxic, data) of the training documents: labelled, not held out, at most ``max_train`` of
    each label. Of an id with several labels the largest counts."""
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .filter(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    both = [hash_sample(chosen.filter(F.col("toxic") == t), ["label_id"], max_train) for t in (0, 1)]
    rows = docs.select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"))
    return (
        rows.join(F.broadcast(both[0].unionByName(both[1])), F.col("doc_id") == F.col("label_id"))
        .select("toxic", "data")
        .distinct()
    )


def telling_words(train: DataFrame) -> np.ndarray:
    """Names of the words that stand for toxic documents, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, toxic = batch["data"].to_pylist(), batch["toxic"].to_numpy()
            for rows in _groups(data):
                tokens = tokens_of([data[i] for i in rows])
                own = np.array([zlib.crc32(data[i]) for i in rows], np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "name": pa.array(tokens.names.view(np.int64)),
                        "context": pa.array(hashing.pair(*tokens.features[2:4]).view(np.int64)),
                        "text": pa.array(own[tokens.owner]),
                        "toxic": pa.array(toxic[rows][tokens.owner], pa.int32()),
                    }
                )

    words = train.mapInArrow(run, "name long, context long, text long, toxic int").distinct()
    totals = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    is_toxic, is_clean = F.col("toxic") == 1, F.col("toxic") == 0
    counts = words.groupBy("name").agg(
        F.count_distinct(F.when(is_toxic, F.col("text"))).alias("toxic"),
        F.count_distinct(F.when(is_clean, F.col("text"))).alias("clean"),
        F.count_distinct(F.when(is_toxic, F.col("context"))).alias("contexts"),
    )
    often = counts.filter(F.least("toxic", "contexts") >= MIN_TIMES)
    ratio = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    # Few, because the training documents are: no more than their words.
    names = [r["name"] for r in often.filter(ratio >= MIN_RATIO).select("name").collect()]
    return np.sort(np.array(names, np.int64).view(np.uint64))


def _gold(tokens: Tokens, toxic: np.ndarray, telling: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(telling, tokens.names), len(telling) - 1)
    return (telling[at] == tokens.names) & (toxic[tokens.owner] == 1)


def known_features(train: DataFrame, telling: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """The features that stand at least twice with a T, as a hash table, how often they do, and
    the share of T among all tokens. Of two features in one place the more frequent stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, toxic = batch["data"].to_pylist(), batch["toxic"].to_numpy()
            for rows in _groups(data):
                tokens = tokens_of([data[i] for i in rows])
                gold = _gold(tokens, toxic[rows], telling)
                found = tokens.features[:, gold].ravel().view(np.int64)
                # All tokens are counted under 0, which no feature of a word is.
                yield pa.RecordBatch.from_pydict(
                    {
                        "feature": pa.array(np.append(found, 0)),
                        "n": pa.array(np.append(np.ones(len(found), np.int64), len(gold))),
                    }
                )

    counts = train.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    known, times, tokens, gold = np.zeros(FEATURES, np.uint64), np.zeros(FEATURES + 1), 1, 0
    for n, feature in sorted((r["n"], r["feature"]) for r in counts.filter("n > 1").collect()):
        name = np.array([feature], np.int64).view(np.uint64)
        at = int(name[0] >> np.uint64(64 - BITS))
        if feature == 0:
            tokens = n
        else:
            known[at], times[at], gold = name[0], n, gold + n
    return known, times, max(gold, 1) / KINDS / tokens


def learn(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Field:
    """Fit the field. The driver holds the weights and receives one sum per feature."""
    train = stored(training_rows(docs, labels, max_train), "toxic_train")
    telling = telling_words(train)
    weights, bias, moves = np.zeros(FEATURES + 1), -3.0, np.zeros(4)
    if not len(telling):
        return Field(np.zeros(FEATURES, np.uint64), weights, -np.inf, moves)
    known, times, share = known_features(train, telling)
    bias = float(np.log(share))
    # With all weights 0 the slope is (times with T) - share * (times in all): the start is half
    # the log odds of each feature, because word and ending say the same.
    first = _slope(train, Field(known, weights, bias, moves), telling)[: FEATURES + 1]
    weights = 0.5 * np.log((times + 0.1) / (np.maximum(times - first, 0) + 0.1)) * (times > 0)
    squares = np.full(FEATURES + 6, 1e-8)
    for _ in range(ITERATIONS):
        slope = _slope(train, Field(known, weights, bias, moves), telling)
        slope[: FEATURES + 1] -= DECAY * weights
        squares += slope**2
        change = STEP * slope / np.sqrt(squares)
        weights = weights + change[: FEATURES + 1]
        bias += change[FEATURES + 1]
        moves = moves + change[FEATURES + 2 :]
    field = Field(known, weights, float(bias), moves)
    return replace(field, cut=_best_cut(*_train_evidence(train, field)))


def _train_evidence(train: DataFrame, field: Field) -> tuple[np.ndarray, np.ndarray]:
    """Evidence and label of the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, toxic = batch["data"].to_pylist(), batch["toxic"].to_numpy()
            for rows in _groups(data):
                evidence = _evidence([data[i] for i in rows], field)[0]
                yield pa.RecordBatch.from_pydict(
                    {"evidence": pa.array(evidence), "toxic": pa.array(toxic[rows], pa.int32())}
                )

    # Few, as the training documents are.
    rows = train.mapInArrow(run, "evidence double, toxic int").collect()
    return np.array([r["evidence"] for r in rows]), np.array([r["toxic"] for r in rows])


def _best_cut(evidence: np.ndarray, toxic: np.ndarray) -> float:
    """The evidence with the fewest toxic documents below it and clean ones from it on: the middle
    of the gap, and of several the lowest."""
    order = np.lexsort((toxic, evidence))
    values, toxic = evidence[order], toxic[order]
    errors = np.cumsum(toxic == 1) - np.cumsum(toxic == 0)
    gaps = np.flatnonzero(values[1:] > values[:-1])
    if not len(gaps):
        return float(np.log(2))
    best = gaps[np.argmin(errors[gaps])]
    return float((values[best] + values[best + 1]) / 2)


def _slope(train: DataFrame, field: Field, telling: np.ndarray) -> np.ndarray:
    """Slope of the log likelihood of all tags: features, none for the unknown, bias, moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 6)
        for batch in batches:
            data, toxic = batch["data"].to_pylist(), batch["toxic"].to_numpy()
            for rows in _groups(data):
                tokens = tokens_of([data[i] for i in rows])
                tag, expected = marginals(tokens, field)
                gold = _gold(tokens, toxic[rows], telling)
                error = gold - tag
                for kind in places(tokens.features, field.known):
                    total[: FEATURES + 1] += np.bincount(kind, error, FEATURES + 1)
                total[FEATURES + 1] += error.sum()
                if len(gold) > 1:
                    same = tokens.owner[1:] == tokens.owner[:-1]
                    move = (2 * gold[:-1] + gold[1:])[same]
                    total[FEATURES + 2 :] += np.bincount(move, minlength=4) - expected.sum(axis=0)
        total[FEATURES] = 0
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"place": pa.array(used), "slope": pa.array(total[used])})

    parts = train.mapInArrow(run, "place long, slope double").groupBy("place").agg(F.sum("slope"))
    slope = np.zeros(FEATURES + 6)
    for place, value in parts.collect():
        slope[place] = value
    return slope


def score_documents(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, score and ``spans`` (start, end, probability; characters) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            data = batch["data"].to_pylist()
            for rows in _groups(data):
                texts = [data[i] for i in rows]
                if np.isinf(own.bias):
                    scores, spans = np.zeros(len(texts)), [[] for _ in texts]
                else:
                    scores, tokens, tag = document_scores(texts, own)
                    spans = _spans(texts, tokens, tag)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch["doc_id"].take(pa.array(rows)),
                        "score": pa.array(scores),
                        "spans": pa.array(spans, SPANS),
                    }
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"),
    )
    return rows.mapInArrow(
        run, "doc_id long, score double, spans array<struct<start:bigint,end:bigint,probability:double>>"
    )


SPANS = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])
)


def _spans(texts: list[bytes], tokens: Tokens, tag: np.ndarray) -> list[list[dict]]:
    spans: list[list[dict]] = [[] for _ in texts]
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    for i in np.flatnonzero(tag >= 0.5):
        row = tokens.owner[i]
        start, end = tokens.starts[i] - begins[row], tokens.ends[i] - begins[row]
        head = len(texts[row][:start].decode())
        size = len(texts[row][start:end].decode())
        spans[row].append({"start": head, "end": head + size, "probability": float(tag[i])})
    return spans


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and spans of every document."""
    return score_documents(docs, learn(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "spans",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted to be toxic, with all their columns.

    The score is computed beside the text in the same task, so no text is shuffled.
    """
    field = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    @F.pandas_udf("double")
    def score(texts):
        data = [(t or "").encode() for t in texts]
        scores = np.zeros(len(data))
        if not np.isinf(field.value.bias):
            for rows in _groups(data):
                scores[rows] = document_scores([data[i] for i in rows], field.value)[0]
        return pd.Series(scores)

    return docs.filter(score("text") < 0.5)
