"""Quality rules and a likelihood-ratio verdict, with built-in functions only.

The verdict compares two multinomials over hashed word 1- and 2-grams: one of the trusted
documents, one of the whole corpus. A document's score is the sum over its n-grams of
log(p_trusted / p_corpus), divided by the number of n-grams; documents at or above a cut pass.
Counts of all documents enter; they are combined by bucket before the shuffle, so a task
sends at most ``buckets`` rows whatever it reads. The table of log ratios has ``buckets`` numbers
and reaches the tasks as one literal array.

How high a good document scores depends on how much text the trusted ones have, so the cut comes
from the data: a fifth of the trusted documents, by hash of the id, stays out of the trusted counts,
and the cut lies where it parts their scores from those of documents known to be bad with the
fewest errors. Unseen good documents score like those, whatever the size of the table.

Everything else happens inside the row: no text, word or n-gram is shuffled. Repeated 3-word
windows come from sorting a text's window hashes (with their places) and comparing neighbours.

Words are runs of anything but ASCII white space. A missing or empty text has no words; its score
is 0 and the base rules reject it. Without trusted documents both models are the corpus, all
scores are 0 and pass. Rows are judged one by one, so repeated rows get the same verdict.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionlab.llm.common import let, texts

BUCKETS = 1 << 14
HELD_OUT = 5  # one in so many trusted documents sets the cut
# Deviations below the mean of the good scores where there are no bad ones.
DEVIATIONS = 4
BLANKS = r"[\x20\x09-\x0D]+"
TRIMMED = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
SHORT_LIST = 64
PRIOR = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# No longer a cap: every trusted document counts.
MAX_TRUSTED = 20_000
TRUSTED_PIECE = 1 << 21  # trusted ids broadcast at a time


def words_of(text: Column) -> Column:
    bare = F.btrim(text, F.lit(TRIMMED))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANKS))


def _windows(words: Column, width: int) -> Column:
    """Structs of ``width`` consecutive words, one for every place; the last ones hold NULL."""
    n = F.greatest(F.size(words), F.lit(1))
    return F.arrays_zip(*[words] + [F.slice(words, k + 1, n) for k in range(1, width)])


def _bucket(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def _sum(items: Column, kind: str = "long") -> Column:
    return F.aggregate(items, F.lit(0).cast(kind), lambda total, x: total + x)


def repeated_words(words: Column) -> Column:
    """How many words lie in a 3-word window whose words occur as a window more than once."""
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(
        let(
            F.transform(F.slice(_windows(words, 3), 1, F.size(words) - 2), lambda w: F.xxhash64(w)),
            lambda windows: F.when(
                F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")
            ).otherwise(let(_repeated_places(windows), _covered)),
        )
    )


def _repeated_places(windows: Column) -> Column:
    """Places (from 0, ascending) of the hashes that occur more than once."""

    def few(repeated: Column) -> Column:
        return F.filter(
            F.transform(windows, lambda h, i: F.when(F.array_contains(repeated, h), i)),
            lambda i: i.isNotNull(),
        )

    # Looking every window up in a short list is fast; a long one would make it quadratic.
    many = let(
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        lambda ordered: F.sort_array(
            F.filter(
                F.transform(
                    ordered,
                    lambda x, k: F.when(
                        F.get(ordered, k + 1)["h"].eqNullSafe(x["h"])
                        | F.get(ordered, k - 1)["h"].eqNullSafe(x["h"]),
                        x["i"],
                    ),
                ),
                lambda i: i.isNotNull(),
            )
        ),
    )
    repeated = let(
        F.sort_array(windows),
        lambda ordered: F.array_distinct(
            F.filter(
                F.transform(ordered, lambda h, k: F.when(F.get(ordered, k + 1) == h, h)),
                lambda h: h.isNotNull(),
            )
        ),
    )
    return let(repeated, lambda r: F.when(F.size(r) <= SHORT_LIST, few(r)).otherwise(many))


def _covered(places: Column) -> Column:
    """A window adds the words that the window before it does not already hold."""
    added = F.transform(
        places,
        lambda i, k: F.when(k == 0, F.lit(3)).otherwise(
            F.least(F.lit(3), i - F.get(places, k - 1))
        ),
    )
    return _sum(added)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(TRIMMED)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, ``words`` and the base figures of every document."""
    text = F.col("text")
    rows = texts(docs).select("doc_id", "text", words_of(text).alias("words"))
    n_words = F.size("words").cast("long")
    figures = rows.select(
        "doc_id",
        "words",
        n_words.alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        duplicate_lines(text).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return figures.withColumn("base_failed", failed)


def log_ratios(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, max_trusted: int = MAX_TRUSTED
) -> DataFrame:
    """One row, one array: log(p_trusted / p_corpus) for every bucket. The trusted counts get
    ``PRIOR`` per bucket on average, in the corpus's proportions, so that a bucket about which they
    say little has a ratio near 0 and the others are not shifted. ``trusted`` has the doc_id of
    the trusted documents; where there are none, and in buckets that no text uses, the ratio is 0. The trusted model counts all
    of them, joined by id; an id that is listed twice counts once. The corpus model counts every
    document. ``max_trusted`` is no longer used."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("trusted_id")).distinct()
    rows = texts(docs)

    def windows(frame: DataFrame, is_trusted: bool) -> DataFrame:
        return frame.select(F.lit(is_trusted).alias("is_trusted"), words_of(F.col("text")).alias("words")).select(
            "is_trusted", F.inline(_windows(F.col("words"), 2)).alias("first", "second")
        )

    # Texts are never shuffled: the corpus counts take every row where it lies, and the trusted ids
    # reach the texts in broadcast pieces of at most TRUSTED_PIECE, each against the rows of its hash.
    pieces = max(1, -(-ids.count() // TRUSTED_PIECE))
    piece_of = lambda c: F.pmod(F.xxhash64(c), F.lit(pieces))
    words = windows(rows, False)
    for piece in range(pieces):
        own = ids.filter(piece_of(F.col("trusted_id")) == piece)
        matched = rows.filter(piece_of(F.col("doc_id")) == piece).join(
            F.broadcast(own), F.col("doc_id") == F.col("trusted_id"), "left_semi"
        )
        words = words.unionByName(windows(matched, True))
    grams = words.select(
        "is_trusted",
        F.explode(
            F.array(
                _bucket(F.col("first"), buckets),
                F.when(F.col("second").isNotNull(), _bucket(F.struct("first", "second"), buckets)),
            )
        ).alias("bucket"),
    )
    counts = (
        grams.filter("bucket IS NOT NULL")
        .groupBy("bucket")
        .agg(F.count_if(~F.col("is_trusted")).alias("corpus"), F.count_if("is_trusted").alias("trusted"))
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(counts, "bucket", "left").na.fill(0, ["corpus", "trusted"])
    table = filled.agg(
        F.sum("corpus").alias("all_corpus"),
        F.sum("trusted").alias("all_trusted"),
        F.array_sort(F.collect_list(F.struct("bucket", "corpus", "trusted"))).alias("counts"),
    )
    prior = F.lit(PRIOR * buckets)

    def ratio(x: Column) -> Column:
        share = x["corpus"] / F.col("all_corpus")
        return F.ln((x["trusted"] + prior * share) / (F.col("all_trusted") + prior)) - F.ln(share)

    known = lambda x: F.when(x["corpus"] > 0, ratio(x)).otherwise(0.0)
    return table.select(
        F.when(F.col("all_trusted") == 0, F.transform("counts", lambda x: F.lit(0.0)))
        .otherwise(F.transform("counts", known))
        .alias("log_ratios")
    )


def _scored(docs: DataFrame, ratios: np.ndarray, buckets: int) -> DataFrame:
    """The base figures and ``score`` of every document."""
    table = F.lit(ratios)
    value = lambda x: F.element_at(table, _bucket(x, buckets) + 1)
    grams = F.greatest(2 * F.size("words") - 1, F.lit(1))
    return base_rules(docs).withColumn(
        "score",
        F.aggregate(
            _windows(F.col("words"), 2),
            F.lit(0.0),
            lambda total, x: total
            + value(x["words"])
            + F.when(x["1"].isNotNull(), value(x)).otherwise(0.0),
        )
        / grams,
    )


def cut_between(good: np.ndarray, bad: np.ndarray) -> float:
    """The score at which documents begin to pass: the share of good scores below it and that of bad
    ones from it on add up to the least. Of equally good places the lowest counts, and the cut lies
    in the middle of the gap there. Without bad scores it is ``DEVIATIONS`` standard deviations below
    the mean of the good ones, without good ones everything passes."""
    if not len(good):
        return -np.inf
    if not len(bad):
        return float(good.mean() - DEVIATIONS * good.std())
    places = np.unique(np.concatenate([good, bad]))
    below = np.searchsorted(np.sort(good), places, side="left") / len(good)
    passing = 1 - np.searchsorted(np.sort(bad), places, side="left") / len(bad)
    # All bad documents may also lie below every place.
    errors = np.append(below + passing, 1.0)
    best = int(errors.argmin())
    if best == len(places):
        return float(np.nextafter(places[-1], np.inf))
    return float((places[best - 1] + places[best]) / 2) if best else float(places[0])


def fit_cut(docs: DataFrame, ratios: np.ndarray, good: DataFrame, bad: DataFrame, buckets: int) -> float:
    """The cut from documents that the base rules let through: ``good`` and ``bad`` have their ids.
    All of them are scored; the cut is that of ``cut_between``, found by Spark: the scores are
    counted by value, cut into ranges, and summed up range by range, so that only a few numbers of
    each range reach the driver."""
    return _cut_from(_scored(docs, ratios, buckets), good, bad)


def _cut_from(scored: DataFrame, good: DataFrame, bad: DataFrame) -> float:
    """``fit_cut`` from the base figures and ``score`` of every document."""
    judged = (
        good.select("doc_id").withColumn("is_good", F.lit(True))
        .unionByName(bad.select("doc_id").withColumn("is_good", F.lit(False)))
        .distinct()
        .select(F.col("doc_id").alias("judged_id"), "is_good")
    )
    # Every document is scored where it lies; only ids and scores are shuffled, never texts.
    scores = (
        scored.filter("NOT base_failed")
        .select("doc_id", "score")
        .join(judged, F.col("doc_id") == F.col("judged_id"))
        .select("is_good", "score")
    )
    return cut_of(scores)


def cut_of(scores: DataFrame, ranges: int = 64, per_range: int = 200_000) -> float:
    """``cut_between`` of the ``score`` of rows with ``is_good`` true and false, by Spark."""
    totals = scores.agg(
        F.count_if("is_good").alias("n_good"),
        F.count_if(~F.col("is_good")).alias("n_bad"),
        F.avg(F.when(F.col("is_good"), F.col("score"))).alias("mean"),
        F.stddev_pop(F.when(F.col("is_good"), F.col("score"))).alias("std"),
    ).first()
    n_good, n_bad = totals["n_good"], totals["n_bad"]
    if not n_good:
        return -np.inf
    if not n_bad:
        return float(totals["mean"] - DEVIATIONS * totals["std"])
    ranges = max(ranges, (n_good + n_bad) // per_range)
    places = scores.groupBy("score").agg(
        F.count_if("is_good").alias("good"), F.count_if(~F.col("is_good")).alias("bad")
    )
    bounds = sorted(set(places.approxQuantile("score", [k / ranges for k in range(1, ranges)], 0.001)))
    part = F.lit(0)
    for bound in bounds:
        part = part + F.when(F.col("score") > F.lit(bound), 1).otherwise(0)
    places = places.withColumn("part", part).persist()
    try:
        parts = places.groupBy("part").agg(
            F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.max("score").alias("top")
        ).collect()  # one row a range
        good_before, bad_before, top_before, total = {}, {}, {}, [0, 0, None]
        for row in sorted(parts, key=lambda r: r["part"]):
            good_before[row["part"]], bad_before[row["part"]], top_before[row["part"]] = total
            total = [total[0] + row["good"], total[1] + row["bad"], row["top"]]
        before = F.create_map(*[x for k, v in good_before.items() for x in (F.lit(k), F.lit(v))])
        bad_map = F.create_map(*[x for k, v in bad_before.items() for x in (F.lit(k), F.lit(v))])
        top_map = F.create_map(*[x for k, v in top_before.items() for x in (F.lit(k), F.lit(v).cast("double"))])
        within = Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
        ordered = Window.partitionBy("part").orderBy("score")
        ranked = places.select(
            "score",
            (before[F.col("part")] + F.coalesce(F.sum("good").over(within), F.lit(0))).alias("good_less"),
            (bad_map[F.col("part")] + F.coalesce(F.sum("bad").over(within), F.lit(0))).alias("bad_less"),
            F.coalesce(F.lag("score").over(ordered), top_map[F.col("part")]).alias("previous"),
        )
        errors = F.col("good_less") / F.lit(n_good) + (F.lit(1) - F.col("bad_less") / F.lit(n_bad))
        best = ranked.select("score", "previous", errors.alias("errors")).orderBy("errors", "score").first()
    finally:
        places.unpersist()
    # The cut above every score errs by 1.0, as the lowest one does, which comes first.
    if best["previous"] is None:
        return float(best["score"])
    return float((best["previous"] + best["score"]) / 2)


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    rejected: DataFrame | None = None,
    buckets: int = BUCKETS,
    cut: float | None = None,
) -> DataFrame:
    """The base figures, ``score`` and ``kept`` of every document. ``trusted`` and ``rejected`` have
    the doc_id of documents known to be good and bad. With ``cut`` all trusted documents are counted
    and the cut is the given one."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL")
    is_held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    counted = ids.filter(~is_held) if cut is None else ids
    ratios = np.array(log_ratios(docs, counted, buckets).first()["log_ratios"])
    scored = _scored(docs, ratios, buckets).drop("words")
    if cut is None:
        bad = rejected if rejected is not None else ids.limit(0)
        bad = bad.select(F.col("doc_id").cast("long").alias("doc_id"))
        # Scored once: the cut and the verdict read the same rows, which hold no text.
        scored = scored.persist()
        cut = _cut_from(scored, ids.filter(is_held), bad)
    verdict = ~F.col("base_failed") & (F.col("score") >= F.lit(cut))
    return scored.withColumn("kept", verdict)
