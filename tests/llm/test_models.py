import base64
import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sessionlab.llm import bytes_bpe, html_text, language_model, packing, quality, toxicity
from sessionlab.llm.catalog import QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "  two  blanks ", "tab\tand\r\nline\n\nend\n", "it's I'LL 12½ x²", "naïve ÉCOLE ß İ",
    "中文 한글 ١٢٣ 👨‍👩‍👧 é ​ x", "<|endoftext|>", "word,word. word... ***", "a" * 300,
]


def test_bpe_equals_the_rank_file_library(frame):
    ranks = dict(map(bytes.split, open(RANKS, "rb")))
    ranks = {base64.b64decode(token): int(rank) for token, rank in ranks.items()}
    want = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    docs = frame(list(enumerate(ODD)) + [(None, "x")])
    tokens = bytes_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, offsets=True)
    for r in tokens.collect():
        text = "x" if r.doc_id is None else ODD[r.doc_id] or ""
        assert r.ids == want.encode_ordinary(text)
        assert r.byte_starts == [
            len(b"".join(want.decode_single_token_bytes(i) for i in r.ids[:k])) for k in range(len(r.ids))
        ]
        for byte, char in zip(r.byte_starts, r.char_starts):
            assert len(text[:char].encode()) <= byte < len(text[: char + 1].encode())
    back = bytes_bpe.decode(tokens, RANKS, public_tokenizers.PATTERN, text=True)
    assert all(r.text == ("x" if r.doc_id is None else ODD[r.doc_id] or "") for r in back.collect())
    assert bytes_bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_split_characters_decode():
    codec = bytes_bpe.Codec(RANKS, public_tokenizers.PATTERN)
    ids = codec.encode("👨")
    assert len(ids) > 1 and codec.decode(ids[:1]).tobytes() == "👨".encode()[: len(codec.decode(ids[:1]))]
    with pytest.raises(ValueError):
        codec.decode(np.array([60000]))


def test_pieces_equal_the_tokenizer_and_fill_the_sequences(frame):
    tokenizer = Tokenizer.from_file(WORDS)
    texts = ODD + [f"word{i} " * (i * 7 % 61 + 1) for i in range(200)] + ["many words " * 5000]
    texts += ["a <|endoftext|> b", "<|startoftext|>.", "<|EndOfText|>", "unbroken" * 9000, "e.g., don't. é, a.,"]
    docs = frame(list(enumerate(texts)) + [(None, "x"), (3, ODD[3])])
    got = packing.pack_documents(docs, WORDS).collect()
    want = collections.Counter()
    for i, text in [*enumerate(texts), (None, "x"), (3, ODD[3])]:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            want[(i, piece, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        ends = 0
        for offset, length in sorted(items):
            assert offset == ends
            ends += length
        assert ends <= 4096
    assert len(bins) == math.ceil(sum(r.length for r in got) / 4096)
    assert packing.pack_documents(docs.limit(0), WORDS).count() == 0


def test_common_words_survive_many_rare_ones(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 50)
    codec, calls = packing.WordCodec(WORDS), []
    encode = codec._encode_word
    monkeypatch.setattr(codec, "_encode_word", lambda w: calls.append(w) or encode(w))
    for i in range(200):
        codec.encode(f"common words return. rare{i}x once{i}y")
    assert sum(w in (b"common", b"words", b"return") for w in calls) == 3
    assert len(codec.words) + len(codec.old) <= 110


def test_sequences_join_the_ids(frame, spark):
    pieces = packing.stored(packing.cut(frame([(1, "one two"), (2, "three")]), WORDS, with_ids=True), "p")
    packed = packing.pack(pieces)
    rows = sorted(packed.collect(), key=lambda r: r.offset)
    got = packing.sequences(packed).collect()
    assert [bytes(r.ids) for r in got] == [b"".join(bytes(r.ids) for r in rows)]


@pytest.mark.parametrize("capacity", [10, 12, 17])
def test_plan_is_a_packing_and_close_to_the_bound(capacity):
    random = np.random.default_rng(capacity)
    for _ in range(30):
        lengths = random.integers(1, capacity + 1, random.integers(0, 60))
        plan = packing.Plan(collections.Counter(lengths.tolist()), capacity)
        load, placed = collections.Counter(), collections.Counter()
        for length, first, items, first_bin, per_bin, _ in plan.segments:
            assert placed[length] == first
            placed[length] += items
            for k in range(items):
                load[first_bin + k // per_bin] += length
        assert placed == collections.Counter(lengths.tolist())
        assert max(load.values(), default=0) <= capacity and len(load) == plan.bins
        assert plan.bins <= 11 / 9 * math.ceil(lengths.sum() / capacity) + 4


def base_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered),
    )


def test_base_figures_equal_brute_force(spark, frame):
    random = np.random.default_rng(3)
    texts = [None, "", "a", "a b c a b c", "x\nx\n \n\nx", "# a|b <c>"]
    for few in (2, 4, 400):
        texts += [" ".join(f"w{k}" for k in random.integers(0, few, n)) for n in (3, 50, 700)]
    docs = frame(list(enumerate(texts)))
    got = quality.judge(docs, docs.select("doc_id").limit(0)).collect()
    for r in got:
        figures = base_figures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == figures
        assert r.base_failed == (figures[0] < 50 or 2 * figures[4] > figures[0])
        assert r.score == 0 and r.kept != r.base_failed
    assert quality.judge(docs.limit(0), docs.select("doc_id")).count() == 0


def gram_bucket(words, buckets):
    value = 42
    for word in words:
        value = xxhash.xxh64(word.encode(), seed=value & (2**64 - 1)).intdigest()
    return (value - 2**64 if value >= 2**63 else value) % buckets


def test_scores_equal_brute_force(spark, frame):
    random = np.random.default_rng(8)
    texts = [None, "", "one", " two\twords "] + [
        " ".join(f"{kind}{k}" for k in random.integers(0, 30, 70)) for kind in "aab" for _ in range(6)
    ]
    rows = [*enumerate(texts), (4, texts[4])]
    trusted = spark.createDataFrame([(4,), (5,), (5,), (99,), (None,)], "doc_id int")
    buckets = 64
    grams = lambda t: [
        gram_bucket(w[i : i + n], buckets) for w in [(t or "").split()] for n in (1, 2) for i in range(len(w) - n + 1)
    ]
    corpus = collections.Counter(g for _, t in rows for g in grams(t))
    own = collections.Counter(g for i, t in rows if i in (4, 5) for g in grams(t))
    prior, every, all_own = quality.PRIOR * buckets, sum(corpus.values()), sum(own.values())
    ratio = {g: math.log((own[g] + prior * n / every) / (all_own + prior)) - math.log(n / every) for g, n in corpus.items()}
    for r in quality.judge(frame(rows), trusted, buckets=buckets, cut=0.01).collect():
        found = grams(texts[r.doc_id])
        assert r.score == pytest.approx(sum(ratio[g] for g in found) / max(len(found), 1))
        assert r.kept == (not r.base_failed and r.score >= 0.01)


def test_the_cut_parts_good_from_bad():
    cut = lambda good, bad: quality.cut_between(np.array(good, float), np.array(bad, float))
    assert cut([5, 6], [1, 2]) == 3.5 and cut([2, 5, 6, 7], [1, 1, 3]) == 4
    assert cut([], [1]) == -math.inf and cut([], []) == -math.inf
    assert cut([4, 6], []) == 5 - quality.DEVIATIONS
    assert cut([1, 2], [8, 9]) == 1 and cut([3, 3], [3]) <= 3


def test_verdict_holds_for_documents_that_are_not_counted(spark):
    """Held-out trusted documents pass, bad ones do not, and the share of unlabelled documents that
    are rejected does not depend on the size of the table."""
    rejected = {}
    for size in ("0.01", "0.1"):
        folder = f"/root/testdata/sf{size}"
        got = QUERIES["op6_quality_rules"](spark, folder).filter("NOT base_failed")
        labels = spark.read.parquet(f"{folder}/labels.parquet")
        held = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(quality.HELD_OUT)) == 0
        counts = collections.Counter()
        for r in got.join(labels, "doc_id", "left").select("quality", "kept", held.alias("held")).collect():
            counts[r.quality, r.kept] += 1
            counts["held", r.kept] += r.quality == 1 and r.held
        share = lambda kind, kept: counts[kind, kept] / (counts[kind, True] + counts[kind, False])
        assert share(1, False) <= 0.01 and share("held", False) <= 0.05 and share(0, True) <= 0.05
        rejected[size] = share(None, False)
        print(size, {k: round(share(k, False), 4) for k in (1, "held", None)}, round(share(0, True), 4))
    assert abs(rejected["0.01"] - rejected["0.1"]) <= 0.05 and rejected["0.1"] <= 0.1


def test_toxic_documents_are_found_and_clean_ones_left_alone(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op7_toxicity"](spark, folder).filter("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    counts = {
        (r.toxic, r.predicted): r["count"]
        for r in got.join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    }
    assert counts.get((0, 1), 0) <= 0.005 * counts[0, 0]
    assert counts[1, 1] >= 0.5 * (counts[1, 1] + counts.get((1, 0), 0))


def test_toxic_documents_are_found_in_every_language(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op7_toxicity"](spark, folder).filter("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter("toxic = 1")
    langs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").distinct()
    found = {
        r.lang: r.share
        for r in got.join(labels, "doc_id").join(langs, "doc_id").groupBy("lang")
        .agg(F.avg("predicted").alias("share")).collect()
    }
    assert set(found) == {"de", "en", "es", "fr"} and min(found.values()) >= 0.75


def test_spans_are_the_offending_words(spark, frame):
    rows = [(i, f"Ünder{i} the calm word{i % 7} stands here") for i in range(150)]
    rows += [(i, f"Ünder{i} the horrid, word{i % 7} stands here") for i in range(150, 300)]
    labels = spark.createDataFrame(
        [(i, int(i >= 150)) for i in range(300)] + [(None, 1)], "doc_id long, toxic int"
    )
    docs = frame([*rows, (400, None), (401, ""), (None, "horrid")])
    field = toxicity.learn(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, field).collect()}
    text = rows[200][1]
    assert [text[s.start : s.end] for s in got[200].spans] == ["horrid"]
    assert got[200].score > 0.9 and got[10].score < 0.1 and got[400].score == got[401].score == 0
    none = toxicity.learn(docs, labels.limit(0))
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.0}
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [*range(150), 400, 401]
    assert toxicity.rate(docs.limit(0), labels).count() == 0


def test_marginals_equal_enumeration():
    texts = [b"a b c d", b"", b"b", b"c a a b c"]
    tokens = toxicity.tokens_of(texts)
    random = np.random.default_rng(1)
    known = np.zeros(toxicity.FEATURES, np.uint64)
    names = np.unique(tokens.features)
    known[(names >> np.uint64(64 - toxicity.BITS)).astype(int)] = names
    field = toxicity.Field(known, np.append(random.normal(size=toxicity.FEATURES), 0), -0.3, random.normal(size=4))
    tag, moves = toxicity.marginals(tokens, field)
    score = field.weights[toxicity.places(tokens.features, known)].sum(axis=0) + field.bias
    for row in range(len(texts)):
        own = np.flatnonzero(tokens.owner == row)
        weight = {}
        for tags in itertools.product((0, 1), repeat=len(own)):
            total = sum(score[i] for i, t in zip(own, tags) if t)
            total += sum(field.moves[2 * a + b] for a, b in zip(tags, tags[1:]))
            weight[tags] = math.exp(total)
        whole = sum(weight.values())
        for k, i in enumerate(own):
            assert tag[i] == pytest.approx(sum(w for t, w in weight.items() if t[k]) / whole)
            if k:
                both = sum(w for t, w in weight.items() if t[k - 1] and t[k]) / whole
                assert moves[i, 3] == pytest.approx(both)


@pytest.fixture
def small_model():
    random = np.random.default_rng(2)
    states = language_model.STATES
    part = lambda *shape: random.random(shape) + 0.05
    start, enter, moves, emits = part(states), part(states), part(states, states), part(4, states)
    return language_model.Model(
        start / start.sum(), enter / enter.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0)
    )


def walks(text, model, first):
    """(probability, states) of every walk through the states that emits the text."""
    for path in itertools.product(range(language_model.STATES), repeat=len(text)):
        yield (
            first[path[0]]
            * math.prod(model.moves[a, b] for a, b in zip(path, path[1:]))
            * math.prod(model.emits[s, p] for s, p in zip(text, path))
        ), path


def block_frame(spark, texts, block_bytes=1 << 20):
    """Blocks of texts of one-letter words, all of them training documents; the letter of symbol k
    is the k-th."""
    data = [(i, False, " ".join("?.abcdefghij"[k] for k in t[:-1]).encode()) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(data, "doc_id long, held_out boolean, data binary")
    return language_model.stored(language_model.to_blocks(frame.repartition(3), block_bytes), "blocks")


HEAD = [b"a", b"b"]  # symbols 2 and 3; "." is none of the head


def groups_of(texts):
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    return language_model._groups(np.concatenate(texts), ends - sizes, sizes, np.zeros(len(sizes), bool))


def test_forward_recursion_equals_enumeration(small_model):
    texts = [[1, 2, 0], [3, 0], [0], [2, 2, 1, 0]]
    found = {}
    for own, symbols, layout, inner in groups_of(texts):
        _, scale = language_model._forward(symbols, layout, small_model, inner)
        found |= dict(zip(own, np.add.reduceat(np.log(scale)[layout.place], layout.first)))
    for number, text in enumerate(texts):
        total = sum(p for p, _ in walks(text, small_model, small_model.start))
        assert found[number] == pytest.approx(math.log(total))


def expected_by_enumeration(texts, model, stretch):
    """(start, enter, moves, emits) expected counts over all walks."""
    states = language_model.STATES
    start, enter, moves, emits = np.zeros(states), np.zeros(states), np.zeros((states, states)), np.zeros((4, states))
    for text in texts:
        for at in range(0, len(text), stretch):
            part = text[at : at + stretch]
            every = list(walks(part, model, model.enter if at else model.start))
            total = sum(p for p, _ in every)
            for p, path in every:
                (enter if at else start)[path[0]] += p / total
                for symbol, state in zip(part, path):
                    emits[symbol, state] += p / total
                for a, b in zip(path, path[1:]):
                    moves[a, b] += p / total
    return start, enter, moves, emits


TEXTS = [[1, 2, 0], [3, 0], [0], [2, 2, 1, 0], [1, 2, 0]]


@pytest.mark.parametrize("stretch, block_bytes", [(99, 1 << 20), (2, 3)])
def test_a_round_equals_enumeration(monkeypatch, spark, small_model, stretch, block_bytes):
    monkeypatch.setattr(language_model, "STRETCH", stretch)
    start, enter, moves, emits = (x + language_model.SMOOTH for x in expected_by_enumeration(TEXTS, small_model, stretch))
    got = language_model.baum_welch_round(block_frame(spark, TEXTS, block_bytes), small_model, HEAD)
    assert np.allclose(got.start, start / start.sum()) and np.allclose(got.enter, enter / enter.sum())
    assert np.allclose(got.moves, moves / moves.sum(axis=1, keepdims=True))
    assert np.allclose(got.emits, emits / emits.sum(axis=0))


@pytest.mark.parametrize("block_bytes", [1 << 20, 3])
def test_states_of_all_words_equal_enumeration(spark, small_model, block_bytes):
    """Words outside the head get states of their own from the last round, and scores follow."""
    # "." and "c" are both symbol 1 in the rounds.
    texts = [[1, 2, 0], [4, 2, 4, 0], [4, 3, 0], [1, 0]]
    as_symbols = [[1 if s == 4 else s for s in t] for t in texts]
    states = language_model.STATES
    want = {w: np.zeros(states) for w in (b"", b".", b"a", b"b", b"c")}
    for text, own in zip(texts, as_symbols):
        every = list(walks(own, small_model, small_model.start))
        total = sum(p for p, _ in every)
        for p, path in every:
            for word, state in zip(text, path):
                want[b"" if word == 0 else b".abc"[word - 1 : word]][state] += p / total
    blocks = block_frame(spark, texts, block_bytes)
    words = language_model.stored(language_model.word_states(blocks, small_model, HEAD), "states")
    vocabulary = {r.block: [b"", *bytes(r.words).split(b"\n")] if r.words else [b""] for r in blocks.collect()}
    seen = collections.Counter()
    for r in words.collect():
        word = vocabulary[r.block][r.place]
        share = language_model.unpack(np.array([r.packed]))[0]
        assert r.n == round(want[word].sum()) and np.allclose(share * r.n, want[word], atol=0.003 * r.n)
        seen[word] += r.is_first
    assert seen == dict.fromkeys(want, 1)
    totals = language_model.state_totals(words)
    assert np.allclose(totals, sum(want.values()), atol=0.03)
    # Scores by enumeration, with the emissions of all words.
    tokens, types = sum(map(len, texts)), len(want)
    first_rows = {vocabulary[r.block][r.place]: r for r in words.collect() if r.is_first}
    share = totals / tokens
    emits = {
        word: (language_model.unpack(np.array([r.packed]))[0] * r.n + share) / (totals + share * (types + 1))
        for word, r in first_rows.items()
    }
    head = language_model.Head(HEAD, np.array([2, 1]), len(texts), tokens, types)
    for r in language_model.score_blocks(blocks, words, small_model, head).collect():
        own = [b"" if k == 0 else b".abc"[k - 1 : k] for k in texts[r.doc_id]]
        total = sum(
            small_model.start[path[0]]
            * math.prod(small_model.moves[a, b] for a, b in zip(path, path[1:]))
            * math.prod(emits[w][s] for w, s in zip(own, path))
            for path in itertools.product(range(states), repeat=len(own))
        )
        assert r.score == pytest.approx(math.log10(total)) and r.n_known == len(own)
    # Every state's probabilities add up to 1, with one more word that was never seen.
    whole = sum(emits.values()) + share / (totals + share * (types + 1))
    assert np.allclose(whole, 1, atol=1e-3)


def test_shares_survive_packing():
    random = np.random.default_rng(1)
    shares = random.dirichlet(np.ones(language_model.STATES), 500)
    assert np.abs(language_model.unpack(language_model.pack(shares)) - shares).max() < 0.003
    assert language_model.pack(np.eye(language_model.STATES)).min() > 0
    assert not language_model.unpack(np.zeros(1, np.int64)).any()


def test_rounds_raise_the_likelihood(spark):
    random = np.random.default_rng(5)
    texts = [[*(random.integers(2, 6, 30) + 4 * (k % 2)), 0] for k in range(40)]
    blocks = block_frame(spark, texts)
    head = [bytes([c]) for c in b"abcdefgh"]
    model = language_model._random_model(10, np.ones(10))

    def likelihood():
        return sum(np.log(language_model._forward(s, la, model, i)[1]).sum() for _, s, la, i in groups_of(texts))

    values = [likelihood()]
    for _ in range(4):
        model = language_model.baum_welch_round(blocks, model, head)
        values.append(likelihood())
    assert all(b > a - 1e-6 for a, b in zip(values, values[1:])) and values[-1] > values[0] + 10


def test_a_very_long_text_is_scored(frame):
    rows = [(i, f"word{i % 7} and more") for i in range(40)] + [(99, "very long " * 50_000), (100, "x" * 2_000_000)]
    got = {r.doc_id: r for r in language_model.score_texts(frame(rows)).collect()}
    assert got[99].n_tokens == 100_001 and math.isfinite(got[99].score) and got[100].n_tokens == 2


def test_language_model_scores(monkeypatch, frame):
    monkeypatch.setattr(language_model, "HEAD", 20)
    random = np.random.default_rng(4)
    texts = [None, "", "Same same\tSAME"]
    for kind in ("a", "b"):
        texts += [" ".join(f"{kind}{k}" for k in random.zipf(1.5, 40) % 60) for _ in range(60)]
    rows = [*enumerate(texts), (None, "same new"), (7, texts[7]), (2 * 10**9, "unseen")]
    got = language_model.score_texts(frame(rows)).collect()
    held = {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 7 == 2}
    words = lambda t: [*(t or "").encode().lower().split(), "end"]
    counts = collections.Counter(w for i, t in rows if i not in held for w in words(t))
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter()
    for i, t in rows:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t))
        want[(i, i in held, len(words(t)), sum(counts[w] > 0 for w in words(t)), n, round(base, 6))] += 1
    assert collections.Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    both = [r for r in got if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in both) > sum(r.base_score for r in both)
    assert language_model.score_texts(frame([])).count() == 0


def test_every_round_learns_from_all_training_documents(monkeypatch, frame):
    seen = []

    def record(blocks, model, head):
        seen.append(sum(held is False for r in blocks.collect() for held in r.held_out))
        return model

    monkeypatch.setattr(language_model, "baum_welch_round", record)
    rows = [(i, f"word{i % 9} same") for i in range(1500)]
    monkeypatch.setattr(language_model, "BLOCK_BYTES", 500)
    got = language_model.score_texts(frame(rows)).collect()
    training = sum(zlib.crc32(str(i).encode()) % 7 != 2 for i in range(1500))
    # The last round is the one that gathers the states of all words.
    assert seen == [training] * (language_model.ROUNDS - 1) and len(got) == 1500


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body>
<header>Site</header><nav><ul><li><a href=/>Home</a><li><a href=/b>More</a></ul></nav>
<div id="cookie-notice">We use cookies, as all do.</div>
<article><h1>Title</h1><p><b>First &amp; long&nbsp;text,   with commas, and a <a href=x>link</a>.<br><p>Short.
<ul><li>one<li>two, three</ul><div class="ad">Buy, now, cheap!</div><p>Last &lt;line&gt; of it, at last.
<section class="comments"><p>A reader wrote a long, long comment, with marks.</p></section></article>
<aside>Side, bar.</aside><form>Name <input></form><script>var t = "</p>";</script><footer>&copy; all</footer></body>"""


def test_main_text():
    assert html_text.main_text(PAGE).split("\n") == [
        "Title", "First & long text, with commas, and a link.", "Short.", "one", "two, three",
        "Last <line> of it, at last.",
    ]
    assert html_text.main_text("") == "" and html_text.main_text("<nav>x</nav>") == ""
    assert html_text.main_text("<div>" * 5000 + "deep &eacute;") == "deep é"


TEXT = "A long text of the article, with commas, stops; and more words, as they come. " * 3


@pytest.mark.parametrize(
    "page, blocks",
    [
        ('<body><div class="post has-sidebar"><p>{t}</p><p>{t}</p></div></body>', "tt"),
        ('<div class="layout with-header"><article><p>{t}</p></article></div><div class="sidebar">x</div>', "t"),
        ('<body><div><p>A lead, with a comma.</p></div><div class="body"><p>{t}{t}</p><p>{t}</p></div><div>(c)</div></body>', "ltt"),
        ('<body><h1>Title</h1><div class="body"><p>{t}</p><p>{t}</p></div></body>', "Ttt"),
        ('<article><h1><a href="x">Title</a></h1><p>{t}</p><p>{t}</p></article>', "Ttt"),
        ('<div class="content related-posts"><p>{t}</p></div>', "t"),
        ('<body><article><p>{t}</p></article><article><p>{t}</p></article><div class="comments"><p>{t}{t}{t}</p></div></body>', "tt"),
        ('<main><p>{t}</p><section class="comments"><article class="comment"><p>{t}{t}{t}</p></article></section></main>', "t"),
        ('<article><p>Short.</p><div class="ad"><p>{t}{t}</p></div><p>End.</p></article>', "SE"),
    ],
)
def test_article_text_is_not_lost(page, blocks):
    found = html_text.main_text(page.replace("{t}", TEXT)).split("\n")
    kinds = {"A long": "t", "A lead": "l", "Title": "T", "Short.": "S", "End.": "E"}
    assert "".join(kinds.get(b[:6], "?") for b in found) == blocks


def test_extract_keeps_every_page(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, 5), (2, None, None, 6), (2, None, None, 6), (None, "v", "plain", 7)],
        "page_id long, url string, html string, text int",
    )
    got = sorted((str(r.page_id), r.url, r.n_chars) for r in html_text.extract(pages).collect() if r.url)
    assert got == [("1", "u", len(html_text.main_text(PAGE))), ("None", "v", 5)]
    assert html_text.extract(pages).count() == 4 and html_text.extract(pages.limit(0)).count() == 0


def test_text_digests_of_the_bpe_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op8_byte_bpe"](spark, folder).collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
