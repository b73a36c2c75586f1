"""Chat windows, source divergence and vector codes against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sessionlab.llm import chat_windows, divergence, oracles, vector_codes
from sessionlab.llm.catalog import QUERIES
from sessionlab.llm.common import stored

FOLDER = "/root/testdata/sf0.001"
VOCABULARY, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def conversation_digests(rows):
    """(turns, digest of turns, loss characters, digest of loss) by conversation."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for conv_id, own in turns.items():
        own.sort()
        loss = "".join(text for *_, role, text in own if role == "assistant")
        said = "".join(f"{role}\n{text}\n" for *_, role, text in own)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        found[conv_id] = (len(own), digest(said), len(loss), digest(loss))
    return found


@pytest.fixture(scope="module")
def conversations(spark):
    """Control strings and pieces of them, ties, missing values, repeated rows, a long text."""
    random.seed(1)
    pieces = ["<s>", "<\\s>", "</s>", "[INST]", "[\\\\/INST]", "<", "[", "\\", "/s>", "INST]", "x", "\n", " ok"]
    rows = []
    for conv_id in (1, 2, None, 5):
        for turn in range(random.choice([30, 150])):
            role = random.choice(["user", "assistant", "assistant", "tool\n[INST]", None]) if turn else "system"
            text = "".join(random.choices(pieces, k=random.randint(0, 60)))
            rows.append((conv_id, random.choice([turn, turn, turn, 7, None]), role, random.choice([text, text, None])))
    rows += rows[:5] + [(9, 0, "user", "long " * 30_000), (10, 0, "assistant", None), (11, 0, "system", "only")]
    return rows, "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("budget, history, chunk", [(128, 32, 50), (2000, 300, 40), (16, 0, 4096)])
def test_windows_say_every_turn_once(spark, conversations, budget, history, chunk):
    rows, schema = conversations
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{schema}, chunk int, kind string")
    short, long = chat_windows.windows(frame, VOCABULARY, PATTERN, budget, history, chunk)
    got = {r.conv_id: tuple(r)[1:5] for r in chat_windows.digests(short, long).collect()}
    assert got == conversation_digests(rows)
    for window in short.unionByName(long).collect():
        assert window.tokens <= budget or window.turns - window.repeated == 1
        assert len(chat_windows.read_turns(window.text)) == window.turns


def test_windows_repeat_system_turn_and_limited_history(spark):
    rows = [(1, 0, "system", "Be brief.")]
    rows += [(1, n, "user" if n % 2 else "assistant", f"turn {n} " + "word " * 30) for n in range(1, 30)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for chunk in (4096, 8):  # in one piece and dealt out
        short, long = chat_windows.windows(frame, VOCABULARY, PATTERN, 200, 60, chunk)
        made = short.unionByName(long).orderBy("chunk", "window").collect()
        assert len(made) > 5 and all(w.text.startswith("<s>[INST]system[/INST]Be brief.</s>") for w in made)
        assert all(w.repeated == 2 and w.tokens <= 200 for w in made[1:])
        learnt = [chat_windows.unescape(w.text[s.start : s.end]) for w in made for s in w.loss]
        assert learnt == [r[3] for r in rows if r[2] == "assistant"]


def test_escape_breaks_control_strings():
    random.seed(3)
    for _ in range(3000):
        text = "".join(random.choices(["<", "[", "\\", "/", "s>", "INST]", "<s>", "[/INST]", "é"], k=random.randint(0, 12)))
        hidden = chat_windows.escape(text)
        assert chat_windows.unescape(hidden) == text
        assert not any(mark in hidden for mark in ("<s>", "</s>", "[INST]", "[/INST]"))
        formatted = chat_windows.write_turn(text, text)[0]
        assert chat_windows.read_turns(formatted * 2) == [(text, text)] * 2


def test_chat_query_holds_the_control_conversation(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in QUERIES["op11_chat_formatting"](spark, FOLDER).collect()}
    assert {k: tuple(r)[1:5] for k, r in got.items()} == conversation_digests(rows)
    assert all(r.formatted_chars > r.loss_chars for r in got.values())
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_windows.digests(*chat_windows.windows(empty, VOCABULARY, PATTERN)).count() == 0


DOCS = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def audited():
    """Terms around the threshold, prefixes of each other, long ones, missing values, repeated rows."""
    random.seed(4)
    stems = ["a", "ab", "abc", "abcd", "abcde", "Éa", "éé", "x" * 40, "x" * 41, "y" * 3000, "wort", "Wörter"]
    words = stems + [s + t for s in stems for t in stems]
    rows = []
    for i in range(120):
        text = random.choice([" ", ",", "\n1 ", "\x0b"]).join(random.choices(words, k=random.randint(0, 12)))
        source = random.choice(["s1", "s1", "s1", "s2", "S3", None])
        rows.append((i, random.choice([text, text, text, None]), random.choice(["en", "en", None, "de"]), source))
    return rows + rows[:2] + [(None, None, "fr", "only"), (7, "lonely", "fr", "other"), (8, "", "it", None)]


def as_sql_rows(rows):
    database = duckdb.connect()
    database.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    database.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    return sorted(tuple(r) for r in database.execute(oracles.SOURCE_DIVERGENCE).fetchall())


def test_audit_equals_sql(spark, audited):
    frame = spark.createDataFrame([(*r, 1, 2, "z") for r in audited], f"{DOCS}, term int, n int, block string")
    got = sorted(tuple(r) for r in divergence.audit(frame.repartition(3)).collect())
    assert got == as_sql_rows(audited)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("term_blocks")]


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(1, "one", "en", "a"), (2, None, "en", "b")]
    got = sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)] == as_sql_rows(rows)


def test_kept_terms_do_not_depend_on_blocks_or_levels(spark, audited):
    documents = defaultdict(Counter)
    for _, text, lang, _ in audited:
        for term in set(divergence.terms_of((text or "").encode())):
            documents[lang or ""][term] += 1
    want = sorted((lang, t.decode()) for lang, terms in documents.items() for t, n in terms.items() if n >= 3)
    frame = spark.createDataFrame(audited, DOCS)
    for block_bytes, first in ((1, 1), (500, 3), (1 << 20, 4)):
        blocks = divergence.write_blocks(frame, block_bytes)
        kept = divergence.kept_terms(blocks, 3, first)
        assert sorted(tuple(r) for r in kept.select("lang", "term").distinct().collect()) == want
        assert kept.select("lang", "term").distinct().count() == kept.select("term_id").distinct().count()


def test_words_are_ordered_by_their_bytes():
    random.seed(2)
    words = {bytes(random.choices(b"abz\xc3\xa9", k=random.randint(1, 24))) for _ in range(3000)}
    words |= {b"a" * n for n in range(1, 40)} | {b"a" * 16 + w for w in list(words)[:50]}
    words = list(words)
    order, heads = divergence.in_order(words)
    assert [words[i] for i in order] == sorted(words)
    assert heads.tolist() == [int.from_bytes((words[i] + b" ")[:8].ljust(8, b"\0")) for i in order]
    assert len(divergence.in_order([])[0]) == 0


def test_rare_prefixes_are_discarded(spark):
    rows = [(i, f"common rare{'abcdefgh'[i]}tail" + "z" * 100, "en", "s") for i in range(8)]
    blocks = divergence.write_blocks(spark.createDataFrame(rows, DOCS).coalesce(1))
    first = stored(divergence.level(blocks, None, 4), "level")
    assert {bytes(r.prefix): r.docs for r in first.collect()} == {b"comm": 8, b"rare": 8}
    ranges = first.groupBy("block").agg(F.collect_list(F.struct("lo", "hi")).alias("list"))
    second = divergence.level(blocks, ranges, 8)
    assert {bytes(r.prefix): r.docs for r in second.collect() if r.docs > 1} == {b"common ": 8}


def test_weight_is_exact_for_large_counts(spark):
    counts = [0, 5, 2**33 - 1, 2**33, 10**12, 3 * 10**17]
    frame = spark.createDataFrame([(c, c * 3 + 7, 11) for c in counts], "c long, n long, v long")
    got = frame.select(divergence.weight(frame["c"], frame["n"], frame["v"])).collect()
    assert [r[0] for r in got] == [1 + 10**9 * (c + 1) // (c * 3 + 18) for c in counts]


VECTORS = "vec_id long, embedding array<float>, label int"


def codes_by_loops(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [math.floor(4096 * x) for x in r[1]]))
    vectors = [[math.floor(4096 * x) for x in r[1]] for r in kept]
    width = len(vectors[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in vectors]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, c)), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        groups = [defaultdict(list) for _ in range(parts)]
        for c in cut:
            for p in range(parts):
                groups[p][nearest(c[p], p)[1]].append(c[p])
        books = [
            [[sum(x) // len(own[k]) for x in zip(*own[k])] if k in own else book[k] for k in range(len(book))]
            for own, book in zip(groups, books)
        ]
    best = [[nearest(c[p], p) for p in range(parts)] for c in cut]
    label_error = Counter()
    for r, b in zip(kept, best):
        label_error[r[2]] += sum(d for d, _ in b)
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    sha = hashlib.sha256(flat.encode()).hexdigest()
    return sorted(
        (str(r[0]), str(r[2]), "".join(f"{k:02x}" for _, k in b), sum(d for d, _ in b), label_error[r[2]], sha)
        for r, b in zip(kept, best)
    )


def vector_rows(count, width, size, seed=6):
    random.seed(seed)
    rows = [
        (i, [float(np.float32(random.uniform(-size, size))) for _ in range(width)], random.choice([None, 1, 1, 2]))
        for i in range(count)
    ]
    rows += [rows[3], rows[3], (None, rows[0][1], 1), (3, rows[4][1], 2)]
    return rows + [(500, None, 1), (501, rows[0][1][:-1] + [None], 1), (502, [math.nan] * width, 1), (503, [math.inf] * width, None)]


@pytest.mark.parametrize("count, width, size", [(120, 16, 1.0), (60, 8, 60000.0), (5, 64, 0.01)])
def test_codes_equal_loops(spark, count, width, size):
    rows = vector_rows(count, width, size)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{VECTORS}, ints int, code string")
    got = vector_codes.compress(frame.repartition(3)).collect()
    assert sorted((str(r[0]), str(r[1]), *r[2:]) for r in got) == codes_by_loops(rows)


def test_products_of_limbs_are_exact():
    random.seed(7)
    for width, bits, most in ((8, None, 2**28), (1000, None, 2**26), (3, 4, 2**20), (5, 1, 100)):
        left = np.array([[random.randint(-most, most) for _ in range(width)] for _ in range(7)], np.int64)
        right = np.array([[random.randint(-most, most) for _ in range(width)] for _ in range(5)], np.int64)
        want = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in right] for x in left]
        assert vector_codes.exact_products(left, right, bits).tolist() == want
        assert width * 4 ** vector_codes.limb_bits(width) <= 2**53
        parts = vector_codes.limbs(left, bits or vector_codes.limb_bits(width))
        assert all(np.abs(p).max() <= 2 ** (bits or vector_codes.limb_bits(width)) for p in parts)


def test_codes_of_few_odd_and_no_vectors(spark):
    assert vector_codes.compress(spark.createDataFrame([], VECTORS)).count() == 0
    rows = [(i, [float(i), 1.0, 2.0], i) for i in range(4)] + [(9, [1.0], 1), (10, [], 1)]
    got = vector_codes.compress(spark.createDataFrame(rows, VECTORS)).orderBy("vec_id").collect()
    assert [r.vec_id for r in got] == [0, 1, 2, 3] and all(r.error == 0 for r in got)
    assert [r.code[:2] for r in got] == ["00", "01", "02", "03"]
    with pytest.raises(Exception, match="larger than"):
        vector_codes.compress(spark.createDataFrame([(1, [1e20] * 8, 1)], VECTORS)).collect()


def test_codes_lead_back_to_entries(spark):
    rows = vector_rows(40, 16, 1.0)
    vectors = stored(vector_codes.integer_vectors(spark.createDataFrame(rows, VECTORS)), "ints")
    books = vector_codes.fit(vectors)
    for r in vector_codes.decode(vector_codes.encode(vectors, books), books).collect():
        picked = [books.entries[p][int(r.code[2 * p : 2 * p + 2], 16)] for p in range(8)]
        assert r.ints == np.concatenate(picked).tolist()
