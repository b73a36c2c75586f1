import collections
import hashlib
import re

import duckdb
import pytest

from sessionlab.llm import common, exact_dedup, line_dedup, ngram_join, repeats
from sessionlab.llm.catalog import QUERIES, SQL
from sessionlab.session import scratch_path

FOLDER = "/root/testdata/sf0.001"
NAMES = "documents pages labels embeddings"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    base = duckdb.connect()
    for table in NAMES.split():
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = base.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(cursor.fetchall())


def test_copies_are_labelled(frame):
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (5, "b"), (None, "a"), (6, "A")]
    got = sorted(
        (r.doc_id or -1, r.keep_id, r.group_size, r.kept)
        for r in exact_dedup.label_copies(frame(rows)).collect()
    )
    assert got == [
        (-1, 2, 3, False), (1, 2, 3, False), (2, 2, 3, True), (3, 4, 2, False), (4, 4, 2, True),
        (5, 5, 2, True), (5, 5, 2, True), (6, 6, 1, True),
    ]


def test_repeated_rows_stay_once_with_all_columns(frame):
    docs = frame([(1, "a"), (2, "a"), (5, "b"), (5, "b"), (None, "c"), (7, None)])
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect() if r.text) == [
        ("2", "a"), ("5", "b"), ("None", "c"),
    ]
    assert exact_dedup.drop_copies(docs.limit(0)).count() == 0


def test_index_goes_on_with_later_batches(spark, frame):
    path = scratch_path(spark, "index")
    first = exact_dedup.DigestIndex(spark, path)
    exact_dedup.label_copies(frame([(1, "a"), (2, "b")]), first)
    again = exact_dedup.DigestIndex(spark, path)
    got = exact_dedup.label_copies(frame([(3, "a"), (4, "c")]), again)
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in got.collect()) == [(3, 1, False), (4, 4, True)]
    assert again.rows().count() == 3


def test_lines(frame):
    long, other = "a line of twenty characters", "ANOTHER line of twenty ÉÈ"
    rows = [
        (1, f"{long}\nx"), (2, f" {long.upper()}\t\n{long}"), (3, long), (None, f"{long}\n{other}"),
        (5, None), (6, f"{other}\nshort\n"), (7, other.lower()), (8, other), (9, "short"), (9, "short"),
    ]
    got = sorted(
        (r.doc_id or -1, r.n_lines, r.n_dropped, r.kept_text)
        for r in line_dedup.dedup_lines(frame(rows)).collect()
    )
    assert got == [
        (-1, 2, 2, ""), (1, 2, 1, "x"), (2, 2, 2, ""), (3, 1, 0, long), (5, 1, 0, ""),
        (6, 3, 1, "short\n"), (7, 1, 0, other.lower()), (8, 1, 0, other),
        (9, 1, 0, "short"), (9, 1, 0, "short"),
    ]
    assert line_dedup.dedup_lines(frame([])).count() == 0


def test_many_lines_use_several_bitmap_words(frame):
    shared = [f"a shared line with number {i:05d}" for i in range(200)]
    text = "\n".join(line for pair in zip(shared, map(str, range(200))) for line in pair)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(frame([(i, text) for i in (1, 2, 3)])).collect()}
    assert [got[i].n_dropped for i in (1, 2, 3)] == [200, 200, 0]
    assert got[1].kept_text == "\n".join(map(str, range(200)))


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def classes(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return collections.Counter((doc_id, least[root(i)]) for i, (doc_id, _) in enumerate(rows))


def test_near_copies_form_the_classes_of_brute_force(monkeypatch, frame, near_copies):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    got = ngram_join.link_classes(frame(near_copies)).collect()
    assert collections.Counter((r.doc_id, r.class_id) for r in got) == classes(near_copies)


@pytest.mark.parametrize("block", [8, 256])
def test_every_link_is_counted(monkeypatch, frame, near_copies, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    sets = {(i, t): frozenset(shingles(t)) for i, t in near_copies}
    different = [own for own in set(sets.values()) if own]
    want = {
        row: sum(own != other and len(own & other) >= 0.8 * len(own | other) for other in different)
        for row, own in sets.items()
    }
    got = ngram_join.link_classes(frame(near_copies)).collect()
    assert {(r.doc_id, r.n_links) for r in got} == {(i, n) for (i, _), n in want.items()}
    assert max(want.values()) > 10


def test_one_near_copy_stays(frame):
    text = " ".join(f"word{i}" for i in range(60))
    docs = frame([(1, text), (2, text + " more"), (3, "else"), (None, None), (4, "")])
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "None"]
    assert ngram_join.link_classes(docs.limit(0)).count() == 0


def test_pruning_drops_only_unlikely_pairs():
    limits = ngram_join.least_matches()
    assert list(limits) == [16, 32, 48, 64, 80, 96]
    assert all(0.4 * n < limits[n] < 0.75 * n for n in limits)


def cut_by_brute_force(rows, size):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(d[k : k + size] for _, d in data for k in range(len(d) - size + 1))
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - size + 1):
            if seen[d[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = len(re.findall(b"\1+", gone))
        out.append((i or -1, len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("segment, size", [(1 << 20, 400), (1 << 11, 400), (1 << 20, 240), (1 << 11, 200), (1 << 20, 100)])
def test_repeats_equal_brute_force(monkeypatch, frame, passages, segment, size):
    monkeypatch.setattr(repeats, "SEGMENT", segment)
    got = repeats.remove_repeats(frame(passages), size).collect()
    assert sorted(
        (r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got
    ) == cut_by_brute_force(passages, size)


def test_too_short_strings_are_refused(frame):
    with pytest.raises(ValueError, match="shorter"):
        repeats.seed_bytes(64)
    assert [repeats.seed_bytes(n) for n in (100, 200, 240, 400)] == [16, 32, 32, 64]


def test_stripped_documents_keep_their_columns(frame):
    passage = "".join(chr(97 + i * i % 23) for i in range(500))
    docs = frame([(1, passage + "é1"), (2, "2" + passage), (3, None)])
    got = repeats.strip_repeats(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.lang) for r in got.collect()) == [
        (1, "é1", "en"), (2, "2", "en"), (3, "", "en"),
    ]
    assert repeats.strip_repeats(docs.limit(0)).count() == 0


def test_no_table_stays_in_the_catalog(spark, frame):
    docs = frame([(1, "a" * 500), (2, "a" * 500), (3, None)])
    names = lambda: {t.name for t in spark.catalog.listTables()}
    before = names()  # other tests open indexes of their own
    assert exact_dedup.drop_copies(docs).count() == 2
    assert repeats.strip_repeats(docs).count() == 3
    assert names() == before


def test_few_groups_are_hot_and_the_others_are_bounded(spark):
    totals = [1000, 10**9, 10**11, 10**13]
    frame = spark.createDataFrame([(n,) for n in totals], "total long")
    limits = [r[0] for r in frame.orderBy("total").select(common.hot_size(frame["total"])).collect()]
    assert limits == [1, 10**6, 10**6, 5 * 10**7]
    assert all(total / limit <= common.MOST_HOT for total, limit in zip(totals, limits))
