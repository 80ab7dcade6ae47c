import re
from collections import defaultdict

import pytest

from tidemark.llm import ngram_join as nj

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows):
    """doc_id -> (n_shingles, component_id), from plain strings."""
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    at = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            at[g].append(i)
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in sets.items():
        common = defaultdict(int)
        for g in s:
            for j in at[g]:
                if j < i:
                    common[j] += 1
        for j, o in common.items():
            if 100 * o >= 75 * (len(s) + len(sets[j]) - o):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_join(df).collect()}
    assert got == brute(rows)


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_join(docs).collect()}
    assert got == want
    assert sum(a != c for a, (_, c) in want.items()) > 20


def test_chains_and_edges(spark):
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[k * 4 : k * 4 + 60])) for k in range(40)]  # a chain: ends share nothing
    rows += [(100, None), (101, ""), (102, " \n\t"), (103, "one two"), (104, "ONE\ttwo"), (105, "one two three")]
    rows += [(200, "x " * 50_000), (201, "X " * 3)]
    check(spark, rows)


def family(n, length=120, seed=0):
    """Copies of one text with a few words changed: some link, some do not."""
    base = [f"v{seed}x{k}" for k in range(length)]
    rows = []
    for k in range(n):
        w = list(base)
        w[2 * k % length] = f"z{seed}x{k}"
        w[(2 * k + 45) % length] = f"y{seed}x{k}"
        w[(2 * k + 80) % length] = f"q{seed}x{k % 7}"
        rows.append((1000 * seed + k + 1, " ".join(w)))
    return rows


@pytest.mark.parametrize("stored,members,probes", [(16 << 20, 2000, 250), (3000, 7, 7), (3000, 2000, 3), (16 << 20, 5, 1)])
def test_groups_larger_than_a_trie(spark, monkeypatch, stored, members, probes):
    monkeypatch.setattr(nj, "STORED", stored)
    monkeypatch.setattr(nj, "MEMBERS", members)
    monkeypatch.setattr(nj, "PROBES", probes)
    check(spark, family(60) + family(9, 60, 1) + family(3, 40, 2))


@pytest.mark.parametrize("flush,common", [(100, 2), (400, 3), (3000, 4)])
def test_common_shingles_leave_by_document(spark, monkeypatch, flush, common):
    monkeypatch.setattr(nj, "FLUSH", flush)
    monkeypatch.setattr(nj, "COMMON", common)
    check(spark, family(40) + family(9, 60, 1) + [(5000 + k, f"only this line stands here and {k}") for k in range(8)])


def test_a_long_chain_of_candidates_stays_near_linear(spark, monkeypatch):
    """Neighbours share enough for a candidate and not for a link: no work is done across the chain."""
    monkeypatch.setattr(nj, "MEMBERS", 20)
    words = [f"w{k}" for k in range(4000)]
    rows = [(k, " ".join(words[k * 12 : k * 12 + 60])) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in nj.ngram_join(df).collect()} == set(range(300))
    trie = nj.Trie([])  # a subtree of one class, or with a smaller shared key, is not entered
    trie.insert([1, 2, 3, 4], 7, 4, 70)
    assert list(trie.probe([1, 2, 3, 4], 4, 71)) == [7] and list(trie.probe([1, 2, 3, 4], 4, 70)) == []
    assert list(trie.probe([1, 2, 3, 4], 4, 71, first=2)) == [] and list(trie.probe([1, 2, 3, 4], 4, 71, first=1)) == [7]


def test_one_id_with_two_texts(spark):
    a, b = "a b c d e f g h", "q r s t u v w x"
    rows = [(5, a), (5, b), (9, b), (7, a), (3, "other words here for you all"), (None, b), (4, None)]
    got = nj.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == sorted(
        [(5, 4, 5), (5, 4, 5), (9, 4, 5), (7, 4, 5), (3, 2, 3), (0, 4, 0), (4, 0, 4)]
    )


def test_clashing_names_are_carried(spark):
    names = ["__row", "__stay", "__id", "row", "class", "first", "n_shingles", "component_id", "a.b"]
    df = spark.createDataFrame([(5, "a b c d e f"), (9, "a b c d e f")], "doc_id long, text string")
    df = df.selectExpr("*", *[f"{k} as `{n}`" for k, n in enumerate(names)])
    (r,) = nj.keep_one(df).collect()
    assert nj.keep_one(df).columns == df.columns and r.doc_id == 5 and [r[n] for n in names] == list(range(len(names)))


def test_repeated_rows_null_ids_and_empty(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(5, text), (5, text), (9, text), (None, text), (None, None)], "doc_id long, text string")
    got = sorted(nj.ngram_join(df).collect(), key=str)
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in got if r.doc_id) == [(5, 4, 5), (5, 4, 5), (9, 4, 5)]
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert nj.ngram_join(df.limit(0)).count() == 0


def test_keep_one_carries_columns(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(5, text, "n", 1), (9, text, "n", 2), (7, "other", "n", 3)], "doc_id long, text string, n string, rep int")
    assert sorted((r.doc_id, r.rep) for r in nj.keep_one(df).collect()) == [(5, 1), (7, 3)]


def test_keep_one_row_of_each_class(spark):
    text, other = "a b c d e f g h", "q r s t u v w x"
    rows = [(5, text), (5, text), (9, text), (None, text), (9, other), (None, "i j k l m"), (None, "I j k l m"), (3, ""), (3, None), (4, ""), (None, ""), (None, " ")]
    got = [(r.doc_id, r.text) for r in nj.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted((i or 0, " ".join((t or "").lower().split())) for i, t in got) == [(0, ""), (0, "i j k l m"), (3, ""), (4, ""), (5, text), (9, other)]


@pytest.mark.parametrize("a", range(1, 30))
def test_bounds(a):
    for b in range(1, 30):
        for o in range(min(a, b) + 1):
            assert (100 * o >= 75 * (a + b - o)) == (o >= nj.required(a, b))
            if 100 * o >= 75 * (a + b - o):
                assert o > a - nj.prefix_length(a)  # the prefix cannot miss it


def test_a_large_family_of_several_classes_is_one_group(spark, monkeypatch):
    """Its largest class only probes, and no set is sent once a shingle."""
    monkeypatch.setattr(nj, "MEMBERS", 40)
    sent = []
    run = nj._run_tries
    monkeypatch.setattr(nj, "_run_tries", lambda rows: (sent.append(rows.count()), run(rows))[1])
    base = [f"v{k}" for k in range(80)]
    rows = []
    for k in range(120):
        w = list(base)
        for j in range(1 if k % 6 else 4):  # each sixth is too far from the others
            w[(k + 19 * j) % 80] = f"z{(k + j) // 12}"
        rows.append((k, " ".join(w)))
    check(spark, rows)
    assert sent[1] < 120 * 10
