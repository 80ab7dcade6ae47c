import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules as q

DOCS = "doc_id long, text string, lang string, stratum string, n int"


def brute(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


TEXTS = [
    None, "", " \n\t", "one", "a b c", "a b c a b c", "a a a a a", "x y z w x y z", "l\nl\n l\n\n\nl", "# * <b> é 🙂 é 🙂",
    "p q r " * 30_000, "w " * 70_000, " ".join(f"w{i % 997}" for i in range(5000)),
]


def test_base_columns(spark):
    df = spark.createDataFrame([(i, t, "en", "clash", 1) for i, t in enumerate(TEXTS)], DOCS)
    for r in q.base_stats(df).collect():
        want = brute(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def binomial(n, k, p):
    log = lambda j: math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p)
    return 1.0 if k >= n * p else math.fsum(math.exp(log(j)) for j in range(k + 1))


@pytest.mark.parametrize(
    "n,k,p",
    [(1000, 0, 0.005), (1000, 1, 0.005), (20_000, 60, 0.005), (300_000, 1000, 0.005), (5, 5, 0.005), (50, 0, 0.3), (1, 0, 0.02), (10_000_000, 199_000, 0.02)],
)
def test_binomial_tail(spark, n, k, p):
    got = spark.range(1).select(q._tail(F.lit(n).cast("long"), F.lit(k).cast("long"), p)).first()[0]
    assert got == pytest.approx(binomial(n, k, p), rel=1e-6, abs=1e-12)


def test_equal_hashes_are_not_equal_windows(spark, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(q.F, "xxhash64", lambda *c: real(*c) % 3)  # most windows share a hash
    df = spark.createDataFrame([(i, t, "en", "", 1) for i, t in enumerate(TEXTS[:10])], DOCS)
    got = {r.doc_id: r.n_repeat_words for r in q.base_stats(df).collect()}
    assert got == {i: brute(t)[4] for i, t in enumerate(TEXTS[:10])}


def clean(i):
    return " ".join(f"w{(i * 7 + k * 13) % 5003}" for k in range(60))


def test_cutoffs_are_admitted_only_with_enough_labels(spark):
    rows = [(i, clean(i), "a", "", 0) for i in range(3000)]
    rows += [(10_000 + i, clean(i), None, "", 0) for i in range(20)]
    rows += [(20_000 + i, clean(i) + " ###" * 60, "a" if i % 2 else None, "", 0) for i in range(40)]
    df = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(r[0], int(r[0] < 20_000)) for r in rows] * 2, "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in q.quality_rules(df, labels).collect()}
    assert all(got[i] for i in range(3000)) and all(got[10_000 + i] for i in range(20))
    assert not any(got[20_000 + i] for i in range(1, 40, 2))  # the large stratum has cutoffs
    assert all(got[20_000 + i] for i in range(0, 40, 2))  # the pool has too few labels
    kept = q.quality_filter(df, labels)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, k in got.items() if k)


def plain_steps(rows, risk=q.RISK, level=q.LEVEL, pool=q.POOL):
    """rows of (stratum, first step): the steps that each stratum admits, by the rule as it is stated."""
    of = Counter(s for s, _ in rows)
    groups = {}
    for stratum, first in rows:
        groups.setdefault(("own", stratum) if of[stratum] >= pool else "pool", []).append(first)
    out = {}
    for name, firsts in groups.items():
        steps = 0
        while steps < len(q.PATH) and binomial(len(firsts), sum(f <= steps for f in firsts), risk) <= level / len(groups):
            steps += 1
        out[name] = steps
    return out


def test_thresholds_are_the_plain_rule(spark):
    import random
    import zlib

    rng = random.Random(4)
    for trial in range(4):
        rows = []
        for stratum, n in (("a", 3000), ("b", 700), (None, 650), ("c", 60), ("d", 100)):
            lose = rng.choice([0.0, 0.005, 0.015, 0.03])
            rows += [(stratum, rng.randrange(len(q.PATH)) if rng.random() < lose else len(q.PATH)) for _ in range(n)]
        stats = spark.createDataFrame([(i, s, f, False) for i, (s, f) in enumerate(rows)], "doc_id long, stratum string, first_step int, base_failed boolean")
        labels = spark.createDataFrame([(i, 1) for i in range(len(rows))], "doc_id long, quality int")
        taught = [r for i, r in enumerate(rows) if zlib.crc32(str(i).encode()) % 5]
        got = {"pool" if r.pooled else ("own", r.stratum): r.steps for r in q.thresholds(stats, labels).collect()}
        assert got == plain_steps(taught), trial


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_the_rules_bite_and_the_held_out_fold_loses_little(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = q.quality_rules(docs, labels).join(docs.select("doc_id", "lang"), "doc_id").join(labels.select("doc_id", "quality").distinct(), "doc_id")
    rows = judged.filter("not base_failed").withColumn("held", q.held_out()).collect()
    assert any(not r.kept for r in rows)
    clean_held = [r for r in rows if r.held and r.quality == 1]
    lost = Counter(r.lang for r in clean_held if not r.kept)
    for lang, n in Counter(r.lang for r in clean_held).items():
        # what a true loss of RISK would exceed once in a thousand times
        most = next(k for k in range(n + 1) if k >= n * q.RISK and 1 - math.fsum(math.comb(n, j) * q.RISK**j * (1 - q.RISK) ** (n - j) for j in range(k + 1)) < 1e-3)
        assert lost[lang] <= most, lang
    assert sum(lost.values()) <= q.RISK * len(clean_held)
    junk = [r for r in rows if r.quality == 0]
    assert sum(not r.kept for r in junk) > 0.5 * len(junk)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, clean(1), "a", "", 0), (1, clean(1), "a", "", 0), (None, None, None, "", 0)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert sorted((r.doc_id or 0, r.kept) for r in q.quality_rules(df, none).collect()) == [(0, False), (1, True), (1, True)]
    assert q.quality_rules(df.limit(0), none).count() == 0 and q.quality_filter(df.limit(0), none).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "x", "a", "", 0)], DOCS)
    plan = q.base_stats(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
