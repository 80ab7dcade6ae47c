import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import line_dedup as d

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=10, keep_first=False):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    docs, first = defaultdict(set), {}
    for n, (i, text) in enumerate(rows):
        for pos, line in enumerate((text or "").split("\n")):
            docs[key(line)].add(n)
            first[key(line)] = min(first.get(key(line), (i, pos)), (i, pos))
    hot = {k for k, v in docs.items() if k and len(v) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for pos, x in enumerate(lines) if key(x) not in hot or (keep_first and first[key(x)] == (i, pos))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


ROWS = [(i, f"Shared  line\n own {i}\n\tSHARED  LINE \n\n" + ("É\n" if i < 10 else "é\n") + ("x\n" * 150 if i == 3 else "")) for i in range(14)]
ROWS += [(100, None), (101, ""), (102, "\n\n"), (103, "shared  line"), (104, "  shared  line")]


def got(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "a", 7) for i, t in rows], "doc_id long, text string, h string, pos int")
    out, own = d._apply(df, d.drop_bitmaps(df, **options))
    return sorted((r.doc_id, r[own].lines, r[own].dropped, r[own].kept) for r in out.collect())


def test_against_brute_force(spark):
    assert got(spark, ROWS) == brute(ROWS)
    assert got(spark, ROWS, keep_first=True) == brute(ROWS, keep_first=True)
    assert got(spark, ROWS, min_docs=2) == brute(ROWS, min_docs=2)


def test_salted_runs(spark, monkeypatch):
    monkeypatch.setattr(d, "RUN", 3)
    assert got(spark, ROWS) == brute(ROWS)
    assert got(spark, ROWS, keep_first=True) == brute(ROWS, keep_first=True)


def test_hot_lines_beside_a_shuffle_join(spark, monkeypatch):
    monkeypatch.setattr(d, "RUN", 3)
    monkeypatch.setattr(d, "SMALL", 1)
    rows = ROWS + [(200 + i, f"b{i % 2}\nc\nc") for i in range(24)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows, keep_first=True) == brute(rows, keep_first=True)


def test_a_very_long_text(spark):
    rows = [(i, f"head {i}\n" + "shared\n" * 60_000 + "tail" if i == 3 else f"shared\nrow {i}") for i in range(12)]
    assert got(spark, rows) == brute(rows)


def test_stage_keeps_columns(spark):
    names = ["n_first", "__drop", "__id", "__th", "__lines", "__key", "__on", "drop", "th", "h", "pos", "a.b"]
    df = spark.createDataFrame([(i, t, "a", len(t or "")) for i, t in ROWS], "doc_id long, text string, __x string, n_chars long")
    df = df.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    out = d.line_dedup(df)
    assert out.columns == df.columns
    by = {r.doc_id: r for r in out.collect()}
    assert by[100].text is None and by[0].n_chars == len(by[0].text) and "hared" not in by[0].text
    assert all(r[n] == k for r in by.values() for k, n in enumerate(names))


def test_repeated_rows_null_ids_empty(spark):
    rows = [(5, "r\nq")] * 10 + [(None, "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = d.line_dedup(df).collect()
    assert sorted(str(r.text) for r in out) == [""] * 11
    assert d.line_dedup(df.limit(0)).count() == 0


def test_query_columns(spark, sf001):
    r = d.query(spark, sf001).filter(F.col("n_lines") == 1).first()
    text = spark.read.parquet(f"{sf001}/documents.parquet").filter(F.col("doc_id") == r.doc_id).first().text or ""
    assert r.kept_sha256 == hashlib.sha256(b"" if r.n_dropped else text.encode()).hexdigest()


@pytest.mark.parametrize("bits", [64, 1 << 10, 1 << 26])
def test_the_sieve_only_saves_work(spark, monkeypatch, bits):
    from tidemark.llm import common

    monkeypatch.setattr(common, "SIEVE", bits)
    assert got(spark, ROWS) == brute(ROWS)
    rows = spark.range(1000).withColumn("__at", F.lit(1)).withColumn("__sieve", F.lit(2))
    keys = spark.range(0, 1000, 7).select(F.xxhash64("id").alias("h"))
    may, no = common.sieve(rows, F.xxhash64("id"), keys)
    assert may.columns == rows.columns and {r.id for r in may.collect()} >= set(range(0, 1000, 7))
    assert may.count() + no.count() == 1000 and (bits == 64 or no.count() > 100)
    empty, every = common.sieve(rows, F.xxhash64("id"), keys.limit(0))
    assert empty.count() == 0 and every.count() == 1000
