import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing as m


def water(sizes, weights=(5, 2, 1), cap=3):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left, share = total - sum(cap * sizes[s] for s in full), sum(w[s] for s in names if s not in full)
        level = left / share if share else 0
        over = {s for s in names if s not in full and level * w[s] > cap * sizes[s]}
        if not over:
            return {s: float(cap * sizes[s]) if s in full else level * w[s] for s in names}
        full |= over


def check(spark, df):
    size = {}
    for r in df.collect():
        size.setdefault(r.source, 0)
        size[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = water(size)
    rows = m.mix_sizes(df).collect()
    taken, least = defaultdict(int), defaultdict(lambda: 10**9)
    sources = {r.doc_id: r.source for r in df.collect()}
    for r in rows:
        s = sources[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(want[s], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * len(r.shards)
        taken[s] += r.taken
        if r.size:
            least[s] = min(least[s], r.size)
    return want, taken, rows


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want, taken, rows = check(spark, df)
    assert sum(want.values()) == pytest.approx(sum(r.size for r in rows))
    for s, target in want.items():
        assert target * 0.9 <= taken[s] <= target + 1e-6, s
    shards = defaultdict(int)
    for r in rows:
        for x in r.shards:
            shards[x] += 1
    assert set(shards) == set(range(16)) and max(shards.values()) < 3 * min(shards.values())
    assert sorted(map(str, m.mix_sizes(df.repartition(7)).collect())) == sorted(map(str, rows))


def test_caps_nulls_and_empties(spark):
    rows = [(i, "w " * (i % 7), s) for i, s in enumerate(["tiny"] + ["big"] * 60 + [None] * 20 + ["Éa"] * 20 + ["empty"] * 2)]
    rows += [(900, None, "empty"), (901, "", "empty"), (500, "w w", "dup"), (500, "w w", "dup"), (None, "w", "dup")]
    df = spark.createDataFrame([r + ("clash",) for r in rows if r[2] != "empty" or not (r[1] or "").strip()], "doc_id long, text string, source string, size string")
    check(spark, df.filter("doc_id is not null and doc_id <> 500"))
    full = m.mix_sizes(df).collect()
    assert len(full) == df.count()
    assert len({tuple(r.shards) for r in full if r.doc_id == 500}) == 1
    assert m.mix_sizes(df.limit(0)).count() == 0 and m.mix(df.limit(0)).count() == 0


def test_rows_follow_the_plan(spark, sf001):
    names = ["shards", "__block", "__plan", "__spot", "__at", "shard", "copy", "block", "words", "a.b"]
    df = spark.read.parquet(f"{sf001}/documents.parquet").select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    planned = {r.doc_id: sorted(r.shards) for r in m.mix_sizes(df).collect()}
    got = defaultdict(list)
    out = m.mix(df, shard_column="at")
    for r in out.collect():
        got[r.doc_id].append(r["at"])
        assert all(r[n] == k for k, n in enumerate(names))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in planned.items() if v}
    assert m.mix(df).columns == df.columns


@pytest.mark.parametrize("total,good,drawn", [(1, 1, 1), (5, 0, 3), (5, 5, 3), (10, 4, 5), (40, 13, 29), (3000, 700, 1500), (200_000, 3, 100_000), (100_000, 60_000, 50_000)])
def test_hypergeometric_draws(spark, total, good, drawn):
    low, high = max(0, drawn + good - total), min(good, drawn)
    ln = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    chance = lambda x: math.exp(ln(good, x) + ln(total - good, drawn - x) - ln(total, drawn)) if low <= x <= high else 0.0
    mode = max(low, min(high, (drawn + 1) * (good + 1) // (total + 2)))

    def plain(u):
        if low == high:
            return low
        reached, j = 0.0, 0
        while j <= high - low:
            for x in (mode + j, mode - j) if j else (mode,):
                reached += chance(x)
                if chance(x) and reached >= u:
                    return x
            j += 1
        return mode

    us = [(k + 0.37) / 211 for k in range(211)]
    df = spark.createDataFrame([(u,) for u in us], "u double")
    n = [F.lit(x).cast("long") for x in (total, good, drawn)]
    got = [r.x for r in df.select("u", m.hypergeometric(F.col("u"), *n).alias("x")).orderBy("u").collect()]
    assert got == [plain(u) for u in us]
    if high - low > 5:  # evenly spread numbers give the mean and the spread of the distribution
        mean = drawn * good / total
        spread = math.sqrt(mean * (1 - good / total) * (total - drawn) / (total - 1))
        assert abs(sum(got) / len(got) - mean) < 0.25 * spread + 0.05
        assert math.sqrt(sum((x - mean) ** 2 for x in got) / len(got)) == pytest.approx(spread, rel=0.15)


@pytest.mark.parametrize("shards,group", [(1, 256), (7, 256), (16, 256), (37, 256), (8, 3), (5, 1)])
def test_leaf_quotas(spark, shards, group):
    quotas = {None: 40, "": 7, "+": 1, "big": 3000, **{f"s{i}": 10 + i for i in range(9)}}
    df = spark.createDataFrame(list(quotas.items()), "source string, quota long")
    rows = m.split_quotas(df, shards, group=group).collect()
    of_source, of_shard = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.quota > 0 and 0 <= r.shard < shards
        of_source[r.source] += r.quota
        of_shard[r.shard] += r.quota
    assert len({(r.shard, r.source) for r in rows}) == len(rows)
    assert of_source == quotas
    total = sum(quotas.values())
    assert set(of_shard.values()) <= {total // shards, -(-total // shards)}
    assert sorted(map(str, m.split_quotas(df.repartition(3), shards, group=group).collect())) == sorted(map(str, rows))


def test_leaf_quotas_are_multivariate_hypergeometric(spark):
    """Over many seeds: means, variances and the covariance of two sources in one shard."""
    quotas = {"a": 30, "b": 50, "c": 20}
    df = spark.createDataFrame(list(quotas.items()), "source string, quota long")
    draws = []
    for seed in range(24):
        rows = m.split_quotas(df, 2, seed=seed).collect()
        draws.append({s: sum(r.quota for r in rows if r.shard == 0 and r.source == s) for s in quotas})
    mean = {s: sum(d[s] for d in draws) / len(draws) for s in quotas}
    for s, q in quotas.items():
        variance = 50 * q / 100 * (1 - q / 100) * 50 / 99
        assert abs(mean[s] - q / 2) < 4 * math.sqrt(variance / len(draws))
        assert 0.25 * variance < sum((d[s] - mean[s]) ** 2 for d in draws) / len(draws) < 2.5 * variance
    together = sum((d["a"] - mean["a"]) * (d["b"] - mean["b"]) for d in draws) / len(draws)
    assert together < 0  # what one source gains the others lose


def test_runs_are_disjoint_and_as_long_as_the_quotas(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sized = m.sizes(df).cache()
    blocks, n = m.plan(sized, shards=6)
    rows = blocks.collect()
    copies = spark.createDataFrame([(r.source, len(r.shards)) for r in rows], "source string, copies long")
    quotas = copies.groupBy("source").agg(F.sum("copies").alias("quota")).filter("quota > 0")
    want = {(r.shard, r.source): r.quota for r in m.split_quotas(quotas, 6).collect()}
    got = defaultdict(int)
    for r in rows:
        for x in r.shards:
            got[x, r.source] += 1
    assert got == want and n == m.BLOCKS


def test_a_large_block_leaves_no_large_gap(spark):
    rows = [(i, "w " * (5000 if i == 3 else 10), "a") for i in range(300)] + [(1000 + i, "w " * 10, "b") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want, taken, _ = check(spark, df)
    for s in want:
        assert want[s] - 3 * 10 <= taken[s] <= want[s], s


def test_many_sources(spark):
    rows = [(i, "w " * (1 + i % 17), f"site{i % 900}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want, taken, _ = check(spark, df)
    assert sum(taken.values()) > 0.7 * sum(want.values())


def test_a_very_long_text(spark):
    df = spark.createDataFrame([(1, "w " * 400_000, "a"), (2, "w", "b"), (3, "w w w", "a")], "doc_id long, text string, source string")
    check(spark, df)
