import random
import zlib
from array import array
from collections import defaultdict

from tidemark.llm import packing as p

ODD = ["", " ", "it's DON'T we'll I'd", "x²y³ ½ ①", "naïve Ünïcode ŠĐ ĳ ǅ", "日本語 テスト", "éä", "a b\x85c\x1cd", "İstanbul ΣΑΣ", "<|endoftext|> x<|startoftext|>y", "🙂👍🏽 ok", "...!!! 123 4.5", "ﬁne Å", "​zero﻿", "A" * 3000]


def test_ids_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer

    tokenizer, words = Tokenizer.from_file(p.default_tokenizer()), p.WordTokenizer(p.default_tokenizer())
    rng = random.Random(3)
    alphabet = "abcXYZ'stremvld éüßñÀŽ019²_-.,!#\t\n ̀日σΣ🙂"
    texts = ODD + ["".join(rng.choices(alphabet, k=40)) for _ in range(2000)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in texts:
        assert words.ids(text) == array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes(), text[:80]


def test_forgetting_changes_nothing():
    full, small = p.WordTokenizer(p.default_tokenizer()), p.WordTokenizer(p.default_tokenizer())
    small.seen = p.Memory(1000)
    rng = random.Random(5)
    for _ in range(200):
        text = " ".join(rng.choices(["alpha", "beta", "gamma,", "delta", "Alpha", "zeta", "eta"], k=9))
        assert full.ids(text) == small.ids(text)


def test_assign_covers_every_token_once():
    rng = random.Random(1)
    for n in (0, 1, 5, 400):
        lengths = [rng.choice([0, 1, 3, 100, 2047, 2048, 2049, 9000, rng.randrange(1, 3000)]) for _ in range(n)]
        cover, rows = defaultdict(int), defaultdict(list)
        for item, start, size, sequence, offset in p.assign(lengths):
            assert size > 0 and start == cover[item] or start > cover[item]
            rows[sequence].append((offset, size))
            cover[item] += size
        assert all(cover[i] == x for i, x in enumerate(lengths))
        used = 0
        for spans in rows.values():
            at = 0
            for offset, size in sorted(spans):
                assert offset == at
                at += size
            assert at <= p.LENGTH
            used += p.LENGTH - at
        assert used < p.LENGTH  # under one sequence of padding


def plainly(lengths, room=p.LENGTH):
    """Each remainder, longest first, to the cheapest sequence with room for all of it, else cut at the cheapest."""
    out, rest, n = [], [], 0
    for item, size in enumerate(lengths):
        for k in range(size // room):
            out.append((item, k * room, room, n, 0))
            n += 1
        if size % room:
            rest.append((-(size % room), item, size // room * room))
    used = [0] * (-(-sum(-r[0] for r in rest) // room))
    cost = [0.0] * len(used)
    for size, item, start in sorted(rest):
        size = -size
        while size:
            roomy = [s for s in range(len(used)) if room - used[s] >= size] or [s for s in range(len(used)) if used[s] < room]
            s = min(roomy, key=lambda s: (cost[s], s))
            take = min(size, room - used[s])
            out.append((item, start, take, n + s, used[s]))
            used[s] += take
            cost[s] += take + take * take / p.QUADRATIC
            start, size = start + take, size - take
    return out


def test_assign_is_the_plain_rule():
    rng = random.Random(11)
    for trial in range(60):
        top = rng.choice([5, 60, 700, 2500, 9000])
        lengths = [rng.randrange(0, top) for _ in range(rng.choice([0, 1, 2, 9, 80, 250]))]
        assert p.assign(lengths) == plainly(lengths), trial


def test_costs_are_balanced():
    lengths = [1500] * 20 + [400] * 40
    cost = defaultdict(float)
    for _, _, size, sequence, _ in p.assign(lengths):
        cost[sequence] += size + size * size / p.QUADRATIC
    assert max(cost.values()) < 1.35 * (sum(cost.values()) / len(cost))


def test_pieces_of_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (None, "null id"), (-2, "twice"), (-2, "twice")], "doc_id long, text string"))
    rows = p.pack(docs, p.default_tokenizer()).collect()
    words, by_doc = p.WordTokenizer(p.default_tokenizer()), defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
        by_doc[r.doc_id].append(r)
    for d in docs.filter("doc_id >= 0").collect():
        pieces = sorted(by_doc[d.doc_id], key=lambda r: r.start)
        whole = b"".join(bytes(r.ids) for r in pieces)
        assert whole == words.ids(d.text) + array("I", [1]).tobytes() and pieces[0].doc_tokens == len(whole) // 4
    assert [(r.start, r.length) for r in by_doc[-1]] == [(0, 1)] and len(by_doc[-2]) == 2 and len(by_doc[None]) >= 1
    assert p.pack(docs.limit(0), p.default_tokenizer()).count() == 0


def test_remainders_are_cut_only_where_none_has_room():
    rng = random.Random(7)
    for lengths in ([900] * 30 + [600] * 30 + [200] * 60 + [40] * 100, [rng.randrange(1, 2048) for _ in range(1500)]):
        pieces = p.assign(lengths)
        total = sum(lengths)
        used, cost = [0] * -(-total // p.LENGTH), [0.0] * -(-total // p.LENGTH)
        for item, start, size, s, offset in pieces:  # in the order of placing
            left = lengths[item] - start
            roomy = [(c, k) for k, (u, c) in enumerate(zip(used, cost)) if p.LENGTH - u >= left]
            open_ = roomy or [(c, k) for k, (u, c) in enumerate(zip(used, cost)) if u < p.LENGTH]
            assert s == min(open_)[1] and offset == used[s] and size == min(left, p.LENGTH - used[s])
            used[s] += size
            cost[s] += size + size * size / p.QUADRATIC


def test_clashing_names_nulls_and_long_texts(spark):
    long = "it's 2 words, or three: " * 60_000
    rows = [(1, long), (None, None), (2, ""), (2, ""), (3, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *[f"'x' as {n}" for n in ("ids", "start", "length", "sequence_id", "offset", "doc_tokens")])
    out = p.pack(df, p.default_tokenizer())
    assert out.columns == [c.split()[0] for c in p.SCHEMA.split(", ")]
    got = out.collect()
    words = p.WordTokenizer(p.default_tokenizer())
    pieces = sorted((r.start, bytes(r.ids)) for r in got if r.doc_id == 1)
    assert b"".join(x for _, x in pieces) == words.ids(long) + array("I", [p.END]).tobytes()
    short = sorted((r.doc_id or 0, r.length, r.doc_tokens) for r in got if r.doc_id not in (1, 3))
    assert short == [(0, 1, 1), (2, 1, 1), (2, 1, 1)]
    assert p.pack(df.limit(0), p.default_tokenizer()).count() == 0
