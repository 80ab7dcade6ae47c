import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import classifier as c
from tidemark.llm import language as g
from tidemark.llm import media as m
from tidemark.llm import webp

# --- language -----------------------------------------------------------------


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = g.query(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    hits = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert hits[1] > 100 and hits[0] >= 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.collect())


def test_language_cases(spark):
    rows = [(i, t, x, "clash") for i, (t, x) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("123 ...", "en"), ("", None), ("über", None)] * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = {r.doc_id: r for r in g.identify(df, g.train(df)).collect()}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (2, 3, 4)) and out[0].lang_pred == "en" and out[1].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in out.values())
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in g.identify(df, g.train(unlabelled)).collect()} == {"und"}
    assert g.identify(df.limit(0), g.train(df.limit(0))).count() == 0


def test_letters_alone_count(spark):
    rows = [(0, "½ ²"), (1, "①"), (2, "ⅷ"), (3, "٣ _"), (4, "x²"), (5, "日本"), (6, " ́"), (7, "a" * 2_000_000 + " the")]
    df = spark.createDataFrame([(i, t, "en") for i, t in rows] + [(8, "the", "en")] * 9, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in g.identify(df, g.train(df)).collect()}
    assert [got[i] for i in range(8)] == ["und"] * 4 + ["en", "en", "und", "en"]
    assert g.letters_of("Ab½c ²x") == "ab c x"


def test_predictions_are_those_of_plain_vectors(spark):
    """Trigram vectors one by one, summed by hand, compared by cosine."""
    import random

    rng = random.Random(6)
    speech = {"xx": "abcde", "yy": "defgh", "zz": "ghijk"}
    rows = [(i, " ".join("".join(rng.choices(speech[x], k=4)) for _ in range(6)), x) for i, x in enumerate(rng.choices(list(speech), k=60))]
    rows += [(100, "abc def, ghi!", None), (101, "k", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    e = g.Encoder()

    def vector(text):
        said = f" {' '.join(''.join(c if c.isalpha() else ' ' for c in text.lower()).split())} "
        total = sum(np.roll(e._letter(ord(a)).astype(float), 2) * np.roll(e._letter(ord(b)), 1) * e._letter(ord(x)) for a, b, x in zip(said, said[1:], said[2:]))
        return total / np.linalg.norm(total)

    unit = lambda v: v / np.linalg.norm(v)
    sums = {x: unit(sum(vector(t) for i, t, y in rows if y == x and zlib.crc32(str(i).encode()) % 5)) for x in speech}
    mean = sum(sums.values()) / len(sums)
    prototypes = {x: unit(v - mean) for x, v in sums.items()}
    got = {r.doc_id: r for r in g.identify(df, g.train(df)).collect()}
    for i, text, _ in rows:
        cosines = {x: float(vector(text) @ p) for x, p in prototypes.items()}
        best = max(cosines.values())
        assert cosines[got[i].lang_pred] > best - 2e-5 and abs(got[i].score - (1 + best) / 2) < 2e-5


def test_vectors_bind_and_bundle():
    e = g.Encoder(256, 1)
    a, b, x = (e._letter(ord(k)).astype(int) for k in "ab ")
    spell = lambda p, q, r: np.roll(p, 2) * np.roll(q, 1) * r
    want = spell(x, a, b) + spell(a, b, x)
    assert np.allclose(e.encode(["AB"])[0], want / np.linalg.norm(want), atol=1e-5)
    texts = ["ein text", "another text", "", "zzz"] * 40
    assert np.array_equal(g.Encoder(256, 1).encode(texts), e.encode(texts))


def test_forgotten_vectors_come_back(monkeypatch):
    texts = ["".join(chr(97 + (i * k) % 26) for k in range(30)) for i in range(1, 60)]
    want = g.Encoder(64, 3).encode(texts)
    monkeypatch.setattr(g, "KEPT", 10)
    assert np.allclose(g.Encoder(64, 3).encode(texts), want, atol=1e-6)


# --- media --------------------------------------------------------------------

TEXTS = [None, "", "a", "x" * 191, "x" * 192, "é" * 500, "".join(chr(33 + i % 90) for i in range(5000)), "🙂日本" * 300, "z" * (192 * 16_390)]


def test_media_digests(spark):
    df = spark.createDataFrame([(i, t, b"clash") for i, t in enumerate(TEXTS)] + [(None, "a", b""), (2, "a", b"")], "doc_id long, text string, media binary")
    rows = m.media_digests(df).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        data = (TEXTS[r.doc_id] if r.doc_id is not None else "a") or ""
        data = data.encode()
        padded = data + b" " * (max(192, -(-len(data) // 192) * 192) - len(data))
        assert (r.n_bytes, r.payload_bytes) == (len(data), len(padded))
        assert r.payload_sha256 == hashlib.sha256(padded).hexdigest() and r.tail_crc32 == zlib.crc32(padded[-16:])
        media = m.store(padded)
        assert r.media_bytes == len(media) and r.media_sha256 == hashlib.sha256(media).hexdigest()
    assert len({(r.feature, r.media_sha256) for r in rows if r.n_bytes == 1}) == 1
    assert m.media_digests(df.limit(0)).count() == 0


def test_any_webp_decodes_to_pixels(spark):
    image = np.random.default_rng(1).integers(0, 1 << 32, (7, 9), dtype=np.uint64).astype(np.uint32)
    modes = np.full((2, 3), 11 << 8, np.uint32)
    df = spark.createDataFrame([(1, bytearray(webp.encode(image, modes=modes, green=True, cache_bits=3))), (2, None)], "doc_id long, media binary")
    got = {r.doc_id: r.images for r in m.to_pixels(df).collect()}
    assert got[2] == [] and (np.frombuffer(got[1][0].argb, "<u4").reshape(7, 9) == image).all()
    docs = spark.createDataFrame([(1, "hello")], "doc_id long, text string")
    assert m.to_pixels(m.to_media(docs)).first().images[0].width == 192


# --- classifier ---------------------------------------------------------------


def plain_statistics(text):
    """The statistics from plain strings."""
    import math
    import re
    import unicodedata

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars = max(len(words), 1), max(sum(map(len, words)), 1)
    count = lambda p: len(re.findall(p, text))
    return {
        "log_words": math.log1p(len(words)), "chars_per_word": sum(map(len, words)) / n, "symbols_per_word": count(r"[#*$%&|<>]") / n,
        "marks_per_word": count(r"[!?;:()\[\]{}=_~^\\/]") / n, "upper_share": sum(unicodedata.category(c) == "Lu" for c in text) / chars,
        "digit_share": count("[0-9]") / chars, "distinct_share": len(set(words)) / n, "dup_lines_per_word": (len(lines) - len(set(lines))) / n,
        "lines_per_word": len(lines) / n, "stops_per_word": count(r"\.") / n, "wide_share": (len(text.encode()) - len(text)) / chars,
        "longest_word": float(max(map(len, words), default=0)),
    }


def test_statistics_are_those_of_plain_strings(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(-1, None), (-2, ""), (-3, " \n\t\n"), (-4, "A\nA\n\na É É ü 9.9 [x] # *** \\ 🙂🙂"), (-5, "w " * 100_000), (-6, "x" * 300_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.asDict() for r in c.statistics(df).collect()}
    for i, text in docs:
        want = plain_statistics(text)
        assert set(want) == set(c.STATISTICS)
        assert all(abs(got[i][k] - v) < 1e-9 * max(1, abs(v)) for k, v in want.items()), i


def test_quality_on_held_out_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = c.query(spark, "/root/testdata/sf0.01").join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.quality for r in got)
    assert len(got) > 50 and right >= 0.95 * len(got)
    clean = [r for r in got if r.quality == 1]
    assert sum(r.predicted for r in clean) >= 0.98 * len(clean)


def test_columns_equal_the_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stats = c.statistics(docs).cache()
    rng = np.random.default_rng(2)
    pdf = stats.toPandas()
    x = pdf[c.STATISTICS].to_numpy(float)
    y = (x[:, 2] + rng.normal(0, 0.2, len(x)) < 0.3).astype(int)
    model = c.fit(x, y)
    assert model.rules and all(len(k) <= c.DEPTH for k, _ in model.rules)
    got = dict(stats.select("doc_id", model.column().alias("s")).collect())
    want = dict(zip(pdf["doc_id"], model.score(x), strict=True))
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)
    assert c.fit(x, y).rules == model.rules


def test_penalty_makes_the_ensemble_sparse():
    rng = np.random.default_rng(4)
    r = (rng.random((800, 40)) < 0.5).astype(float)
    y = (1 / (1 + np.exp(-(3 * r[:, 0] - 3 * r[:, 1]))) > rng.random(800)).astype(float)
    _, w = c._lasso(r, y, 0.03)
    assert w[0] > 0.5 and w[1] < -0.5 and (np.abs(w[2:]) > 1e-6).sum() <= 8


def test_classifier_cases(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "w", "x"), (3, "w", "x"), (None, "w", "x"), (4, "a" * 50_000, "x")], "doc_id long, text string, predicted string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in c.classify(df, none).collect()} == {0.5} and c.classify(df, none).count() == 6
    one = spark.createDataFrame([(i, 1) for i in range(1, 5)] + [(3, None), (3, 1)], "doc_id long, quality int")
    assert all(0.5 < r.score < 1 and r.predicted == 1 for r in c.classify(df, one).collect())
    assert c.classify(df.limit(0), one).count() == 0
