import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
from test_line_dedup import brute as plain_lines
from test_mixing import water
from test_ngram_join import brute as plain_groups
from test_quality_rules import brute as plain_base
from test_quality_rules import plain_steps

import corpus_pipeline
from tidemark.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from tidemark.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_acts_on_what_came_before(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    labels = spark.read.parquet(f"{sf001}/labels.parquet")
    before, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, before, sf001), f"test-{name}")
        seen[name] = (before, after)
        before = after
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "mixing", "packing"]
    for name, (_, after) in seen.items():
        assert name == "packing" or after.columns == COLUMNS

    old, new = seen["quality_rules"]
    kept = {r.doc_id for r in quality_rules.quality_rules(old, labels).filter("kept").collect()}
    assert {r.doc_id for r in new.collect()} == kept and 0 < len(kept) < old.count()
    old, new = seen["line_dedup"]
    assert new.count() == old.count() and all(r.n_chars == len(r.text) for r in new.collect())
    assert line_dedup.query(spark, sf001).count() == docs.count()
    old, new = seen["ngram_join"]
    heads = {r.doc_id for r in ngram_join.ngram_join(old).collect() if r.doc_id == r.component_id}
    assert {r.doc_id for r in new.collect()} == heads
    old, new = seen["mixing"]
    want = {r.doc_id: len(r.shards) for r in mixing.mix_sizes(old).collect() if r.shards}
    assert Counter(r.doc_id for r in new.collect()) == want
    old, new = seen["packing"]
    firsts = Counter(r.doc_id for r in new.filter("start = 0").collect())
    assert firsts == Counter(r.doc_id for r in old.collect())


def test_empty_documents(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf001), f"test-empty-{name}")
        assert docs.count() == 0


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, th string, __row string, plan int, `a.b` int"


def documents():
    """Clean, junk, copies, near copies, shared lines, nulls, empty and long texts, repeated rows, one id twice."""
    rng = random.Random(12)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 9))) for _ in range(700)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    rows = []
    for i in range(1, 900):
        text = prose(rng.randrange(55, 90))
        if i % 9 == 0:
            text += "\nAll rights  reserved by the house\n"
        if i % 14 == 0:
            text += " ###" * 60
        rows.append([i, text, rng.choice(["en", "de", None]), rng.choice(["web", "web", "books", None])])
    base = prose(90).split()
    for i in range(30):  # near copies, and copies of them
        near = list(base)
        near[3 * i] = "changed"
        rows.append([2000 + i, " ".join(near), "en", "web"])
        rows.append([3000 + i, " ".join(near).upper(), "en", "books"])
    rows += [[4000, None, None, None], [4001, "", "en", "web"], [4002, " \n", "en", "web"], [None, prose(60), "en", None], [None, None, None, None]]
    rows += [rows[0][:], rows[0][:], [1, prose(70), "en", "web"], [4003, prose(30_000), "en", "books"], [4004, "w " * 30_000, "en", "books"]]
    return [(i, t, x, s, len(t or ""), "x", "y", 7, 8) for i, t, x, s in rows]


def test_stages_are_those_of_plain_python(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], int("###" not in (r[1] or ""))) for r in rows if r[0] is not None and r[0] < 900]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, results = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, str(tmp_path)), f"plain-{name}")
        results[name] = [tuple(r) for r in docs.collect()]
        assert name == "packing" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "th", "__row", "plan", "a.b"]
        assert name == "packing" or all(r[5:] == ("x", "y", 7, 8) for r in results[name])

    # quality rules
    def first_step(text):
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = plain_base(text)
        value = {
            "symbols_per_word": n_symbols / max(n_words, 1), "chars_per_word": word_chars / max(n_words, 1),
            "repeated_share": n_repeat_words / max(n_words, 1), "dup_lines_per_word": n_dup_lines / max(n_words, 1),
        }
        return next((k for k, (rule, cut) in enumerate(quality_rules.PATH) if value[rule] > cut), len(quality_rules.PATH))

    base = {t: plain_base(t) for t in {r[1] for r in rows}}
    passes = lambda t: base[t][0] >= 50 and 100 * base[t][4] <= 50 * base[t][0]
    clean = {i for i, q in labels if q}
    taught = [(r[2], first_step(r[1])) for r in rows if r[0] in clean and zlib.crc32(str(r[0]).encode()) % 5 and passes(r[1])]
    steps = plain_steps(taught)
    assert max(steps.values()) > 0
    limit = lambda x: steps.get(("own", x), steps.get("pool", 0))
    want = [r for r in rows if passes(r[1]) and first_step(r[1]) >= limit(r[2])]
    assert Counter(results["quality_rules"]) == Counter(want) and 0 < len(want) < len(rows)
    assert not any("###" in r[1] for r in want)

    # line dedup
    before, after = results["quality_rules"], results["line_dedup"]
    told = plain_lines([(r[0] if r[0] is not None else -1, r[1]) for r in before])
    assert sorted((r[0] if r[0] is not None else -1, r[1]) for r in after) == sorted((i, t) for i, _, _, t in told)
    assert all(r[4] == len(r[1]) for r in after) and any(d for _, _, d, _ in told)

    # one document of each group
    before, after = after, results["ngram_join"]
    groups = plain_groups([(k, r[1]) for k, r in enumerate(before)])
    heads = {}
    for k, r in enumerate(before):
        heads.setdefault(groups[k][1], []).append(r)
    assert len(after) == len(heads)
    left = Counter(after)
    for members in heads.values():
        ids = [r[0] for r in members if r[0] is not None]
        chosen = [r for r in members if r[0] == (min(ids) if ids else None)]
        assert sum(left[r] for r in set(chosen)) == 1, members[0][0]
    assert len(after) < len(before) - 25

    # mixing
    before, after = after, results["mixing"]
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r[3]] += size(r)
    for r in after:
        taken[r[3]] += size(r)
    copies, there = Counter(after), Counter(before)
    assert set(copies) <= set(there) and all(copies[r] <= 3 * n for r, n in there.items())
    for source, target in water(sizes).items():
        assert target - 0.2 * target - 100 <= taken[source] <= target + 1e-6, source

    # packing
    before, pieces = after, results["packing"]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    ids = lambda t: array("I", [*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END]).tobytes()
    cache = {t: ids(t) for t in {r[1] for r in before}}
    total = sum(len(cache[r[1]]) // 4 for r in before)
    assert sum(p[2] for p in pieces) == total
    whole = Counter((r[0], cache[r[1]]) for r in before if len(cache[r[1]]) // 4 < packing.LENGTH)
    single = Counter((p[0], bytes(p[7])) for p in pieces if p[2] == p[4])
    assert not single - whole
    rows_of = defaultdict(list)
    for p in pieces:
        assert len(p[7]) == 4 * p[2] and zlib.crc32(bytes(p[7])) == p[3]
        rows_of[p[5]].append((p[6], p[2]))
    for spans in rows_of.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= packing.LENGTH
    every = Counter()
    for r in before:
        every.update(np.frombuffer(cache[r[1]], "<u4").tolist())
    got = Counter()
    for p in pieces:
        got.update(np.frombuffer(bytes(p[7]), "<u4").tolist())
    assert got == every


def test_scratch_of_a_stage_goes_when_the_next_begins(spark, tmp_path):
    import os

    from tidemark import session

    docs = spark.createDataFrame(documents()[:200], SCHEMA)
    seen = []
    for name, stage in corpus_pipeline.STAGES[1:3]:
        docs = materialize(stage(spark, docs, str(tmp_path)), f"scratch-{name}")
        seen.append(list(session._WRITTEN[(spark.sparkContext.applicationId, "corpus-pipeline")]))
    there = lambda path: os.path.exists(path.removeprefix("file:").replace("///", "/").replace("//", "/"))
    assert seen[0] and not any(map(there, seen[0])) and any(map(there, seen[1]))
