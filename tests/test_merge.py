import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge as g


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_moves_sightings_forward_only(spark):
    schema = "k string, title string, note string, first long, last long, changed string"
    target = spark.createDataFrame([("a", "A", "keep", 5, 9, "t0"), ("b", "B", "keep", None, 3, "t0")], schema)
    source = spark.createDataFrame([("a", "A2", 7, 7), ("c", "C", 1, 2)], "k string, title string, first long, last long")
    fwd = {"first": "least", "last": "greatest"}
    out = g.upsert(target, source, ["k"], fwd, touch=F.lit("t1"), touched="changed")
    assert rows(out) == [("a", "A2", "keep", 5, 9, "t1"), ("b", "B", "keep", None, 3, "t0"), ("c", "C", None, 1, 2, "t1")]
    assert rows(g.upsert(out, source, ["k"], fwd, touch=F.lit("t1"), touched="changed")) == rows(out)
    seen = spark.createDataFrame([("b", 1, 8), ("zz", 1, 1)], "k string, first long, last long")
    assert rows(g.touch(target, seen, ["k"], "first", "last"))[1] == ("b", "B", "keep", 1, 8, "t0")
    assert g.touch(target, seen, ["k"], "first", "last").count() == 2


def test_lookup_ids_are_stable(spark):
    names = lambda *x: spark.createDataFrame([(v,) for v in x], "name string")
    first = g.upsert_lookup(spark.createDataFrame([], "id long, name string"), names("b", "a", None, "", "a", "x" * 2000, "x" * 2001, "é" * 1001))
    assert {r.name: r.id for r in first.collect()} == {"a": 1, "b": 2, "x" * 2000: 3}
    second = g.upsert_lookup(first, names("aa", "b", "é" * 1000))
    got = {r.name: r.id for r in second.collect()}
    assert got["a"] == 1 and got["b"] == 2 and sorted(got.values()) == [1, 2, 3, 4, 5]


def test_replace_is_scoped_by_key_and_method(spark):
    schema = "job int, skill int, method string"
    target = spark.createDataFrame([(1, 1, "dict"), (1, 2, "model"), (2, 9, "dict")], schema)
    fresh = spark.createDataFrame([(1, 3, "dict"), (1, 3, "dict")], schema)
    out = g.replace_scoped(target, fresh, fresh, ["job"], F.col("method") == "dict")
    assert rows(out) == [(1, 2, "model"), (1, 3, "dict"), (2, 9, "dict")]
    assert rows(g.replace_scoped(target, fresh, fresh, ["job"])) == [(1, 3, "dict"), (2, 9, "dict")]


def test_hierarchy_keeps_index_gaps_and_dangling_children(spark):
    df = spark.createDataFrame([("p", ["a", "", "z", "a"], 9), (None, ["a"], 1), ("q", None, 2)], "uid string, child_uids array<string>, child_count int")
    assert rows(g.hierarchy(df)) == [("p", "a", 0), ("p", "a", 3), ("p", "z", 2)]
    assert sorted(r.uid for r in g.partial_containers(df).collect()) == ["p", "q"]


def test_parents_come_from_crawled_containers_only(spark):
    schema = "uid string, content_kind string, child_uids array<string>, position int"
    df = spark.createDataFrame([("m", "MODULE", ["x"], 0), ("p2", "LEARNING_PATH", ["m", "m", "gone"], 2), ("p1", "LEARNING_PATH", ["m"], 1)], schema)
    assert {r.uid: r.parent_uids for r in g.resolve_parents(df).collect()} == {"m": ["p1", "p2"], "p1": [], "p2": []}


def test_diff_and_differing(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "j int, s int")
    b = spark.createDataFrame([(1, 2), (2, 2)], "j int, s int")
    assert dict(rows(g.diff(a, b, ["j", "s"]))) == {"added": 1, "kept": 1, "removed": 1}
    t = spark.createDataFrame([(1, None), (2, [])], "k int, x array<string>")
    s = spark.createDataFrame([(1, []), (2, [])], "k int, x array<string>")
    assert [r.k for r in g.differing(t, s, "k", ["x"]).collect()] == [1]


def test_model_edges_leave_other_methods_alone(spark):
    edge = "job_id string, skill_id int, method string, confidence double, rationale string"
    target = spark.createDataFrame([("a", 1, "dict", None, None), ("a", 2, "model", 0.5, "old"), ("b", 2, "model", 0.5, "b")], edge)
    new = spark.createDataFrame([("a", 1, 0.9, "x"), ("a", 3, 0.8, "y"), ("a", 3, 0.7, "z")], "job_id string, skill_id int, confidence double, rationale string")
    jobs = spark.createDataFrame([("a",), ("c",)], "job_id string")
    done = spark.createDataFrame([], "job_id string, model string, edges long, matched_at timestamp")
    edges, marks = g.model_edges(target, done, new, jobs, "m1", F.lit(dt.datetime(2026, 1, 1)))
    assert sorted((r.job_id, r.skill_id, r.method) for r in edges.collect()) == [("a", 1, "dict"), ("a", 3, "model"), ("b", 2, "model")]
    assert {r.job_id: r.edges for r in marks.collect()} == {"a": 3, "c": 0}
    g.check_failures(4, 1)
    with pytest.raises(RuntimeError):
        g.check_failures(4, 2)


def test_resolve_and_orphans(spark):
    lookup = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    names = spark.createDataFrame([("a",), ("q",)], "skill string")
    found, lost = g.resolve_names(names, lookup, "skill")
    assert found.count() == 1 and [r.skill for r in lost.collect()] == ["q"]
    assert [r.id for r in g.orphans(lookup, "id", lookup.filter("id = 1")).collect()] == [2]
    pairs = g.junction(spark.createDataFrame([(7, ["a", "a", "q"])], "k int, items array<string>"), "k", "items", lookup)
    assert rows(pairs) == [(7, 1)]
