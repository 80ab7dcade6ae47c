import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import medallion as m
from tidemark.operators import quality as q
from tidemark.sources.schemas import JOB_POSTING


def postings(spark, rows):
    """rows: (job_id, title, crawled_at)."""
    blank = {f.name: None for f in JOB_POSTING.fields} | {"tech_stack": ["a"], "skills": [], "source": "s"}
    return spark.createDataFrame([blank | {"job_id": i, "title": t, "crawled_at": c} for i, t, c in rows], JOB_POSTING)


DAY = "2026-10-{:02}T02:00:00Z".format


def test_history_keeps_the_latest_sighting_of_each_content(spark):
    bronze = postings(spark, [("x", "A", DAY(1)), ("x", "A", DAY(2)), ("x", "B", DAY(3)), ("x", "A", DAY(4)), (None, "C", DAY(4)), ("y", "A", "?")])
    h = m.history(bronze)
    assert sorted((r.job_id, r.title, r.crawled_at) for r in h.collect()) == [("x", "A", DAY(4)), ("x", "B", DAY(3)), ("y", "A", "?")]
    assert {r.job_id: r.title for r in m.current(h).collect()} == {"x": "A", "y": "A"}


def test_append_reads_the_lookback_and_is_idempotent(spark):
    first = m.append_history(None, postings(spark, [("x", "A", DAY(10))]))
    later = postings(spark, [("x", "A", DAY(10)), ("late", "L", "2026-10-09T03:00:00Z"), ("old", "O", DAY(8)), ("bad", "Z", "")])
    second = m.append_history(first, later)
    assert sorted(r.job_id for r in second.collect()) == ["late", "x"]
    assert sorted(map(str, m.append_history(second, later).collect())) == sorted(map(str, second.collect()))


def test_an_empty_target_loads_everything(spark):
    empty = m.history(postings(spark, []))
    assert m.watermark(empty, F.col("crawled_ts")) is None
    assert m.append_history(empty, postings(spark, [("x", "A", "")])).count() == 1


def test_watermark_stops_at_the_epoch(spark):
    df = spark.createDataFrame([(dt.datetime(1970, 1, 1, 5),)], "t timestamp")
    assert m.watermark(df, F.col("t")) == dt.datetime(1970, 1, 1)


def test_fingerprint_fields_do_not_shift(spark):
    df = spark.createDataFrame([("a", None, ["x|y"]), (None, "a", ["x", "y"]), ("a", "", None)], "p string, q string, r array<string>")
    a, b, c = [r[0] for r in df.select(m.fingerprint([F.col("p"), F.col("q")], [F.col("r")])).collect()]
    assert len({a, b, c}) == 3


def test_latest_pushes_the_limit_below_the_shuffle(spark):
    plan = m.latest_per_key(spark.range(10).withColumn("k", F.col("id") % 3), ["k"], "id")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_quality_and_graph(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    got = q.violations(df, {"n": lambda d: q.not_null(d, "k"), "u": lambda d: q.unique(d, "k"), "v": lambda d: q.accepted(d, "k", ["a"])})
    assert {r.test: r.failures for r in got.collect()} == {"n": 1, "u": 1, "v": 0}
    graph = q.ModelGraph()
    graph.add("c", ["b"], lambda b: b.filter("v > 1"), {"u": lambda d: q.unique(d, "k")})
    graph.add("b", ["src"], lambda s: s)
    assert graph.order() == ["b", "c"] and graph.run({"src": df})["c"].count() == 2
    graph.add("d", ["c"], lambda c: c, {"n": lambda d: q.not_null(d, "k")})
    with pytest.raises(AssertionError):
        graph.run({"src": df})
    graph.add("b", ["d"], lambda d: d)
    with pytest.raises(ValueError):
        graph.order()


def test_pending_and_tables(spark):
    items = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "k int, at string")
    assert [r.k for r in m.pending(items, items.filter("k = 3"), "k", "at", 5).collect()] == [2, 1]
    with pytest.raises(LookupError):
        m.require_tables(spark, "no_such_table")
