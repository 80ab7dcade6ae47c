import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import scalars as s

NOW = dt.datetime(2026, 11, 2, 12)


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_salary_texts(spark):
    cases = [
        ("Thu nhập 12 tới 17 triệu", 12_000_000, 17_000_000, "VND"), ("$900 up to $1,250", 900, 1250, "USD"), ("Trên 35 Triệu", 35_000_000, None, "VND"),
        ("Dưới 8 tr", None, 8_000_000, "VND"), ("2.5 triệu", 25_000_000, 25_000_000, "VND"), ("thỏa thuận", None, None, None), ("", None, None, None), (None, None, None, None),
    ]
    got = values(spark, s.salary_of_text(F.col("x")), [(c[0],) for c in cases], "x string")
    assert [tuple(g) for g in got] == [c[1:] for c in cases]


def test_usd_rounds_halves_to_even(spark):
    rows = [("62500", "VND"), ("87500", "VND"), ("100", "USD"), ("0", "USD"), ("-5", "USD"), ("x", "USD"), (None, "VND"), ("50000", None)]
    assert values(spark, s.to_usd(F.col("a"), F.col("c")), rows, "a string, c string") == [2, 4, 100, None, None, None, None, 2]


def test_classes(spark):
    rows = [(1, 1), (1, 2), (1, None), (None, 2), (None, None)]
    kinds = lambda **k: values(spark, s.classify_salary(F.col("a"), F.col("b"), **k).kind, rows, "a int, b int")
    assert kinds() == ["FIXED", "RANGE", "FROM", "UP_TO", "NEGOTIABLE"]
    assert kinds(equal_is_fixed=False)[0] == "RANGE"
    assert kinds(single=F.lit(7))[4] == "FIXED"


def test_periods(spark):
    rows = [(10e6, 20e6, "MONTHLY", "VND"), (10e6, 20e6, "YEARLY", "VND"), (100.0, 100.0, "HOURLY", "USD"), (5e6, None, "monthly", "VND"), (5e6, 6e6, "NEVER", "VND"), (None, 3e6, "MONTHLY", "VND")]
    pay = s.salary_by_period(F.col("a"), F.col("b"), F.col("p"), F.col("c"))
    got = [tuple(r) for r in values(spark, pay.struct(), rows, "a double, b double, p string, c string")]
    assert got == [("RANGE", 10_000_000, 20_000_000), ("NEGOTIABLE", None, None), ("FIXED", 17600, 17600), ("FROM", 5_000_000, None), ("NEGOTIABLE", None, None), ("UP_TO", None, 3_000_000)]


def test_days(spark):
    rows = [("2026-11-01",), ("2026-11-05",), ("2026-11-01T09:09:18.141Z",), ("nonsense",), ("2026",), (None,)]
    day = F.lit(NOW.date())
    assert values(spark, s.days_since(F.col("d"), day), rows, "d string") == [1, -3, None, None, None, None]
    assert values(spark, s.days_since(F.col("d"), day, clamp=True, prefix=True), rows, "d string") == [1, 0, 1, None, None, None]


def test_bounded_int(spark):
    rows = [("5",), ("5.9",), ("0",), ("-1",), ("2147483647",), ("2147483648",), ("x",), (None,)]
    assert values(spark, s.bounded_int(F.col("v")), rows, "v string") == [5, 5, None, None, 2147483647, None, None, None]


def test_urls_and_lists(spark):
    rows = [("https://WWW.Site.com:80/a?b=1#c",)]
    assert values(spark, s.host(F.col("u")), rows, "u string") == ["site.com:80"]
    assert values(spark, s.canonical_url(F.col("u")), rows, "u string") == ["https://WWW.Site.com:80/a"]
    assert values(spark, s.csv_items(F.col("u")), [(" a,b , ,a",), (None,)], "u string") == [["a", "b"], []]
    assert values(spark, s.bullet_lines(F.col("u")), [("- a\n\n • b *",)], "u string") == [["a", "b"]]
    assert values(spark, s.first_filled(F.col("a"), F.col("b")), [(" ", " x "), (None, None)], "a string, b string") == ["x", None]
    assert values(spark, s.unclip(F.col("u"), "[cut]"), [("<b>Hi</b>  there…",), ("whole",), ("",)], "u string") == ["Hi there [cut]", "whole", None]
    assert values(spark, s.arrangement_by_phrases(F.col("u")), [("Fully  REMOTE",), ("remote setup",), ("Hybrid, WFH",), ("LÀM VIỆC TỪ XA",)], "u string") == ["REMOTE", "AT_OFFICE", "HYBRID", "REMOTE"]


def test_epoch_and_years(spark):
    now = F.lit(NOW).cast("timestamp")
    ms = int(dt.datetime(2026, 11, 1, 13, tzinfo=dt.UTC).timestamp() * 1000)
    assert values(spark, s.days_since_epoch_ms(F.col("m"), now), [(ms,), (ms + 10 * 86_400_000,), (None,)], "m long") == [0, None, None]
    assert values(spark, s.years_of(F.col("m")), [(35,), (None,)], "m int") == [2, None]
    assert values(spark, s.mapped(F.col("v"), s.LEVELS), [("beginner",), ("?",), (None,)], "v string") == ["INTRO", "UNKNOWN", "UNKNOWN"]
