"""``html_fields`` against its SQL on pages that the smallest tables lack."""

import duckdb

from tidemark.plans.registry import ORACLE, QUERIES

PAGES = [
    (1, "<h1>and&amp;&amp</h1><li>a<li>"),  # a title cut within a reference
    (2, "<h1>a &amp;lt; b&lt;c&nbsp;d</h1>"),
    (3, "<h1 id=x> one\n\t two\r\n<b>three</b> </h1><h1>other</h1>"),
    (4, "<script>var t = '<li>'</script><LI>x<li class=y>"),
    (5, "<h1>never closed"),
    (6, ""),
    (7, None),
    (8, "<h1>é ü\u000bx</h1><!-- <li> -->"),
]


def test_html_fields_equal_their_sql(spark, tmp_path):
    spark.createDataFrame(PAGES, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(con.execute(f"select page_id, items, title from ({ORACLE['html_fields']})").fetchall())
    got = sorted((r.page_id, r.items, r.title) for r in QUERIES["html_fields"](spark, str(tmp_path)).collect())
    assert got == want
