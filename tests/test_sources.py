import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources import contracts as c
from tidemark.sources import pages as p
from tidemark.sources import scan
from tidemark.sources.schemas import COURSE, JOB_POSTING
from tidemark.streaming import sink

NOW = dt.datetime(2026, 11, 2, 8)
SCHEMA = {
    "type": "record", "name": "R",
    "fields": [
        {"name": "job_id", "type": "string"}, {"name": "n", "type": ["null", "int"], "default": None}, {"name": "big", "type": "long"},
        {"name": "tags", "type": {"type": "array", "items": "string"}}, {"name": "kind", "type": {"type": "enum", "name": "K", "symbols": ["A", "B"]}},
        {"name": "ok", "type": "boolean"}, {"name": "x", "type": "double"}, {"name": "raw", "type": ["null", "bytes"], "default": None},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
    ],
}
RECORD = {"job_id": "é", "n": -5, "big": 1 << 40, "tags": ["a", ""], "kind": "B", "ok": True, "x": 1.5, "raw": b"\x00", "day": 3}


def test_scans(spark, tmp_path):
    spark.range(2).selectExpr("id", "'x' as a").write.parquet(f"{tmp_path}/one/dt=1")
    spark.range(1).selectExpr("'y' as b", "id + 10 as id").write.parquet(f"{tmp_path}/two/dt=1")
    both = scan.union_scan(spark, f"{tmp_path}/{{one,two}}/*/*.parquet")
    assert sorted((r.id, r.a, r.b) for r in both.collect()) == [(0, "x", None), (1, "x", None), (10, None, "y")]
    assert scan.declared_scan(spark, f"{tmp_path}/none/*/*.parquet", COURSE).count() == 0
    framed = scan.union_frames(spark.range(1).select("id"), spark.range(1).selectExpr("'q' as z"))
    assert sorted(map(str, framed.collect())) == ["Row(id=0, z=None)", "Row(id=None, z='q')"]


def test_sink_lands_by_day_of_writing(spark, tmp_path):
    schema = StructType().add("id", "long")
    spark.range(5).write.parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second run finds nothing new
        sink.start_sink(sink.read_files(spark, f"{tmp_path}/in", schema), f"{tmp_path}/out", f"{tmp_path}/cp", seconds=None).awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == 5 and str(out.first().dt) == str(dt.datetime.now(dt.UTC).date())
    events = sink.read_files(spark, "/root/testdata/sf0.001", spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema)
    assert sink.distinct_within(events, ["event_id"], "ts").isStreaming


def test_avro_round_trip_and_types(spark):
    assert c.decode_record(SCHEMA, c.encode_record(SCHEMA, RECORD)) == RECORD
    assert c.to_struct(SCHEMA).simpleString() == "struct<job_id:string,n:int,big:bigint,tags:array<string>,kind:string,ok:boolean,x:double,raw:binary,day:date>"
    assert "n Nullable(Int32)" in c.to_ddl(SCHEMA, "t") and "day Date" in c.to_ddl(SCHEMA, "t") and c.to_ddl(SCHEMA, "t").endswith("ORDER BY job_id")
    assert c.check_record(SCHEMA, RECORD) == [] and len(c.check_record(SCHEMA, RECORD | {"kind": "Z", "big": None, "n": 1 << 31})) == 3
    flat = {"type": "record", "name": "F", "fields": SCHEMA["fields"][:-1]}
    payload = c.encode_record(flat, RECORD)
    df = spark.createDataFrame([(bytearray(payload),)], "payload binary").select(c.frame(F.col("payload"), 258).alias("value"))
    parts = df.select(c.unframe(F.col("value")).alias("m")).select("m.*")
    assert parts.first().schema_id == 258
    assert c.decode_messages(parts, flat).first().tags == ["a", ""]
    with pytest.raises(Exception, match="magic"):
        spark.createDataFrame([(bytearray(b"\x01abcdef"),)], "v binary").select(c.unframe(F.col("v"))).collect()


def test_contracts():
    c.Contract("a-b", "producer", {"schema": "s", "topic": "t"})
    for name, kind, body in [("A", "producer", {"schema": 1, "topic": 1}), ("a", "x", {}), ("a", "producer", {}), ("a", "streaming", {"topic": 1, "sink": 1, "resources": {"limits": {}}})]:
        with pytest.raises(ValueError):
            c.Contract(name, kind, body)
    assert c.plan_topics(["a:1:1", "b:2:1"], {"a"}) == [("b", 2, 1)]
    with pytest.raises(ValueError):
        c.plan_topics(["b:2"], set())


LD = {
    "@type": "JobPosting", "title": "T", "url": "https://x/1", "datePosted": "2026-10-30", "industry": "IT", "hiringOrganization": {"name": "Org", "sameAs": "https://org", "url": "https://o"},
    "jobLocation": [{"address": {"addressCountry": "VN", "addressRegion": "Hồ Chí Minh", "addressLocality": "Q1"}}],
    "experienceRequirements": {"monthsOfExperience": 30}, "skills": "Python, SQL ,Python",
    "baseSalary": {"currency": "VND", "value": {"minValue": 25_000_000, "maxValue": 50_000_000}},
    "description": "<h2>Mô tả công việc</h2><ul><li>Do it</li></ul><h2>Yêu cầu ứng viên</h2><ul><li>Must</li></ul><p>Ưu tiên:</p><ul><li>May</li></ul><h2>Quyền lợi được hưởng</h2><ul><li>Pay</li></ul>",
}
SCRIPT = "<script type='application/ld+json'>{bad</script><script type='application/ld+json'>%s</script>"


@pytest.fixture
def one(spark):
    def parse(site, *pages):
        df = spark.createDataFrame([(p,) for p in pages], "page string")
        return [r.asDict() for r in p.parse_postings(df, site, NOW).collect()]

    return parse


def test_itviec(one):
    page = f"""<html><head><link rel="canonical" href=" https://itviec/1 ">{SCRIPT % json.dumps(LD)}</head><body><h1>Dev  Ops</h1><h3><a href="/c">Co</a></h3>
    <div class="x text-rich-grey text-truncate">Hanoi</div><span>Hybrid</span><a class="itag">Go</a><a class="itag">Go</a>
    <h2>Job description</h2><p>Intro</p><ul><li>One<li>Two</ul><h2>Your skills and experience</h2><div>- a<br>- b</div>
    <h2>More jobs for you</h2>
    <a class="itag">No</a></body></html>"""
    (r,) = one("itviec", page)
    assert (r["title"], r["company_name"], r["company_url"], r["location"], r["work_arrangement"]) == ("Dev Ops", "Org", "/c", "Hanoi", "HYBRID")
    assert (r["tech_stack"], r["responsibilities"], r["skills"]) == (["Go"], ["One", "Two"], ["a", "b"])
    assert (r["posted_days_ago"], r["min_years_experience"], r["salary_type"], r["job_url"]) == (3, 2, "NEGOTIABLE", "https://itviec/1")
    assert r["description"].startswith("Intro\n") and len(r["job_id"]) == 64 and list(r) == JOB_POSTING.fieldNames()
    assert one("itviec", "<p>no job</p>") == []


def test_topcv(one):
    (r,) = one("topcv", f"<h1>Dev</h1><div class='box-job-information-detail-item'>Làm việc từ xa</div>{SCRIPT % json.dumps(LD)}")
    assert (r["salary_type"], r["salary_min_usd"], r["salary_max_usd"]) == ("RANGE", 1000, 2000)
    assert (r["responsibilities"], r["skills"], r["nice_to_have"], r["benefits"]) == (["Do it"], ["Must"], ["May"], ["Pay"])
    assert (r["location"], r["work_arrangement"], r["tech_stack"], r["company_url"]) == ("Hồ Chí Minh", "REMOTE", ["Python", "SQL"], "https://org")
    cases = [
        ({"minValue": 25e6, "maxValue": 25e6}, ("FIXED", 1000, 1000)), ({"value": 5e7}, ("FIXED", 2000, 2000)),
        ({"minValue": -1}, ("NEGOTIABLE", None, None)), ({"maxValue": "62500"}, ("UP_TO", None, 2)), ({"value": "agreed"}, ("NEGOTIABLE", None, None)),
    ]
    for value, want in cases:
        (r,) = one("topcv", "<h1>D</h1>" + SCRIPT % json.dumps(LD | {"baseSalary": {"currency": "VND", "value": value}}))
        assert (r["salary_type"], r["salary_min_usd"], r["salary_max_usd"]) == want
    page = f"""<div class="address"><span class="city-text">Huế</span></div><p class="company-name">Own name</p>
    <div class="box-company-info-detail__list--item-label">Quy mô:</div><div>50 người</div>{SCRIPT % json.dumps({"@type": "JobPosting", "title": " T ", "jobBenefits": "- a<br>- b"})}"""
    (r,) = one("topcv", page)
    assert (r["title"], r["company_name"], r["location"], r["company_size"], r["benefits"]) == ("T", "Own name", "Huế", "50 người", ["a", "b"])


def test_careerviet(one):
    body = """<h1>Kế toán</h1><section class="job-detail-content"><ul><li><strong>Lương:</strong><p>21 - 35 Triệu VND</p></li></ul>
    <div class="detail-row"><h2>MÔ TẢ CÔNG VIỆC</h2><p>- Fully remote</p><p>x</p></div></section><ul class="welfare-list"><li>A</li><li>A</li></ul>"""
    ld = LD | {"baseSalary": {"value": {"value": "thỏa thuận"}}, "datePosted": "2026-12-30T01:02:03Z"}
    (r,) = one("careerviet", body + SCRIPT % json.dumps([{"@type": "X"}, ld]))
    assert (r["salary_type"], r["salary_min_usd"], r["salary_max_usd"], r["currency"]) == ("RANGE", 840, 1400, "USD")
    assert (r["responsibilities"], r["work_arrangement"], r["benefits"], r["posted_days_ago"], r["location"]) == (["Fully remote", "x"], "REMOTE", ["A"], 0, "Q1")
    (r,) = one("careerviet", body + SCRIPT % json.dumps(LD | {"baseSalary": {"currency": "USD", "value": {"minValue": 900, "maxValue": 900}}}))
    assert (r["salary_type"], r["salary_min_usd"]) == ("RANGE", 900)


def test_indeed(one):
    cards = [
        {"displayTitle": "D", "jobkey": "k", "company": " C ", "companyOverviewLink": "/cmp/x", "snippet": "<b>Hi }</b> { there…", "pubDate": 1793577600000 - 86_400_000 * 2, "remoteLocation": True,
         "extractedSalary": {"min": 120e6, "max": 240e6, "type": "YEARLY"}, "rankedBenefits": [{"label": "A"}, {"label": "A"}, None]},
        {"title": "no key"}, "junk",
        {"title": "E", "jobkey": "j", "extractedSalary": {"min": 10, "max": 10, "type": "HOURLY"}, "salarySnippet": {"currency": "usd"}},
    ]
    blob = json.dumps({"metaData": {"mosaicProviderJobCardsModel": {"results": cards}}})
    a, b = one("indeed", f"<script>{p.CARDS_MARKER}={blob}; more {{}}</script>")
    assert (a["salary_type"], a["salary_min_usd"], a["salary_max_usd"], a["currency"]) == ("RANGE", 10_000_000, 20_000_000, "VND")
    assert (a["company_url"], a["work_arrangement"], a["benefits"], a["description"]) == (p.CARD_SITE + "/cmp/x", "REMOTE", ["A"], f"Hi }} {{ there {p.CLIPPED}")
    assert (b["salary_type"], b["salary_min_usd"], b["country"]) == ("FIXED", 1760, "Vietnam")
    assert one("indeed", "nothing") == [] and one("indeed", p.CARDS_MARKER + "={broken") == []


def test_courses(spark):
    ms = {"modules": [{"uid": "m1", "url": "https://l/m1?WT=1", "title": "M", "type": "module", "levels": ["beginner"], "products": ["power-bi"], "units": ["u"], "number_of_children": 3}],
          "learningPaths": [{"uid": "p1", "url": "https://l/p1", "title": "P", "type": "learningPath", "modules": ["m1", "gone"], "firstModuleUrl": "https://l/m1?x"}]}
    md = "- [x](https://front)\n### Algo\n- [toc](#a)\n- Deep [ML], UC | [Playlist](https://www.yt.com/p?list=1).\n### Math\n- [Again](https://www.yt.com/p?list=1)\n"
    mit = {"results": [{"learn_url": "https://mit/1", "title": "C", "topics": [{"name": "Math"}], "languages": ["fr-fr"], "platform": {"name": "OCW"}, "min_weeks": 4}, {"title": "no url"}]}
    fcc = [{"name": "data-analysis-with-python.json"}, {"name": "README.md"}]
    envelopes = [("mslearn", json.dumps(ms)), ("csvideo", md), ("mitlearn", json.dumps(mit)), ("freecodecamp", json.dumps(fcc)), ("other", "x")]
    df = spark.createDataFrame([(json.dumps({"source": s, "page": x}),) for s, x in envelopes], "page string")
    got = {r.url: r for r in p.parse_courses(df, NOW).collect()}
    assert len(got) == 5
    m, path = got["https://l/m1"], got["https://l/p1"]
    assert (m.level, m.content_kind, m.tags, m.parent_uids, m.child_count) == ("INTRO", "MODULE", ["power bi"], ["p1"], 3)
    assert (path.child_uids, path.first_child_url, path.parent_uids) == (["m1", "gone"], "https://l/m1", [])
    video = got["https://www.yt.com/p?list=1"]
    assert (video.title, video.tags, video.provider) == ("Deep", ["Algo", "Math"], "yt.com")
    assert (got["https://mit/1"].language, got["https://mit/1"].provider, got["https://mit/1"].duration_weeks_min) == ("fr", "OCW", 4)
    assert got["https://www.freecodecamp.org/learn/data-analysis-with-python/"].title == "Data Analysis With Python"


def test_postings_as_rows(spark):
    df = spark.createDataFrame([("<h1>Dev</h1>",), (None,), ("<p>",)], "page string")
    out = p.parse_postings(df, "itviec", NOW)
    rows = out.collect()
    assert len(rows) == 1 and rows[0].title == "Dev" and rows[0].job_id is None
    assert [f.dataType for f in out.schema] == [f.dataType for f in JOB_POSTING]


def test_parents_are_those_of_the_same_page(spark):
    def page(path, module):
        return json.dumps({"source": "mslearn", "page": json.dumps({
            "modules": [{"uid": module, "url": f"https://l/{module}", "title": "M"}],
            "learningPaths": [{"uid": path, "url": f"https://l/{path}", "title": "P", "type": "learningPath", "modules": ["m1", "m2", "m1"]}],
        })})

    df = spark.createDataFrame([(page("p1", "m1"),), (page("p2", "m2"),), (page("p1", "m1"),), (None,)], "page string")
    got = sorted((r.uid, tuple(r.parent_uids)) for r in p.parse_courses(df, NOW).collect())
    assert got == [("m1", ("p1",)), ("m1", ("p1",)), ("m2", ("p2",)), ("p1", ()), ("p1", ()), ("p2", ())]
