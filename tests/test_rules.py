import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.test_text import VOCABULARY
from tidemark.operators import reports
from tidemark.operators import rules as r

ROLES = r.RoleRules(
    {
        "backend": {"role": ["backend", "java developer"], "qualifier": ["java"]},
        "data": {"role": ["data engineer", "data scientist"], "qualifier": ["python", "sql"]},
        "mobile": {"role": ["ios developer"], "qualifier": ["swift"]},
    },
    {"senior": ["senior", "sr."], "lead": ["lead", "trưởng nhóm"], "intern": ["intern"]},
)
TITLES = [
    ("Senior Backend Engineer", "backend", "senior"), ("Python Engineer", "data", None), ("Backend (Python)", "backend", None),
    ("Backend & Data Engineer", "AMBIGUOUS", None), ("Java / SQL", "AMBIGUOUS", None), ("Chef", "UNKNOWN", None),
    ("", "UNKNOWN", None), (None, "UNKNOWN", None), ("Trưởng Nhóm, senior", "UNKNOWN", "lead"), ("Studios developer", "mobile", None),
]


def test_role_plan(spark):
    df = spark.createDataFrame([(str(i), t[0]) for i, t in enumerate(TITLES)], "job_id string, title string")
    got = {x.job_id: x for x in r.role_plan(df, ROLES, "v2", F.lit(dt.datetime(2026, 1, 1))).collect()}
    assert [(got[str(i)].title, got[str(i)].family, got[str(i)].seniority) for i in range(len(TITLES))] == TITLES
    assert got["2"].matched_rules == ["backend|backend|role", "data|python|qualifier"]
    assert reports.ambiguous_combinations(r.role_plan(df, ROLES, "v2", F.lit(1)), 5).collect()[0].n == 2


@pytest.mark.parametrize(
    "families,seniority",
    [({"UNKNOWN": {"role": ["x"]}}, {}), ({"a": {}}, {}), ({"a": {"role": ["x"]}, "b": {"role": ["X "]}}, {}), ({"a": {"boss": ["x"]}}, {}), ({"a": {"role": [" "]}}, {}), ({"a": {"role": ["x"]}}, {"king": ["y"]})],
)
def test_faulty_role_rules(families, seniority):
    with pytest.raises(r.RuleError):
        r.RoleRules(families, seniority)


TAGS = r.TagMap(VOCABULARY, {"container orchestration": "Terraform"}, ["Data Engineer"], ["history"])


def test_tags(spark):
    tags = ["Container  Orchestration", "tf", "data engineer", "History", "what", "", None, "engineer"]
    df = spark.createDataFrame([(t,) for t in tags], "tag string")
    assert [x[0] for x in df.select(TAGS.classify(F.col("tag"))).collect()] == ["skill", "skill", "role", "subject", None, None, None, None]
    rows = spark.createDataFrame([(1, ["what", "tf", "sveltejs", "container orchestration"])], "id int, tags array<string>")
    assert TAGS.skills_of(rows, "id", "tags").collect()[0].skills == ["Terraform", "Svelte"]
    for bad in ({"x": "Cobol"}, None):
        with pytest.raises(r.RuleError):
            r.TagMap(VOCABULARY, bad or {}, ["tf"])
    with pytest.raises(r.RuleError):
        r.TagMap(VOCABULARY, {}, ["a", "A"])


def test_course_skills_and_edges(spark):
    schema = "id string, url string, title string, summary string, tags array<string>, source string, content_kind string"
    df = spark.createDataFrame(
        [
            ("t", "u1", "Learn Rust", "with sveltejs and Rust", ["tf"], "s", "COURSE"),
            ("m", "u2", "Learning", "about cplusplus", [], "s", "COURSE"),
            ("g", "u3", "Nothing", None, ["tf"], "s", "COURSE"),
            ("o", "u4", "Rust and Svelte", None, None, "s", "COURSE"),
        ],
        schema,
    )
    out = r.course_skills(df, VOCABULARY, TAGS, {"u4": {"teaches": ["C++", "F#"], "deny": ["Svelte"]}})
    got = {x.id: (x.teaches, x.mentions) for x in out.collect()}
    assert got["t"] == (["Rust"], ["Terraform", "Svelte"])
    assert got["m"] == ([], ["C++"]) and got["g"] == ([], ["Terraform"])
    assert got["o"] == (["Rust", "C++", "F#"], [])
    edges = r.course_edges(out)
    assert {x.id for x in edges.collect()} == {"t", "o"}
    assert {x.relation: x.n for x in reports.relation_counts(edges).collect()} == {"teaches": 4, "mentions": 2}
    cover = reports.course_coverage(df, out).collect()[0]
    assert (cover.total, cover.kept, cover.dropped, cover.dropped_with_mentions) == (4, 2, 2, 2)


def edge(a, b, **k):
    return {"skill": a, "requires": b, "evidence": "curated", "why": "w", "curator": "c"} | k


def test_prerequisites(spark):
    p = r.Prerequisites([edge("b", "a"), edge("c", "a"), edge("d", "b"), edge("d", "c")], set("abcde"))
    assert p.layers("abcd") == [["a"], ["b", "c"], ["d"]] and p.layers("ad") == [["a", "d"]]
    assert p.required_by("d") == ["b", "c"]
    got = {x.skill: x.layer for x in r.layers_of(p.table(spark), spark.createDataFrame([(x,) for x in "abcd"], "skill string")).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 2}
    bad = [[edge("a", "a")], [edge("a", "b"), edge("b", "a")], [edge("a", "b"), edge("b", "c"), edge("c", "a")], [edge("a", "zz")], [edge("a", "b"), edge("a", "b")], [edge("a", "b", why=" ")], [edge("a", "b", evidence="hunch")], [edge("a", "b", curator=None)]]
    for edges in bad:
        with pytest.raises(r.RuleError):
            r.Prerequisites(edges, set("abcde"))


def test_replies(spark):
    said = [("1", 'Sure:\n```json\n[{"skill":"Go","confidence":0.9,"why":" w "},{"skill":"Go","confidence":0.1,"why":"again"},{"skill":"C","confidence":2,"why":"w"}]\n```'), ("2", ""), ("3", "no list"), ("4", '[{"skill":"Cobol","confidence":0.5,"why":"w"},{"skill":"C","confidence":"0.5","why":""},{"skill":"React","confidence":0.5,"why":"w"}]')]
    replies = spark.createDataFrame(said, "job_id string, reply string").select("job_id", r.reply_items(F.col("reply")).alias("items"))
    assert {x.job_id: None if x["items"] is None else len(x["items"]) for x in replies.collect()} == {"1": 3, "2": 0, "3": None, "4": 3}
    skills = spark.createDataFrame([("Go",), ("C",), ("React",)], "skill string")
    have = spark.createDataFrame([("4", "React")], "job_id string, skill string")
    assert [tuple(x) for x in r.valid_edges(replies, skills, have).collect()] == [("1", "Go", 0.9, "w")]


def test_gateway_failures_are_marked(spark):
    def ask(text):
        if "boom" in text:
            raise OSError("down")
        return f"[{len(text)}]"

    df = spark.createDataFrame([("a", "x" * 20_000), ("b", "boom"), ("c", None)], "job_id string, text string")
    assert sorted(map(tuple, r.ask_model(df, ask).collect())) == [("a", "[12000]", False), ("b", None, True), ("c", "[0]", False)]
