import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as t

VOCABULARY = t.Vocabulary(
    {
        "technical": {
            "Rust": ["rs lang"], "Terraform": ["tf"], "MariaDB": ["maria db", "mariadb"], "Svelte": ["sveltejs"], "R": ["rstats"],
            "Quarkus": [], "Quarkus Native": [], "VB.NET": [], ".NET": [], ".NET Maui": [], "A/B": [], "C++": ["cplusplus"], "F#": ["fsharp"], "C": [],
            "Vue.js": ["vuejs"],
        },
        "professional": {"Làm việc nhóm": ["việc nhóm"]},
    },
    excluded=["engineer"],
)

TAGS = [
    (".NET", ".net"), (".NET Maui", ".net maui"), ("3) Rust", "rust"), ("· Terraform", "terraform"), ("— MariaDB", "mariadb"),
    ("12. Svelte", "svelte"), ("\t.NET\n", ".net"), ("SvelteJS…", "sveltejs"), ("Ｒｕｓｔ", "rust"), ("", ""), (None, ""),
    ("Maria \n DB", "maria db"), ("GROẞE", "grosse"), (".,", ""), ("F#", "f#"), ("> > C++ :", "c++"),
]


def test_normalise(spark):
    df = spark.createDataFrame([(a,) for a, _ in TAGS], "tag string")
    assert [r[0] for r in df.select(t.normalise(F.col("tag"))).collect()] == [b for _, b in TAGS]
    assert [t.normalise_value(a) for a, _ in TAGS] == [b for _, b in TAGS]


SCANS = [
    ("The cluster is described in Terraform and talks to maria db", {"Terraform", "MariaDB"}),
    ("sveltejs at the front, fsharp at the back", {"Svelte", "F#"}),
    ("one module of Quarkus Native", {"Quarkus Native"}),
    ("Quarkus Native here, Quarkus Native there", {"Quarkus Native", "Quarkus"}),
    ("ported from VB.NET", {"VB.NET"}),
    ("vitamin C, plan R and a tf card", set()),
    ("ＲＵＳＴ since last year", {"Rust"}),
    ("we settle it by A/B.", {"A/B"}),
    ("a fishing net, a .network and rusty nails", set()),
    ("ten years of .NET, mostly", {".NET"}),
    (".NET Maui on phones, .NET elsewhere", {".NET Maui", ".NET"}),
    ("Vue.js, never Vue.jsx", {"Vue.js"}),
    ("C++ beside F#; C++17 is another word", {"C++", "F#"}),
    ("KHẢ NĂNG LÀM VIỆC NHÓM", {"Làm việc nhóm"}),
    ("việc nhóm", {"Làm việc nhóm"}),
    ("x.rust and rust.x hide it, rust. does not", {"Rust"}),
    ("", set()),
]


@pytest.mark.parametrize("said,found", SCANS)
def test_scan(said, found):
    assert set(t.Scanner(VOCABULARY).scan(said)) == found


def by_patterns(said):
    """The rule by one pattern a term: longest first, a term takes its first free match."""
    import unicodedata

    said = unicodedata.normalize("NFKC", said).lower()
    taken, found = set(), {}
    for term, name in VOCABULARY.scan_order():
        for a in range(len(said)):
            m = re.compile(t.LEFT + re.escape(term) + t.RIGHT).match(said, a)
            if m and not taken & set(range(*m.span())):
                taken |= set(range(*m.span()))
                found[name] = None
                break
    return list(found)


def test_scan_is_the_rule_by_patterns():
    rng = random.Random(8)
    scanner = t.Scanner(VOCABULARY)
    words = [term for term, _ in VOCABULARY.scan_order()] + ["C", "net", ".", "/", "+", "é", "js", "x1", "native", "engineer"]
    for _ in range(400):
        said = "".join(rng.choice(words).swapcase() + rng.choice([" ", "", ".", ", ", "\n", "#"]) for _ in range(12))
        assert scanner.scan(said) == by_patterns(said), said


def test_extract_column_keeps_order(spark):
    rows = [(["sveltejs", "engineer", "c", "sveltejs"], "cplusplus", ["maria db", None]), (None, None, None), ([], "x", [])]
    df = spark.createDataFrame(rows, "tags array<string>, description string, bullets array<string>")
    got = [r[0] for r in df.select(VOCABULARY.extract_column(F.col("tags"), F.col("description"), F.col("bullets"))).collect()]
    assert got == [["Svelte", "C", "C++", "MariaDB"], [], []]


def test_exact_column_equals_the_driver(spark):
    tags = ["TF", "engineer", "rs lang", "?", None, "c", "4. VueJS"]
    df = spark.createDataFrame([(x,) for x in tags], "tag string")
    assert [r[0] for r in df.select(VOCABULARY.exact_column(F.col("tag"))).collect()] == [VOCABULARY.exact(x) for x in tags]


def test_plain_terms_agree_where_no_term_nests(spark):
    flat = t.Vocabulary({"technical": {"Rust": ["rs3"], "Svelte": ["sveltejs"], "C++": [], "Vue.js": ["vue js"], "F#": ["fsharp"]}})
    said = [s for s, _ in SCANS if s.isascii()] + ["RUST sveltejs C++", "é.rust érust rusté vue JS, rs3", "rust.é F#.", None]
    df = spark.createDataFrame([(x,) for x in said], "said string")
    got = [r[0] for r in df.select(t.plain_terms(F.col("said"), flat)).collect()]
    assert got == [sorted(t.Scanner(flat).scan(x or "")) for x in said]
    assert spark.range(1).select(t.plain_terms(F.lit("x"), t.Vocabulary({}))).first()[0] == []


def test_terms_and_kinds():
    assert VOCABULARY.kind("Rust") == "technical"
    with pytest.raises(KeyError):
        VOCABULARY.kind("Cobol")
    terms = {a: (b, c) for a, b, c in VOCABULARY.terms()}
    assert terms["rs lang"] == ("Rust", True) and terms["c++"] == ("C++", True) and terms["c"] == ("C", False) and terms["tf"] == ("Terraform", False)
    shared = t.Vocabulary({"a": {"One": ["x y z"], "Two": ["X  Y Z", "two"]}})
    assert shared.lookup == {"one": "One", "x y z": "One", "two": "Two"}
