import pytest

from tests.test_text import VOCABULARY
from tidemark.operators import merge, reports, rules
from tidemark.sources import contracts

KNOWN = set(VOCABULARY.kinds)


def put(path, said):
    path.write_text(said, encoding="utf-8")
    return str(path)


def test_role_files(tmp_path):
    told = rules.RoleRules.from_yaml(put(tmp_path / "r.yaml", "families:\n  a: [x one, ' Y ']\n  b: {role: [z], qualifier: [w]}\nseniority:\n  lead: [boss]\n  senior:\n"))
    assert told.patterns == [("a", "x one", "role"), ("a", "y", "role"), ("b", "z", "role"), ("b", "w", "qualifier")]
    for bad in ("families: {a: [x], b: [X]}", "families: {a: []}", "other: 1", "- a", "families: {UNKNOWN: [x]}", "families: {a: {boss: [x]}}", "families: {a: [' ']}"):
        with pytest.raises(rules.RuleError):
            rules.RoleRules.from_yaml(put(tmp_path / "bad.yaml", bad))
    with pytest.raises(rules.RuleError, match="no pattern.*belongs to"):  # all faults at once
        rules.RoleRules({"a": ["x"], "b": ["x"], "c": []})


def test_tag_files(tmp_path):
    told = rules.TagMap.from_yaml(put(tmp_path / "t.yaml", "skill: {infra as code: Terraform}\nrole: [Clerk]\nsubject: [Logic]\n"), VOCABULARY)
    assert (told.skill_of, told.kind_of) == ({"infra as code": "Terraform"}, {"clerk": "role", "logic": "subject"})
    for bad in ("skill: {a: Cobol}", "role: [tf]", "role: [a]\nsubject: [A]", "skill: {a: Rust}\nrole: [a]", "kind: 1"):
        with pytest.raises(rules.RuleError):
            rules.TagMap.from_yaml(put(tmp_path / "bad.yaml", bad), VOCABULARY)


def test_override_files(tmp_path):
    assert rules.load_overrides(str(tmp_path / "none.yaml"), KNOWN) == {}
    told = rules.load_overrides(put(tmp_path / "o.yaml", "teaches:\n  - {url: u, skills: [Rust]}\n  - {url: u, skills: [C]}\ndeny:\n  - {url: v, skills: [R]}\n"), KNOWN)
    assert told == {"u": {"teaches": ["C", "Rust"], "deny": []}, "v": {"teaches": [], "deny": ["R"]}}
    for bad in ("teaches: [{skills: [Rust]}]", "deny: [{url: u, skills: [Cobol]}]", "allow: []", "teaches: [u]"):
        with pytest.raises(rules.RuleError):
            rules.load_overrides(put(tmp_path / "bad.yaml", bad), KNOWN)


def test_prerequisite_files(tmp_path):
    head = "curated_by: me\nprerequisites:\n"
    told = rules.Prerequisites.from_yaml(put(tmp_path / "p.yaml", head + "  - {skill: Rust, requires: C, why: w, by: you}\n  - {skill: C++, requires: C, why: w}\n"), KNOWN)
    assert [(e["skill"], e["curator"], e["evidence"]) for e in told.edges] == [("Rust", "you", "curated"), ("C++", "me", "curated")]
    one = "  - {skill: Rust, requires: C, why: w}\n"
    for bad in ("prerequisites: []", head + one + one, head + "  - {skill: Rust, requires: C}\n", head + "  - {skill: Rust, requires: C, why: w, evidence_kind: hunch}\n", head + one + "  - {skill: C, requires: Rust, why: w}\n", head + "  - x\n"):
        with pytest.raises(rules.RuleError):
            rules.Prerequisites.from_yaml(put(tmp_path / "bad.yaml", bad), KNOWN)


def test_layers_by_rounds(spark):
    names = [f"n{i}" for i in range(40)]  # forty diamonds, one below the other: paths double at each
    edges = [(f"n{i + 1}", f"n{i}") for i in range(39)] + [(f"n{i + 2}", f"n{i}") for i in range(38)]
    df = spark.createDataFrame(edges, "skill string, requires string")
    nodes = spark.createDataFrame([(n,) for n in names[:12]], "skill string")
    assert {r.skill: r.layer for r in rules.layers_of(df, nodes).collect()} == {f"n{i}": i for i in range(12)}
    assert rules.layers_of(df, nodes.limit(0)).count() == 0
    with pytest.raises(rules.RuleError):
        rules.layers_of(spark.createDataFrame([("n0", "n1"), ("n1", "n0")], "skill string, requires string"), nodes)


def test_changes_are_dry_by_default(spark):
    before = spark.createDataFrame([(1, 1), (2, 2)], "a int, b int")
    after = spark.createDataFrame([(2, 2), (3, 3)], "a int, b int")
    written = []
    change = merge.Change(before, after, ["a"])
    assert change.apply(written.append) == {"added": 1, "kept": 1, "removed": 1} and not written
    change.apply(written.append, dry_run=False)
    assert sorted(map(tuple, written[0].collect())) == [(2, 2), (3, 3)]
    lookup = spark.createDataFrame([(1, "x")], "id long, name string")
    with pytest.raises(LookupError, match="y"):
        merge.ids_of(spark.createDataFrame([("x",), ("y",)], "skill string"), lookup, "skill", "skill_id")


def test_report_text(spark):
    assert reports.as_text(spark.createDataFrame([("a", 10), ("bcd", None)], "name string, n int")) == "name  n\na     10\nbcd"


def test_contract_rendering():
    c = contracts.Contract("my-jobs", "producer", {"schema": "s", "topic": "t", "settings": {"delay": 3, "off": ""}})
    schema = {"type": "record", "name": "R", "fields": [{"name": "id", "type": "string"}]}
    out = contracts.rendered(c, schema)
    assert out["subject"] == "t-value" and out["environment"] == {"DELAY": "3"} and "my_jobs" in out["ddl"]
    wanted = contracts.register([c], {"s": schema}, {})
    assert list(wanted) == ["t-value"] and contracts.register([c], {"s": dict(reversed(schema.items()))}, wanted) == {}
    images = [{"spec": [{"image": "repo:5000/a/b"}, {"image": "b:1.2"}, {"image": "c:latest"}, {"image": "d@sha256:0"}]}]
    assert contracts.unpinned(images) == ["c:latest", "repo:5000/a/b"]
