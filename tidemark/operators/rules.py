"""Rule tables: role families, tags, overrides and prerequisites.

Tables are loaded from YAML (or built in code), checked on the driver, where a
faulty table is an error, and applied as literal expressions: a few hundred
patterns are one array filter, without a join or a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import Vocabulary, normalise, normalise_value
from tidemark.session import discard, materialize

UNKNOWN, AMBIGUOUS = "UNKNOWN", "AMBIGUOUS"
TIERS = ["role", "qualifier"]

# Seniority levels, highest first, and kinds of evidence.
SENIORITY = ["manager", "lead", "senior", "middle", "junior", "intern"]
EVIDENCE = ["curated", "provider_order"]


class RuleError(ValueError):
    """A rule table contradicts itself or names what does not exist."""


def load_sections(path: str, sections: set[str]) -> dict:
    """The mapping in a YAML file, which may have these sections and no others."""
    import yaml

    with open(path, encoding="utf-8") as f:
        doc = yaml.safe_load(f) or {}
    if not isinstance(doc, dict):
        raise RuleError(f"{path} holds no mapping")
    require([f"{path}: unknown section {x!r}" for x in sorted(map(str, set(doc) - sections))])
    return doc


def require(faults: list[str]) -> None:
    """All faults of a table at once."""
    if faults:
        raise RuleError("; ".join(faults))


def shared(pairs: list[tuple[str, str]]) -> list[str]:
    """A fault for each key that stands with two owners, or twice with one."""
    owners: dict[str, list[str]] = {}
    for key, owner in pairs:
        owners.setdefault(key, []).append(owner)
    return [f"{key!r} belongs to {' and '.join(found)}" for key, found in owners.items() if len(found) > 1]


@dataclass
class RoleRules:
    """families: family -> tier -> patterns, or a list of role patterns;
    seniority: level -> patterns."""

    families: dict[str, dict[str, list[str]] | list[str]]
    seniority: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        tiered = {f: {TIERS[0]: x} if isinstance(x, list) else (x or {}) for f, x in self.families.items()}
        rows = [(family, normalise_value(p), tier) for family, tiers in tiered.items() for tier, found in tiers.items() for p in found or []]
        self.patterns = list(dict.fromkeys(rows))
        with_any = {family for family, key, _ in rows if key}
        require(
            [f"{family} is a result, not a family" for family in tiered if family in (UNKNOWN, AMBIGUOUS)]
            + [f"{family} has no pattern" for family in tiered if family not in with_any]
            + [f"{family}: unknown tier {tier}" for family, tiers in tiered.items() for tier in tiers if tier not in TIERS]
            + [f"{family}: an empty pattern" for family, key, _ in rows if not key]
            + shared(list(dict.fromkeys((key, family) for family, key, _ in rows)))
            + [f"unknown seniority {level}" for level in self.seniority if level not in SENIORITY]
        )

    @classmethod
    def from_yaml(cls, path: str) -> RoleRules:
        doc = load_sections(path, {"families", "seniority"})
        return cls(doc.get("families") or {}, {k: v or [] for k, v in (doc.get("seniority") or {}).items()})

    def classify(self, key: Column) -> Column:
        """struct(family, seniority, matched) of a normalised title: substring
        patterns; the role tier decides, qualifiers only where it has no hit."""
        kind = "array<struct<family:string,pattern:string,tier:string>>"
        rows = [F.struct(F.lit(f).alias("family"), F.lit(p).alias("pattern"), F.lit(t).alias("tier")) for f, p, t in self.patterns]
        table = F.array(*rows) if rows else F.array().cast(kind)
        matched = F.array_sort(F.filter(table, lambda r: F.contains(key, r["pattern"])))

        def decide(hits: Column) -> Column:
            tier = lambda name: F.array_distinct(F.transform(F.filter(hits, lambda r: r["tier"] == name), lambda r: r["family"]))
            found = F.when(F.size(tier("role")) > 0, tier("role")).otherwise(tier("qualifier"))
            family = F.when(F.size(found) == 1, F.get(found, 0)).when(F.size(found) > 1, AMBIGUOUS).otherwise(UNKNOWN)
            level = F.lit(None).cast("string")
            for name in reversed(SENIORITY):
                for p in self.seniority.get(name, []):
                    level = F.when(F.contains(key, F.lit(normalise_value(p))), name).otherwise(level)
            return F.struct(family.alias("family"), level.alias("seniority"), hits.alias("matched"))

        return F.get(F.transform(F.array(matched), decide), 0)


def encode_matches(matched: Column) -> Column:
    """``family|pattern|tier`` strings of matched rules, sorted."""
    return F.array_sort(F.transform(matched, lambda r: F.concat_ws("|", r["family"], r["pattern"], r["tier"])))


def usable(family: Column) -> Column:
    return ~family.isin(UNKNOWN, AMBIGUOUS)


def role_plan(jobs: DataFrame, rules: RoleRules, version: str, clock: Column) -> DataFrame:
    """A row for every job, with its title as it stands."""
    keyed = jobs.select("job_id", "title", normalise(F.col("title")).alias("key"))
    return keyed.select("job_id", "title", rules.classify(F.col("key")).alias("r")).select(
        "job_id",
        "r.family",
        "r.seniority",
        F.lit(version).alias("method"),
        encode_matches(F.col("r.matched")).alias("matched_rules"),
        "title",
        clock.alias("classified_at"),
    )


@dataclass
class TagMap:
    """Tags that are skills (tag -> canonical name), roles or subjects."""

    vocabulary: Vocabulary
    skills: dict[str, str] = field(default_factory=dict)
    roles: list[str] = field(default_factory=list)
    subjects: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.skill_of = {normalise_value(tag): name for tag, name in self.skills.items()}
        labels = [(normalise_value(tag), kind) for kind, tags in (("role", self.roles), ("subject", self.subjects)) for tag in tags]
        self.kind_of = dict(labels)
        require(
            [f"tag {tag!r}: {name!r} is not in the vocabulary" for tag, name in self.skills.items() if name not in self.vocabulary.kinds]
            + shared([(tag, "skill") for tag in self.skill_of] + labels)
            + [f"tag {tag!r} is a skill by the vocabulary" for tag, _ in labels if self.vocabulary.exact(tag)]
        )

    @classmethod
    def from_yaml(cls, path: str, vocabulary: Vocabulary) -> TagMap:
        doc = load_sections(path, {"skill", "role", "subject"})
        return cls(vocabulary, doc.get("skill") or {}, doc.get("role") or [], doc.get("subject") or [])

    def _tables(self) -> tuple[dict[str, str], dict[str, str]]:
        return self.vocabulary.tags | self.skill_of, self.kind_of

    def classify(self, tag: Column) -> Column:
        """skill, role, subject or null."""
        skills, kinds = self._tables()
        table = {k: "skill" for k in skills} | {k: v for k, v in kinds.items() if k not in skills}
        return _literal(table, normalise(tag))

    def skill(self, tag: Column) -> Column:
        return _literal(self._tables()[0], normalise(tag))

    def skills_of(self, rows: DataFrame, key: str, tags: str) -> DataFrame:
        """(key, skills): each row's skills in tag order, distinct; one explode,
        as the normalising UDF takes a column of tags."""
        named = rows.select(key, F.posexplode(tags).alias("at", "tag")).withColumn("skill", self.skill(F.col("tag")))
        ordered = F.array_sort(F.collect_list(F.struct("at", "skill")))
        return named.filter("skill is not null").groupBy(key).agg(
            F.array_distinct(F.transform(ordered, lambda s: s["skill"])).alias("skills")
        )


def _literal(table: dict[str, str], key: Column) -> Column:
    if not table:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def load_overrides(path: str, known: set[str]) -> dict[str, dict[str, list[str]]]:
    """url -> teaches and deny, from lists of urls with skills; no file, no rule."""
    from pathlib import Path

    doc = load_sections(path, {"teaches", "deny"}) if Path(path).exists() else {}
    entries = [(part, x if isinstance(x, dict) else {}) for part in ("teaches", "deny") for x in doc.get(part) or []]
    require(
        [f"{part}: an entry without a url" for part, x in entries if not x.get("url")]
        + [f"{part}: {name!r} is not in the vocabulary" for part, x in entries for name in x.get("skills") or [] if name not in known]
    )
    out: dict[str, dict[str, list[str]]] = {}
    for part, x in entries:
        rule = out.setdefault(x["url"], {"teaches": [], "deny": []})
        rule[part] = sorted({*rule[part], *(x.get("skills") or [])})
    return out


def _by_url(overrides: dict[str, dict], part: str) -> Column:
    """The skills that an override lists for a row's url, as a literal map."""
    empty = F.array().cast("array<string>")
    pairs = [x for url, rule in overrides.items() for x in (F.lit(url), F.array(*map(F.lit, sorted(rule.get(part) or []))).cast("array<string>"))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("url")), empty) if pairs else empty


def course_skills(courses: DataFrame, vocabulary: Vocabulary, tag_map: TagMap, overrides: dict[str, dict] | None = None) -> DataFrame:
    """(id, teaches, mentions): a title teaches, what else is said mentions. An
    override by url adds curated skills to what is taught and, last of all,
    denies skills in both."""
    empty = F.array().cast("array<string>")
    said = F.concat_ws(" ", "title", F.coalesce("summary", F.lit("")))
    base = courses.select(
        "id",
        "url",
        vocabulary.extract_column(empty, F.col("title"), empty).alias("teaches"),
        vocabulary.extract_column(F.coalesce("tags", empty), said, empty).alias("everything"),
    )
    mapped = tag_map.skills_of(courses, "id", "tags")
    joined = base.join(mapped.withColumnRenamed("id", "m_id"), F.col("id") == F.col("m_id"), "left")
    everything = F.array_union("everything", F.coalesce("skills", empty))
    taught, denied = F.array_union("teaches", _by_url(overrides or {}, "teaches")), _by_url(overrides or {}, "deny")
    return joined.select(
        "id",
        F.array_except(taught, denied).alias("teaches"),
        F.array_except(F.array_except(everything, taught), denied).alias("mentions"),
    )


def course_edges(matched: DataFrame) -> DataFrame:
    """(id, skill, relation); a course that teaches nothing has no edges."""
    kept = matched.filter(F.size("teaches") > 0)
    return kept.select("id", F.explode("teaches").alias("skill"), F.lit("teaches").alias("relation")).unionByName(
        kept.select("id", F.explode("mentions").alias("skill"), F.lit("mentions").alias("relation"))
    )


@dataclass
class Prerequisites:
    """edges: dicts of skill, requires, evidence, why and curator."""

    edges: list[dict]
    known: set[str]

    def __post_init__(self) -> None:
        pairs = [(e.get("skill"), e.get("requires")) for e in self.edges]
        self.pairs = set(pairs)
        require(
            [f"unknown skill {name!r}" for pair in pairs for name in pair if name not in self.known]
            + [f"{a} requires itself" for a, b in pairs if a == b]
            + [f"{a} requires {b} twice" for a, b in self.pairs if pairs.count((a, b)) > 1]
            + [f"{e.get('skill')}: evidence {e.get('evidence')!r}" for e in self.edges if e.get("evidence") not in EVIDENCE]
            + [f"{e.get('skill')}: no {need}" for e in self.edges for need in ("why", "curator") if not str(e.get(need) or "").strip()]
        )
        self._levels(self.known)  # raises on a cycle

    @classmethod
    def from_yaml(cls, path: str, known: set[str]) -> Prerequisites:
        """Edges with the file's curator, kind and reason where they name none of their own."""
        doc = load_sections(path, {"curated_by", "prerequisites"})
        curator = str(doc.get("curated_by") or "").strip()
        require([] if curator else [f"{path}: no curator"])
        listed = [x if isinstance(x, dict) else {} for x in doc.get("prerequisites") or []]
        edges = [
            {
                "skill": x.get("skill"), "requires": x.get("requires"), "evidence": x.get("evidence_kind", EVIDENCE[0]),
                "why": str(x.get("why") or "").strip(), "curator": str(x.get("by") or curator).strip(),
            }
            for x in listed
        ]
        return cls(edges, known)

    def required_by(self, skill: str) -> list[str]:
        return sorted(r for s, r in self.pairs if s == skill)

    def _levels(self, skills) -> list[list[str]]:
        left, out = set(skills), []
        while left:
            ready = sorted(s for s in left if not any(a == s and b in left for a, b in self.pairs))
            if not ready:
                raise RuleError(f"a cycle among {sorted(left)}")
            out.append(ready)
            left -= set(ready)
        return out

    def layers(self, skills) -> list[list[str]]:
        """What can be learned first, next, ...; only edges within ``skills`` bind."""
        return self._levels(set(skills))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(e["skill"], e["requires"], e["evidence"], e["why"], e["curator"]) for e in self.edges],
            "skill string, requires string, evidence_kind string, why string, curated_by string",
        )


def layers_of(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(skill, layer): the longest chain of requirements below a node, over the
    edges (skill, requires) within ``nodes``. Rounds peel off what requires
    nothing that is left; each is a written table, and a cycle is an error."""
    names = nodes.select("skill").distinct()
    left = materialize(names, "layers-left")
    bound = materialize(
        edges.select("skill", "requires").distinct().join(names, "skill", "left_semi").join(names.withColumnRenamed("skill", "requires"), "requires", "left_semi"),
        "layers-edges",
    )
    out, layer = None, 0
    while not left.isEmpty():
        held = bound.select("skill").distinct()
        ready = materialize(left.join(held, "skill", "left_anti").withColumn("layer", F.lit(layer)), f"layer-{layer}")
        if ready.isEmpty():
            raise RuleError("the requirements hold a cycle")
        out = ready if out is None else out.unionByName(ready)
        done = ready.select("skill")
        before = left, bound
        left = materialize(left.join(done, "skill", "left_anti"), "layers-left")
        bound = materialize(bound.join(done.withColumnRenamed("skill", "requires"), "requires", "left_anti"), "layers-edges")
        discard(*before)
        layer += 1
    discard(left, bound)
    return names.withColumn("layer", F.lit(0)) if out is None else out


# --- replies of a language model ---------------------------------------------

WHY_LIMIT, TEXT_LIMIT = 1_000, 12_000
REPLY = "array<struct<skill:string,confidence:string,why:string>>"


def reply_items(reply: Column) -> Column:
    """Items of a reply: what stands from the first ``[`` to the last ``]``.
    Null where that is no JSON list; empty for an empty reply."""
    body = F.regexp_extract(reply, r"(?s)(\[.*\])", 1)
    return F.when(F.trim(reply) == "", F.array().cast(REPLY)).when(body == "", F.lit(None)).otherwise(F.from_json(body, REPLY))


def valid_edges(replies: DataFrame, skills: DataFrame, have: DataFrame) -> DataFrame:
    """(job_id, skill, confidence, rationale) of ``replies`` (job_id, items):
    known skills that the job lacks, once, with a confidence from 0 to 1 and a
    reason, cut to its limit."""
    rows = replies.select("job_id", F.posexplode("items").alias("at", "i")).select(
        "job_id", "at", F.col("i.skill").alias("skill"), F.col("i.confidence").try_cast("double").alias("confidence"),
        F.substring(F.trim("i.why"), 1, WHY_LIMIT).alias("rationale"),
    )
    rows = rows.filter(F.col("confidence").between(0, 1) & (F.coalesce("rationale", F.lit("")) != ""))
    rows = rows.join(skills.select("skill").distinct(), "skill", "left_semi").join(have.select("job_id", "skill"), ["job_id", "skill"], "left_anti")
    first = rows.groupBy("job_id", "skill").agg(F.min(F.struct("at", "confidence", "rationale")).alias("f"))
    return first.select("job_id", "skill", "f.confidence", "f.rationale")


def ask_model(rows: DataFrame, ask, schema: str = "job_id string, reply string, failed boolean") -> DataFrame:
    """Calls ``ask(text) -> reply`` (a gateway, or a stub) where the rows are;
    a call that raises marks its row failed."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                try:
                    out.append((ask((text or "")[:TEXT_LIMIT]), False))
                except Exception:
                    out.append((None, True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("job_id"), pa.array([r for r, _ in out], pa.string()), pa.array([f for _, f in out], pa.bool_())],
                ["job_id", "reply", "failed"],
            )

    return rows.select("job_id", "text").mapInArrow(run, schema)
