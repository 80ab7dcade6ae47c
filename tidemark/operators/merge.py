"""Set-based reconciliation of serving tables.

Each function takes the target as it is and what came in, and returns the target
as it should be: the caller writes it (or, on a dry run, only counts). One
full outer join takes the place of row-by-row upserts, and running the same
input again gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.operators.medallion import first_by
from tidemark.session import materialize

NAME_BYTES = 2_000


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    forward: dict[str, str] | None = None,
    keep: list[str] = (),
    insert: bool = True,
    touch: Column | None = None,
    touched: str | None = None,
) -> DataFrame:
    """``source`` over ``target``, matched on ``keys`` (unique on both sides).

    Columns take the source's value, except: ``forward`` maps a column to
    ``least`` or ``greatest`` of both (nulls ignored), ``keep`` columns and
    columns that the source lacks stay as in the target. ``insert=False`` only
    updates. ``touch`` is written to the column ``touched`` of changed rows."""
    forward = forward or {}
    t, s = target.alias("t"), source.withColumn("__in", F.lit(True)).alias("s")
    t = t.withColumn("__at", F.lit(True)).alias("t")
    on = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    joined = t.join(s, on, "full" if insert else "left")
    incoming, there = F.col("s.__in").isNotNull(), F.col("t.__at").isNotNull()
    out = []
    for c in target.columns:
        if c == touched:
            value = F.when(incoming, touch).otherwise(F.col(f"t.{c}"))
        elif c in keys:
            value = F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
        elif c not in source.columns:
            value = F.col(f"t.{c}")
        elif c in forward:
            value = getattr(F, forward[c])(F.col(f"t.{c}"), F.col(f"s.{c}"))
        elif c in keep:
            value = F.when(there, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        else:
            value = F.when(incoming, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        out.append(value.alias(c))
    return joined.select(*out)


def touch(target: DataFrame, seen: DataFrame, keys: list[str], first: str = "first_seen_at", last: str = "last_seen_at") -> DataFrame:
    """Sightings of rows that did not change: the two columns only, no inserts."""
    return upsert(target, seen, keys, {first: "least", last: "greatest"}, insert=False)


def usable_name(name: Column) -> Column:
    """Neither null nor empty, nor over the lookup's byte limit (counted, never cut)."""
    return F.coalesce((name != "") & (F.octet_length(name) <= NAME_BYTES), F.lit(False))


def upsert_lookup(target: DataFrame, names: DataFrame, id_column: str = "id", name_column: str = "name") -> DataFrame:
    """Adds unseen names to an (id, name) table; ids there stay, new ones follow
    the greatest. New names are numbered by range of name: partition offsets
    come from one small count, so no task sees all names."""
    fresh = (
        names.filter(usable_name(F.col(name_column))).select(name_column).distinct()
        .join(target.select(name_column), name_column, "left_anti")
    )
    parts = fresh.sparkSession.conf.get("spark.sql.shuffle.partitions")
    # written, as a second evaluation could range names in another way
    ranged = materialize(fresh.repartitionByRange(int(parts), name_column).withColumn("__part", F.spark_partition_id()), "new-names")
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    offsets = counts.select(F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__skip"))
    first = target.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long")).first()[0]
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(name_column))
    numbered = ranged.withColumn("__rank", rank).join(F.broadcast(offsets), F.col("__part") == F.col("__p"))
    new = numbered.select((F.lit(first) + F.col("__skip") + F.col("__rank")).cast("long").alias(id_column), name_column)
    return target.select(F.col(id_column).cast("long").alias(id_column), name_column).unionByName(new)


def latest_attributes(rows: DataFrame, key: str, version: str, columns: list[str]) -> DataFrame:
    """For each key its attributes as last written."""
    ordered = [F.col(version).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in columns]]
    return first_by(rows, [key], ordered).select(key, *columns)


def replace_scoped(target: DataFrame, fresh: DataFrame, scope: DataFrame, keys: list[str], only: Column | None = None) -> DataFrame:
    """Deletes the target's rows whose ``keys`` are in ``scope`` (and that meet
    ``only``, so one method's rows can go without another's), adds ``fresh``."""
    scope = scope.select(*keys).distinct()
    if only is None:
        kept = target.join(scope, keys, "left_anti")
    else:
        kept = target.filter(~F.coalesce(only, F.lit(False))).unionByName(target.filter(only).join(scope, keys, "left_anti"))
    return kept.unionByName(fresh.select(*target.columns)).distinct()


def junction(rows: DataFrame, key: str, items: str, lookup: DataFrame, id_column: str = "id", name_column: str = "name") -> DataFrame:
    """Distinct (key, id) pairs of an array column resolved by a lookup."""
    pairs = rows.select(key, F.explode(items).alias(name_column)).distinct()
    return pairs.join(lookup, name_column).select(key, id_column).distinct()


def hierarchy(rows: DataFrame, uid: str = "uid", children: str = "child_uids") -> DataFrame:
    """(parent_uid, child_uid, position): the position is the array index, so a
    skipped empty child leaves a gap; unknown children stay."""
    return (
        rows.filter(F.col(uid).isNotNull())
        .select(F.col(uid).alias("parent_uid"), F.posexplode(children).alias("position", "child_uid"))
        .filter(F.coalesce(F.col("child_uid") != "", F.lit(False)))
        .select("parent_uid", "child_uid", "position")
    )


def resolve_parents(rows: DataFrame, kind: str = "LEARNING_PATH", scope: list[str] = ()) -> DataFrame:
    """``rows`` with ``parent_uids``: for every container its uid at each child
    that is there (in the same ``scope``, such as a page), in container order;
    containers are ordered by ``position``."""
    scope = list(scope)
    parents = (
        rows.filter((F.col("content_kind") == kind) & F.col("uid").isNotNull())
        .select(*[F.col(c).alias(f"of_{c}") for c in scope], F.col("uid").alias("parent"), F.col("position").alias("at"), F.explode("child_uids").alias("child"))
        .distinct()
        .groupBy("child", *[f"of_{c}" for c in scope])
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "parent"))), lambda s: s["parent"]).alias("found"))
    )
    same = F.col("uid") == F.col("child")
    for c in scope:
        same = same & (F.col(c) == F.col(f"of_{c}"))
    joined = rows.drop("parent_uids").join(parents, same, "left")
    empty = F.array().cast("array<string>")
    return joined.withColumn("parent_uids", F.coalesce(F.array_distinct("found"), empty)).drop("child", "found", *[f"of_{c}" for c in scope])


def partial_containers(rows: DataFrame) -> DataFrame:
    """Containers that state more children than they list."""
    return rows.filter(F.col("child_count") > F.coalesce(F.size("child_uids"), F.lit(0)))


def diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(change, n) of a junction: added, removed, kept."""
    a, b = before.select(*keys).distinct().withColumn("__a", F.lit(1)), after.select(*keys).distinct().withColumn("__b", F.lit(1))
    change = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").otherwise("kept")
    return a.join(b, keys, "full").groupBy(change.alias("change")).agg(F.count(F.lit(1)).alias("n"))


def differing(target: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Source rows of which any column differs from the target's; null and an
    empty array are different."""
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    return source.alias("s").join(target.alias("t"), F.col(f"s.{key}") == F.col(f"t.{key}")).filter(changed).select("s.*")


def resolve_names(names: DataFrame, lookup: DataFrame, column: str, name_column: str = "name") -> tuple[DataFrame, DataFrame]:
    """(rows found in the lookup, names that are not): nothing is inserted."""
    at = F.col(column) == F.col(f"l.{name_column}")
    found = names.join(lookup.alias("l"), at, "inner")
    return found, names.join(lookup.alias("l"), at, "left_anti").select(column).distinct()


def orphans(lookup: DataFrame, id_column: str, *referrers: DataFrame) -> DataFrame:
    """Lookup rows that no referrer uses."""
    out = lookup
    for r in referrers:
        out = out.join(r.select(F.col(id_column)).distinct(), id_column, "left_anti")
    return out


def model_edges(target: DataFrame, done: DataFrame, edges: DataFrame, jobs: DataFrame, model: str, clock: Column) -> tuple[DataFrame, DataFrame]:
    """Edges by a model for ``jobs``: its earlier ones are replaced, other
    methods' stay and win; every job is marked done even without an edge."""
    kept = target.join(jobs.select("job_id").distinct().withColumn("__go", F.lit(True)), "job_id", "left")
    kept = kept.filter(~(F.coalesce(F.col("__go"), F.lit(False)) & F.col("method").eqNullSafe("model"))).drop("__go")
    new = edges.join(kept.select("job_id", "skill_id"), ["job_id", "skill_id"], "left_anti")
    new = first_by(new, ["job_id", "skill_id"], [F.col("confidence").desc(), F.col("rationale")]).withColumn("method", F.lit("model"))
    count = edges.groupBy("job_id").agg(F.count(F.lit(1)).alias("edges"))
    marks = jobs.select("job_id").distinct().join(count, "job_id", "left").select(
        "job_id", F.lit(model).alias("model"), F.coalesce("edges", F.lit(0)).alias("edges"), clock.alias("matched_at")
    )
    return kept.unionByName(new.select(*kept.columns)), upsert(done, marks, ["job_id"])


def check_failures(tried: int, failed: int, limit: float = 0.25) -> None:
    """Raises after the writes if too many items failed."""
    if tried and failed / tried > limit:
        raise RuntimeError(f"{failed} of {tried} items failed")


# --- whole reconciles: planned first, written only when told to ---------------


@dataclass
class Change:
    """A planned rewrite of a table: what is there, what shall be, and by which
    columns a row is told. Nothing is written unless ``dry_run`` is off."""

    before: DataFrame
    after: DataFrame
    keys: list[str]

    def counts(self) -> DataFrame:
        """(change, n): rows added, removed and kept."""
        return diff(self.before, self.after, self.keys)

    def apply(self, write: Callable[[DataFrame], None], dry_run: bool = True) -> dict[str, int]:
        """The counts; ``write`` gets the new table if this is no dry run. It is
        written to scratch first, as it may read what it replaces."""
        planned = materialize(self.after.select(*self.before.columns), "planned")
        counts = {r.change: r.n for r in Change(self.before, planned, self.keys).counts().collect()}
        if not dry_run:
            write(planned)
        return counts


def ids_of(names: DataFrame, lookup: DataFrame, column: str, as_id: str, id_column: str = "id", name_column: str = "name") -> DataFrame:
    """``names`` with the id of each name; a name that the lookup lacks is an error."""
    ids = lookup.select(F.col(id_column).alias(as_id), F.col(name_column).alias("__name"))
    joined = names.join(ids, F.col(column) == F.col("__name"), "left").drop("__name")
    absent = [r[0] for r in joined.filter(F.col(as_id).isNull()).select(column).distinct().orderBy(column).limit(20).collect()]
    if absent:
        raise LookupError(f"not in the lookup: {', '.join(map(str, absent))}")
    return joined.drop(column)


def course_skills_change(target: DataFrame, edges: DataFrame, lookup: DataFrame) -> Change:
    """Full rebuild of (course_id, skill_id, relation) from (id, skill, relation)."""
    after = ids_of(edges.withColumnRenamed("id", "course_id"), lookup, "skill", "skill_id")
    return Change(target, after.select("course_id", "skill_id", "relation").distinct(), ["course_id", "skill_id", "relation"])


def prerequisites_change(target: DataFrame, edges: DataFrame, lookup: DataFrame) -> Change:
    """(skill_id, requires_skill_id, evidence_kind, why, curated_by) as declared:
    edges that are no longer declared go."""
    after = ids_of(ids_of(edges, lookup, "skill", "skill_id"), lookup, "requires", "requires_skill_id")
    return Change(target, after, ["skill_id", "requires_skill_id"])


def terms_change(target: DataFrame, terms: DataFrame, lookup: DataFrame) -> Change:
    """(term, skill_id, scannable) from the vocabulary's (term, skill, scannable)."""
    return Change(target, ids_of(terms, lookup, "skill", "skill_id"), ["term", "skill_id", "scannable"])


def courses_upsert(target: DataFrame, courses: DataFrame, clock: Column) -> DataFrame:
    """Courses over the serving table, by id; ``updated_at`` of changed rows only."""
    columns = [c for c in target.columns if c not in ("id", "updated_at") and c in courses.columns]
    known = target.select("id").join(courses.select("id"), "id", "left_semi")
    changed = differing(target, courses, "id", columns).select("id").unionByName(courses.select("id").join(known, "id", "left_anti"))
    return upsert(target, courses.join(changed, "id", "left_semi").select("id", *columns), ["id"], touch=clock, touched="updated_at")


def route_fields(jobs: DataFrame, lookups: dict[str, str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """For each array column of ``lookups`` (column -> lookup) the distinct usable
    (job_id, name) pairs, and (column, names, too_long) of what was left out."""
    pairs = {c: jobs.select("job_id", F.explode(c).alias("name")).distinct() for c in lookups}
    routed = {c: p.filter(usable_name(F.col("name"))) for c, p in pairs.items()}
    counts = None
    for c, p in pairs.items():
        names = p.select("name").filter("name <> ''").distinct()
        row = names.agg(F.count(F.lit(1)).alias("names"), F.count_if(~usable_name(F.col("name"))).alias("too_long"))
        row = row.select(F.lit(c).alias("column"), "names", "too_long")
        counts = row if counts is None else counts.unionByName(row)
    return routed, counts
