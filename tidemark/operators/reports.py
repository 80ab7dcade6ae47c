"""Coverage reports as tables. Ties are broken by name, so reports repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.rules import AMBIGUOUS, UNKNOWN, usable

PROFILE_MINIMUM = 50


def course_coverage(courses: DataFrame, matched: DataFrame) -> DataFrame:
    """Per source and kind: total, kept (teaches something), dropped, and
    dropped that only mention."""
    kept = F.size("teaches") > 0
    return courses.join(matched, "id").groupBy("source", "content_kind").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(kept).alias("kept"),
        F.count_if(~kept).alias("dropped"),
        F.count_if(~kept & (F.size("mentions") > 0)).alias("dropped_with_mentions"),
    )


def top(df: DataFrame, by: str, n: int) -> DataFrame:
    """The n most frequent values, then by name."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), by).limit(n)


def uncovered(names: DataFrame, edges: DataFrame, name: str = "skill") -> DataFrame:
    return names.select(name).distinct().join(edges.select(name).distinct(), name, "left_anti")


def stale_urls(overrides: DataFrame, courses: DataFrame) -> DataFrame:
    return overrides.select("url").distinct().join(courses.select("url"), "url", "left_anti")


def tag_coverage(counts: DataFrame, kind: str = "kind") -> DataFrame:
    """``counts`` (tag, n, kind): tags, pairs and whole per cent by kind."""
    by = counts.groupBy(F.coalesce(kind, F.lit("UNCLASSIFIED")).alias("kind")).agg(
        F.count(F.lit(1)).alias("tags"), F.sum("n").cast("long").alias("pairs")
    )
    total = counts.agg(F.greatest(F.coalesce(F.sum("n"), F.lit(0)), F.lit(1)).cast("long").alias("t")).first()[0]
    return by.withColumn("percent", F.expr(f"100 * pairs div {total}"))


def role_coverage(plan: DataFrame, skills: DataFrame) -> DataFrame:
    """Per family: postings, those with skills, edges, whether both counts carry
    a demand profile, and the share of all postings in tenths of a per cent."""
    total = F.greatest(F.sum("postings").over(Window.partitionBy()), F.lit(1))  # a row a family
    edges = skills.groupBy("job_id").agg(F.count(F.lit(1)).alias("edges"))
    n, with_skills = F.count(F.lit(1)), F.count("edges")
    return plan.join(edges, "job_id", "left").groupBy("family").agg(
        n.alias("postings"),
        with_skills.alias("with_skills"),
        F.coalesce(F.sum("edges"), F.lit(0)).alias("edges"),
        (usable(F.first("family")) & (n >= PROFILE_MINIMUM) & (with_skills >= PROFILE_MINIMUM)).alias("profile"),
    ).withColumn("permille", F.floor(1000 * F.col("postings") / total).cast("long"))


def seniority_counts(plan: DataFrame) -> DataFrame:
    """Postings by stated level; NONE where no level is stated."""
    return plan.groupBy(F.coalesce("seniority", F.lit("NONE")).alias("seniority")).agg(F.count(F.lit(1)).alias("postings"))


def classified(plan: DataFrame) -> DataFrame:
    """(postings, usable, unknown, ambiguous, percent): how much of a plan can be used."""
    n, good = F.count(F.lit(1)), F.count_if(usable(F.col("family")))
    return plan.agg(
        n.alias("postings"),
        good.alias("usable"),
        F.count_if(F.col("family") == UNKNOWN).alias("unknown"),
        F.count_if(F.col("family") == AMBIGUOUS).alias("ambiguous"),
        F.floor(100 * good / F.greatest(n, F.lit(1))).cast("long").alias("percent"),
    )


def ambiguous_combinations(plan: DataFrame, n: int = 10) -> DataFrame:
    families = F.array_join(
        F.array_sort(F.array_distinct(F.transform("matched_rules", lambda r: F.substring_index(r, "|", 1)))), ","
    )
    return top(plan.filter(F.col("family") == AMBIGUOUS).select(families.alias("families")), "families", n)


def unknown_titles(plan: DataFrame, n: int = 20) -> DataFrame:
    return top(plan.filter(F.col("family") == UNKNOWN), "title", n)


def column_coverage(df: DataFrame, columns: list[str], by: str = "source") -> DataFrame:
    """For each array column: null, empty and filled rows, longest item in
    characters, items with NUL characters, blank items. One scan: all columns are
    measured in one pass and told apart afterwards."""

    def measured(c: str) -> Column:
        items = F.coalesce(F.col(c), F.array().cast("array<string>"))
        return F.struct(
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.count_if(F.size(c) == 0).alias("empty"),
            F.count_if(F.size(c) > 0).alias("filled"),
            F.coalesce(F.max(F.array_max(F.transform(items, lambda x: F.char_length(x)))), F.lit(0)).alias("longest"),
            F.sum(F.size(F.filter(items, lambda x: F.contains(x, F.lit("\x00"))))).alias("with_nul"),
            F.sum(F.size(F.filter(items, lambda x: F.trim(x) == ""))).alias("blank"),
            F.lit(c).alias("column"),
        )

    wide = df.groupBy(by).agg(F.array(*map(measured, columns)).alias("m"))
    return wide.select(by, F.explode("m").alias("m")).select(by, "m.*")


def relation_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("relation").agg(F.count(F.lit(1)).alias("n"))


def extraction_stats(rows: DataFrame, bullets: str, skills: str) -> DataFrame:
    return rows.agg(
        F.coalesce(F.sum(F.size(bullets)), F.lit(0)).alias("bullets_in"), F.coalesce(F.sum(F.size(skills)), F.lit(0)).alias("skills_out")
    )


def oversized(rows: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """(column, items, too_long): distinct items of each array column, and those
    over the lookup's byte limit; one explode over all columns."""

    def named(c: str) -> Column:
        return F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.struct(F.lit(c).alias("column"), x.alias("item")))

    each = F.concat(*map(named, columns))
    items = rows.select(F.explode(each).alias("e")).select("e.*").filter(F.coalesce(F.col("item") != "", F.lit(False))).distinct()
    return items.groupBy("column").agg(F.count(F.lit(1)).alias("items"), F.count_if(F.octet_length("item") > limit).alias("too_long"))


def as_text(report: DataFrame, columns: list[str] | None = None, limit: int = 200) -> str:
    """A report of at most ``limit`` rows as aligned text, for a log."""
    names = columns or report.columns
    rows = [names] + [["" if x is None else str(x) for x in r] for r in report.select(*names).limit(limit).collect()]
    widths = [max(len(r[k]) for r in rows) for k in range(len(names))]
    return "\n".join("  ".join(x.ljust(w) for x, w in zip(r, widths, strict=True)).rstrip() for r in rows)


def teaching_sample(courses: DataFrame, matched: DataFrame, skill: str, n: int = 10) -> DataFrame:
    return courses.join(matched.filter(F.array_contains("teaches", skill)), "id").select("title").orderBy("title").limit(n)
