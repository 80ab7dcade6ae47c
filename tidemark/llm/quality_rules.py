"""Quality rules with risk-controlled thresholds.

Base statistics are computed row by row with built-in functions. The rules are
a fixed path of steps, each of which tightens the cutoff of one statistic by one
notch; a document has a first step that rejects it, or none. Along the path ever
more is rejected, so "the rules up to step t reject more than ``RISK`` of the
clean documents" is tested in this fixed sequence by the exact binomial tail of
the labelled clean documents rejected so far, and the walk ends at the first
test that does not reject: no level is spent on the steps, and the risk is that
of all rules together. The level is divided by the number of strata (Bonferroni).
With confidence ``1 - LEVEL`` no stratum then loses more than ``RISK`` of its
clean documents to the rules. Strata with fewer than ``POOL`` clean labels are
one stratum together, as are those without any; the promise is then the pool's.

Cases: null text counts as no words (base_failed); a null stratum is a stratum
of its own; repeated rows are each judged, and a repeated label row counts
once; without labels no step is admitted; an empty table gives an empty result;
columns other than id, text and stratum are ignored (``quality_filter`` carries
them).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, let, ln_gamma, named, table, text_of, words_of
from tidemark.session import materialize

QUERY = "op5_quality_rules"

#: Statistic (SQL over the base columns, valid in both dialects) and its grid
#: of cutoffs, loosest first. A document above a cutoff is rejected.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols_per_word": ("n_symbols / greatest(n_words, 1)", [2.0, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2, 0.1]),
    "chars_per_word": ("word_chars / greatest(n_words, 1)", [40.0, 25.0, 20.0, 16.0, 13.0, 11.0]),
    "repeated_share": ("n_repeat_words / greatest(n_words, 1)", [0.5, 0.45, 0.4, 0.35, 0.3]),
    "dup_lines_per_word": ("n_dup_lines / greatest(n_words, 1)", [0.2, 0.1, 0.05, 0.03, 0.02]),
}
RISK, LEVEL, POOL = 0.02, 0.05, 500

#: The steps, in order: the loosest notch of every rule, then the next ones.
PATH = [(rule, cuts[k]) for k in range(max(len(c) for _, c in RULES.values())) for rule, (_, cuts) in RULES.items() if k < len(cuts)]

#: Above so many words positions no longer fit beside 48 hash bits in a long.
PACKED_WORDS = 65_536


def _positions_packed(tri: Column) -> Column:
    """Positions of trigram hashes that occur again: sort (48 hash bits,
    16 position bits) and keep those with an equal neighbour."""
    packed = F.transform(tri, lambda h, i: F.shiftleft(h, 16).bitwiseOR(i.cast("long")))

    def repeated(s: Column) -> Column:
        key = lambda x: F.shiftright(x, 16)
        return F.filter(
            s,
            lambda x, k: F.coalesce(key(x) == key(F.get(s, k - 1)), F.lit(False))
            | F.coalesce(key(x) == key(F.get(s, k + 1)), F.lit(False)),
        )

    return F.transform(let(F.sort_array(packed), repeated), lambda x: x.bitwiseAND(F.lit(0xFFFF)))


def _positions_wide(tri: Column) -> Column:
    """The same for very long texts, over (hash, position) structs."""
    pairs = F.transform(tri, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i")))

    def repeated(s: Column) -> Column:
        return F.filter(
            s,
            lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False)),
        )

    return F.transform(let(F.sort_array(pairs), repeated), lambda x: x["i"])


def repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice in ``words``."""
    zero = F.lit(0).cast("long")
    trigrams = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )

    def covered(positions: Column) -> Column:
        start = F.struct(zero.alias("n"), F.lit(-3).cast("long").alias("last"))
        return F.aggregate(
            F.sort_array(positions),
            start,
            lambda acc, p: F.struct(
                (acc["n"] + F.least(F.lit(3).cast("long"), p - acc["last"])).alias("n"), p.alias("last")
            ),
            lambda acc: acc["n"],
        )

    def same(positions: Column) -> Column:
        """Of windows with equal hashes, those whose words are equal."""
        at = lambda i, k: F.get(words, (i + k).cast("int"))
        windows = F.transform(
            positions, lambda i: F.struct(F.concat_ws(" ", at(i, 0), at(i, 1), at(i, 2)).alias("g"), i.alias("i"))
        )

        def repeated(s: Column) -> Column:
            return F.filter(
                s,
                lambda x, k: F.coalesce(x["g"] == F.get(s, k - 1)["g"], F.lit(False))
                | F.coalesce(x["g"] == F.get(s, k + 1)["g"], F.lit(False)),
            )

        return F.transform(let(F.sort_array(windows), repeated), lambda x: x["i"])

    def count(tri: Column) -> Column:
        found = F.when(F.size(tri) <= PACKED_WORDS, _positions_packed(tri)).otherwise(_positions_wide(tri))
        return F.when(F.size(F.array_distinct(tri)) == F.size(tri), zero).otherwise(covered(same(found)))

    return F.when(F.size(words) < 3, zero).otherwise(let(trigrams, count))


def base_stats(docs: DataFrame, stratum: str = "lang", *carried: Column) -> DataFrame:
    """doc_id, stratum and the base columns of every row; one narrow pass."""
    text = text_of()
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    by_words = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        ),
    )
    by_lines = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return (
        docs.select(
            F.col("doc_id").alias("doc_id"),
            F.col(stratum).cast("string").alias("stratum"),
            by_words.alias("w"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            by_lines.alias("n_dup_lines"),
            *carried,
        )
        .select(*(["__row"] if carried else []), "doc_id", "stratum", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")
        .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .withColumn("first_step", F.expr(_first_step()))
    )


def _first_step(prefix: str = "") -> str:
    """The first step of the path that rejects a row, as SQL of both dialects;
    beyond the last where none does."""
    value = {rule: sql.replace("n_", f"{prefix}n_").replace("word_chars", f"{prefix}word_chars") for rule, (sql, _) in RULES.items()}
    whens = " ".join(f"when ({value[rule]}) > {cut!r} then {step}" for step, (rule, cut) in enumerate(PATH))
    return f"case {whens} else {len(PATH)} end"


def _tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p); 1 where k is at the mean or above, where
    no level could admit it. Below the mean the terms fall from k down, so those
    beyond many deviations are nothing and the sum has few."""
    x, size = k.cast("double"), n.cast("double")
    last = (
        ln_gamma(size + 1) - ln_gamma(x + 1) - ln_gamma(size - x + 1) + x * math.log(p) + (size - x) * math.log1p(-p)
    )
    terms = F.least(x, F.ceil(60 * F.sqrt(size * p)) + 200).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(0), terms),
        F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s")),
        lambda acc, j: F.struct(
            (acc["t"] * (x - j) * (1 - p) / ((size - x + j + 1) * p)).alias("t"), (acc["s"] + acc["t"]).alias("s")
        ),
        lambda acc: acc["s"],
    )
    return F.when(x >= size * p, F.lit(1.0)).otherwise(F.exp(last) * total)


def thresholds(stats: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL, pool: int = POOL) -> DataFrame:
    """(stratum, pooled, steps): how many steps of the path each stratum admits;
    the pool has one row, without a stratum.

    Counts come from all labelled rows outside the held-out fold. Rows that the
    base check drops are not the rules' to lose and are left out."""
    clean = labels.filter(F.col("quality") == 1).select(F.col("doc_id").alias("label_id")).distinct()
    known = stats.filter(~F.col("base_failed") & ~held_out()).join(clean, F.col("doc_id") == F.col("label_id"), "left_semi")
    lost = [F.count_if(F.col("first_step") <= step).alias(f"k{step}") for step in range(len(PATH))]
    by_stratum = known.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *lost)  # partial sums first: a hot stratum is a few rows
    small = F.col("n") < pool
    grouped = (
        by_stratum.groupBy(F.when(~small, F.col("stratum")).alias("stratum"), small.alias("pooled"))
        .agg(F.sum("n").alias("n"), F.array(*[F.sum(f"k{step}") for step in range(len(PATH))]).alias("lost"))
        .withColumn("tests", F.count(F.lit(1)).over(Window.partitionBy()))  # a row a stratum of at least ``pool`` labels
    )
    admitted = F.filter("lost", lambda k: _tail(F.col("n"), k, risk) <= F.lit(level) / F.col("tests"))
    return grouped.select("stratum", "pooled", F.size(admitted).alias("steps"))  # losses only grow, so none is skipped


def _verdict(judged: DataFrame, cuts: DataFrame) -> DataFrame:
    """``judged`` (base columns and stratum) with ``kept``."""
    cuts = materialize(cuts, "op5-cuts")  # a row a stratum, so the join is a broadcast
    pooled = cuts.filter("pooled").agg(F.coalesce(F.max("steps"), F.lit(0))).first()[0]
    own = cuts.filter("not pooled").select(F.col("stratum").alias("__of"), F.col("steps").alias("__steps"))
    joined = judged.join(own, F.col("stratum").eqNullSafe(F.col("__of")), "left")
    over = F.col("first_step") < F.coalesce("__steps", F.lit(pooled))
    return joined.withColumn("kept", ~F.col("base_failed") & ~over).drop("__of", "__steps")


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Base columns, ``base_failed`` and ``kept`` for every row of ``docs``."""
    stats = materialize(base_stats(docs, stratum), "op5-stats")
    return _verdict(stats, thresholds(stats, labels)).drop("stratum", "first_step")


def quality_filter(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were. Rows that
    pass the base check are written with their statistics, so that texts are
    read once; the thresholds read the statistics alone."""
    whole = F.struct(*map(named, docs.columns)).alias("__row")
    passed = materialize(base_stats(docs, stratum, whole).filter("not base_failed"), "op5-passed")
    return _verdict(passed, thresholds(passed, labels)).filter("kept").select("__row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _oracle() -> str:
    return f"""
with d as (
  select row_number() over () as rid, doc_id, lang as stratum, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
tri as (
  select rid, i, w[i] || chr(32) || w[i + 1] || chr(32) || w[i + 2] as g
  from (select rid, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)),
rep as (select rid, i from (select rid, i, count(*) over (partition by rid, g) as c from tri) where c > 1),
cov as (
  select rid, count(distinct i + k) as n_repeat_words
  from rep, (select unnest([0, 1, 2]) as k) group by rid),
lines as (
  select rid, count(*) - count(distinct l) as n_dup_lines
  from (select rid, unnest(string_split(t, chr(10))) as l from d)
  where regexp_matches(l, '[^\\x20\\x09-\\x0D]') group by rid),
s as (
  select d.doc_id, d.stratum, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
         coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from d left join lines using (rid) left join cov using (rid)),
b as (select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed from s),
f as (select *, coalesce('of ' || stratum, 'null') as of, {_first_step()} as first_step from b),
known as (select * from f where not base_failed
          and doc_id in (select doc_id from labels where quality = 1) and {_CRC} % 5 <> 0),
own as (select of from known group by of having count(*) >= {POOL}),
grouped as (select coalesce(own.of, 'pool') as of, first_step from known left join own using (of)),
tests as (select count(distinct of) as n_tests from grouped),
k as (select of, step, count(*) as n, count(*) filter (first_step <= step) as k
      from grouped, (select unnest(range({len(PATH)})) as step) group by all),
admitted as (
  select of, count(*) filter (k < n * {RISK!r} and list_sum(list_transform(range(0, k + 1), lambda j:
    exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK!r}) + (n - j) * ln(1 - {RISK!r}))))
    <= {LEVEL!r} / n_tests) as steps
  from k, tests group by of)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (not base_failed and first_step >= coalesce(a.steps, 0)) as kept
from f left join own using (of) left join admitted a on a.of = coalesce(own.of, 'pool')
"""


#: crc32 of the id as text, bit by bit: DuckDB has no crc32.
_CRC = (
    "(xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, strlen(doc_id::varchar)), "
    "lambda q: ascii(substr(doc_id::varchar, q + 1, 1))::bigint)), lambda a, c: list_reduce("
    "list_prepend(xor(a, c), [0::bigint, 0::bigint, 0::bigint, 0::bigint, 0::bigint, 0::bigint, 0::bigint, 0::bigint]), "
    "lambda x, _z: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end)), 4294967295::bigint))"
)
ORACLE_SQL = _oracle()
