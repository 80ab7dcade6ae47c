"""Quality classifier: a sparse ensemble of rules.

Statistics of each text are built-in expressions. Small decision trees are
grown on random halves of a labelled sample; every path from a root to a node
becomes a rule (a conjunction of comparisons). A logistic model over the rules
is fitted with an L1 penalty, and the rules that keep a weight are compiled
into one Spark column, so scoring is a projection.

At most ``SAMPLE`` labelled documents, those of smallest id hash outside the
held-out fold, teach (a documented bound: the driver holds their statistics).

Cases: null or empty text has statistics of 0 and a score like any other; with
no labels every score is 0.5, with labels of one class the share of 1 smoothed
by one of each; several labels of one id count as their least; repeated rows
are all returned; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, fold_of, hash_sample, held_out, let, table, text_of, words_of
from tidemark.session import materialize

QUERY = "op3_quality_classifier"
SAMPLE, SEED, CUT = 20_000, 20_029, 0.3
TREES, DEPTH, BINS, LEAF, PENALTY, STEPS = 24, 3, 24, 12, 0.001, 600

STATISTICS = [
    "log_words", "chars_per_word", "symbols_per_word", "marks_per_word", "upper_share", "digit_share",
    "distinct_share", "dup_lines_per_word", "lines_per_word", "stops_per_word", "wide_share", "longest_word",
]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and the statistics of every row; one narrow pass."""
    text = text_of()

    def count(regex: str) -> Column:
        return F.regexp_count(text, F.lit(regex)).cast("double")

    by_words = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).alias("n"),
            F.char_length(F.array_join(w, "")).alias("chars"),
            F.size(F.array_distinct(w)).alias("distinct"),
            F.coalesce(F.array_max(F.transform(w, lambda x: F.char_length(x))), F.lit(0)).alias("longest"),
        ),
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    raw = docs.select(
        "doc_id",
        held_out().alias("held_out"),
        by_words.alias("w"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct"))).alias("l"),
        count(r"[#*$%&|<>]").alias("symbols"),
        count(r"[!?;:()\[\]{}=_~^\\/]").alias("marks"),
        count(r"\p{Lu}").alias("upper"),
        count("[0-9]").alias("digits"),
        count(r"\.").alias("stops"),
        (F.octet_length(text) - F.char_length(text)).cast("double").alias("wide"),
    )
    words, chars = F.greatest(F.col("w.n"), F.lit(1)), F.greatest(F.col("w.chars"), F.lit(1))
    return raw.select(
        "doc_id",
        "held_out",
        F.log1p(F.col("w.n").cast("double")).alias("log_words"),
        (F.col("w.chars") / words).alias("chars_per_word"),
        (F.col("symbols") / words).alias("symbols_per_word"),
        (F.col("marks") / words).alias("marks_per_word"),
        (F.col("upper") / chars).alias("upper_share"),
        (F.col("digits") / chars).alias("digit_share"),
        (F.col("w.distinct") / words).alias("distinct_share"),
        ((F.col("l.n") - F.col("l.distinct")) / words).alias("dup_lines_per_word"),
        (F.col("l.n") / words).alias("lines_per_word"),
        (F.col("stops") / words).alias("stops_per_word"),
        (F.col("wide") / chars).alias("wide_share"),
        F.col("w.longest").cast("double").alias("longest_word"),
    )


# --- learning, on the driver, over a bounded sample --------------------------

Condition = tuple[int, bool, float]  # statistic, above?, threshold


@dataclass
class Model:
    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for conditions, weight in self.rules:
            z += weight * covers(conditions, x)
        return 1 / (1 + np.exp(-z))

    def column(self) -> Column:
        z = F.lit(self.intercept)
        for conditions, weight in self.rules:
            hold = F.lit(True)
            for s, above, at in conditions:
                value = F.col(STATISTICS[s])
                hold = hold & ((value > at) if above else (value <= at))
            z = z + F.when(hold, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def covers(conditions: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    hold = np.ones(len(x), bool)
    for s, above, at in conditions:
        hold &= (x[:, s] > at) if above else (x[:, s] <= at)
    return hold


def _split(x: np.ndarray, y: np.ndarray, candidates: np.ndarray) -> tuple[float, int, float]:
    """(gain, statistic, threshold) of the best split by Gini impurity."""
    n, ones = len(y), y.sum()
    whole = ones * (n - ones) / n
    best = (1e-9, -1, 0.0)
    for s in candidates.tolist():
        cuts = np.unique(np.quantile(x[:, s], np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
        low = x[:, s][:, None] <= cuts
        m, k = low.sum(0), (low & (y[:, None] > 0)).sum(0)
        fits = (m >= LEAF) & (n - m >= LEAF)
        a, b = np.maximum(m, 1), np.maximum(n - m, 1)
        gain = np.where(fits, whole - k * (m - k) / a - (ones - k) * (n - m - ones + k) / b, 0.0)
        i = int(gain.argmax())
        if gain[i] > best[0]:
            # midway to the next value, so that a rule does not hang on one document
            above = x[:, s][x[:, s] > cuts[i]]
            best = (float(gain[i]), s, float((cuts[i] + above.min()) / 2))
    return best


def _paths(x, y, rng, depth: int, above: tuple[Condition, ...], out: list) -> None:
    if above:
        out.append(above)
    if not depth or len(y) < 2 * LEAF or not 0 < y.sum() < len(y):
        return
    _, s, at = _split(x, y, rng.permutation(x.shape[1])[: max(2, 2 * x.shape[1] // 3)])
    if s < 0:
        return
    high = x[:, s] > at
    _paths(x[~high], y[~high], rng, depth - 1, (*above, (s, False, at)), out)
    _paths(x[high], y[high], rng, depth - 1, (*above, (s, True, at)), out)


def _lasso(r: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient for L1 logistic regression; the intercept
    is not penalised."""
    n, d = r.shape
    design = np.c_[np.ones(n), r]
    step = 4 * n / max(np.linalg.norm(design, 2) ** 2, 1e-9)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w = np.zeros(d + 1)
    w[0] = np.log(share / (1 - share))
    v, t = w.copy(), 1.0
    for _ in range(STEPS):
        slope = design.T @ (1 / (1 + np.exp(-(design @ v))) - y) / n
        new = v - step * slope
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Model:
    if not len(y):
        return Model(0.0)
    if y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(float(np.log(share / (1 - share))))
    rng, found = np.random.default_rng(seed), []
    for _ in range(TREES):
        half = rng.permutation(len(y))[: max(2, len(y) // 2)]
        _paths(x[half], y[half], rng, DEPTH, (), found)
    rules, masks = {}, []
    for conditions in found:
        hold = covers(conditions, x)
        key = np.packbits(hold).tobytes()
        if 0.005 * len(y) <= hold.sum() <= 0.995 * len(y) and key not in rules:
            rules[key] = conditions
            masks.append(hold)
    if not masks:
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(float(np.log(share / (1 - share))))
    intercept, weights = _lasso(np.array(masks, float).T, y.astype(float), PENALTY)
    kept = [(c, float(w)) for c, w in zip(rules.values(), weights, strict=True) if abs(w) > 1e-6]
    return Model(intercept, kept)


def train(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    known = labels.groupBy(F.col("doc_id").alias("label_id")).agg(F.min("quality").alias("quality")).filter(F.col("quality").isNotNull())
    labelled = (
        stats.filter(~F.col("held_out") & F.coalesce(fold_of() != 0, F.lit(False)))
        .join(known, F.col("doc_id") == F.col("label_id"))
        .select("doc_id", "quality", *STATISTICS)
    )
    rows = hash_sample(labelled, sample, SEED).toPandas().sort_values(["doc_id", *STATISTICS])
    return fit(rows[STATISTICS].to_numpy(float), (rows["quality"].to_numpy(float) >= 1).astype(int))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    stats = materialize(statistics(docs), "op3-stats")
    return stats.select("doc_id", "held_out", train(stats, labels).column().alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL = None
