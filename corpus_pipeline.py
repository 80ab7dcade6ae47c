"""From raw documents to packed sequences: each stage is written as Parquet and
read again as the next one's documents. A stage's own scratch tables are deleted
when the next one begins, as its result is written by then."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from tidemark.llm.common import table
from tidemark.session import discard, materialize, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows of an Arrow batch: these are whole texts, and both sides hold a batch at once.
BATCH = ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def _stage(f: Stage) -> Stage:
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(*BATCH)  # for the session, as what a stage returns is run later
        with scratch(spark, "corpus-pipeline"):
            return f(spark, docs, sf_dir)

    return run_stage


@_stage
def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.quality_filter(docs, table(spark, sf_dir, "labels"))


@_stage
def _lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share."""
    return line_dedup.line_dedup(docs)


@_stage
def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return ngram_join.keep_one(docs)


@_stage
def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; rows repeat where a source is raised."""
    return mixing.mix(docs)


@_stage
def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of fixed-length sequences, with their token ids."""
    # rows carry their ids here, and workers that earlier stages used are used again
    return packing.pack(docs, packing.default_tokenizer(), held=1_000_000, memory=32 << 20)


STAGES = [
    ("quality_rules", _quality),
    ("line_dedup", _lines),
    ("ngram_join", _near),
    ("mixing", _mix),
    ("packing", _pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return docs


#: Hash permutations, token ids and reachability have no SQL form here.
ORACLE_SQL = None
