"""Column helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

#: ASCII white space, as a regex class body, and as the characters themselves.
WS = r"\x20\x09-\x0D"
WS_CHARS = " \t\n\x0b\x0c\r"
WORD = rf"[^{WS}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound to a lambda variable: evaluated once a row,
    however often ``body`` mentions it (the optimizer would otherwise inline it)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(name: str, *tables: DataFrame) -> str:
    """``name``, or longer, so that no column of ``tables`` is called so."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def named(column: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def fold_of(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; 0 is the held-out fold."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold_of(doc_id) == 0, F.lit(False))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. Pure ASCII takes the fast built-in path."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, lower)
    )


def hash_sample(rows: DataFrame, bound: int, seed: int, doc_id: str = "doc_id") -> DataFrame:
    """At most ``bound`` rows, those of smallest id hash. All but about ``bound``
    rows are filtered out where they are before the rest is ordered, so no task
    gathers a top list of every other."""
    at = F.xxhash64(F.lit(seed), F.col(doc_id))
    share = min(1.0, bound / max(1, rows.count()))
    spread = 1 << 31
    kept = rows if share == 1.0 else rows.filter(F.pmod(at, F.lit(spread)) < F.lit(int(share * spread)))
    return kept.withColumn("__at", at).orderBy(F.pmod("__at", F.lit(spread)), "__at").limit(bound).drop("__at")


def ln_gamma(x: Column) -> Column:
    """Stirling's series twelve places up, where it is exact to about 1e-13."""
    y = x + 12
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    for k in range(12):
        series = series - F.log(x + k)
    return series


def ranked(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``rank``, from 0, in the order of ``column``, nulls last: rows
    are ranged and numbered in their range, and a row for each range is summed."""
    order = named(column).asc_nulls_last()
    placed = rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("__part", F.spark_partition_id())
    placed = materialize(placed, "ranked")
    ends = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = before.select("__part", F.coalesce(F.sum("__n").over(ends), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__part").orderBy(order))
    return (
        placed.withColumn("rank", own)
        .join(F.broadcast(before), "__part")  # as many rows as shuffle partitions
        .withColumn("rank", F.col("rank") + F.col("__before") - 1)
        .drop("__part", "__before")
    )


#: Bits of the sieve: 2**20 words of 64 at most are broadcast, however many keys there are.
SIEVE = 1 << 26


def sieve(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may be among ``keys``, rows that surely are not), by one hashed
    bit a key; ``keys`` has one column, the hash of ``key``. What is surely out
    needs no join, so its texts are not shuffled; the rest needs an exact one."""
    spot = F.pmod(F.col(keys.columns[0]), F.lit(SIEVE))
    words = keys.select(F.shiftright(spot, 6).alias("__word"), spot.alias("__spot"))
    words = words.groupBy("__word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__spot").bitwiseAND(63).cast("int"))).alias("__bits"))
    own, at = fresh("__sieve", rows), fresh("__at", rows)
    words = words.select(F.col("__word").alias(f"{own}_word"), F.col("__bits").alias(own))
    placed = rows.withColumn(at, F.pmod(key, F.lit(SIEVE)))
    joined = placed.join(F.broadcast(words), F.shiftright(named(at), 6) == F.col(f"{own}_word"), "left")
    may = F.coalesce(F.getbit(F.col(own), named(at).bitwiseAND(63).cast("int")) == 1, F.lit(False))
    kept = [named(c) for c in rows.columns]
    return joined.filter(may).select(*kept), joined.filter(~may).select(*kept)


#: Rows of an Arrow batch that are turned into Python objects at once.
SLICE = 512


def tidy() -> None:
    """Gives free memory back: a worker is used again, and so would keep for the
    next stage what the largest task before it needed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def by_slices(run):
    """``run`` over batches, as a task that takes them in slices and ends tidily."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(b.slice(k, SLICE) for b in batches for k in range(0, b.num_rows, SLICE))
        finally:
            tidy()

    return task
