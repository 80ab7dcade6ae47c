"""History, current and incremental views over landed rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

EPOCH = "1970-01-01 00:00:00"


def parsed(stamp: Column) -> Column:
    """An ISO stamp as a timestamp; null if unparseable."""
    return F.try_to_timestamp(stamp)


def fingerprint(scalars: list[Column], arrays: list[Column] = (), joiner: str = "|") -> Column:
    """SHA-256 of the fields, joined by a separator that texts do not hold.
    Nulls are empty; the items of an array are joined by ``joiner``."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in scalars]
    parts += [F.coalesce(F.array_join(c, joiner), F.lit("")) for c in arrays]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


#: What makes a posting's content: (field, what stands for null), then arrays.
POSTING_FIELDS = [("title", ""), ("salary_type", ""), ("salary_min_usd", 0), ("salary_max_usd", 0), ("location", ""), ("work_arrangement", ""), ("description", "")]
POSTING_ARRAYS = ["tech_stack", "skills", "responsibilities", "benefits"]


def posting_fingerprint() -> Column:
    return fingerprint([F.coalesce(F.col(c), F.lit(x)) for c, x in POSTING_FIELDS], [F.col(c) for c in POSTING_ARRAYS])


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``, which should be total. Spark
    keeps one row a key and task before it shuffles (WindowGroupLimit)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def latest_per_key(df: DataFrame, keys: list[str], version: str, *ties: str) -> DataFrame:
    return first_by(df, keys, [F.col(c).desc() for c in (version, *ties)])


def history(bronze: DataFrame, key: str = "job_id", version: str = "crawled_at") -> DataFrame:
    """One row for each (key, content): the latest sighting of that content.
    Rows without a key are left out. ``crawled_ts`` is typed so that later
    filters reach the scan."""
    hashed = bronze.filter(F.col(key).isNotNull()).withColumn("content_hash", posting_fingerprint())
    return latest_per_key(hashed, [key, "content_hash"], version).withColumn("crawled_ts", parsed(F.col(version)))


def watermark(df: DataFrame, stamp: Column, lookback: dt.timedelta = dt.timedelta(days=1)) -> dt.datetime | None:
    """Greatest stamp less the look-back, not before the epoch; None if empty."""
    top = df.agg(F.max(stamp)).first()[0]
    return None if top is None else max(top - lookback, dt.datetime(1970, 1, 1))


def since(df: DataFrame, stamp: Column, bound: dt.datetime | None) -> DataFrame:
    """Rows strictly after the bound; all rows where there is none. Rows whose
    stamp cannot be read only come with a full load."""
    return df if bound is None else df.filter(stamp > F.lit(bound))


def append_history(target: DataFrame | None, bronze: DataFrame, key: str = "job_id", version: str = "crawled_at") -> DataFrame:
    """History after one more run: the slice since the watermark joins what is
    there; of one (key, content) the latest stays. Running again changes nothing."""
    bound = None if target is None else watermark(target, parsed(F.col(version)))
    fresh = history(since(bronze, parsed(F.col(version)), bound), key, version)
    if target is None:
        return fresh
    return latest_per_key(target.unionByName(fresh, allowMissingColumns=True), [key, "content_hash"], version)


def current(history_rows: DataFrame, key: str = "job_id", version: str = "crawled_at") -> DataFrame:
    ties = ["content_hash"] if "content_hash" in history_rows.columns else []
    return latest_per_key(history_rows, [key], version, *ties)


def sightings(bronze: DataFrame, key: str, stamp: Column) -> DataFrame:
    """First and last stamp of each key: partial aggregates before the shuffle."""
    return bronze.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.min(stamp).alias("first_seen_at"), F.max(stamp).alias("last_seen_at")
    )


def tag_counts(df: DataFrame, tags: str) -> DataFrame:
    return df.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def pending(items: DataFrame, done: DataFrame, key: str, order: str, limit: int) -> DataFrame:
    """Items not done, oldest first (unknown age before all): top-k, no full sort."""
    return items.join(done, key, "left_anti").orderBy(F.col(order).asc_nulls_first(), F.col(key)).limit(limit)


def missing_from(df: DataFrame, declared: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not declared: what a reconcile deletes."""
    return df.join(declared.select(*keys).distinct(), keys, "left_anti")


def snapshot(df: DataFrame, name: str, stamp: str) -> str:
    """A copy as table ``name_stamp``, made before anything is changed."""
    copy = f"{name}_{stamp}"
    df.write.saveAsTable(copy)
    return copy


def require_tables(spark, *names: str) -> None:
    """Fails before any write if a table is missing."""
    absent = [n for n in names if not spark.catalog.tableExists(n)]
    if absent:
        raise LookupError(f"tables not found: {', '.join(absent)}")
