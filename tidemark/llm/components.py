"""Connected components over an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import discard, materialize


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
    )


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest
    node of its component. Rounds grow with the logarithm of the diameter; each
    is cut by a written table. Minima are pre-aggregated before the shuffle, and
    the joins that send them back can be split by AQE where a hub is hot. Only the
    last round's table stays."""
    edges = materialize(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label
    )
    seen = _fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        before, edges = edges, materialize(small, label)
        discard(before)
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
