"""Mixing sources to target weights with a multivariate-hypergeometric tree.

Every source is cut into blocks by a hash of the document id, so all further
bookkeeping is over (source, block). Targets come from water filling: weights
share the total, no source may exceed ``CAP`` times its size, the excess goes on
by weight. A source's exact quota is a number of block copies: every block
``floor(target / size)`` times, and of a random permutation of the blocks as many
as what is owed then holds. Where the next one is too large, those that fit what
is left are walked through again, ``PASSES`` times in all, so a few large blocks
leave no large gap.

The quotas are split among the output shards by a binary tree. At a node with a
quota for each source, the left child gets its share of the node's total, and
how many of each source these are is drawn from the multivariate hypergeometric
distribution: source after source, each a hypergeometric draw from what is left
(first over groups of sources, then within each group, so that no fold is longer
than about the root of the number of sources). At the leaves every source's
permuted copies are dealt out in disjoint runs as long as the leaf quotas; what
the mix takes of a block is the number of its copies in these runs. Rows are
shuffled within their shard at the end. All randomness is hashes of ids and a
seed: reruns agree.

Shards grow with the corpus (``SHARD`` words each, ``SHARDS`` at least) and blocks
with the shards.

Cases: null text has size 0; the null source ranks last; a source of size 0
has target 0 and takes no words; repeated rows share their block and are taken
alike; ties in a permutation are broken by block and copy; an empty table gives
an empty result; other columns, whatever their names, are carried by ``mix`` and
ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm.common import WORD, fresh, let, named, ranked, table, text_of
from tidemark.session import materialize

QUERY = "op10_mixing"
WEIGHTS, CAP, SEED = (5, 2, 1), 3, 20_017

#: Words of a shard, and shards at least; blocks of a source at least, and for each shard.
SHARD, SHARDS, BLOCKS, EACH = 1 << 24, 16, 1024, 16

#: Walks through the permuted blocks to find those that fit.
PASSES = 4

#: Sources of a group in the tree, and levels that are split in one pass.
GROUP, LEVELS = 256, 4

#: Block rows up to which the shard table is broadcast; a shuffle join beyond.
SMALL = 500_000


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and size in words of every row; one narrow pass."""
    return docs.select(
        F.col("doc_id").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
    )


def block_of(seed: int, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(blocks)).cast("int")


def targets(by_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Adds weight and target to (source, source_size); a row a source.

    A level is shared out by weight; sources that it would fill are set to their
    cap and the level of the rest is found again until none is filled. It only
    rises, so a source once full stays so, and few rounds are needed."""
    weighted = ranked(by_source, "source").withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    )
    weighted = materialize(weighted.drop("rank"), "op10-weights")
    most, level, full = F.col("source_size") * cap, 0.0, -1
    total = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    while True:
        over = most < F.lit(level) * F.col("weight")
        spent, used, filled = weighted.agg(
            F.coalesce(F.sum(F.when(over, most)), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)), F.count_if(over)
        ).first()
        if filled == full or not used:
            break
        full, level = filled, (total - spent) / used
    return weighted.withColumn("target", F.least(most.cast("double"), F.lit(level) * F.col("weight")))


def _fitting(blocks: DataFrame, seed: int) -> DataFrame:
    """``blocks`` (source, block, words, owed) with ``extra``: 1 for those drawn
    once more. All windows are by source, over its blocks."""
    whole = Window.partitionBy("source")
    walk = whole.orderBy(F.xxhash64(F.lit(seed), F.lit("draw"), "source", "block"), "block").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    out = blocks.withColumn("extra", F.lit(0)).withColumn("left", F.col("owed"))
    for _ in range(PASSES):
        fits = (F.col("extra") == 0) & (F.col("words") > 0) & (F.col("words") <= F.col("left"))
        out = out.withColumn("fits", F.when(fits, F.col("words")))
        reached = F.sum("fits").over(walk) <= F.col("left")
        out = out.withColumn("now", F.coalesce(F.when(reached, F.col("fits")), F.lit(0)))
        out = out.withColumn("left", F.col("left") - F.sum("now").over(whole)).withColumn(
            "extra", F.col("extra") + (F.col("now") > 0).cast("int")
        )
    return out.drop("fits", "now", "left")


# --- the tree ----------------------------------------------------------------


def hypergeometric(u: Column, total: Column, good: Column, drawn: Column) -> Column:
    """How many of ``good`` among ``total`` are in ``drawn``, for a uniform ``u``:
    outcomes are taken from the mode outwards until their share of all chances
    exceeds it. Chances are walked by their ratios, twice: their sum comes first."""
    n, k, m = (c.cast("double") for c in (total, good, drawn))
    low, high = F.greatest(F.lit(0.0), m + k - n), F.least(k, m)

    def from_mode(x: Column) -> Column:
        n, k, m, low, high, mode = (x[c] for c in ("n", "k", "m", "low", "high", "mode"))
        deviation = F.sqrt(m * (k / n) * (1 - k / n) * (n - m) / F.greatest(n - 1, F.lit(1.0)))
        steps = F.sequence(F.lit(1), F.least(F.ceil(9 * deviation) + 40, high - low).cast("int"))

        def chances(acc: Column, j: Column) -> Column:
            """Of one outcome farther on either side, against the mode's."""
            a, b = mode + j, mode - j
            up = F.when(a <= high, acc["up"] * (k - a + 1) * (m - a + 1) / (a * (n - k - m + a))).otherwise(F.lit(0.0))
            down = F.when(b >= low, acc["down"] * (b + 1) * (n - k - m + b + 1) / ((k - b) * (m - b))).otherwise(F.lit(0.0))
            return F.struct(up.alias("up"), down.alias("down"))

        one = [F.lit(1.0).alias(c) for c in ("up", "down", "sum")]
        whole = F.aggregate(
            steps,
            F.struct(*one),
            lambda acc, j: let(
                chances(acc, j), lambda c: F.struct(c["up"].alias("up"), c["down"].alias("down"), (acc["sum"] + c["up"] + c["down"]).alias("sum"))
            ),
            lambda acc: acc["sum"],
        )

        def find(goal: Column) -> Column:
            def step(acc: Column, j: Column) -> Column:
                return let(
                    chances(acc, j),
                    lambda c: F.struct(
                        c["up"].alias("up"),
                        c["down"].alias("down"),
                        (acc["sum"] + c["up"] + c["down"]).alias("sum"),
                        F.coalesce(
                            acc["found"],
                            F.when((c["up"] > 0) & (acc["sum"] + c["up"] >= goal), mode + j),
                            F.when((c["down"] > 0) & (acc["sum"] + c["up"] + c["down"] >= goal), mode - j),
                        ).alias("found"),
                    ),
                )

            start = F.struct(*one, F.when(goal <= 1, mode).alias("found"))
            return F.coalesce(F.aggregate(steps, start, step, lambda acc: acc["found"]), mode)

        return let(whole * u, find)

    certain = (n <= 0) | (low >= high)
    mode = F.greatest(low, F.least(high, F.floor((m + 1) * (k + 1) / (n + 2)).cast("double")))
    given = F.struct(n.alias("n"), k.alias("k"), m.alias("m"), low.alias("low"), high.alias("high"), mode.alias("mode"))
    return F.when(certain, F.greatest(low, F.lit(0.0))).otherwise(let(given, from_mode)).cast("long")


def _shares(parts: Column, drawn: Column, total: Column) -> Column:
    """array<struct<of, quota, left>>: ``drawn`` of ``total`` split among
    ``parts`` (of, quota, u) by a multivariate hypergeometric draw."""
    kind = "array<struct<of:string,quota:bigint,left:bigint>>"
    start = F.struct(total.cast("long").alias("total"), drawn.cast("long").alias("drawn"), F.array().cast(kind).alias("out"))

    def step(acc: Column, p: Column) -> Column:
        return let(
            hypergeometric(p["u"], acc["total"], p["quota"], acc["drawn"]),
            lambda x: F.struct(
                (acc["total"] - p["quota"]).alias("total"),
                (acc["drawn"] - x).alias("drawn"),
                F.array_append(acc["out"], F.struct(p["of"].alias("of"), p["quota"].alias("quota"), x.alias("left"))).cast(kind).alias("out"),
            ),
        )

    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def uniform(seed: int, *by: Column | str) -> Column:
    """A number in (0, 1) by hash."""
    return (F.pmod(F.xxhash64(F.lit(seed), F.lit("uniform"), *by), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED, group: int = GROUP) -> DataFrame:
    """(shard, source, quota) from (source, quota): the leaves of the tree. A
    node stands for ``width`` shards from its first on; the totals of shards
    differ by one at most."""
    groups = max(1, -(-quotas.count() // group))
    # a name that tells null from every string, and the group of a source
    of = F.concat(F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.lit("+")), F.coalesce("source", F.lit("")))
    nodes = quotas.select(
        of.alias("of"), F.pmod(F.xxhash64("source"), F.lit(groups)).cast("string").alias("grp"),
        F.lit(0).alias("shard"), F.lit(shards).alias("width"), "quota",
    )
    level = 0
    while 1 << level < shards:
        if groups == 1:
            nodes, level = _levels(nodes, level, min(LEVELS, (shards - 1).bit_length() - level), seed), level + LEVELS
        else:
            nodes, level = _level_by_group(nodes, level, seed), level + 1
    return nodes.select("shard", F.when(F.col("of").startswith("+"), F.expr("substring(of, 2)")).alias("source"), "quota")


def _levels(nodes: DataFrame, level: int, more: int, seed: int) -> DataFrame:
    """``more`` levels at once where a node's sources are few: a node is a row,
    and what it splits into stays in its row."""
    kind = "array<struct<of:string,quota:bigint>>"
    by_node = nodes.groupBy("shard", "width").agg(F.sort_array(F.collect_list(F.struct("of", F.col("quota").cast("long").alias("quota")))).alias("parts"))

    def split(n: Column, depth: int) -> Column:
        at = lambda p: uniform(seed, F.lit(depth), n["shard"], p["of"])
        parts = F.transform(n["parts"], lambda p: F.struct(p["of"].alias("of"), p["quota"].alias("quota"), at(p).alias("u")))
        total = F.aggregate(n["parts"], F.lit(0).cast("long"), lambda acc, p: acc + p["quota"])
        width = _left(n["width"])
        drawn = F.floor(total * width / n["width"])

        def halves(shares: Column) -> Column:
            some = lambda quota: F.filter(
                F.transform(shares, lambda x: F.struct(x["of"].alias("of"), quota(x).alias("quota"))), lambda x: x["quota"] > 0
            )
            return F.array(
                F.struct(n["shard"].alias("shard"), width.alias("width"), some(lambda x: x["left"]).cast(kind).alias("parts")),
                F.struct(
                    (n["shard"] + width).alias("shard"), (n["width"] - width).alias("width"), some(lambda x: x["quota"] - x["left"]).cast(kind).alias("parts")
                ),
            )

        return F.when(n["width"] > 1, let(_shares(parts, drawn, total), halves)).otherwise(F.array(n))

    grown = by_node.select(F.array(F.struct("shard", "width", "parts")).alias("nodes"))
    for depth in range(level, level + more):
        grown = grown.select(F.flatten(F.transform("nodes", _at_depth(split, depth))).alias("nodes"))
    out = grown.select(F.explode("nodes").alias("n")).select("n.shard", "n.width", F.explode("n.parts").alias("p"))
    return materialize(out.select("p.of", F.lit("0").alias("grp"), "shard", "width", "p.quota"), "op10-tree")


def _at_depth(split, depth: int):
    return lambda n: split(n, depth)


def _level_by_group(nodes: DataFrame, level: int, seed: int) -> DataFrame:
    """One level, first over groups of sources, then within each group."""

    def parts(of: str, *salt: Column) -> Column:
        at = uniform(seed, F.lit(level), *salt, "shard", of)
        return F.sort_array(F.collect_list(F.struct(F.col(of).alias("of"), "quota", at.alias("u")))).alias("parts")

    by_group = nodes.filter("width > 1").groupBy("shard", "width", "grp").agg(F.sum("quota").alias("quota"), parts("of"))
    by_group = materialize(by_group, "op10-groups")
    by_node = by_group.groupBy("shard", "width").agg(F.sum("quota").alias("quota"), parts("grp", F.lit("group")))
    drawn = F.floor(F.col("quota") * _left(F.col("width")) / F.col("width"))
    dealt = by_node.select("shard", F.explode(_shares(F.col("parts"), drawn, F.col("quota"))).alias("g"))
    dealt = dealt.select("shard", F.col("g.of").alias("grp"), F.col("g.left").alias("drawn"))
    by_group = by_group.join(dealt, ["shard", "grp"])
    split = by_group.select("shard", "width", "grp", F.explode(_shares(F.col("parts"), F.col("drawn"), F.col("quota"))).alias("s"))
    split = materialize(split, "op10-tree")
    width = _left(F.col("width"))
    left = split.select("s.of", "grp", "shard", width.alias("width"), F.col("s.left").alias("quota"))
    right = split.select(
        "s.of", "grp", (F.col("shard") + width).alias("shard"), (F.col("width") - width).alias("width"),
        (F.col("s.quota") - F.col("s.left")).alias("quota"),
    )
    return nodes.filter("width = 1").unionByName(left).unionByName(right).filter("quota > 0")


def _left(width: Column) -> Column:
    return F.floor((width + 1) / 2).cast("int")


# --- blocks ------------------------------------------------------------------


def plan(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, shards: int | None = None, blocks: int | None = None, seed: int = SEED
) -> tuple[DataFrame, int]:
    """(source, block, source_size, target, shards), where each block's copies
    go, and the number of blocks that ids are hashed to."""
    if shards is None:
        words = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        shards = max(SHARDS, -(-words // SHARD))
    blocks = blocks or max(BLOCKS, EACH * shards)
    by_block = materialize(
        sized.groupBy("source", block_of(seed, blocks).alias("block")).agg(F.sum("size").alias("words")), "op10-blocks"
    )
    aimed = targets(by_block.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    whole = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0))
    owing = (
        by_block.withColumnRenamed("source", "of")
        .join(aimed, F.col("of").eqNullSafe(F.col("source")))
        .select("source", "source_size", "target", "block", "words", whole.cast("int").alias("whole"))
        .withColumn("owed", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    copies = materialize(
        _fitting(owing, seed).select("source", "source_size", "target", "block", (F.col("whole") + F.col("extra")).alias("copies")), "op10-copies"
    )
    quotas = copies.groupBy("source").agg(F.sum("copies").alias("quota")).filter("quota > 0")
    return copies.join(
        _dealt(copies, split_quotas(quotas, shards, seed), seed),
        F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("part")),
        "left",
    ).select("source", "block", "source_size", "target", F.coalesce("shards", F.array().cast("array<int>")).alias("shards")), blocks


def _dealt(copies: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """(of, part, shards): every source's permuted copies in runs as long as its
    leaf quotas."""
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = leaves.withColumn("first", F.coalesce(F.sum("quota").over(before), F.lit(0))).select(
        F.col("source").alias("of"), "shard", F.explode(F.expr("sequence(first + 1, first + quota)")).alias("at")
    )
    each = copies.filter("copies > 0").select("source", "block", F.explode(F.expr("sequence(1, copies)")).alias("copy"))
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), F.lit("deal"), "source", "block", "copy"), "block", "copy")
    placed = each.withColumn("place", F.row_number().over(order).cast("long"))
    return (
        placed.join(runs, F.col("source").eqNullSafe(F.col("of")) & (F.col("place") == F.col("at")))
        .groupBy(F.col("source").alias("of"), F.col("block").alias("part"))
        .agg(F.sort_array(F.collect_list("shard")).alias("shards"))
    )


def _with_plan(left: DataFrame, source: Column, block: Column, blocks: DataFrame, own: str) -> DataFrame:
    """``left`` with the plan of each row's block as one struct column ``own``."""
    blocks = blocks.select(F.struct(*blocks.columns).alias(own))
    if blocks.count() <= SMALL:
        blocks = F.broadcast(blocks)
    return left.join(blocks, source.eqNullSafe(F.col(own)["source"]) & (block == F.col(own)["block"]))


def mix_sizes(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """What the mix takes of each row, without its text."""
    sized = materialize(sizes(docs), "op10-sizes")
    blocks, n = plan(sized, seed=seed, **options)
    return _with_plan(sized, F.col("source"), block_of(seed, n), materialize(blocks, "op10-plan"), "plan").select(
        "doc_id",
        "size",
        F.col("plan.source_size").alias("source_size"),
        F.col("plan.target").alias("target"),
        (F.col("size") * F.size("plan.shards")).alias("taken"),
        F.col("plan.shards").alias("shards"),
    )


def mix(docs: DataFrame, seed: int = SEED, shard_column: str | None = None, **options) -> DataFrame:
    """The mixed rows: ``docs`` with each row as often as its block was drawn,
    dealt to shards and shuffled within them. A shard is spread over tasks by a
    further hash of the id, so its size does not bound a task."""
    blocks, n = plan(materialize(sizes(docs), "op10-sizes"), seed=seed, **options)
    own, spot, at = fresh("__plan", docs), fresh("__spot", docs), fresh("__at", docs)
    drawn = _with_plan(docs, F.col("source").cast("string"), block_of(seed, n), materialize(blocks, "op10-plan"), own)
    spots = F.transform(F.col(own)["shards"], lambda shard, copy: F.struct(shard.alias("shard"), copy.alias("copy")))
    kept = [named(c) for c in docs.columns]
    out = (
        drawn.select(*kept, F.explode(spots).alias(spot))
        .withColumn(at, F.xxhash64(F.lit(seed), "doc_id", F.col(spot)["copy"]))
        .repartition(F.col(spot)["shard"], F.pmod(at, F.lit(64)))
        .sortWithinPartitions(F.col(spot)["shard"], at)
    )
    return out.select(*kept, *([F.col(spot)["shard"].alias(shard_column)] if shard_column else []))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(table(spark, sf_dir, "documents"))


ORACLE_SQL = None
