"""Exact removal of lines that many documents share.

Lines are reduced to 128-bit key hashes (two of 64 bits that do not depend on
each other); text is never shuffled to find them. Document frequencies come from
one partial-then-final aggregation over the distinct keys of each document, so a
line that a third of all documents hold is a few rows a task by the time it is
shuffled. Only postings of frequent lines go on: they are range-partitioned by
(key, salt) with a secondary sort by document and position, first occurrences
are streamed from the sorted runs, and what returns to the documents is a sparse
bitmap of 64-line words. The salt splits the run of a line with more than
``RUN`` documents.

Postings meet the frequent lines by a broadcast of at most ``SMALL`` lines. Where
more are frequent, the hottest are broadcast: those in more than a ``SMALL``-th
of all postings, of which there are fewer than ``SMALL``; a line of the rest is no
larger than that share in the shuffle join. Texts that no bitmap may belong to, by
a sieve of fixed size, are not shuffled to meet one.

Cases: null or empty text is one empty line, which is never dropped; ties do
not arise, as every occurrence is dropped (or, with ``keep_first``, all but the
first by id and position); each row counts as a document, so repeated rows
count repeatedly; an empty table gives an empty result; other columns, whatever
their names, are carried by ``line_dedup``. Rows of one id with different texts
are told apart by a text hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm.common import WS_CHARS, ascii_lower, fresh, let, named, sieve, table, text_of
from tidemark.session import materialize

QUERY = "op7_line_dedup"
MIN_DOCS, MIN_CHARS = 10, 1

#: Documents of one line in a sorted run before the run is split by a salt.
RUN = 1_024

#: Frequent lines (of 24 bytes) that are broadcast at most.
SMALL = 200_000


def _key_hashes(text: Column, min_chars: int) -> Column:
    """A 128-bit hash for each line; null for lines too short to count."""

    def one(line: Column) -> Column:
        key = ascii_lower(F.trim(line, F.lit(WS_CHARS)))
        return let(key, lambda k: F.when(F.char_length(k) >= min_chars, F.struct(F.xxhash64(k).alias("a"), F.xxhash64(F.lit(1), k).alias("b"))))

    return F.transform(F.split(text, "\n"), one)


def _of_frequent(postings: DataFrame, frequent: DataFrame) -> DataFrame:
    """``postings`` (h, ...) of frequent lines, with their frequency."""
    lines, total = frequent.agg(F.count(F.lit(1)), F.coalesce(F.sum("df"), F.lit(0))).first()
    if lines <= SMALL:
        return postings.join(F.broadcast(frequent), "h")
    hot = materialize(frequent.filter(F.col("df") > max(RUN, total // SMALL)), "op7-hot")
    cold = frequent.join(F.broadcast(hot.select("h")), "h", "left_anti")
    rest = postings.join(F.broadcast(hot.select("h")), "h", "left_anti")
    return postings.join(F.broadcast(hot), "h").unionByName(rest.join(cold, "h"))


def drop_bitmaps(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False
) -> DataFrame:
    """(doc_id, text_hash, drop, n_first): ``drop`` maps a 64-line word to its
    bits, for documents that lose lines; ``n_first`` counts the lines that are
    the first occurrence in the corpus of a frequent key."""
    text = text_of()
    hashed = materialize(
        docs.select("doc_id", F.xxhash64(text).alias("th"), _key_hashes(text, min_chars).alias("hs")), "op7-lines"
    )
    frequent = materialize(
        hashed.select(F.explode(F.array_distinct("hs")).alias("h"))
        .filter(F.col("h").isNotNull())
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("df"))
        .filter(F.col("df") >= min_docs),
        "op7-frequent",
    )
    salt = F.pmod(F.xxhash64("doc_id", "th"), F.ceil(F.col("df") / RUN))
    postings = hashed.select("doc_id", "th", F.posexplode("hs").alias("pos", "h")).filter(F.col("h").isNotNull())
    runs = (
        _of_frequent(postings, frequent)
        .select("h", salt.alias("salt"), "doc_id", "th", "pos")
        .repartitionByRange("h", "salt")
        .sortWithinPartitions("h", "salt", "doc_id", "pos")
    )
    run = Window.partitionBy("h", "salt").orderBy("doc_id", "pos")
    postings = materialize(runs.withColumn("rank", F.row_number().over(run)), "op7-runs")
    firsts = (
        postings.filter(F.col("rank") == 1)
        .groupBy("h")
        .agg(F.min(F.struct("doc_id", "pos", "th")).alias("at"))
        .select("at.*")
    )
    bit = F.expr("shiftleft(1L, pos % 64)")
    none = F.lit(0).cast("long")
    key = ["doc_id", "th", F.floor(F.col("pos") / 64).cast("int").alias("word")]
    words = (
        postings.select(*key, bit.alias("dropped"), none.alias("first"))
        .unionByName(firsts.select(*key, none.alias("dropped"), bit.alias("first")))
        .groupBy("doc_id", "th", "word")
        .agg(F.bit_or("dropped").alias("dropped"), F.bit_or("first").alias("first"))
    )
    if keep_first:
        words = words.withColumn("dropped", F.col("dropped").bitwiseAND(F.bitwise_not("first")))
    return words.groupBy("doc_id", "th").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "dropped"))).alias("drop"),
        F.sum(F.bit_count("first")).alias("n_first"),
    )


def _apply(docs: DataFrame, bitmaps: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (kept text, lines, dropped, first), and its name."""
    text, own, on = text_of(), fresh("__lines", docs), fresh("__on", docs)
    bits = materialize(bitmaps, "op7-bitmaps")
    bits = bits.select(F.struct("doc_id", "th").alias(on), F.struct(F.col("drop").alias("drop"), F.col("n_first").alias("n_first")).alias(own))
    keyed = docs.withColumn(fresh("__key", docs), F.struct(F.col("doc_id").alias("doc_id"), F.xxhash64(text).alias("th")))
    key = named(keyed.columns[-1])
    same = key["doc_id"].eqNullSafe(F.col(on)["doc_id"]) & (key["th"] == F.col(on)["th"])
    hashed = lambda k: F.xxhash64(F.lit(2), k["doc_id"], k["th"])
    marked, clear = sieve(keyed, hashed(key), bits.select(hashed(F.col(on)).alias("h")))
    joined = marked.join(bits, same, "left").unionByName(clear, allowMissingColumns=True)
    drop = F.col(own)["drop"]

    def keep(_line: Column, i: Column) -> Column:
        word = F.coalesce(F.try_element_at(drop, F.floor(i / 64).cast("int")), F.lit(0).cast("long"))
        return F.getbit(word, i % 64) == 0

    lines = F.split(text, "\n")
    dropped = F.aggregate(F.map_values(drop), F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w))
    found = F.struct(
        F.when(drop.isNull(), text).otherwise(F.array_join(F.filter(lines, keep), "\n")).alias("kept"),
        F.size(lines).cast("long").alias("lines"),
        F.coalesce(dropped, F.lit(0).cast("long")).alias("dropped"),
        F.coalesce(F.col(own)["n_first"], F.lit(0).cast("long")).alias("first"),
    )
    return joined.select(*map(named, docs.columns), found.alias(own)), own


def line_dedup(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with shared lines removed from ``text`` (``n_chars`` follows);
    the other columns as they were. A null text stays null."""
    out, own = _apply(docs, drop_bitmaps(docs, **options))
    columns = {c: named(c) for c in docs.columns}
    columns["text"] = F.when(F.col("text").isNotNull(), F.col(own)["kept"])
    if "n_chars" in columns:
        columns["n_chars"] = F.when(
            F.col(own)["dropped"] > 0, F.char_length(F.col(own)["kept"]).cast(docs.schema["n_chars"].dataType)
        ).otherwise(F.col("n_chars"))
    return out.select(*[c.alias(name) for name, c in columns.items()])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, own = _apply(docs, drop_bitmaps(docs))
    return out.select(
        "doc_id",
        F.col(own)["lines"].alias("n_lines"),
        F.col(own)["dropped"].alias("n_dropped"),
        F.sha2(F.col(own)["kept"], 256).alias("kept_sha256"),
        F.col(own)["first"].alias("n_first"),
    )


ORACLE_SQL = r"""
with d as (select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select rid, doc_id, unnest(ls) as line, unnest(range(len(ls))) as pos from d),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
f as (select key, min((doc_id, pos)) as head from k where length(key) >= 1
      group by key having count(distinct rid) >= 10)
select doc_id, count(*)::bigint as n_lines, count(f.key)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (f.key is null), '')) as kept_sha256,
       count(*) filter ((doc_id, pos) = f.head)::bigint as n_first
from k left join f on k.key = f.key group by rid, doc_id
"""
