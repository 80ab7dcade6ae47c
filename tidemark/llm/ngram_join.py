"""Self-join of documents on the Jaccard similarity of their word shingles.

1. Shingle hashes leave the texts packed by hash range (a few bytes each) and
   are counted. Only shingles that two documents hold can be in an overlap, so
   a document survives if at least ``NUM/DEN`` of its set is such. A shingle that
   ``COMMON`` documents of one batch hold is known to be common there: only its
   count goes to its range, its postings go on spread by document.
2. Survivors' sets come back in one global order, rarest first. Two sets that
   link share a shingle among the first ``n - ceil(n * NUM / DEN) + 1``, their
   prefixes; documents with a shingle in their prefixes are a group.
3. Each document is compared with the smallest of every group that it is in.
   The links found give classes, and a group within one class is done.
4. In the other groups sets are stored in a radix trie in the global order and
   the members run down it: paths that stored sets share are overlapped once. A
   subtree is cut when what is left of either set cannot reach the required
   overlap, or when all below is in the member's own class, as known so far. Groups
   that overlap are joined into one, so that a set is sent once; where that would
   be more than a trie holds, its largest class only probes, and the others are
   dealt out over tries. Where that compares more pairs than the groups one by one,
   as in long chains, they stay apart, and a subtree is also cut when a smaller
   shingle is shared, as that one's group has the pair.
5. Links give classes by star contraction.

Exact: no candidate is dropped; hash order and salts only spread the work. Work
follows the sizes of the groups of single shingles, not of chains of them. Sets
with the same shingles are one representative from step 3 on. A group is dealt to
tasks by salts, and stored in tries of bounded bytes, so its size does not bound
one task's memory; only members of one group, in different classes after step 3,
are compared with one another, and never two of its largest class.

Cases: null, empty or blank text has no set and links with nothing; equal sets
link; a null doc_id gets a null component; repeated rows of one id are one
document and all returned; of one id with different texts each row is a document
of its own, and its component the smallest id in its class; an empty table gives
an empty result; other columns are ignored (``keep_one`` carries them).
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_slices, fresh, named, sieve, table, tidy
from tidemark.llm.components import components
from tidemark.llm.shingles import shingle_sets
from tidemark.session import discard, materialize

QUERY = "op2_ngram_join"
NUM, DEN = 75, 100

#: Packed shingles held before they are handed on, and documents among these that
#: make a shingle common (the greatest frequency that the global order tells apart).
FLUSH, COMMON = 1_000_000, 170

#: Documents that are compared with one smallest in one task; bytes of the sets in
#: one trie, and members in one task.
PROBES, STORED, MEMBERS = 250, 16 << 20, 2_000

#: Distinct keys up to which a trie's runs are bit masks once all its sets are stored.
MASKED = 1 << 17

#: Groups up to which their sizes (of 16 bytes) are broadcast; a shuffle join beyond.
SMALL = 200_000

_U64, _U32, _U8, _I64, _I32 = np.dtype("<u8"), np.dtype("<u4"), np.dtype("u1"), np.dtype("<i8"), np.dtype("<i4")


def required(a: int, b: int) -> int:
    """Smallest overlap at which sets of sizes a and b link: DEN*o >= NUM*(a+b-o)."""
    return -(-NUM * (a + b) // (NUM + DEN))


def prefix_length(n: int) -> int:
    return n - -(-NUM * n // DEN) + 1


# --- steps 1 and 2: sets in global order -------------------------------------


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, low, high = [], [], []
        for keys in shingle_sets(batch.column("text").to_pylist()):
            n.append(len(keys))
            low.append(int(keys.sum(dtype=_U64).astype(_I64)) if len(keys) else None)
            high.append(int(np.bitwise_xor.reduce(keys * (keys | np.uint64(1))).astype(_I64)) if len(keys) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64())],
            ["doc_id", "n", "f1", "f2"],
        )


def _order_key(df: np.ndarray, low: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The global order: document frequency, then 40 hash bits and the range."""
    return (np.minimum(df, COMMON).astype(_U64) << np.uint64(55)) | (low << np.uint64(15)) | (part % 32768).astype(_U64)


def _postings(parts: int):
    """Packed (hash, document) pairs by hash range: 40 bits of each hash beside
    its range, so a false match costs a candidate at worst. Common shingles leave
    as (count, hash) in ``many`` and as finished keys by document in ``done``."""

    def packed(part, keys, doc, ids, sizes):
        order = np.argsort(part, kind="stable")
        part, keys, doc = part[order], keys[order], doc[order]
        cuts = np.searchsorted(part, np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            own = doc[cuts[p] : cuts[p + 1]]
            heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])  # documents come in order
            of, count = own[heads], np.diff(np.r_[heads, len(own)])
            yield p, ids[of].tobytes(), sizes[of].astype(_I32).tobytes(), count.astype(_I32).tobytes(), keys[cuts[p] : cuts[p + 1]]

    def flush(ids, sets):
        sizes = np.fromiter(map(len, sets), _I64, len(sets))
        keys = np.concatenate(sets)
        doc = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
        ids = np.array(ids, _I64)
        part = ((keys >> np.uint64(40)) % np.uint64(parts)).astype(np.int32)
        low = keys & np.uint64((1 << 40) - 1)
        rows = []
        order = np.argsort(keys)
        heads = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
        count = np.diff(np.r_[heads, len(keys)])
        common = count >= COMMON
        if common.any():
            for p, c, k in zip(part[order[heads[common]]].tolist(), count[common].tolist(), low[order[heads[common]]].tolist(), strict=True):
                rows.append((p, None, None, None, None, None, np.array([c, k], _I64).tobytes(), None))
            is_common = np.zeros(len(keys), bool)
            is_common[order] = np.repeat(common, count)
            finished = _order_key(np.full(int(is_common.sum()), COMMON), low[is_common], part[is_common])
            for p, i, n, c, k in packed((ids[doc[is_common]] % parts).astype(np.int32), finished, doc[is_common], ids, sizes):
                rows.append((p, i, n, c, None, None, None, k.tobytes()))
            part, low, doc = part[~is_common], low[~is_common], doc[~is_common]
        for p, i, n, c, k in packed(part, low, doc, ids, sizes):
            rows.append((p, i, n, c, (k & np.uint64(0xFFFFFFFF)).astype(_U32).tobytes(), (k >> np.uint64(32)).astype(_U8).tobytes(), None, None))
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
            ["part", "ids", "ns", "counts", "lo", "hi", "many", "done"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, held = [], [], 0
        for batch in batches:
            for doc_id, keys in zip(
                batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text").to_pylist()), strict=True
            ):
                if len(keys):
                    ids.append(doc_id)
                    sets.append(keys)
                    held += len(keys)
                if held >= FLUSH:
                    yield flush(ids, sets)
                    ids, sets, held = [], [], 0
        if sets:
            yield flush(ids, sets)

    return run


_POSTINGS = "part int, ids binary, ns binary, counts binary, lo binary, hi binary, many binary, done binary"


def _join(column, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.drop_null().to_pylist()), dtype)


def _shared(parts: int, buckets: int):
    """Of one hash range: the shingles that at least two documents hold, as keys
    of the global order, repacked by document bucket. Finished keys pass."""

    def run(t: pa.Table) -> pa.Table:
        part = t.column("part")[0].as_py()
        finished, open_ = t.filter(pc.is_valid(t.column("done"))), t.filter(pc.is_valid(t.column("lo")))
        ids, ns, counts = _join(open_.column("ids"), _I64), _join(open_.column("ns"), _I32), _join(open_.column("counts"), _I32)
        many = _join(t.column("many"), _I64).reshape(-1, 2)
        low = _join(open_.column("lo"), _U32).astype(_U64) | (_join(open_.column("hi"), _U8).astype(_U64) << np.uint64(32))
        order = np.argsort(low)
        low = low[order]
        heads = np.flatnonzero(np.r_[np.ones(min(1, len(low)), bool), low[1:] != low[:-1]])
        run = np.diff(np.r_[heads, len(low)])
        df = run.copy()
        if len(many) and len(low):  # known to be common elsewhere
            own = low[heads]
            at = np.minimum(np.searchsorted(own, many[:, 1].astype(_U64)), len(own) - 1)
            same = own[at] == many[:, 1].astype(_U64)
            np.add.at(df, at[same], many[same, 0])
        df = np.repeat(df, run)
        keep = df >= 2
        of = np.repeat(np.arange(len(ids), dtype=np.int32), counts)[order[keep]]
        keys = _order_key(df[keep], low[keep], np.full(int(keep.sum()), part))
        del order, low, df, keep
        ids = np.concatenate([ids, _join(finished.column("ids"), _I64)])
        more = _join(finished.column("counts"), _I32)
        of = np.concatenate([of, np.repeat(np.arange(len(more), dtype=np.int32) + len(ns), more)])
        ns = np.concatenate([ns, _join(finished.column("ns"), _I32)])
        keys = np.concatenate([keys, _join(finished.column("done"), _U64)])
        bucket = ids[of] % buckets
        order = np.lexsort((of, bucket))
        bucket, of, keys = bucket[order], of[order], keys[order]
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = []
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            own = of[cuts[b] : cuts[b + 1]]
            heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            docs, count = own[heads], np.diff(np.r_[heads, len(own)])
            rows.append((b, ids[docs].tobytes(), ns[docs].tobytes(), count.astype(_I32).tobytes(), keys[cuts[b] : cuts[b + 1]].tobytes()))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        return pa.table(
            [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
            ["bucket", "ids", "ns", "counts", "keys"],
        )

    return run


def _tidily(run):
    def group(t: pa.Table) -> pa.Table:
        try:
            return run(t)
        finally:
            tidy()

    return group


def _survivors(t: pa.Table) -> pa.Table:
    ids, ns, counts, keys = (
        _join(t.column("ids"), _I64), _join(t.column("ns"), _I32), _join(t.column("counts"), _I32), _join(t.column("keys"), _U64)
    )
    doc, n = np.repeat(ids, counts), np.repeat(ns, counts)
    order = np.lexsort((keys, doc))
    doc, n, keys = doc[order], n[order], keys[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (keys[1:] != keys[:-1])  # repeated rows of one id
    doc, n, keys = doc[fresh], n[fresh], keys[fresh]
    cuts = np.r_[np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]), len(doc)] if len(doc) else np.zeros(1, int)
    out = [
        (int(doc[a]), int(n[a]), keys[a:b].tobytes())
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
        if DEN * (b - a) >= NUM * int(n[a])
    ]
    columns = list(zip(*out, strict=True)) or [[]] * 3
    return pa.table(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())],
        ["doc_id", "n", "keys"],
    )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, keys = [], []
        for doc_id, n, blob in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "n", "keys")], strict=True):
            own = np.frombuffer(blob, _U64)
            head = own[: prefix_length(n) - (n - len(own))].astype(_I64)
            docs.append(np.full(len(head), doc_id, _I64))
            keys.append(head)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(docs or [np.zeros(0, _I64)])), pa.array(np.concatenate(keys or [np.zeros(0, _I64)]))],
            ["doc_id", "key"],
        )


# --- steps 3 and 4: comparing ------------------------------------------------


class Trie:
    """Sets in the global order. A node holds a run of keys, its children by
    their first key, the documents that end there, the least document size and
    greatest set length below it, and the class of all below it if it is one.
    When ``freeze`` has numbered the keys, a run is also a mask of bits."""

    __slots__ = ("run", "children", "ends", "least", "longest", "only", "mask", "keys")

    def __init__(self, run: list[int]):
        self.run, self.children, self.ends = run, {}, []
        self.least, self.longest, self.only = 1 << 62, 0, None
        self.mask, self.keys = 0, None

    def insert(self, keys: list[int], doc_id: int, n: int, of: int) -> None:
        node, at = self, 0
        while True:
            node.only = of if node.least == 1 << 62 or node.only == of else None
            node.least, node.longest = min(node.least, n), max(node.longest, len(keys))
            same = 0
            while same < len(node.run) and at + same < len(keys) and node.run[same] == keys[at + same]:
                same += 1
            if same < len(node.run):  # split: the rest of the run becomes a child
                rest = Trie(node.run[same:])
                rest.children, rest.ends = node.children, node.ends
                below = [(e[1], e[2], e[3]) for e in rest.ends] + [(c.least, c.longest, c.only) for c in rest.children.values()]
                rest.least, rest.longest = min(b[0] for b in below), max(b[1] for b in below)
                rest.only = below[0][2] if len({b[2] for b in below}) == 1 else None
                node.run, node.children, node.ends = node.run[:same], {rest.run[0]: rest}, []
            at += same
            if at == len(keys):
                node.ends.append((doc_id, n, len(keys), of))
                return
            child = node.children.get(keys[at])
            if child is None:
                child = node.children[keys[at]] = Trie(keys[at:])
            node = child

    def _walk(self) -> Iterator[Trie]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(node.children.values())

    def freeze(self) -> None:
        """Numbers the keys in order, if they are few enough for masks; nothing
        is inserted any more."""
        runs = [node.run for node in self._walk() if node.run]
        keys = np.unique(np.concatenate([np.array(r, _U64) for r in runs])) if runs else np.zeros(0, _U64)
        if len(keys) <= MASKED:
            self.keys = keys
            for node in self._walk():
                node.mask = self._bits(node.run, 0)[0]

    def _bits(self, keys: list[int], first: int) -> tuple[int, int]:
        """The mask of those of ``keys`` that are numbered, and of all before ``first``."""
        of = np.array(keys, _U64)
        at = np.searchsorted(self.keys, of)
        at = at[np.take(self.keys, at, mode="clip") == of] if len(self.keys) else at[:0]
        bits = np.zeros(len(self.keys), bool)
        bits[at] = True
        mask = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
        return mask, (1 << int(np.searchsorted(self.keys, np.uint64(first)))) - 1

    def probe(self, keys: list[int], n: int, of: int | None = None, first: int = 0, classes: _Classes | None = None) -> Iterator[int]:
        """Ids of stored documents that link with a set of full size ``n``, but
        for those known to be in class ``of`` (or, by ``classes``, in one joined
        with it) and those that share a key before ``first``."""
        own, below = (set(keys), 0) if self.keys is None else self._bits(keys, first)
        stack, total = [(self, 0, 0)], len(keys)
        while stack:
            node, overlap, depth = stack.pop()
            if of is not None and node.only is not None:
                if node.only == of or (classes is not None and classes.find(node.only) == classes.find(of)):
                    continue
            if run := node.run:
                least = required(n, node.least)
                # at best all that is left of either set, from or behind a key, matches
                if overlap + min(node.longest - depth, total - bisect_left(keys, run[0])) < least:
                    continue
                if self.keys is None:
                    shared = [k for k in run if k in own]
                    if shared and shared[0] < first:
                        continue
                    overlap += len(shared)
                else:
                    shared = node.mask & own
                    if shared & below:
                        continue
                    overlap += shared.bit_count()
                depth += len(run)
                if overlap + min(node.longest - depth, total - bisect_right(keys, run[-1])) < least:
                    continue
            for doc_id, size, _, other in node.ends:
                if DEN * overlap >= NUM * (n + size - overlap) and (of is None or other != of):
                    yield doc_id
            for child in node.children.values():
                stack.append((child, overlap, depth))


class _Classes:
    def __init__(self):
        self.of: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.of.get(root, root)) != root:
            root = up
        while self.of.get(x, x) != root:
            self.of[x], x = root, self.of[x]
        return root

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.of[max(a, b)] = min(a, b)
        return a != b


#: What a row does in its trie: it is stored, it probes, or it probes and is stored.
STORE, PROBE, BOTH = 0, 1, 2


def _trie_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (grp, block, salt, act): the stored sets of a trie come
    first. Emits links that join two classes of the group."""
    group, trie, classes, class_of, frozen = None, None, None, None, False
    for batch in batches:
        u, v = [], []
        columns = [batch.column(c).to_pylist() for c in ("grp", "block", "salt", "act", "doc_id", "of", "first", "n", "keys")]
        for grp, block, salt, act, doc_id, of, first, n, blob in zip(*columns, strict=True):
            if group != (grp, block, salt):
                group, trie, classes, class_of, frozen = (grp, block, salt), Trie([]), _Classes(), {}, False
            keys = np.frombuffer(blob, _U64).tolist()
            own = doc_id if of is None else of
            if act == PROBE and not frozen:  # all that is stored has come
                trie.freeze()
                frozen = True
            if act != STORE:
                for other in trie.probe(keys, n, of, first & 0xFFFFFFFFFFFFFFFF, classes):
                    if other != doc_id and classes.union(own, class_of[other]):
                        u.append(doc_id)
                        v.append(other)
            if act != PROBE:
                class_of[doc_id] = own
                trie.insert(keys, doc_id, n, own)
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _run_tries(rows: DataFrame) -> DataFrame:
    """Links (u, v) of rows (grp, block, salt, act, doc_id, of, first, n, keys)."""
    return (
        rows.repartition("grp", "block", "salt")
        .sortWithinPartitions("grp", "block", "salt", "act", "doc_id")
        .mapInArrow(by_slices(_trie_links), "u long, v long")
    )


def _with_smallest(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among (u, v): v's set in a trie, all its u's run down it."""
    none = F.lit(None).cast("long").alias("of"), F.lit(0).cast("long").alias("first")
    salts = F.ceil(F.count(F.lit(1)) / PROBES).cast("int")
    by = materialize(pairs.groupBy("v").agg(salts.alias("salts")), "op2-smallest")
    own = sets.select("doc_id", "n", "keys")
    block = F.lit(0).alias("block")
    stored = by.join(own, F.col("v") == F.col("doc_id")).select(
        F.col("v").alias("grp"), block, F.explode(F.expr("sequence(0, salts - 1)")).alias("salt"), F.lit(STORE).alias("act"), "doc_id", *none, "n", "keys"
    )
    probes = pairs.join(by, "v").join(own, F.col("u") == F.col("doc_id")).select(
        F.col("v").alias("grp"), block, F.pmod(F.xxhash64("u"), F.col("salts")).cast("int").alias("salt"), F.lit(PROBE).alias("act"), "doc_id", *none, "n", "keys"
    )
    return _run_tries(stored.unionByName(probes))


def _sized(rows: DataFrame, by: list[str]) -> DataFrame:
    """For each group ``by`` of rows (doc_id, of, size): its documents ``c``, its
    largest class ``top``, and the documents outside of that, ``m`` of ``bytes``."""
    classes = rows.groupBy(*by, "of").agg(F.count(F.lit(1)).alias("c"), F.sum("size").alias("bytes"))
    top = F.max(F.struct("c", "of", "bytes"))
    return classes.groupBy(*by).agg(F.sum("c").alias("c"), F.sum("bytes").alias("all_bytes"), top.alias("t")).select(
        *by, "c", "all_bytes", F.col("t.of").alias("top"), (F.col("c") - F.col("t.c")).alias("m"), (F.col("all_bytes") - F.col("t.bytes")).alias("bytes")
    )


def _chains(members: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members (grp, doc_id, of, v) with the root of their chained groups, the sizes
    of groups, and those of chains with how a chain is compared: as one trie where
    it fits into it; beyond, as one group, or apart if that compares fewer pairs."""
    chained = components(members.select(F.col("doc_id").alias("u"), "v"), "op2-chained")
    bytes_of = sets.select("doc_id", F.octet_length("keys").cast("long").alias("size"))
    members = materialize(
        members.join(chained.withColumnRenamed("node", "doc_id"), "doc_id").join(bytes_of, "doc_id").select("root", "grp", "doc_id", "of", "size"), "op2-chained-members"
    )
    groups = materialize(_sized(members, ["root", "grp"]), "op2-sizes-of-groups")
    apart = groups.groupBy("root").agg(F.sum(F.col("c") * F.col("m")).alias("pairs"))
    fits = (F.col("c") <= MEMBERS) & (F.col("all_bytes") <= STORED)
    kind = F.when(fits, "whole").when(F.col("c") * F.col("m") <= F.col("pairs"), "joined").otherwise("apart")
    once = members.select("root", "doc_id", "of", "size").distinct()
    return members, groups, materialize(_sized(once, ["root"]).join(apart, "root").withColumn("kind", kind), "op2-chains")


def _within(members: DataFrame, groups: DataFrame, chains: DataFrame, sets: DataFrame) -> DataFrame:
    """Links across classes of what ``_chains`` returns."""
    sets = sets.select("doc_id", "n", "keys")
    once = members.select("root", "doc_id", "of").distinct()
    zero = F.lit(0)
    columns = ["doc_id", "of", "first", "n", "keys"]
    kinds = chains.select("root", "kind")
    whole = once.join(kinds.filter("kind = 'whole'"), "root").join(sets, "doc_id").withColumn("first", zero.cast("long")).select(
        F.col("root").alias("grp"), zero.alias("block"), zero.alias("salt"), F.lit(BOTH).alias("act"), *columns
    )
    large = kinds.filter("kind <> 'whole'")
    if large.isEmpty():
        return _run_tries(whole)
    # half of the rows of a task are stored, half probe
    blocks = F.greatest(F.ceil(F.col("bytes") / STORED), F.ceil(2 * F.col("m") / MEMBERS)).cast("int").alias("blocks")
    dealt = ["grp", "first", "top", blocks, F.ceil(2 * F.col("c") / MEMBERS).cast("int").alias("salts")]
    of_chain = chains.filter("kind = 'joined'").select(F.col("root").alias("grp"), F.lit(0).cast("long").alias("first"), "top", "bytes", "m", "c")
    of_group = groups.join(kinds.filter("kind = 'apart'"), "root").select("grp", F.col("grp").alias("first"), "top", "bytes", "m", "c")
    size = materialize(of_chain.select(*dealt).unionByName(of_group.select(*dealt)), "op2-dealt")
    rows = once.join(kinds.filter("kind = 'joined'"), "root").select(F.col("root").alias("grp"), F.lit(True).alias("chain"), "doc_id", "of").unionByName(
        members.join(kinds.filter("kind = 'apart'"), "root").select("grp", F.lit(False).alias("chain"), "doc_id", "of")
    )
    size = size.withColumn("chain", F.col("first") == 0)
    rows = rows.join(F.broadcast(size) if size.count() <= SMALL else size, ["grp", "chain"]).join(sets, "doc_id")
    stored = rows.filter("of <> top").select(
        "grp", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.expr("sequence(0, salts - 1)")).alias("salt"), F.lit(STORE).alias("act"), *columns,
    )
    probes = rows.select(
        "grp", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
        F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int").alias("salt"), F.lit(PROBE).alias("act"), *columns,
    )
    return _run_tries(whole.unionByName(stored).unionByName(probes))


# --- the whole join ----------------------------------------------------------


def _spread(in_groups: DataFrame, known: DataFrame, sets: DataFrame) -> tuple[DataFrame, tuple]:
    """The class of each row of ``in_groups``, and the chains of those groups that
    are not within one class; of groups with the same documents the first."""
    of = in_groups.join(known, F.col("doc_id") == F.col("node"), "left").select(
        "key", "doc_id", "v", F.coalesce("root", "doc_id").alias("of")
    )
    of = materialize(of, "op2-of")
    mark = F.xxhash64(F.lit(7), "doc_id")
    keys = (
        of.groupBy("key")
        .agg(F.min("of").alias("a"), F.max("of").alias("b"), F.count(F.lit(1)).alias("c"), F.bit_xor(mark).alias("x"), F.sum(F.shiftrightunsigned(mark, 24)).alias("y"))
        .filter("a <> b")
        .groupBy("c", "x", "y")
        .agg(F.min("key").alias("grp"))
        .select("grp")
    )
    members = materialize(of.join(keys, F.col("key") == F.col("grp")).select("grp", "doc_id", "of", "v"), "op2-members")
    placed = _chains(members, sets)
    discard(members)
    return of, placed


def _classes(sets: DataFrame) -> DataFrame:
    """(node, root) of every document of ``sets`` that links with another."""
    prefixes = sets.mapInArrow(by_slices(_prefixes), "doc_id long, key long")
    stars = prefixes.groupBy("key").agg(F.min("doc_id").alias("v"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    in_groups = materialize(prefixes.join(stars, "key"), "op2-groups")
    pairs = materialize(in_groups.filter("doc_id <> v").select(F.col("doc_id").alias("u"), "v").distinct(), "op2-pairs")
    reached = materialize(_with_smallest(pairs, sets), "op2-reached")
    known = components(reached, "op2-known")
    of, placed = _spread(in_groups, known, sets)
    links = reached.unionByName(_within(*placed, sets))
    out = components(links, "op2-classes")
    discard(in_groups, pairs, reached, of, *placed)
    return out


def _join_rows(texts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of rows whose ids tell their texts apart."""
    spark = texts.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    same = ["n", "f1", "f2"]
    heads = materialize(
        sizes.filter("n > 0 and doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("rep")), "op2-heads"
    )
    sets = (
        texts.filter("doc_id is not null")
        .mapInArrow(by_slices(_postings(parts)), _POSTINGS)
        .groupBy("part")
        .applyInArrow(_tidily(_shared(parts, parts)), "bucket int, ids binary, ns binary, counts binary, keys binary")
        .groupBy("bucket")
        .applyInArrow(_tidily(_survivors), "doc_id long, n long, keys binary")
        .join(heads.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    )
    sets = materialize(sets, "op2-sets")
    classes = _classes(sets)
    discard(sets)
    rep = heads.select(*[F.col(c).alias(f"r_{c}") for c in same], "rep")
    on = [F.col(c) == F.col(f"r_{c}") for c in same]
    known = F.col("doc_id").isNotNull()
    return (
        sizes.join(rep, on, "left")
        .join(classes, F.col("rep") == F.col("node"), "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(known, F.coalesce("root", "rep", "doc_id")).alias("component_id"),
        )
    )


def ngram_join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sizes = materialize(texts.mapInArrow(by_slices(_sizes), "doc_id long, n long, f1 long, f2 long"), "op2-sizes")
    shape = F.struct("n", "f1", "f2")
    torn = sizes.filter("doc_id is not null").groupBy("doc_id").agg((F.min(shape) != F.max(shape)).alias("torn"))
    if torn.agg(F.coalesce(F.bool_or("torn"), F.lit(False))).first()[0]:
        discard(sizes)
        return _by_row(texts)[1].select(F.col("__id").alias("doc_id"), "n_shingles", "component_id")
    return _join_rows(texts, sizes)


def _by_row(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with a row number, and (row, __id, n_shingles, class, component_id) of
    each row: rows are the documents, and ids only name the classes."""
    row = fresh("__row", docs)
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "op2-rows")
    texts = rows.select(named(row).alias("doc_id"), F.col("text").cast("string").alias("text"))
    sizes = materialize(texts.mapInArrow(by_slices(_sizes), "doc_id long, n long, f1 long, f2 long"), "op2-sizes")
    ids = rows.select(named(row).alias("row"), F.col("doc_id").cast("long").alias("__id"))
    joined = _join_rows(texts, sizes).select(F.col("doc_id").alias("of_row"), "n_shingles", F.col("component_id").alias("class"))
    joined = materialize(joined.join(ids, F.col("of_row") == F.col("row")).drop("of_row"), "op2-joined")
    least = joined.groupBy("class").agg(F.min("__id").alias("least"))
    out = joined.join(least, "class").withColumn("component_id", F.when(F.col("__id").isNotNull(), F.col("least"))).drop("least")
    return rows, out


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: the one with its smallest id, a row
    without an id only where no other has one. Classes are of rows, so repeated
    rows and two texts of one id are told apart. Rows without words are a class
    for each id, those without an id one more."""
    rows, joined = _by_row(docs)
    row, gone = rows.columns[-1], fresh("__gone", rows)
    words = F.col("n_shingles") > 0
    first = F.min(F.struct(F.col("__id").isNull(), F.col("__id"), F.col("row").alias("row")))
    heads = (
        joined.groupBy(F.when(words, F.col("class")).alias("class"), F.when(~words, F.col("__id")).alias("id"))
        .agg(first.alias("first"))
        .select(F.col("first.row").alias("stays"))
    )
    removed = materialize(joined.join(heads, F.col("row") == F.col("stays"), "left_anti").select(F.col("row").alias(gone)), "op2-removed")
    # only texts that may go are shuffled to meet the list of those that do
    marked, clear = sieve(rows, F.xxhash64(F.lit(2), named(row)), removed.select(F.xxhash64(F.lit(2), F.col(gone)).alias("h")))
    kept = marked.join(removed, named(row) == F.col(gone), "left_anti").unionByName(clear)
    return kept.select(*map(named, docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


ORACLE_SQL = None
