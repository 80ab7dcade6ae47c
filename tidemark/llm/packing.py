"""Cost-balanced packing of documents into fixed-length token sequences.

Documents are tokenised and packed where they are read: nothing is shuffled,
and a task holds at most ``held`` tokens (or one document) at a time. Of what is
held, full-length pieces make their own sequences; the remainders go in
descending order to the sequence of lowest estimated cost (linear in tokens plus
quadratic in each piece, for attention within it) that has room. A remainder
that fits into no sequence is cut at the lowest. The number of open sequences is
the least possible, so what is held leaves under one sequence of padding: under
one for each ``held`` tokens, and one more for each task.

Words are tokenised once and remembered: the tokenizer never joins what white
space separates. The memory is bounded by bytes: of two generations of ``memory``
bytes the older is forgotten when the newer is full.

Cases: null or empty text is the end id alone; a null doc_id is carried; ties
keep the order in which rows are read; repeated rows are packed separately;
an empty table gives an empty result; other columns are ignored. A task that
runs again gives the same rows, as ids come from its partition and order.
"""

from __future__ import annotations

import heapq
import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_slices, table

QUERY = "op6_packing"
LENGTH, END = 2048, 1
HELD, MEMORY = 4_000_000, 96 << 20

#: Cost of a piece of n tokens: n + n * n / QUADRATIC.
QUADRATIC = 1024.0

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


class Memory:
    """A map of two generations, each of at most ``limit`` bytes by estimate:
    what is not asked for while a generation fills is forgotten."""

    def __init__(self, limit: int):
        self.limit, self.size, self.new, self.old = limit, 0, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None and self.old and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        self.size += 200 + len(key) + len(value)  # two objects and their slot
        if self.size > self.limit:
            self.old, self.new, self.size = self.new, {}, 0
        self.new[key] = value


#: The pre-tokenizer's pattern and normalizer for which words can be cut here.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]


class WordTokenizer:
    """Little-endian uint32 ids of texts, by a tokenizer whose tokens never span white space.

    Unknown words are normalised, cut and given to the tokenizer's model piece
    by piece. Words of printable Latin letters (up to U+024F, where NFC changes
    nothing) are cut with the tokenizer's own pattern; others go to it whole."""

    def __init__(self, path: str, memory: int = MEMORY):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            setup = json.load(f)
        normal, cut = setup.get("normalizer") or {}, (setup.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.plain = [n["type"] for n in normal.get("normalizers", [])] == _NORMALIZERS and [c.get("type") for c in cut] == ["Split", "ByteLevel"]
        self.plain = self.plain and cut[0]["pattern"] == {"Regex": _PATTERN}
        self.special = [t["content"] for t in setup.get("added_tokens", [])]
        self.cut = regex.compile(_PATTERN).findall
        # the byte-level alphabet, in which printable ASCII stands for itself
        seen = iter(range(256, 512))
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = [chr(b) if b in shown else chr(next(seen)) for b in range(256)]
        self.seen = Memory(memory)  # words as bytes, pieces of words as strings

    def _piece(self, piece: str) -> bytes:
        found = self.seen.get(piece)
        if found is None:
            spelled = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
            found = array("I", [t.id for t in self.tokenizer.model.tokenize(spelled)]).tobytes()
            self.seen.put(piece, found)
        return found

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if not self.plain or "<|" in text and any(s in text for s in self.special) or not (text.isprintable() and max(text) <= "\u024f"):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        text = text.lower()
        if text.isalpha():
            return self._piece(text)
        if text[-1] in ".,;:!?" and text[:-1].isalpha():
            return self._piece(text[:-1]) + self._piece(text[-1])
        return b"".join(map(self._piece, self.cut(text)))

    def ids(self, text: str | None) -> bytes:
        words = (text or "").encode("utf-8", "replace").split()  # ASCII white space only
        got, at = list(map(self.seen.new.get, words)), -1
        try:
            while True:
                at = got.index(None, at + 1)
                word = words[at]
                found = self.seen.get(word)
                if found is None:
                    found = self._word(word)
                    self.seen.put(word, found)
                got[at] = found
        except ValueError:  # no word is missing
            return b"".join(got)


def assign(lengths: list[int], room: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(item, start, length, sequence, offset) for every piece of every item."""
    pieces, rest, n = [], [], 0
    for item, size in enumerate(lengths):
        full = size // room
        for k in range(full):
            pieces.append((item, k * room, room, n, 0))
            n += 1
        if size % room:
            rest.append((size % room, item, full * room))
    rest.sort(key=lambda r: (-r[0], r[1]))
    total = sum(r[0] for r in rest)
    used = [0] * (-(-total // room))
    # ``open_`` has the sequences of each free space by cost, ``tree`` the least
    # (cost, sequence) of the free spaces below each node
    width = 1 << room.bit_length()
    none = (float("inf"), -1)
    open_: list[list[tuple[float, int]]] = [[] for _ in range(room + 1)]
    tree = [none] * (2 * width)

    def refresh(space: int) -> None:
        k = width + space
        tree[k] = open_[space][0] if open_[space] else none
        while k > 1:
            k >>= 1
            a, b = tree[2 * k], tree[2 * k + 1]
            best = a if a <= b else b
            if best is tree[k]:
                break
            tree[k] = best

    def cheapest(size: int) -> tuple[float, int]:
        """Of the sequences with at least ``size`` free."""
        best, k = none, width + size
        if tree[k] < best:
            best = tree[k]
        while k > 1:
            if not k & 1 and tree[k + 1] < best:
                best = tree[k + 1]
            k >>= 1
        return best

    open_[room] = [(0.0, s) for s in range(len(used))]
    refresh(room)
    for size, item, start in rest:
        while size:
            cost, s = cheapest(size)
            if s < 0:
                cost, s = tree[1]
            space = room - used[s]
            take = min(size, space)
            pieces.append((item, start, take, n + s, used[s]))
            used[s] += take
            heapq.heappop(open_[space])  # the cheapest of its space
            refresh(space)
            if take < space:
                heapq.heappush(open_[space - take], (cost + take + take * take / QUADRATIC, s))
                refresh(space - take)
            start, size = start + take, size - take
    return pieces


def _binary(parts: list[memoryview]) -> pa.Array:
    """The parts as one Arrow buffer: joined once."""
    ends = np.cumsum([0, *map(len, parts)]).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(parts))])


def _packer(path: str, room: int, end: int, with_ids: bool, held_tokens: int, memory: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, tail = WordTokenizer(path, memory), np.array([end], "<u4").tobytes()
        base = TaskContext.get().partitionId() << 40
        names, held, size, first = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal names, held, size, first
            lengths = [len(x) // 4 for x in held]
            rows = assign(lengths, room)
            cut = [memoryview(held[i])[4 * start : 4 * (start + n)] for i, start, n, _, _ in rows]
            columns = [
                pa.array([names[r[0]] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.int64()),
                pa.array(list(map(zlib.crc32, cut)), pa.int64()),
                pa.array([lengths[r[0]] for r in rows], pa.int64()),
                pa.array([base + first + r[3] for r in rows], pa.int64()),
                pa.array([r[4] for r in rows], pa.int64()),
                _binary(cut) if with_ids else pa.nulls(len(rows), pa.binary()),
            ]
            first += 1 + max((r[3] for r in rows), default=-1)
            names, held, size = [], [], 0
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held.append(tokenizer.ids(text) + tail)
                names.append(doc_id)
                size += len(held[-1]) // 4
                if size >= held_tokens:
                    yield flush()
        if held:
            yield flush()

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = LENGTH,
    end: int = END,
    with_ids: bool = True,
    held: int = HELD,
    memory: int = MEMORY,
) -> DataFrame:
    """A row for each piece; ``ids`` (uint32, little-endian) with ``with_ids``.
    ``held`` tokens are balanced together, ``memory`` bounds what a worker remembers."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = texts.mapInArrow(by_slices(_packer(tokenizer, length, end, with_ids, held, memory)), SCHEMA)
    return out if with_ids else out.drop("ids")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer(), with_ids=False)


ORACLE_SQL = None
