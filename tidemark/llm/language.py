"""Language identification by hyperdimensional profiles.

Every letter has a random +-1 vector. A trigram's vector binds (multiplies) its
letters' vectors, each permuted (rolled) by its place; a text's vector bundles
(sums) its trigrams' vectors; a language's prototype bundles its documents'
normalised vectors. What all languages share is taken off the prototypes, and
texts are compared with them by cosine.

Prototypes are learned from at most ``SAMPLE`` labelled documents, those of
smallest id hash among the training folds (a documented bound: the model has
``DIM`` numbers a language); partial sums are taken where the texts are.
Prediction is one narrow pass.

Cases: null text, or text without a letter, is ``und`` with score 0; ties go to
the language first by name; documents without a language teach nothing; rows of
one id teach once, by the least language and text; no labels at all predict
``und``; repeated rows are all returned; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fold_of, hash_sample, held_out, table

QUERY = "op9_language_id"
DIM, SEED, SAMPLE, CHUNK = 1024, 20_023, 20_000, 64

#: Trigram vectors kept by a worker; others are made when needed.
KEPT = 40_000

_OTHER = re.compile(r"[\W\d_]+")


def letters_of(text: str | None) -> str:
    """The letters of a text in lower case, words set apart by one blank. Word
    characters that are no letters (such as fractions) set words apart too."""
    words = _OTHER.sub(" ", (text or "").lower())
    if not (words.isascii() or words.replace(" ", "").isalpha()):
        words = "".join(c if c.isalpha() else " " for c in words)
    return " ".join(words.split())


class Encoder:
    """Text vectors; deterministic for a seed."""

    def __init__(self, dim: int = DIM, seed: int = SEED):
        self.dim, self.seed = dim, seed
        self.letters: dict[int, np.ndarray] = {}
        self.row: dict[int, int] = {}
        self.kept = np.zeros((0, dim), np.int8)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) > 20_000:
                self.letters.clear()
            self.letters[code] = np.random.default_rng([self.seed, code]).integers(0, 2, self.dim, dtype=np.int8) * 2 - 1
        return self.letters[code]

    def _vector(self, key: int) -> np.ndarray:
        a, b, c = (self._letter((key >> s) & 0x1FFFFF) for s in (42, 21, 0))
        return np.roll(a, 2) * np.roll(b, 1) * c

    def _vectors(self, keys: np.ndarray) -> np.ndarray:
        names = keys.tolist()
        fresh = [k for k in names if k not in self.row]
        if fresh and len(self.row) + len(fresh) > KEPT:
            self.row, self.kept, fresh = {}, np.zeros((0, self.dim), np.int8), names
        if fresh:
            n = len(self.row)
            self.row.update({k: n + i for i, k in enumerate(fresh)})
            if len(self.row) > len(self.kept):
                grown = np.zeros((max(2 * len(self.kept), len(self.row), 4096), self.dim), np.int8)
                grown[:n] = self.kept[:n]
                self.kept = grown
            for i, k in enumerate(fresh):
                self.kept[n + i] = self._vector(k)
        return self.kept[[self.row[k] for k in names]]

    @staticmethod
    def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(keys, counts) of the trigrams of the letters, words set apart."""
        letters = letters_of(text).strip()
        if not letters:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        code = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        if len(code) < 3:
            code = np.pad(code, (0, 3 - len(code)), constant_values=32)
        return np.unique((code[:-2] << np.uint64(42)) | (code[1:-1] << np.uint64(21)) | code[2:], return_counts=True)

    def encode(self, texts: list[str | None]) -> np.ndarray:
        """A unit row for each text; a zero row where there is no letter."""
        out = np.zeros((len(texts), self.dim), np.float32)
        for first in range(0, len(texts), CHUNK):
            grams = [self.trigrams(t) for t in texts[first : first + CHUNK]]
            keys, at = np.unique(np.concatenate([g[0] for g in grams]), return_inverse=True)
            if not len(keys):
                continue
            row = np.repeat(np.arange(len(grams)), [len(g[0]) for g in grams])
            counts = np.zeros((len(grams), len(keys)), np.float32)
            counts[row, at] = np.concatenate([g[1] for g in grams])
            for k in range(0, len(keys), 8192):
                out[first : first + CHUNK] += counts[:, k : k + 8192] @ self._vectors(keys[k : k + 8192]).astype(np.float32)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)


def _bundle(dim: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sums = Encoder(dim, seed), {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for k in range(0, len(texts), 1024):
                for lang, v in zip(langs[k : k + 1024], encoder.encode(texts[k : k + 1024]), strict=True):
                    sums[lang] = sums.get(lang, 0.0) + v.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["lang", "sum"]
        )

    return run


def train(docs: DataFrame, sample: int = SAMPLE, dim: int = DIM, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """(languages, unit prototypes). At most ``sample`` documents teach."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.coalesce(fold_of() != 0, F.lit(False)))
    ids = hash_sample(labelled.select("doc_id"), sample, seed).select(F.col("doc_id").alias("__id")).distinct()
    # at most ``sample`` ids of eight bytes; a hot id is one row a task before it is shuffled
    rows = labelled.join(F.broadcast(ids), F.col("doc_id") == F.col("__id"), "left_semi")
    once = rows.groupBy("doc_id").agg(F.min(F.struct(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))).alias("r"))
    chosen = once.select("r.lang", "r.text", F.xxhash64("doc_id").alias("at"))
    sums: dict[str, np.ndarray] = {}
    for lang, part in (
        chosen.repartition(12, "at").mapInArrow(_bundle(dim, seed), "lang string, sum binary").orderBy("lang", "sum").collect()
    ):
        sums[lang] = sums.get(lang, 0.0) + np.frombuffer(part, np.float64)
    if not sums:
        return [], np.zeros((0, dim))
    langs = sorted(sums)
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    prototypes = unit(np.array([sums[x] for x in langs]))
    return langs, unit(prototypes - prototypes.mean(0)) if len(langs) > 1 else prototypes


def _predictor(langs: list[str], prototypes: np.ndarray, dim: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, weights = Encoder(dim, seed), prototypes.T.astype(np.float32)
        for batch in batches:
            texts, names, scores = batch.column("text").to_pylist(), [], []
            for k in range(0, len(texts), 1024):
                vectors = encoder.encode(texts[k : k + 1024])
                cosines = np.round((vectors @ weights).astype(np.float64), 5) if langs else np.zeros((len(vectors), 1))
                for v, c in zip(vectors, cosines, strict=True):
                    known = bool(langs) and bool(v.any())
                    names.append(langs[int(c.argmax())] if known else "und")
                    scores.append(float(np.clip((1 + c.max()) / 2, 0, 1)) if known else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], dim: int = DIM, seed: int = SEED) -> DataFrame:
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return texts.mapInArrow(_predictor(*model, dim, seed), "doc_id long, held_out boolean, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))


ORACLE_SQL = None
