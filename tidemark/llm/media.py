"""Media columns: payloads as lossless WebP, and features of their pixels.

The payload of a text (UTF-8, padded with spaces to a positive multiple of 192)
is stored as rows of 192 grey samples (``webp.encode_grey``); more than 16,384
rows make further files, one behind the other. Rows are handled where they are read, one at a time.

Cases: null or empty text is a payload of 192 spaces; a null doc_id is carried;
equal texts give equal values; repeated rows are all returned; an empty table
gives an empty result; other columns are ignored. Damaged media raise an error.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import webp
from tidemark.llm.common import table

QUERY = "op4_media_webp"
ROW = 192


def payload_of(text: str | None) -> tuple[bytes, int]:
    """(padded bytes, bytes of the text)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + b" " * (max(ROW, -(-len(data) // ROW) * ROW) - len(data)), len(data)


def store(payload: bytes) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    return b"".join(webp.encode_grey(rows[k : k + webp.MAX_SIDE]) for k in range(0, len(rows), webp.MAX_SIDE))


def load(media: bytes) -> np.ndarray:
    """Samples (rows, columns) of all files in ``media``."""
    return np.concatenate([webp.samples_of(webp.decode(f)) for f in webp.files(media)])


def feature(samples: np.ndarray) -> str:
    """Mean, deviation and entropy of the samples, and how much neighbours differ."""
    n = samples.size
    share = np.bincount(samples.ravel(), minlength=256) / n
    at = np.arange(256)
    mean = float((share * at).sum())
    spread = float((share * (at - mean) ** 2).sum()) ** 0.5
    entropy = float(-(share[share > 0] * np.log2(share[share > 0])).sum())
    flat = samples.ravel().astype(np.int16)
    steps = float(np.abs(np.diff(flat)).mean())
    return f"{mean:.6f};{spread:.6f};{entropy:.6f};{steps:.6f}"


def _digest(text: str | None) -> tuple:
    payload, n = payload_of(text)
    media = store(payload)
    samples = load(media)
    back = samples.tobytes()
    return (
        n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media),
        hashlib.sha256(media).hexdigest(), feature(samples),
    )


_DIGEST = [
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()),
    ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()),
]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_digest(t) for t in batch.column("text").to_pylist()]
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, kind) for c, (_, kind) in zip(columns, _DIGEST[1:], strict=True)]],
            [name for name, _ in _DIGEST],
        )


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        media = [store(payload_of(t)[0]) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(media, pa.binary())], ["doc_id", "media"])


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for media in batch.column("media").to_pylist():
            images = [webp.decode(f) for f in webp.files(media)] if media else []
            rows.append([{"height": x.shape[0], "width": x.shape[1], "argb": x.astype("<u4").tobytes()} for x in images])
        kind = pa.list_(pa.struct([("height", pa.int32()), ("width", pa.int32()), ("argb", pa.binary())]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "images"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def to_media(docs: DataFrame) -> DataFrame:
    """(doc_id, media): each text's payload as WebP."""
    return _texts(docs).mapInArrow(_encoded, "doc_id long, media binary")


def to_pixels(media: DataFrame) -> DataFrame:
    """(doc_id, images): pixel arrays of a ``media`` column of any lossless WebP."""
    return media.select(F.col("doc_id").cast("long").alias("doc_id"), "media").mapInArrow(
        _decoded, "doc_id long, images array<struct<height:int,width:int,argb:binary>>"
    )


def media_digests(docs: DataFrame) -> DataFrame:
    """Stores each payload, reads it back and describes both."""
    return _texts(docs).mapInArrow(
        _digests,
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digests(table(spark, sf_dir, "documents"))


ORACLE_SQL = None
