"""Micro-batch landing of parsed records with Structured Streaming.

Offsets are logged before a batch and committed after it is written, so a crash
replays the batch: delivery is at least once, and silver collapses repeats.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.sources.scan import land

BATCH_RECORDS, BATCH_SECONDS = 500, 60


def read_topic(spark: SparkSession, servers: str, topic: str, max_records: int = BATCH_RECORDS) -> DataFrame:
    """A Kafka topic from its start, at most ``max_records`` a batch (needs the
    Kafka connector on the class path)."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "maxOffsetsPerTrigger": str(max_records)}
    return spark.readStream.format("kafka").options(**options).load()


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    """Batch write of (key, value)."""
    df.selectExpr("CAST(key AS BINARY) AS key", "value").write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic}
    ).save()


def read_files(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet", max_files: int = 100) -> DataFrame:
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", max_files).load(path)


def start_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    parse: Callable[[DataFrame], DataFrame] | None = None,
    seconds: int | None = BATCH_SECONDS,
    max_records: int = 1_000_000,
    publish: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Lands each batch under the day on which it is written. A batch is written
    by age, and within it a file whenever ``max_records`` are full; the source's
    cap bounds a batch. ``publish`` gets the parsed rows after they have landed,
    so a crash between repeats them. ``seconds=None`` drains what is there and
    stops. Each consumer has its own checkpoint."""

    def write(batch: DataFrame, _batch_id: int) -> None:
        rows = parse(batch) if parse else batch
        if not rows.isEmpty():
            land(rows, path, max_records=max_records)
            if publish:
                publish(rows)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def distinct_within(stream: DataFrame, keys: list[str], event_time: str, delay: str = "1 day") -> DataFrame:
    """Repeats of a key within the delay are dropped; state older than it goes."""
    typed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return typed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
