"""A bounded sample of a topic, without reading the topic."""

from __future__ import annotations

import time
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from jsonflow.operators.sample import DEFAULT_SAMPLE
from jsonflow.plans.spec import SourceSpec
from jsonflow.sources.readers import stream_messages

POLL_SECONDS = 0.1


def from_oldest(source: SourceSpec) -> SourceSpec:
    """A sample is of the oldest messages, wherever the job itself is to start."""
    if source.format != "kafka":
        return source
    return replace(source, options={**source.options, "startingOffsets": "earliest"})


def sample_topic(
    spark: SparkSession, source: SourceSpec, n: int, folder: str, timeout: float = 15.0
) -> DataFrame:
    """The ``n`` oldest messages that a topic gives within ``timeout`` seconds.

    A streaming query from the oldest offsets runs until ``n`` messages have come or the time
    is over; what has come by then counts. On Kafka a micro-batch is bounded to ``n`` messages,
    shared out among the partitions, so little more than the sample is read, and no consumer
    group is left behind. Every call starts afresh in a folder of its own below ``folder``.
    """
    n = n if n > 0 else DEFAULT_SAMPLE
    messages = stream_messages(spark, from_oldest(source), rows_per_trigger=n)
    root = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    order = [c for c in ("partition", "offset") if c in messages.columns]
    taken: dict[int, int] = {}

    def keep(batch: DataFrame, batch_id: int) -> None:
        missing = n - sum(k for b, k in taken.items() if b != batch_id)
        if missing > 0:
            target = f"{root}/sample/batch_id={batch_id}"
            (batch.orderBy(*order) if order else batch).limit(missing).write.mode("overwrite").parquet(target)
            taken[batch_id] = spark.read.schema(batch.schema).parquet(target).count()

    query = messages.writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint").start()
    deadline = time.monotonic() + timeout
    while sum(taken.values()) < n and query.isActive and time.monotonic() < deadline:
        time.sleep(POLL_SECONDS)
    query.stop()
    if query.exception():
        raise query.exception()
    if not taken:
        return spark.createDataFrame([], messages.schema)
    sampled = spark.read.schema(messages.schema).parquet(f"{root}/sample").select(*messages.columns)
    return (sampled.orderBy(*order) if order else sampled).limit(n)
