"""Mappings proposed from a stream: votes are kept by micro-batch and merged when they are asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from jsonflow.operators.decode import decode
from jsonflow.operators.infer import merge_votes, path_votes


def keep(messages: DataFrame, folder: str, checkpoint: str, value_col: str = "value", **trigger) -> StreamingQuery:
    """Start a query that writes the votes of each micro-batch, one row a path, to a folder of its own.

    A batch that is repeated after a failure replaces its folder, so each message votes once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        path_votes(decode(batch, value_col)).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    stream = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return stream.trigger(**trigger).start() if trigger else stream.start()


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The votes of all batches so far, merged; ``infer.propose`` makes a mapping of them."""
    return merge_votes(spark.read.parquet(folder).drop("batch"))
