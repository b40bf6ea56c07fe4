"""Message sources: anything Spark reads that has a message column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonflow.plans.spec import SourceSpec

# Kafka columns handed on next to the message, for ordering, sampling and dedup.
KAFKA_COLUMNS = ("topic", "partition", "offset", "timestamp")

# Sources of files, and how much of their backlog a micro-batch takes at once.
FILE_FORMATS = ("text", "json", "csv", "parquet", "orc", "xml")
MOST_BYTES = str(10 << 30)


def kafka_batch_options(source: SourceSpec) -> dict[str, str]:
    """The whole topic, unless the source says where to start and end."""
    return {"startingOffsets": "earliest", "endingOffsets": "latest", **source.options}


def kafka_stream_options(source: SourceSpec, rows_per_trigger: int | None = None) -> dict[str, str]:
    """From the newest message on, unless the source says where to start. A stream has no end, and takes none."""
    options = {"startingOffsets": "latest", **source.options}
    options.pop("endingOffsets", None)
    if rows_per_trigger:
        options.setdefault("maxOffsetsPerTrigger", str(rows_per_trigger))
    return options


def read_messages(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """The whole source as a batch; a Kafka topic from its oldest to its newest message."""
    if source.format == "kafka":
        return _kafka(spark.read.format("kafka").options(**kafka_batch_options(source)).load())
    if source.table:
        return _named(spark.read.options(**source.options).table(source.table), source)
    reader = spark.read.format(source.format).options(**source.options)
    reader = reader.schema(source.schema) if source.schema else reader
    return _named(reader.load(source.path), source)


def stream_messages(
    spark: SparkSession, source: SourceSpec, rows_per_trigger: int | None = None
) -> DataFrame:
    """The source as a stream; a Kafka job that starts anew begins at the newest message.

    ``rows_per_trigger`` bounds a micro-batch on Kafka. File sources take ``maxFilesPerTrigger``
    or ``maxBytesPerTrigger`` among their options; without either, ``MOST_BYTES`` bounds them.
    """
    if source.format == "kafka":
        return _kafka(spark.readStream.format("kafka").options(**kafka_stream_options(source, rows_per_trigger)).load())
    if source.table:
        return _named(spark.readStream.options(**source.options).table(source.table), source)
    options = dict(source.options)
    if source.format in FILE_FORMATS and not {"maxfilespertrigger", "maxbytespertrigger"} & {k.lower() for k in options}:
        options["maxBytesPerTrigger"] = MOST_BYTES
    reader = spark.readStream.format(source.format).options(**options)
    reader = reader.schema(source.schema) if source.schema else reader
    return _named(reader.load(source.path), source)


def _kafka(df: DataFrame) -> DataFrame:
    return df.select(F.col("value").cast("string").alias("value"), *KAFKA_COLUMNS)


def _named(df: DataFrame, source: SourceSpec) -> DataFrame:
    """Call the message column ``value``; a column that had the name before gives way."""
    if source.value == "value":
        return df
    return df.drop("value").withColumnRenamed(source.value, "value")


def spread(df: DataFrame, min_partitions: int) -> DataFrame:
    """Give a batch source at least ``min_partitions`` tasks.

    Parsing is the costly part, so a source of few splits (one small file) leaves cores
    idle. Sources with enough splits, which is any large one, are left alone: no shuffle.
    """
    if df.rdd.getNumPartitions() >= min_partitions:
        return df
    return df.repartition(min_partitions)
