"""What the operators of this folder share."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonflow.session import prepare, shared_dir

# Words are runs of anything but these six ASCII blanks.
BLANKS = r"[\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: Python gets a bounded number of bytes at a time, as
    texts may be long, and many rows where they are short."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone: whatever else the input is called, it cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def as_row(docs: DataFrame, leave: str | None = None) -> Column:
    """All columns as one struct ``row``, which no name of an operator's own can clash with.

    ``leave`` names a column whose values travel elsewhere; it stays behind.
    """
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != leave]).alias("row")


def from_row(df: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` out of ``row``, some of them changed."""
    return df.select(*[(changed[c] if c in changed else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows as a table in the folder all executors share; lineage ends here."""
    path = f"{folder or shared_dir(df.sparkSession)}/{'t'}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """A fifth of all documents, chosen by id, from which no label is ever learnt."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def learnable(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """``doc_id, label``: at most ``rows`` labelled rows outside the held-out fifth, in hash order."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
