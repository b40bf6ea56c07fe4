"""Run statistics from the run log, one row per flushed batch or error.

Log rows are ``job, batch_id, rows, at, seconds, error``: ``error`` is NULL for a batch
that was inserted, else the kind of error (``insert`` or ``source``) with ``message``.
Every report is one grouping with map-side reduction, so a job that wrote most of the log
costs its group no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_SCHEMA = (
    "job string, batch_id long, rows long, at timestamp, "
    "seconds double, error string, message string"
)

# Upper bounds of the latency buckets, in seconds.
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def inserted(log: DataFrame) -> DataFrame:
    return log.filter(F.col("error").isNull())


def totals(log: DataFrame) -> DataFrame:
    """Batches and rows inserted per job."""
    return inserted(log).groupBy("job").agg(
        F.count("*").alias("batches_total"), F.sum("rows").alias("rows_total")
    )


def latency_histogram(log: DataFrame) -> DataFrame:
    """Cumulative counts of insert latencies: ``job, le, count``; ``+Inf`` counts all."""
    bounds = [*LATENCY_BUCKETS, float("inf")]
    counts = inserted(log).groupBy("job").agg(
        *[F.count_if(F.col("seconds") <= b).alias(f"_{i}") for i, b in enumerate(bounds)]
    )
    names = ["+Inf" if b == float("inf") else f"{b:g}" for b in bounds]
    buckets = F.array(
        *[F.struct(F.lit(n).alias("le"), F.col(f"_{i}").alias("count")) for i, n in enumerate(names)]
    )
    return counts.select("job", F.inline(buckets))


def error_counts(log: DataFrame) -> DataFrame:
    """Errors per job and kind."""
    failed = log.filter(F.col("error").isNotNull())
    return failed.groupBy("job", F.col("error").alias("kind")).agg(F.count("*").alias("errors"))


def status(log: DataFrame) -> DataFrame:
    """Total rows, last batch, its time and the last error per job."""
    ok = F.col("error").isNull()
    order = F.struct("at", "batch_id")
    return log.groupBy("job").agg(
        F.coalesce(F.sum(F.when(ok, F.col("rows"))), F.lit(0)).alias("total_rows"),
        F.max_by(F.when(ok, F.col("rows")), F.when(ok, order)).alias("last_batch"),
        F.max(F.when(ok, F.col("at"))).alias("last_batch_at"),
        F.max_by(F.col("message"), F.when(~ok, order)).alias("last_error"),
    )


def job_list(specs: DataFrame, log: DataFrame) -> DataFrame:
    """Every registered job with its totals; zero for those that never ran.

    ``specs`` has ``id, name, description``.
    """
    per_job = status(log).withColumnRenamed("job", "id")
    return specs.join(per_job, "id", "left").withColumn(
        "total_rows", F.coalesce("total_rows", F.lit(0))
    )
