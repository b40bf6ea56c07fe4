"""Target tables and appending to them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonflow.functions.coerce import target_type
from jsonflow.plans.spec import Field, SinkSpec, quoted
from jsonflow.streaming.latest import LatestTable


def table_name(name: str) -> str:
    """``db.table`` with each part quoted."""
    parts = [p.strip() for p in name.split(".")]
    if not name.strip() or not all(parts):
        raise ValueError("table name required")
    return ".".join(quoted(p) for p in parts)


def create_table(
    spark: SparkSession,
    table: str,
    columns: Iterable[tuple[str, str]],
    format: str = "parquet",
    location: str | None = None,
) -> bool:
    """Create a table from ``(name, declared type)`` pairs; False if it is there already."""
    name, columns = table_name(table), list(columns)
    if not columns:
        raise ValueError("at least one column is required to create a table")
    if spark.catalog.tableExists(name):
        return False
    listed = ", ".join(f"{quoted(c)} {target_type(t).ddl}" for c, t in columns)
    at = " LOCATION '{}'".format(location.replace("'", "\\'")) if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({listed}) USING {format}{at}")
    return True


def ensure_table(spark: SparkSession, sink: SinkSpec, mapping: Sequence[Field]) -> None:
    """Create the sink's table from the mapping, if the sink asks for it."""
    if sink.table and sink.create_if_missing:
        columns = [(m.column, m.type) for m in mapping]
        create_table(spark, sink.table, columns, sink.format, sink.path)


def target_columns(spark: SparkSession, table: str) -> DataFrame:
    """``name, type, position`` of a table's columns, in order."""
    name = table_name(table)
    if not spark.catalog.tableExists(name):
        raise ValueError(f"no such table: {table}")
    fields = spark.table(name).schema.fields
    rows = [(fd.name, fd.dataType.simpleString(), i + 1) for i, fd in enumerate(fields)]
    return spark.createDataFrame(rows, "name string, type string, position int").orderBy("position")


def append(rows: DataFrame, sink: SinkSpec, batch_id: int | None = None) -> None:
    """Append rows to the sink.

    * a table takes them by column name; columns the rows lack are NULL there
    * a path takes each micro-batch into a folder of its own, named by the batch. A batch
      that is run again after a failure replaces its folder, so it counts once
    * a path with ``latest_keys`` keeps the latest row of each key; see ``latest``
    * any other format (JDBC, a connector) gets the sink's options and a plain append

    With ``cut_inserts`` no file holds more than ``batch_size`` rows: a task begins a new one when that many are
    in. Connectors take the size as their ``batchsize`` anyway.
    """
    if sink.cut_inserts:
        with _rows_a_file(rows.sparkSession, sink.batch_size):
            append(rows, replace(sink, cut_inserts=False), batch_id)
    elif sink.table:
        _insert(rows, table_name(sink.table))
    elif sink.latest_keys:
        if batch_id is None:
            raise ValueError("the latest row of a key is kept by numbered batches; use dedup on a batch load")
        latest_table(sink).merge(rows, batch_id)
    elif sink.path and batch_id is not None:
        writer = rows.write.format(sink.format).options(**sink.options)
        writer.mode("overwrite").save(f"{sink.path}/batch_id={batch_id}")
    else:
        options = {"batchsize": str(sink.batch_size), **sink.options}
        writer = rows.write.format(sink.format).options(**options).mode("append")
        writer.save(sink.path) if sink.path else writer.save()


@contextmanager
def _rows_a_file(spark: SparkSession, n: int):
    """The session of a streaming query is its own, so nothing else is written under the setting."""
    name = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(name)
    spark.conf.set(name, n)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def insert_sizes(rows: DataFrame, sink: SinkSpec) -> list[int]:
    """Rows of each insert that ``rows``, which must be kept, are cut into: a task is a worker that inserts when
    ``batch_size`` rows are in, and what it has left at its end. One count per task comes to the driver."""
    counted = rows.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    sizes: list[int] = []
    for row in sorted(counted.collect()):
        whole, rest = divmod(row["n"], sink.batch_size)
        sizes += [sink.batch_size] * whole + [rest] * (rest > 0)
    return sizes


def latest_table(sink: SinkSpec) -> LatestTable:
    return LatestTable(sink.path, sink.latest_keys, sink.latest_order, sink.format)


def _insert(rows: DataFrame, table: str) -> None:
    """A value that does not fit its column of the table becomes NULL there; see ``misfits``."""
    fields = rows.sparkSession.table(table).schema.fields
    given = {c.lower() for c in rows.columns}
    unknown = sorted(given - {fd.name.lower() for fd in fields})
    if unknown:
        raise ValueError(f"columns missing in {table}: {', '.join(unknown)}")
    aligned = [
        (F.col(quoted(fd.name)).try_cast(fd.dataType) if fd.name.lower() in given else F.lit(None).cast(fd.dataType)).alias(fd.name)
        for fd in fields
    ]
    rows.select(*aligned).write.insertInto(table)


def misfits(rows: DataFrame, table: str) -> DataFrame:
    """Values that the table's narrower columns cannot hold: ``value`` (the row as JSON), ``stage`` and
    ``reason``, one row per value."""
    there = {fd.name.lower(): fd.dataType for fd in rows.sparkSession.table(table_name(table)).schema.fields}
    wider = [(c, there[c.lower()]) for c, kind in rows.dtypes if c.lower() in there and there[c.lower()].simpleString() != kind]
    reasons = [
        F.when(F.col(quoted(c)).isNotNull() & F.col(quoted(c)).try_cast(kind).isNull(), F.lit(f"{c}: does not fit {kind.simpleString()}"))
        for c, kind in wider
    ]
    found = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    whole = F.to_json(F.struct(*[F.col(quoted(c)) for c in rows.columns])).alias("value")
    return rows.select(whole, F.lit("insert").alias("stage"), F.explode(found).alias("reason"))
