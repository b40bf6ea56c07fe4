"""JSON messages made from columns, to try a job out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_message(**parts: Column) -> Column:
    """One JSON object; NULL columns are written as JSON null, not left out."""
    fields = [col.alias(name) for name, col in parts.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def test_messages(numbers: DataFrame, i: str = "id", ts: Column | None = None) -> DataFrame:
    """One test message per row of ``numbers`` (e.g. ``spark.range(n)``), in ``value``.

    User ids count from 1, addresses are numbered with at least two digits, and the event
    carries a UTC time, the type ``test`` and the number as a double.
    """
    n = F.col(i).cast("long")
    at = F.current_timestamp() if ts is None else ts
    email = F.concat(
        F.lit("user"),
        F.when(n + 1 < 10, F.concat(F.lit("0"), n + 1)).otherwise((n + 1).cast("string")),
        F.lit("@example.com"),
    )
    user = F.struct((n + 1).alias("id"), email.alias("email"))
    event = F.struct(
        F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"),
        F.lit("test").alias("type"),
        n.cast("double").alias("value"),
    )
    return numbers.select(to_message(user=user, event=event).alias("value"))
