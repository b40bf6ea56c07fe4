"""A mapping worked out from sampled fields, user edits and the target table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonflow.plans.spec import Field


def mapping_frame(spark: SparkSession, mapping: Iterable[Field]) -> DataFrame:
    """A mapping as rows ``position, fieldPath, column, type, nullable``."""
    rows = [(i, m.path, m.column, m.type, m.nullable) for i, m in enumerate(mapping)]
    schema = "position long, fieldPath string, column string, type string, nullable boolean"
    return spark.createDataFrame(rows, schema)


def resolve_mapping(
    fields: DataFrame, edits: DataFrame, target: DataFrame, current: DataFrame
) -> DataFrame:
    """The current mapping with the chosen columns put in.

    * ``fields``  - ``fieldPath, position``: fields of the sample, in order
    * ``edits``   - ``fieldPath, column, type``: the column, and maybe type, chosen per field
    * ``target``  - ``name, type``: columns of the target table
    * ``current`` - ``position, fieldPath, column, type, nullable``

    A field takes the type chosen for it, else its column's type in the target, else
    ``String``; fields without a chosen column are passed over. Chosen fields replace the
    current entry of the same path in its place; new ones follow in field order.
    """
    def given(name: str):
        return F.when(F.trim(F.col(name)) != "", F.col(name))

    chosen = edits.select("fieldPath", given("column").alias("column"), given("type").alias("_type"))
    types = target.select(F.col("name").alias("column"), F.col("type").alias("_target_type"))
    selected = (
        fields.select("fieldPath", F.col("position").alias("_order"))
        .join(chosen.filter(F.col("column").isNotNull()), "fieldPath")
        .join(types, "column", "left")
        .select(
            "fieldPath",
            "_order",
            F.col("column").alias("_column"),
            F.coalesce("_type", "_target_type", F.lit("String")).alias("_new_type"),
        )
    )
    merged = current.join(selected, "fieldPath", "full").select(
        "fieldPath",
        F.coalesce("_column", "column").alias("column"),
        F.coalesce("_new_type", "type").alias("type"),
        F.coalesce("nullable", F.lit(False)).alias("nullable"),
        F.col("position").isNull().alias("_is_new"),
        F.coalesce("position", "_order").alias("_at"),
    )
    return merged.orderBy("_is_new", "_at", "fieldPath").select(
        "fieldPath", "column", "type", "nullable"
    )
