"""Column mapping proposed from messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonflow.operators.flatten import flatten
from jsonflow.plans.spec import Field, read_mapping

# Doubles in this range are whole numbers a 64-bit integer can hold.
INT_MIN, INT_END = -float(2**63), float(2**63)

# Columns that a mapping may have at most.
MOST_COLUMNS = 10_000


def column_name(path: Column) -> Column:
    return F.regexp_replace(path, "[^A-Za-z0-9]", "_")


def path_votes(decoded: DataFrame, depth: int | None = None) -> DataFrame:
    """Per path: can every non-null value be Bool, Int64, Float64; was any value null.

    Values are reduced to flags before the shuffle and the flags aggregate on the map side,
    so what travels is one row per task and path, however often a path occurs. It is one pass,
    however deep the messages are; ``depth`` is as in ``flatten``.
    """
    return _votes(decoded, depth)


def _votes(decoded: DataFrame, depth: int | None) -> DataFrame:
    leaves = flatten(decoded, depth=depth, roots=False)
    k = F.col("_kind")
    kinds = leaves.select("path", "value", F.schema_of_variant("value").alias("_kind"))
    # Whole numbers are told by value: 1.0 and 1e3 are integers too.
    number = F.when(k.startswith("DECIMAL") | (k == "DOUBLE"), F.try_variant_get(F.col("value"), "$", "double"))
    numbers = kinds.select("path", "_kind", number.alias("_number"))
    n, null = F.col("_number"), k == "VOID"
    whole = (n == F.rint(n)) & (n >= INT_MIN) & (n < INT_END)
    flags = numbers.select(
        "path",
        null.alias("_null"),
        (null | (k == "BOOLEAN")).alias("_bool"),
        (null | (k == "BIGINT") | F.coalesce(whole, F.lit(False))).alias("_int"),
        (null | (k == "BIGINT") | n.isNotNull()).alias("_float"),
        k.startswith("OBJECT").alias("_object"),
    )
    return flags.groupBy("path").agg(
        F.bool_or("_null").alias("nullable"),
        F.bool_and("_bool").alias("is_bool"),
        F.bool_and("_int").alias("is_int"),
        F.bool_and("_float").alias("is_float"),
        F.bool_or("_object").alias("unopened"),
        F.count("*").alias("values"),
    )


def merge_votes(votes: DataFrame) -> DataFrame:
    """The votes of several parts of the messages, put together: those of all the messages.

    Parts may be days, topics or micro-batches, in any order; each message must be in one part. Flags are
    joined by and/or and counts added, on the map side first, so old messages are never read again.
    """
    any_of = [F.bool_or(c).alias(c) for c in ("nullable", "unopened")]
    all_of = [F.bool_and(c).alias(c) for c in ("is_bool", "is_int", "is_float")]
    merged = votes.groupBy("path").agg(*any_of, *all_of, F.sum("values").alias("values"))
    return merged.select("path", "nullable", "is_bool", "is_int", "is_float", "unopened", "values")


def infer_mapping(decoded: DataFrame, depth: int | None = None) -> DataFrame:
    """``fieldPath, column, type, nullable`` per path of the messages, as ``propose`` gives it."""
    return propose(path_votes(decoded, depth))


def propose(votes: DataFrame) -> DataFrame:
    """``fieldPath, column, type, nullable`` per path that was voted on, ordered by column name.

    Bool, Int64, Float64 and String are tried in this order; one value that does not fit
    degrades the path. Only an explicit null makes a path Nullable, absence does not. A
    path that is always null has nothing against it and is proposed as Nullable(Bool).
    """
    plain = (
        F.when(F.col("is_bool"), "Bool")
        .when(F.col("is_int"), "Int64")
        .when(F.col("is_float"), "Float64")
        .otherwise("String")
    )
    wrapped = F.concat(F.lit("Nullable("), plain, F.lit(")"))
    return (
        votes.select(
            F.col("path").alias("fieldPath"),
            column_name(F.col("path")).alias("column"),
            F.when(F.col("nullable"), wrapped).otherwise(plain).alias("type"),
            "nullable",
        )
        .orderBy("column", "fieldPath")
    )


def name_clashes(inferred: DataFrame) -> DataFrame:
    """Paths that were given the same column name; such a mapping cannot be loaded as is.

    Names that differ only by case are the same to Spark.
    """
    same = F.lower("column").alias("_same")
    shared = inferred.groupBy(same).agg(F.count("*").alias("paths")).filter("paths > 1")
    return inferred.join(shared, F.lower("column") == F.col("_same")).select("column", "fieldPath", "paths")


def accept(inferred: DataFrame, most: int = MOST_COLUMNS) -> list[Field]:
    """The proposed mapping as a spec: one small row per distinct path comes to the driver.

    Objects keyed by ids give a path for every id. A proposal of more than ``most`` columns is
    refused; nothing is cut.
    """
    rows = inferred.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} columns proposed; objects keyed by ids are no table's columns")
    return read_mapping([row.asDict() for row in rows])
