"""Every leaf of every message as a ``(path, value)`` row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonflow.operators.decode import DOC, RAW

MEMBERS = "map<string,variant>"

# Levels of objects opened by explodes; what lies deeper is opened by one expression.
LEVELS = 4


def flatten(
    decoded: DataFrame,
    keep: Sequence[str] = (),
    depth: int | None = None,
    arrays_as_text: bool = False,
    roots: bool = True,
) -> DataFrame:
    """``keep`` columns, ``path`` and ``value`` (variant) for every leaf.

    Object keys are joined by dots; an empty object has no leaf; arrays stay whole, as
    lists or as JSON text; a JSON null is a leaf. A message that is no object is one leaf
    at path ``""`` (left out without ``roots``).

    ``depth`` is the number of object levels to open; by default all are. Anything nested deeper
    than a given ``depth`` comes out unopened, as an object value at its own path.

    The first levels are explodes of the object's members, which leave other values as they are;
    whatever is still an object then is opened to its end in its row, in time linear in its size. So the plan is
    the same for every input, nothing is measured first, no message makes it grow, and there is no shuffle.
    """
    levels = LEVELS if depth is None else depth
    top = F.try_variant_get(DOC, "$", MEMBERS)
    whole = decoded.filter(F.col(DOC).isNotNull())
    opened = whole.select(*keep, F.col(DOC).alias("_value"), top.alias("_members")).select(
        *keep,
        F.when(F.col("_members").isNull(), F.col("_value")).alias("_value"),
        F.explode_outer("_members").alias("_key", "_member"),
    )
    rows = opened.select(
        *keep,
        F.coalesce("_key", F.lit("")).alias("path"),
        F.coalesce("_member", "_value").alias("value"),
        F.col("_key").isNull().alias("_root"),
    )
    rows = (rows if roots else rows.filter(~F.col("_root"))).drop("_root")
    for _ in range(levels - 1):
        rows = (
            rows.select(*keep, "path", "value", F.try_variant_get("value", "$", MEMBERS).alias("_members"))
            .select(
                *keep,
                "path",
                F.when(F.col("_members").isNull(), F.col("value")).alias("value"),
                F.explode_outer("_members").alias("_key", "_member"),
            )
            .select(*keep, _join("path", "_key").alias("path"), F.coalesce("_member", "value").alias("value"))
        )
    leaves = rows.filter(F.col("value").isNotNull())
    if depth is None:
        leaves = leaves.select(*keep, F.explode(_opened("path", "value")).alias("_leaf"))
        leaves = leaves.select(*keep, "_leaf.path", "_leaf.value")
    if arrays_as_text:
        kind = F.schema_of_variant("value")
        as_text = F.try_variant_get("value", "$", "string").cast("variant")
        leaves = leaves.withColumn(
            "value", F.when(kind.startswith("ARRAY"), as_text).otherwise(F.col("value"))
        )
    return leaves


def _opened(path: str, value: str) -> Column:
    """All leaves below a value as ``path, value`` structs; of a value that is no object, itself.

    A worklist: each step puts the leaves of one level aside and opens the objects of that level, so
    every value is looked at once, however wide or deep the message is.
    """

    def item(p: Column, v: Column) -> Column:
        return F.struct(p.alias("path"), v.alias("value"), F.try_variant_get(v, "$", MEMBERS).alias("members"))

    def open_one(x: Column) -> Column:
        return F.transform(F.map_entries(x["members"]), lambda e: item(F.concat(x["path"], F.lit("."), e["key"]), e["value"]))

    def step(state: Column, _: Column) -> Column:
        level, done = state["level"], state["done"]
        leaves = F.transform(
            F.filter(level, lambda x: x["members"].isNull()), lambda x: F.struct(x["path"].alias("path"), x["value"].alias("value"))
        )
        below = F.flatten(F.transform(F.filter(level, lambda x: x["members"].isNotNull()), open_one))
        gone_on = F.struct(F.concat(done, F.array(leaves)).alias("done"), below.alias("level"))
        return F.when(F.size(level) > 0, gone_on).otherwise(state)

    root = item(F.col(path), F.col(value))
    none = F.array().cast("array<array<struct<path: string, value: variant>>>")
    start = F.struct(none.alias("done"), F.array(root).alias("level"))
    steps = F.sequence(F.lit(0), _levels(F.to_json(value)))
    deep = F.aggregate(steps, start, step, lambda state: F.flatten(state["done"]))
    itself = F.array(F.struct(F.col(path).alias("path"), F.col(value).alias("value")))
    return F.when(F.try_variant_get(value, "$", MEMBERS).isNotNull(), deep).otherwise(itself)


def _levels(text: Column) -> Column:
    """How many objects of a JSON text lie within each other, outside arrays and strings; one scan."""
    # Without escapes a string ends at the next quote; without strings every brace counts.
    bare = F.regexp_replace(F.regexp_replace(text, r"\\.", ""), '"[^"]*"', "")
    marks = F.split(F.regexp_replace(bare, r"[^{}\[\]]+", ""), "")

    def move(at: Column, mark: Column) -> Column:
        lists = at["lists"] + F.when(mark == "[", 1).when(mark == "]", -1).otherwise(0)
        outside = at["lists"] == 0
        depth = at["depth"] + F.when(outside & (mark == "{"), 1).when(outside & (mark == "}"), -1).otherwise(0)
        return F.struct(lists.alias("lists"), depth.alias("depth"), F.greatest(at["most"], depth).alias("most"))

    zero = F.struct(F.lit(0).alias("lists"), F.lit(0).alias("depth"), F.lit(0).alias("most"))
    return F.aggregate(marks, zero, move, lambda at: at["most"])


def _join(path: str, key: str):
    joined = F.when(F.col(path) == "", F.col(key)).otherwise(F.concat(path, F.lit("."), key))
    return F.when(F.col(key).isNull(), F.col(path)).otherwise(joined)
