"""JSON messages derived from the given tables.

Every row of a table becomes one message in ``value``, next to the key columns that the
checks need. Dirt (broken text, wrong kinds, absent keys) is put in by key, so that the
expected outcome can be told from the table alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jsonflow.plans.spec import read_mapping
from jsonflow.sources.readers import spread

# The mapping the typical event messages are loaded with.
EVENT_MAPPING = read_mapping(
    [
        {"fieldPath": "event.ts", "column": "event_ts", "type": "DateTime64(6)"},
        {"fieldPath": "event.type", "column": "event_type", "type": "String"},
        {"fieldPath": "event.value", "column": "event_value", "type": "Float64"},
        {"fieldPath": "user.email", "column": "user_email", "type": "String"},
        {"fieldPath": "user.id", "column": "user_id", "type": "Int64"},
    ]
)

EVENT_MESSAGE = """
to_json(
  named_struct(
    'user', named_struct('id', user_id, 'email', concat('user', user_id, '@example.com')),
    'event', named_struct(
      'ts', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
      'type', event_type,
      'value', value)),
  map('ignoreNullFields', 'false'))
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str, name: str, keep: list[str], sql: str) -> DataFrame:
    """``keep`` expressions and the message an SQL expression makes of each row.

    Messages are made, and later parsed, by at least one task per core.
    """
    rows = spread(table(spark, sf_dir, name), spark.sparkContext.defaultParallelism)
    return rows.selectExpr(*keep, f"{sql} AS value")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir, "events", ["event_id"], EVENT_MESSAGE)


# Numbers and flags in many spellings. By event_id: six spellings of the user id, of which
# two are no number; five of the value; six of a flag; six of a text.
MIXED_MESSAGE = """
concat(
  '{"n":', CASE event_id % 6
     WHEN 0 THEN string(user_id)
     WHEN 1 THEN concat('"', user_id, '"')
     WHEN 2 THEN concat('"', user_id, '.9"')
     WHEN 3 THEN concat(user_id, '.9')
     WHEN 4 THEN '"abc"'
     ELSE 'true' END,
  ',"f":', CASE event_id % 5
     WHEN 0 THEN string(value)
     WHEN 1 THEN concat('"', value, '"')
     WHEN 2 THEN string(user_id)
     WHEN 3 THEN concat('" ', value, ' "')
     ELSE 'null' END,
  ',"b":', CASE event_id % 6
     WHEN 0 THEN 'true'
     WHEN 1 THEN '"TRUE"'
     WHEN 2 THEN '"0"'
     WHEN 3 THEN concat('"', user_id, '"')
     WHEN 4 THEN '"True"'
     ELSE '1' END,
  ',"s":', CASE event_id % 6
     WHEN 0 THEN concat('"', event_type, '"')
     WHEN 1 THEN string(user_id)
     WHEN 2 THEN concat(user_id, 'e3')
     WHEN 3 THEN 'false'
     WHEN 4 THEN concat('["', event_type, '", ', user_id, ']')
     ELSE '{"deep": 1}' END,
  '}')
"""

MIXED_MAPPING = read_mapping(
    [
        {"fieldPath": "n", "column": "n", "type": "Int64"},
        {"fieldPath": "f", "column": "f", "type": "Nullable(Float64)"},
        {"fieldPath": "b", "column": "b", "type": "Bool"},
        {"fieldPath": "s", "column": "s", "type": "String"},
    ]
)


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir, "events", ["event_id"], MIXED_MESSAGE)


# The value is there as a number, as text, as other text, as null, or not at all.
SPARSE_MESSAGE = """
concat(
  '{"event":{"type":"', event_type, '"}',
  CASE event_id % 5
     WHEN 0 THEN concat(',"value":', value)
     WHEN 1 THEN concat(',"value":"', value, '"')
     WHEN 2 THEN ',"value":"n/a"'
     WHEN 3 THEN ',"value":null'
     ELSE '' END,
  '}')
"""


def sparse_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir, "events", ["event_id"], SPARSE_MESSAGE)


# Order dates in every accepted spelling, and two that are not accepted.
DATE_MESSAGE = """
concat('{"d":', CASE o_orderkey % 9
  WHEN 0 THEN concat('"', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"), '"')
  WHEN 1 THEN concat('"', date_format(o_orderdate + INTERVAL 2 HOURS, "yyyy-MM-dd'T'HH:mm:ss.SSS"), '+02:00"')
  WHEN 2 THEN concat('" ', date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss.SSSSSS'), ' "')
  WHEN 3 THEN concat('"\\'', date_format(o_orderdate, 'yyyy-MM-dd'), '\\'"')
  WHEN 4 THEN concat('"', unix_seconds(CAST(o_orderdate AS TIMESTAMP)), '"')
  WHEN 5 THEN concat('"', unix_millis(CAST(o_orderdate AS TIMESTAMP)) + 1000000000000, '"')
  WHEN 6 THEN string(unix_seconds(CAST(o_orderdate AS TIMESTAMP)))
  WHEN 7 THEN '"12:00"'
  ELSE '"2025-13-45"' END, '}')
"""

DATE_MAPPING = read_mapping(
    [
        {"fieldPath": "d", "column": "at", "type": "DateTime"},
        {"fieldPath": "d", "column": "day", "type": "Nullable(Date)"},
    ]
)


def date_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir, "orders", ["o_orderkey"], DATE_MESSAGE)


PAGE_MESSAGE = "to_json(named_struct('page', named_struct('id', page_id, 'url', url, 'html', html)))"
TURN_MESSAGE = "to_json(named_struct('conv', conv_id, 'turn', turn, 'say', named_struct('role', role, 'text', text)))"
LINE_MESSAGE = """
to_json(named_struct(
  'order', named_struct('key', l_orderkey, 'line', l_linenumber),
  'part', l_partkey, 'supplier', l_suppkey,
  'amount', named_struct('quantity', l_quantity, 'price', l_extendedprice,
                         'discount', l_discount, 'tax', l_tax),
  'flags', array(l_returnflag, l_linestatus),
  'shipped', date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')))
"""
LINE_MAPPING = read_mapping(
    [
        {"fieldPath": "order.key", "column": "order_key", "type": "Int64"},
        {"fieldPath": "order.line", "column": "line", "type": "Int64"},
        {"fieldPath": "part", "column": "part", "type": "Int64"},
        {"fieldPath": "amount.quantity", "column": "quantity", "type": "Float64"},
        {"fieldPath": "amount.price", "column": "price", "type": "Float64"},
        {"fieldPath": "amount.discount", "column": "discount", "type": "Float64"},
        {"fieldPath": "flags", "column": "flags", "type": "String"},
        {"fieldPath": "shipped", "column": "shipped", "type": "DateTime"},
        {"fieldPath": "shipped", "column": "shipped_on", "type": "Date"},
    ]
)
DOCUMENT_MESSAGE = """
to_json(named_struct('doc', named_struct('id', doc_id, 'lang', lang, 'source', source),
                     'text', text, 'chars', n_chars))
"""
