"""Registered queries over the given tables, with their SQL checks.

Checks are written against the relational columns, never by reading JSON again.
Timestamps are compared as microseconds since 1970; NULL shows as -1 or ``none``.
"""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jsonflow.operators import dedup, flatten, infer, resolve, runlog, sample
from jsonflow.operators.decode import DOC, decode
from jsonflow.operators.filters import evaluate_filter, filter_summary, keep_matching
from jsonflow.operators.project import project
from jsonflow.plans.load import classify, load_rows, reject_counts, rejects_of
from jsonflow.plans.spec import FilterSpec, LoadSpec, SinkSpec, SourceSpec, read_mapping
from jsonflow.session import shared_dir
from jsonflow.sources.generate import test_messages
from jsonflow.sources.readers import read_messages, stream_messages
from jsonflow.sources.sampling import sample_topic
from jsonflow.streaming import jobs, sinks, votes
from suite import messages as m
from suite.registry import query


def rules(tree: dict) -> FilterSpec:
    return FilterSpec(enabled=True, language="rules", rules=tree)


def sql(expression: str, **fields) -> FilterSpec:
    return FilterSpec(enabled=True, language="sql", expression=expression, fields=fields)


def rule(field: str, operator: str, value="", negate: bool = False) -> dict:
    return {"kind": "rule", "field": field, "operator": operator, "value": str(value), "not": negate}


def group(op: str, *children: dict, negate: bool = False) -> dict:
    return {"kind": "group", "op": op, "children": list(children), "not": negate}


BIG_PURCHASES = rules(group("AND", rule("event.type", "equals", "purchase"), rule("event.value", "gt", 20)))


# --- the whole load -----------------------------------------------------------------


@query(
    """
    SELECT event_id, epoch_us(ts) AS event_ts, event_type, value AS event_value,
           'user' || user_id || '@example.com' AS user_email, user_id
    FROM events WHERE event_type = 'purchase' AND value > 20
    """
)
def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to typed rows: parse, keep big purchases, map and convert."""
    spec = LoadSpec("events", m.EVENT_MAPPING, filter=BIG_PURCHASES)
    return load_rows(m.event_messages(spark, sf_dir), spec, ["event_id"]).withColumn(
        "event_ts", F.unix_micros("event_ts")
    )


@query(
    """
    SELECT l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part,
           l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount,
           '["' || l_returnflag || '","' || l_linestatus || '"]' AS flags,
           epoch_us(l_shipdate) AS shipped, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped_on
    FROM lineitem
    """
)
def load_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The volume load: every order line as a nested message, nothing filtered."""
    raw = m.messages(spark, sf_dir, "lineitem", [], m.LINE_MESSAGE)
    rows = load_rows(raw, LoadSpec("lines", m.LINE_MAPPING))
    return rows.withColumns(
        {"shipped": F.unix_micros("shipped"), "shipped_on": F.col("shipped_on").cast("string")}
    )


@query(
    """
    SELECT doc_id, lang, md5(text) AS text_md5, n_chars AS chars FROM documents
    WHERE lang = 'en' OR n_chars >= 1000
    """
)
def load_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts through escaping, filter and mapping, whole."""
    raw = m.messages(spark, sf_dir, "documents", [], m.DOCUMENT_MESSAGE)
    mapping = read_mapping(
        [
            {"fieldPath": "doc.id", "column": "doc_id", "type": "Int64"},
            {"fieldPath": "doc.lang", "column": "lang", "type": "String"},
            {"fieldPath": "text", "column": "text", "type": "String"},
            {"fieldPath": "chars", "column": "chars", "type": "Int64"},
        ]
    )
    wanted = rules(group("OR", rule("doc.lang", "equals", "en"), rule("chars", "gte", 1000)))
    rows = load_rows(raw, LoadSpec("documents", mapping, filter=wanted))
    return rows.select("doc_id", "lang", F.md5("text").alias("text_md5"), "chars")


@query(
    """
    SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events
    """
)
def load_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that are stored in a column of the source, as the source spec names it."""
    source = SourceSpec.from_dict({"format": "parquet", "path": f"{sf_dir}/events.parquet", "value": "props"})
    mapping = read_mapping([{"fieldPath": "k", "column": "k", "type": "Int64"}])
    # the table has a column "value" of its own, which the messages take the place of
    events = read_messages(spark, source)
    return load_rows(events, LoadSpec("props", mapping), ["event_id"])


# --- decode, flatten, project, coerce -----------------------------------------------


@query(
    """
    SELECT event_id,
           CASE WHEN event_id % 7 IN (0, 1) THEN 'malformed' ELSE 'ok' END AS outcome,
           CASE WHEN event_id % 7 IN (0, 1) THEN -1 ELSE user_id END AS user_id
    FROM events
    """
)
def decode_drop_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages cut short, and messages with text after their end, are told from whole ones."""
    dirty = F.expr(
        """CASE event_id % 7 WHEN 0 THEN left(value, length(value) - 5)
                             WHEN 1 THEN concat(value, value) ELSE value END"""
    )
    raw = m.event_messages(spark, sf_dir).withColumn("value", dirty)
    user = F.try_variant_get(DOC, "$.user.id", "bigint")
    return decode(raw, keep=["event_id"]).select(
        "event_id",
        F.when(F.col(DOC).isNull(), "malformed").otherwise("ok").alias("outcome"),
        F.coalesce(user, F.lit(-1)).alias("user_id"),
    )


@query(
    """
    WITH leaves AS (
      SELECT unnest([
        {path: 'order.key', kind: 'BIGINT', text: CAST(l_orderkey AS VARCHAR)},
        {path: 'order.line', kind: 'BIGINT', text: CAST(l_linenumber AS VARCHAR)},
        {path: 'part', kind: 'BIGINT', text: CAST(l_partkey AS VARCHAR)},
        {path: 'supplier', kind: 'BIGINT', text: CAST(l_suppkey AS VARCHAR)},
        {path: 'amount.quantity', kind: 'NUMBER', text: ''},
        {path: 'amount.price', kind: 'NUMBER', text: ''},
        {path: 'amount.discount', kind: 'NUMBER', text: ''},
        {path: 'amount.tax', kind: 'NUMBER', text: ''},
        {path: 'flags', kind: 'ARRAY', text: '["' || l_returnflag || '","' || l_linestatus || '"]'},
        {path: 'shipped', kind: 'STRING', text: strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')}
      ]) AS leaf FROM lineitem)
    SELECT leaf.path AS path, leaf.kind AS kind, count(*) AS n,
           CAST(sum(length(leaf.text)) AS BIGINT) AS chars,
           CAST(sum(ascii(leaf.text)) AS BIGINT) AS first_codes,
           CAST(sum(ascii(right(leaf.text, 1))) AS BIGINT) AS last_codes
    FROM leaves GROUP BY leaf.path, leaf.kind
    """
)
def flatten_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaf of nested messages, arrays kept whole, summed up by path and kind."""
    raw = m.messages(spark, sf_dir, "lineitem", [], m.LINE_MESSAGE)
    k = F.schema_of_variant("value")
    # 36.0 is written as a whole number or not, by the digits it has
    money = F.col("path").startswith("amount.")
    kind = F.when(money, "NUMBER").when(k.startswith("ARRAY"), "ARRAY").otherwise(k)
    text = F.when(money, "").otherwise(F.try_variant_get("value", "$", "string"))
    leaves = flatten.flatten(decode(raw), depth=2).select("path", kind.alias("kind"), text.alias("text"))
    return leaves.groupBy("path", "kind").agg(
        F.count("*").alias("n"),
        F.sum(F.length("text")).alias("chars"),
        F.sum(F.ascii("text")).alias("first_codes"),
        F.sum(F.ascii(F.right("text", F.lit(1)))).alias("last_codes"),
    )


@query("SELECT vec_id, 'vec' AS path, 'STRING' AS kind, len(embedding) - 1 AS commas, true AS bracketed FROM embeddings")
def flatten_arrays_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays come out of messages as JSON text."""
    raw = m.messages(spark, sf_dir, "embeddings", ["vec_id"], "to_json(named_struct('vec', embedding))")
    leaves = flatten.flatten(decode(raw, keep=["vec_id"]), keep=["vec_id"], arrays_as_text=True)
    text = F.try_variant_get("value", "$", "string")
    commas = F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))
    return leaves.select(
        "vec_id",
        "path",
        F.schema_of_variant("value").alias("kind"),
        commas.cast("bigint").alias("commas"),
        (text.startswith("[") & text.endswith("]")).alias("bracketed"),
    )


@query(
    """
    SELECT CASE WHEN event_id % 500 = 0 THEN 'deep' WHEN event_id % 500 = 1 THEN 'braces' ELSE 'plain' END AS kind,
           CASE WHEN event_id % 500 = 0 THEN 500 WHEN event_id % 500 = 1 THEN 100000 ELSE 1 END AS size,
           count(*) AS n, CAST(sum(user_id) AS BIGINT) AS total
    FROM events WHERE event_id % 500 <> 2 GROUP BY ALL
    """
)
def flatten_hostile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of 500 levels, texts of 100,000 braces and broken texts of as many among plain ones."""
    message = f"""
    CASE event_id % 500
      WHEN 0 THEN concat(repeat('{{"d":', 500), user_id, repeat('}}', 500))
      WHEN 1 THEN concat('{{"t":"', repeat('{{', 100000), '","u":', user_id, '}}')
      WHEN 2 THEN repeat('{{', 100000)
      ELSE concat('{{"id":', user_id, '}}') END
    """
    leaves = flatten.flatten(decode(m.messages(spark, sf_dir, "events", ["event_id"], message), keep=["event_id"]), keep=["event_id"])
    text, number = F.try_variant_get("value", "$", "string"), F.try_variant_get("value", "$", "bigint")
    rows = leaves.groupBy("event_id").agg(
        F.max(F.length("path")).alias("path"),
        F.max(F.when(F.col("path") == "t", F.length(text))).alias("braces"),
        F.sum(F.when(F.col("path") != "t", number)).alias("id"),
    )
    kind = F.when(F.col("braces").isNotNull(), "braces").when(F.col("path") > 10, "deep").otherwise("plain")
    levels = F.when(F.col("path") > 10, (F.col("path") + 1) / 2).otherwise(1)
    sized = rows.select(kind.alias("kind"), F.coalesce("braces", levels.cast("int")).alias("size"), "id")
    return sized.groupBy("kind", "size").agg(F.count("*").alias("n"), F.sum("id").alias("total"))


@query(
    """
    SELECT 'a.b.c.d{"e.k' || event_id || '.' || leaf AS path, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS total
    FROM events, (VALUES ('id'), ('o.id'), ('l')) AS v(leaf) GROUP BY 1
    """
)
def flatten_wide_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of up to 4,000 objects beside each other at level six, with braces and quotes in keys, texts and lists."""
    events = m.table(spark, sf_dir, "events")
    member = F.expr(
        """concat('"k', event_id, '":{"id":', user_id, ',"o":{"id":', user_id, ',"e":{}},"l":[', user_id, ',"}{","\\\\\\"{",{"x":{"y":{}}}]}')"""
    )
    wide = events.groupBy(F.floor(F.col("event_id") / 4000)).agg(F.array_join(F.collect_list(member), ",").alias("members"))
    value = F.concat(F.lit('{"a":{"b":{"c":{"d{\\"e":{'), "members", F.lit("}}}}}"))
    leaves = flatten.flatten(decode(wide.select(value.alias("value"))))
    whole, first = F.try_variant_get("value", "$", "bigint"), F.try_variant_get("value", "$[0]", "bigint")
    return leaves.groupBy("path").agg(F.count("*").alias("n"), F.sum(F.coalesce(whole, first)).alias("total"))


@query(
    """
    SELECT CASE WHEN event_id % 3 = 0 THEN 'l1.l2.l3.l4.l5.l6.l7.l8.l9.l10.l11.id'
                WHEN event_id % 3 = 1 THEN 'l1.l2.id' ELSE 'id' END AS path,
           count(*) AS n, CAST(sum(user_id) AS BIGINT) AS total
    FROM events GROUP BY 1
    """
)
def flatten_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves at very different depths; the depth is measured and none is cut off."""
    opened = "".join(f'{{"l{i}":' for i in range(1, 12))
    message = f"""
    CASE event_id % 3
      WHEN 0 THEN concat('{opened}{{"id":', user_id, '{"}" * 12}')
      WHEN 1 THEN concat('{{"l1":{{"l2":{{"id":', user_id, '}}}}}}')
      ELSE concat('{{"id":', user_id, '}}') END
    """
    leaves = flatten.flatten(decode(m.messages(spark, sf_dir, "events", [], message)))
    number = F.try_variant_get("value", "$", "bigint").alias("number")
    return leaves.select("path", number).groupBy("path").agg(
        F.count("*").alias("n"), F.sum("number").alias("total")
    )


@query(
    """
    SELECT event_id,
      CASE WHEN event_id % 6 < 4 THEN user_id ELSE -1 END AS n,
      CASE event_id % 5 WHEN 0 THEN value WHEN 1 THEN value WHEN 2 THEN CAST(user_id AS DOUBLE) ELSE -1 END AS f,
      CASE event_id % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'true' WHEN 2 THEN 'false'
        WHEN 3 THEN CASE WHEN user_id <> 0 THEN 'true' ELSE 'false' END ELSE 'none' END AS b,
      CASE event_id % 6 WHEN 0 THEN event_type WHEN 1 THEN CAST(user_id AS VARCHAR)
        WHEN 2 THEN CAST(user_id * 1000 AS VARCHAR) WHEN 3 THEN 'false'
        WHEN 4 THEN '["' || event_type || '",' || user_id || ']' ELSE 'none' END AS s
    FROM events
    """
)
def map_project_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped paths to Int64, Float64, Bool and String from numbers, texts and arrays."""
    spec = LoadSpec("mixed", m.MIXED_MAPPING)
    rows = load_rows(m.mixed_messages(spark, sf_dir), spec, ["event_id"])
    return rows.select(
        "event_id",
        F.coalesce("n", F.lit(-1)).alias("n"),
        F.coalesce("f", F.lit(-1.0)).alias("f"),
        F.coalesce(F.col("b").cast("string"), F.lit("none")).alias("b"),
        F.coalesce("s", F.lit("none")).alias("s"),
    )


@query(
    """
    SELECT o_orderkey,
      CASE WHEN o_orderkey % 9 IN (7, 8) THEN -1
           WHEN o_orderkey % 9 = 5 THEN epoch_us(o_orderdate) + 1000000000000000
           ELSE epoch_us(o_orderdate) END AS at,
      CASE WHEN o_orderkey % 9 IN (7, 8) THEN 'none'
           WHEN o_orderkey % 9 = 5 THEN CAST(CAST(make_timestamp(epoch_us(o_orderdate) + 1000000000000000) AS DATE) AS VARCHAR)
           ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day
    FROM orders
    """
)
def coerce_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zoned, plain and date-only text, epochs as text and as numbers, to DateTime and Date."""
    rows = load_rows(m.date_messages(spark, sf_dir), LoadSpec("dates", m.DATE_MAPPING), ["o_orderkey"])
    return rows.select(
        "o_orderkey",
        F.coalesce(F.unix_micros("at"), F.lit(-1)).alias("at"),
        F.coalesce(F.col("day").cast("string"), F.lit("none")).alias("day"),
    )


@query(
    """
    WITH reasons AS (
      SELECT CASE event_id % 6 WHEN 4 THEN 'n: text->Int64' WHEN 5 THEN 'n: boolean->Int64' END AS reason FROM events
      UNION ALL
      SELECT CASE event_id % 5 WHEN 3 THEN 'f: text->Nullable(Float64)' END FROM events
      UNION ALL
      SELECT CASE event_id % 6 WHEN 4 THEN 'b: text->Bool' WHEN 5 THEN 'b: number->Bool' END FROM events)
    SELECT 'coerce' AS stage, reason, count(*) AS rejects FROM reasons
    WHERE reason IS NOT NULL GROUP BY reason
    """
)
def coerce_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that do not fit their column, counted by reason."""
    decoded = decode(m.mixed_messages(spark, sf_dir))
    return reject_counts(classify(decoded, LoadSpec("mixed", m.MIXED_MAPPING)))


@query(
    """
    SELECT event_id, 'decode' AS stage, 'malformed JSON' AS reason FROM events
    WHERE event_id % 6 = 0 AND value > 20
    UNION ALL
    SELECT event_id, 'coerce', 'n: text->Int64' FROM events
    WHERE event_id % 6 = 4 AND event_id % 5 IN (0, 1) AND value > 20
    UNION ALL
    SELECT event_id, 'coerce', 'n: text->Int64' FROM events
    WHERE event_id % 6 = 4 AND event_id % 5 = 2 AND user_id > 20
    UNION ALL
    SELECT event_id, 'coerce', 'n: boolean->Int64' FROM events
    WHERE event_id % 6 = 5 AND event_id % 5 IN (0, 1) AND value > 20
    UNION ALL
    SELECT event_id, 'coerce', 'n: boolean->Int64' FROM events
    WHERE event_id % 6 = 5 AND event_id % 5 = 2 AND user_id > 20
    """
)
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages with stage and reason, from the same pass that loads the rows.

    The filter keeps what counts above 20; a malformed message is a reject whatever the
    filter says.
    """
    broken = F.expr(
        "CASE WHEN event_id % 6 = 0 AND big THEN concat(value, '}') ELSE value END"
    )
    raw = m.messages(spark, sf_dir, "events", ["event_id", "value > 20 AS big"], m.MIXED_MESSAGE)
    raw = raw.withColumn("value", broken)
    spec = LoadSpec("mixed", m.MIXED_MAPPING[:1], filter=rules(rule("f", "gt", 20)))
    both = classify(decode(raw, keep=["event_id"]), spec, ["event_id"])
    return rejects_of(both, ["event_id"]).select("event_id", "stage", "reason")


# --- filters ------------------------------------------------------------------------


def kept_ids(raw: DataFrame, spec: FilterSpec, *keys: str) -> DataFrame:
    return keep_matching(decode(raw, keep=list(keys)), spec).select(*keys)


@query("SELECT event_id FROM events WHERE event_type = 'purchase'")
def filter_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = rules(rule(" event.type ", "equals", "purchase"))
    return kept_ids(m.event_messages(spark, sf_dir), spec, "event_id")


@query(
    r"""
    SELECT page_id FROM pages WHERE regexp_matches(url, '^https?://[a-z.]+\.(com|org)/.*[0-9]$')
    """
)
def filter_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = rules(rule("page.url", "regex", r"^https?://[a-z.]+\.(com|org)/.*[0-9]$"))
    raw = m.messages(spark, sf_dir, "pages", ["page_id"], m.PAGE_MESSAGE)
    return kept_ids(raw, spec, "page_id")


@query(
    """
    SELECT conv_id, turn FROM conversations
    WHERE contains(text, 'ée') OR contains(text, '"') OR contains(text, chr(10))
    """
)
def filter_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accents, quotes and line breaks survive the JSON round trip."""
    spec = rules(group("OR", *[rule("say.text", "contains", part) for part in ("ée", '"', "\n")]))
    raw = m.messages(spark, sf_dir, "conversations", ["conv_id", "turn"], m.TURN_MESSAGE)
    return kept_ids(raw, spec, "conv_id", "turn")


@query(
    """
    SELECT event_id, event_id % 5 <> 4 AS has_value, event_id % 5 = 3 AS value_is_null,
           false AS has_object FROM events
    """
)
def filter_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null value exists, an absent one does not, and an object is no field."""
    decoded = decode(m.sparse_messages(spark, sf_dir), keep=["event_id"])

    def result(path: str, name: str) -> DataFrame:
        nonlocal decoded
        decoded = evaluate_filter(decoded, rules(rule(path, "exists"))).withColumnRenamed("result", name)
        return decoded.drop("error")

    decoded = result("value", "has_value")
    decoded = result("event", "has_object")
    nulls = F.coalesce(F.is_variant_null(F.try_variant_get(DOC, "$.value", "variant")), F.lit(False))
    return decoded.select("event_id", "has_value", nulls.alias("value_is_null"), "has_object")


@query(
    """
    SELECT event_id, 'gt' AS op FROM events WHERE event_id % 5 < 2 AND value > 30
    UNION ALL SELECT event_id, 'gte' FROM events WHERE event_id % 5 < 2 AND value >= 30
    UNION ALL SELECT event_id, 'lt' FROM events WHERE event_id % 5 < 2 AND value < 1.5
    UNION ALL SELECT event_id, 'lte' FROM events WHERE event_id % 5 < 2 AND value <= 0
    """
)
def filter_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and numeric texts compare; an operand that is no number counts as zero."""
    tests = {"gt": "30", "gte": " 3e1 ", "lt": "1.5", "lte": "many"}
    decoded = decode(m.sparse_messages(spark, sf_dir), keep=["event_id"])
    for op, operand in tests.items():
        verdict = evaluate_filter(decoded, rules(rule("value", op, operand)))
        decoded = verdict.withColumnRenamed("result", op).drop("error")
    held = F.array_compact(F.array(*[F.when(F.col(op), op) for op in tests]))
    return decoded.select("event_id", F.explode(held).alias("op"))


@query(
    """
    SELECT event_id FROM events
    WHERE (event_id % 5 < 2 AND NOT (value > 20)) OR event_id % 5 = 4 OR event_type = 'click'
    """
)
def filter_nested_not(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT over a comparison: true for an absent value, not evaluable for null and other text.

    A true branch of an OR outweighs one that is not evaluable; rules without a field and
    empty groups hold.
    """
    tree = group(
        "AND",
        group(
            "OR",
            rule("value", "gt", 20, negate=True),
            group("AND", rule("event.type", "equals", "click"), rule("", "equals", "x")),
        ),
        group("OR"),
        group("AND", group("AND", negate=True), negate=True),
        rule("user.id", "equals", "7", negate=True),
    )
    return kept_ids(m.sparse_messages(spark, sf_dir), rules(tree), "event_id")


@query(
    """
    SELECT count(*) FILTER (event_id % 5 < 2 AND value > 20) AS kept,
           count(*) FILTER ((event_id % 5 < 2 AND value <= 20)) AS dropped,
           count(*) FILTER (event_id % 5 >= 2) AS errored
    FROM events
    """
)
def filter_whatif(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a predicate would keep, drop and fail on, over a whole table."""
    spec = sql("value > 20", value={"path": "value", "as": "double"})
    return filter_summary(decode(m.sparse_messages(spark, sf_dir)), spec)


# Dividing by zero, casting words, overflowing and looking past the end of a list all raise.
RAISING = """
CASE kind WHEN 0 THEN 100 / n > 1
          WHEN 1 THEN int(word) > 50 OR int(word) < 10
          WHEN 2 THEN n * 9223372036854775 > 0
          ELSE array(1, 2, 3)[n % 5] > 0 END
"""
# By event_id % 4; NULL where the expression raises.
RAISED = """
CASE event_id % 4
  WHEN 0 THEN CASE WHEN user_id % 100 = 0 THEN NULL ELSE 100.0 / (user_id % 100) > 1 END
  WHEN 1 THEN CASE WHEN event_type = 'click' THEN NULL ELSE user_id > 50 OR user_id < 10 END
  WHEN 2 THEN CASE WHEN user_id * 1000 * CAST(9223372036854775 AS HUGEINT) > 9223372036854775807 THEN NULL ELSE user_id > 0 END
  ELSE CASE WHEN user_id % 5 > 2 THEN NULL ELSE true END END
"""


def raising_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FilterSpec]:
    message = """
    concat('{"kind":', event_id % 4, ',"n":',
           CASE event_id % 4 WHEN 0 THEN user_id % 100 WHEN 2 THEN user_id * 1000 ELSE user_id END,
           ',"word":"', CASE WHEN event_type = 'click' THEN 'abc' ELSE string(user_id) END, '"}')
    """
    whole = {"as": "int"}
    return m.messages(spark, sf_dir, "events", ["event_id"], message), sql(RAISING, kind={"path": "kind", **whole}, n={"path": "n", **whole}, word="word")


@query(f"SELECT event_id FROM events WHERE {RAISED}")
def filter_sql_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages on which a SQL predicate raises are dropped; the load goes on."""
    raw, spec = raising_messages(spark, sf_dir)
    return kept_ids(raw, spec, "event_id")


@query(
    f"""
    WITH tried AS (SELECT {RAISED} AS r FROM events)
    SELECT count(*) FILTER (r) AS kept, count(*) FILTER (NOT r) AS dropped, count(*) FILTER (r IS NULL) AS errored FROM tried
    """
)
def filter_sql_errors_whatif(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages count as not evaluable."""
    raw, spec = raising_messages(spark, sf_dir)
    return filter_summary(decode(raw), spec)


@query(
    """
    SELECT event_id FROM events
    WHERE (user_id + 3) * 2 - 1 > 4 AND value / 2 + 0.5 < 200 AND user_id % 7 <> 3 AND -user_id < -2
      AND round(value) >= 1 AND abs(user_id - 60) < 500
      AND event_id % 6 IN (0, 1)
    """
)
def filter_arithmetic_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arithmetic, conversions and a flag in many spellings, read as a boolean."""
    spec = sql(
        """(int(id) + 3) * 2 - 1 > 4 AND double(amount) / 2 + 0.5 < 200 AND bigint(id) % 7 <> 3 AND -int(id) < -2
           AND round(double(amount)) >= 1 AND abs(try_subtract(int(id), 60)) < 500 AND flag AND string(int(id)) = id""",
        id="id",
        amount="v",
        flag={"path": "flag", "as": "bool"},
    )
    message = """
    concat('{"id":"', user_id, '","v":"', value, '","flag":',
           CASE event_id % 6 WHEN 0 THEN 'true' WHEN 1 THEN '"T"' WHEN 2 THEN '"0"' WHEN 3 THEN 'false' WHEN 4 THEN '"yes"' ELSE 'null' END, '}')
    """
    return kept_ids(m.messages(spark, sf_dir, "events", ["event_id"], message), spec, "event_id")


@query(
    """
    SELECT event_id, user_id FROM events
    WHERE regexp_matches('user' || user_id || '@example.com', '[05]@example.com$')
      AND value > 10 AND event_type IN ('purchase', 'signup', 'click')
      AND NOT starts_with(event_type, 'cl') AND length(event_type) > 5
      AND hour(ts) BETWEEN 6 AND 17 AND year(ts) = 2024 AND user_id % 5 = 0
    """
)
def filter_expr_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL predicate with text, number, membership and time functions."""
    spec = sql(
        """email RLIKE '[05]@example.com$' AND amount > 10 AND type IN ('purchase', 'signup', 'click')
           AND NOT startswith(type, 'cl') AND char_length(type) > 5 AND NOT no_id AND has_ts
           AND hour(try_to_timestamp(at)) BETWEEN 6 AND 17 AND year(try_to_timestamp(at)) = 2024
           AND id % 5 = 0""",
        email="user.email",
        type="event.type",
        amount={"path": "event.value", "as": "double"},
        at="event.ts",
        has_ts={"path": "event.ts", "as": "present"},
        no_id={"path": "user.id", "as": "is_null"},
        id={"path": "user.id", "as": "int"},
    )
    raw = m.event_messages(spark, sf_dir)
    kept = keep_matching(decode(raw, keep=["event_id"]), spec)
    return project(kept, m.EVENT_MAPPING[4:], ["event_id"])


@query(
    """
    SELECT event_id FROM events
    WHERE year(ts) = 2024 AND month(ts) - 1 = 0 AND dayofmonth(ts) BETWEEN 3 AND 27 AND dayofyear(ts) - 1 <> 13
      AND dayofweek(ts) IN (0, 1, 3) AND hour(ts) % 2 = 1 AND minute(ts) < 45 AND second(ts) >= 10
      AND (epoch_us(ts) // 1000) % 1000 < 900 AND ts + INTERVAL 36 HOUR < TIMESTAMP '2024-01-27 12:00:00'
      AND date_diff('second', TIMESTAMP '2024-01-01 00:00:00', date_trunc('second', ts)) > 200000
    """
)
def filter_time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part of a time, a time moved by an interval, and the time between two."""
    spec = sql(
        """year(t) = 2024 AND month(t) - 1 = 0 AND dayofmonth(t) BETWEEN 3 AND 27 AND dayofyear(t) - 1 <> 13
           AND dayofweek(t) - 1 IN (0, 1, 3) AND hour(t) % 2 = 1 AND minute(t) < 45 AND second(t) >= 10
           AND unix_millis(t) % 1000 < 900 AND t + INTERVAL 36 HOURS < TIMESTAMP '2024-01-27 12:00:00'
           AND timestampdiff(SECOND, TIMESTAMP '2024-01-01 00:00:00', date_trunc('second', t)) > 200000""",
        t={"path": "event.ts", "as": "timestamp"},
    )
    return kept_ids(m.event_messages(spark, sf_dir), spec, "event_id")


@query(
    """
    SELECT event_id FROM events WHERE event_id % 5 = 3 OR (event_id % 5 IN (0, 1) AND value > 20)
    """
)
def filter_null_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that is null, one that is there and not null, and one that is absent."""
    spec = sql(
        "nothing OR (here AND NOT nothing AND amount > 20)",
        nothing={"path": "value", "as": "is_null"},
        here={"path": "value", "as": "present"},
        amount={"path": "value", "as": "double"},
    )
    return kept_ids(m.sparse_messages(spark, sf_dir), spec, "event_id")


@query(
    """
    SELECT vec_id, label FROM embeddings
    WHERE list_aggregate(embedding, 'max') > 0.25 AND list_aggregate(embedding, 'min') > -0.35
      AND len([x for x in embedding if x > 0.2]) >= 2 AND embedding[1] < 0.1
    """
)
def filter_array_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL predicate over array fields: any, all, count and element."""
    spec = sql(
        """exists(v, x -> x > 0.25) AND forall(v, x -> x > -0.35)
           AND size(filter(v, x -> x > 0.2)) >= 2 AND try_element_at(v, 1) < 0.1""",
        v={"path": "vec", "as": "array<double>"},
    )
    message = "to_json(named_struct('id', vec_id, 'vec', embedding))"
    raw = m.messages(spark, sf_dir, "embeddings", ["vec_id", "label"], message)
    return kept_ids(raw, spec, "vec_id", "label")


# --- inference, samples, mapping ----------------------------------------------------

INFER_MESSAGE = """
concat(
  '{"user":{"id":', user_id, ',"email":', CASE WHEN event_type = 'error' THEN 'null'
     ELSE concat('"user', user_id, '@example.com"') END, '}',
  ',"event":{"value":', value, ',"count":', user_id, '.0', ',"none":null,"empty":{}}',
  CASE WHEN event_type = 'view' THEN concat(',"seen-by":', user_id) ELSE '' END,
  ',"mixed":', CASE WHEN event_type = 'click' THEN 'true' ELSE string(user_id) END,
  ',"flag":', CASE WHEN event_type = 'click' THEN 'null' ELSE 'false' END,
  ',"tags":["', event_type, '"],"props":', props, '}')
"""


def proposed(rows: str) -> str:
    """The mapping that the messages of some events propose, told from the events themselves."""
    return f"""
    WITH oldest AS ({rows}),
    facts AS (SELECT bool_or(event_type = 'error') AS null_email, bool_or(event_type = 'view') AS seen,
                     bool_or(event_type = 'click') AS click, bool_or(event_type <> 'click') AS other,
                     bool_and(value = trunc(value)) AS whole FROM oldest),
    fields AS (
      SELECT 'event.count' AS p, 'Int64' AS t, false AS n FROM facts
      UNION ALL SELECT 'event.none', 'Bool', true FROM facts
      UNION ALL SELECT 'event.value', CASE WHEN whole THEN 'Int64' ELSE 'Float64' END, false FROM facts
      UNION ALL SELECT 'flag', 'Bool', click FROM facts
      UNION ALL SELECT 'mixed', CASE WHEN click AND other THEN 'String' WHEN click THEN 'Bool' ELSE 'Int64' END, false FROM facts
      UNION ALL SELECT 'props.k', 'Int64', false FROM facts
      UNION ALL SELECT 'seen-by', 'Int64', false FROM facts WHERE seen
      UNION ALL SELECT 'tags', 'String', false FROM facts
      UNION ALL SELECT 'user.email', 'String', null_email FROM facts
      UNION ALL SELECT 'user.id', 'Int64', false FROM facts)
    SELECT p AS "fieldPath", regexp_replace(p, '[^A-Za-z0-9]', '_', 'g') AS "column",
           CASE WHEN n THEN 'Nullable(' || t || ')' ELSE t END AS "type", n AS "nullable" FROM fields
    """


@query(proposed("SELECT * FROM events"))
def infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping proposed from a whole table: nulls, whole doubles, mixed kinds, absent keys."""
    return infer.infer_mapping(decode(m.messages(spark, sf_dir, "events", [], INFER_MESSAGE)))


@query(
    """
    SELECT 'event.type' AS path, count(*) AS values, false AS nullable, false AS is_int FROM events
    UNION ALL SELECT 'value', count(*) FILTER (event_id % 5 <> 4), true, false FROM events
    """
)
def infer_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts behind a proposal, where a key is absent from part of the messages."""
    counted = infer.path_votes(decode(m.sparse_messages(spark, sf_dir)))
    return counted.select("path", "values", "nullable", "is_int")


@query(proposed("SELECT * FROM events"))
def infer_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping of two parts of the messages whose votes were taken apart and merged."""
    raw = m.messages(spark, sf_dir, "events", ["ts"], INFER_MESSAGE)
    early = F.col("ts") < "2024-01-15"
    parts = [infer.path_votes(decode(raw.filter(part))) for part in (early, ~early)]
    return infer.propose(infer.merge_votes(parts[0].unionByName(parts[1])))


@query(proposed("SELECT * FROM events"))
def stream_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping proposed from a stream, which is stopped, goes on, and votes on new messages only."""
    root = shared_dir(spark)
    raw = m.messages(spark, sf_dir, "events", ["ts"], INFER_MESSAGE)
    for part in (F.col("ts") < "2024-01-15", F.col("ts") >= "2024-01-15"):
        raw.filter(part).select("value").write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema("value string").parquet(f"{root}/in")
        votes.keep(stream, f"{root}/votes", f"{root}/checkpoint", availableNow=True).awaitTermination()
    return infer.propose(votes.read(spark, f"{root}/votes"))


@query(proposed("SELECT * FROM events ORDER BY ts, event_id LIMIT 200"))
def infer_from_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping proposed from the 200 oldest messages."""
    raw = m.messages(spark, sf_dir, "events", ["ts", "event_id"], INFER_MESSAGE)
    return infer.infer_mapping(decode(sample.sample_oldest(raw, 200, ["ts", "event_id"])))


@query(
    """
    SELECT event_type, value AS event_value, user_id, 'user' || user_id || '@example.com' AS user_email,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_ts FROM events
    """
)
def load_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table loaded by the mapping its own messages propose."""
    raw = m.event_messages(spark, sf_dir)
    mapping = infer.accept(infer.infer_mapping(decode(raw)))
    return load_rows(raw, LoadSpec("events", mapping))


@query(
    """
    SELECT event_id, CASE event_id % 4 WHEN 3 THEN user_id + 1 ELSE user_id END AS n,
           event_id % 4 <> 2 AS a_b_exists
    FROM events
    """
)
def path_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``a.b.c`` by nested and by dotted keys; the nested one wins; an object is no field."""
    message = """
    CASE event_id % 4
      WHEN 0 THEN concat('{"a":{"b":{"c":', user_id, '}},"a.b":1}')
      WHEN 1 THEN concat('{"a.b":1,"a":{"b.c":', user_id, '}}')
      WHEN 2 THEN concat('{"a.b":{"c":', user_id, '}}')
      ELSE concat('{"a.b.c":', user_id, ',"a":{"b":{"c":', user_id + 1, '}},"a.b":"x"}') END
    """
    raw = m.messages(spark, sf_dir, "events", ["event_id"], message)
    exists = evaluate_filter(decode(raw, keep=["event_id"]), rules(rule("a.b", "exists")))
    field = read_mapping([{"fieldPath": "a.b.c", "column": "n", "type": "Int64"}])
    return project(exists, field, ["event_id", "result"]).withColumnRenamed("result", "a_b_exists")


@query(
    """
    SELECT vec_id, CAST(list_sum([CAST(x * 100 AS BIGINT) FOR x IN embedding]) AS BIGINT) AS total, len(embedding) AS size,
           list_max([CAST(x * 100 AS BIGINT) FOR x IN embedding]) AS most FROM embeddings
    """
)
def coerce_other_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column declared as a Spark type of its own, here a list of whole numbers."""
    mapping = read_mapping([{"fieldPath": "vec", "column": "vec", "type": "array<bigint>"}])
    message = "to_json(named_struct('vec', transform(embedding, x -> bigint(rint(double(x * 100))))))"
    rows = load_rows(m.messages(spark, sf_dir, "embeddings", ["vec_id"], message), LoadSpec("v", mapping), ["vec_id"])
    return rows.select(
        "vec_id",
        F.aggregate("vec", F.lit(0).cast("bigint"), lambda t, x: t + x).alias("total"),
        F.size("vec").cast("bigint").alias("size"),
        F.array_max("vec").alias("most"),
    )


@query(
    """
    WITH names AS (SELECT DISTINCT 'k' || user_id % 40 || CASE WHEN user_id % 2 = 0 THEN '-a' ELSE '.b' END AS p FROM events)
    SELECT row_number() OVER (ORDER BY regexp_replace(p, '[^A-Za-z0-9]', '_', 'g'), p) AS position, p AS "fieldPath" FROM names
    """
)
def infer_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposed columns come in the order of their names."""
    message = """
    concat('{"k', user_id % 40, CASE WHEN user_id % 2 = 0 THEN '-a":1' ELSE '":{"b":1}' END, '}')
    """
    proposal = infer.infer_mapping(decode(m.messages(spark, sf_dir, "events", [], message)))
    # Numbered as they come, not sorted anew.
    placed = proposal.select("fieldPath", F.monotonically_increasing_id().alias("place"))
    position = F.row_number().over(Window.orderBy("place")).cast("bigint")
    return placed.select(position.alias("position"), "fieldPath")


@query("SELECT 0 AS paths, count(*) AS messages FROM events WHERE value < -1")
def infer_empty_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No message, no proposal."""
    raw = m.event_messages(spark, sf_dir)
    none = raw.join(m.table(spark, sf_dir, "events").filter("value < -1").select("event_id"), "event_id", "left_semi")
    paths = infer.infer_mapping(decode(none)).agg(F.count("*").cast("int").alias("paths"))
    return paths.join(none.agg(F.count("*").alias("messages")))


@query(
    """
    WITH turns AS (SELECT event_id, user_id, user_id % 8 AS p,
                          row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) AS turn
                   FROM events)
    SELECT p AS "partition", event_id AS "offset", user_id FROM turns ORDER BY turn, p LIMIT 100
    """
)
def even_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """100 messages taken in turn from all partitions of a topic, users being spread over 8,
    and loaded."""
    keep = ["user_id % 8 AS partition", "event_id AS offset"]
    raw = m.messages(spark, sf_dir, "events", keep, m.EVENT_MESSAGE)
    spec = LoadSpec("sample", m.EVENT_MAPPING[4:])
    return load_rows(sample.sample_even(raw, 100), spec, ["partition", "offset"])


@query(
    """
    WITH topic AS (SELECT event_id, user_id, CASE WHEN user_id % 8 < 5 THEN 0 ELSE user_id % 8 END AS p FROM events),
    turns AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY event_id) AS turn FROM topic)
    SELECT p AS "partition", event_id AS "offset", user_id FROM turns ORDER BY turn, p LIMIT 4000
    """
)
def even_sample_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4,000 messages taken in turn from partitions of which one has most of the topic, and gaps, and loaded."""
    keep = ["CASE WHEN user_id % 8 < 5 THEN 0 ELSE user_id % 8 END AS partition", "event_id AS offset"]
    raw = m.messages(spark, sf_dir, "events", keep, m.EVENT_MESSAGE)
    spec = LoadSpec("sample", m.EVENT_MAPPING[4:])
    return load_rows(sample.sample_even(raw, 4000), spec, ["partition", "offset"])


@query("SELECT least(100, count(*)) AS messages, 1 AS paths FROM events")
def topic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample taken off the start of a stream, and how many paths it shows."""
    source = SourceSpec(
        "parquet", {"pathGlobFilter": "events.parquet"}, sf_dir, value="props", schema="event_id long, props string"
    )
    decoded = decode(sample_topic(spark, source, 100, shared_dir(spark)))
    leaves = flatten.flatten(decoded, depth=1)
    return leaves.agg(F.count("*").alias("messages"), F.countDistinct("path").cast("int").alias("paths"))


@query(
    """
    SELECT '{"user":{"id":' || (event_id + 1) || ',"email":"user' || CASE WHEN event_id < 9 THEN '0' ELSE '' END || (event_id + 1)
           || '@example.com"},"event":{"ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S.%g')
           || '","type":"test","value":' || event_id || '.0}}' AS value
    FROM events
    """
)
def generate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A test message per row, numbered by it."""
    events = m.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return test_messages(events, "event_id", F.col("ts"))


@query(
    """
    WITH fields AS (SELECT 'part.' || p_partkey AS path, p_partkey AS pos FROM part),
    edits AS (SELECT 'part.' || s_suppkey * 10 AS path,
                     CASE WHEN s_nationkey = 0 THEN '' ELSE 'c' || s_suppkey END AS col,
                     CASE WHEN s_acctbal < 0 THEN 'Float64' END AS type FROM supplier),
    target AS (SELECT 'c' || c_custkey AS name, c_mktsegment AS type FROM customer WHERE c_acctbal > 0),
    current AS (SELECT 'part.' || o_orderkey AS path, 'old' || o_orderkey AS col, o_orderpriority AS type,
                       o_orderstatus = 'F' AS nullable FROM orders),
    chosen AS (SELECT f.path, e.col, coalesce(e.type, t.type, 'String') AS type
               FROM fields f JOIN edits e ON e.path = f.path LEFT JOIN target t ON t.name = e.col
               WHERE e.col <> '')
    SELECT coalesce(c.path, n.path) AS "fieldPath", coalesce(n.col, c.col) AS "column",
           coalesce(n.type, c.type) AS "type", coalesce(c.nullable, false) AS "nullable"
    FROM current c FULL JOIN chosen n ON n.path = c.path
    """
)
def resolve_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen columns and target types put into a current mapping, all four as large tables."""
    part, supplier, customer, orders = (
        m.table(spark, sf_dir, t) for t in ("part", "supplier", "customer", "orders")
    )
    fields = part.selectExpr("concat('part.', p_partkey) AS fieldPath", "p_partkey AS position")
    edits = supplier.selectExpr(
        "concat('part.', s_suppkey * 10) AS fieldPath",
        "CASE WHEN s_nationkey = 0 THEN '' ELSE concat('c', s_suppkey) END AS column",
        "CASE WHEN s_acctbal < 0 THEN 'Float64' END AS type",
    )
    target = customer.filter("c_acctbal > 0").selectExpr(
        "concat('c', c_custkey) AS name", "c_mktsegment AS type"
    )
    current = orders.selectExpr(
        "o_orderkey AS position",
        "concat('part.', o_orderkey) AS fieldPath",
        "concat('old', o_orderkey) AS column",
        "o_orderpriority AS type",
        "o_orderstatus = 'F' AS nullable",
    )
    return resolve.resolve_mapping(fields, edits, target, current)


# --- sinks and streams --------------------------------------------------------------


@query(
    """
    SELECT event_id, epoch_us(ts) + 1 AS ts_micros, event_type, value FROM events
    """
)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice, the second time a microsecond later: the later one stays."""
    events = m.table(spark, sf_dir, "events").select(
        "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_micros"), "event_type", "value"
    )
    again = events.withColumn("ts_micros", F.col("ts_micros") + 1)
    return dedup.latest_per_key(events.unionByName(again), ["event_id"], ["ts_micros"])


@query(
    """
    SELECT CASE WHEN event_id % 4 <> 0 THEN event_id END AS id, user_id, copy
    FROM events, (VALUES (1), (2)) AS c(copy) WHERE event_id % 4 = 0 OR copy = 2
    """
)
def dedup_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice, a quarter of them without the key: those all stay."""
    events = m.table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN event_id % 4 <> 0 THEN event_id END AS id", "user_id", "explode(array(1, 2)) AS copy"
    )
    return dedup.latest_per_key(events, ["id"], ["copy"])


@query(
    """
    SELECT * FROM (
      SELECT 'rows' AS what, count(*) AS n, CAST(sum(CASE WHEN user_id <= 127 THEN user_id END) AS BIGINT) AS total FROM events
      UNION ALL SELECT 'rejects', count(*), CAST(-1 AS BIGINT) FROM events WHERE user_id > 127)
    WHERE n > 0
    """
)
def load_narrow_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with a narrower column than is mapped, named in other case: what does not fit is NULL and a reject."""
    root, name = shared_dir(spark), f"jsonflow_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (USER_ID tinyint) USING parquet LOCATION '{root}/rows'")
    sink = SinkSpec(table=name, rejects_path=f"{root}/rejects")
    spec = LoadSpec("events", m.EVENT_MAPPING[4:], sink=sink)
    drain(spark, spec, f"{root}/checkpoint", messages=event_stream(spark, sf_dir, pathGlobFilter="events.parquet"))
    rows = spark.table(name).agg(F.count("*").alias("n"), F.sum("user_id").alias("total"))
    rejects = spark.read.parquet(f"{root}/rejects").agg(F.count("*").alias("n"), F.lit(-1).cast("bigint").alias("total"))
    both = rows.select(F.lit("rows").alias("what"), "n", "total").union(rejects.select(F.lit("rejects"), "n", "total"))
    return both.filter("n > 0")


@query(
    """
    SELECT 5 AS batches, count(*) AS "rows", CAST(sum(user_id) AS BIGINT) AS total FROM events
    """
)
def load_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog of ten files, loaded two at a time; together the batch load."""
    root = shared_dir(spark)
    m.event_messages(spark, sf_dir).select("value").repartition(10).write.parquet(f"{root}/in")
    source = SourceSpec("parquet", {"maxFilesPerTrigger": "2"}, f"{root}/in", schema="value string")
    spec = LoadSpec("events", m.EVENT_MAPPING[4:], source=source, sink=SinkSpec(path=f"{root}/rows"))
    drain(spark, spec, f"{root}/checkpoint", log_path=f"{root}/log")
    log = jobs.read_log(spark, f"{root}/log").groupBy("job").agg(F.count("*").cast("int").alias("batches"), F.sum("rows").alias("rows"))
    loaded = spark.read.parquet(f"{root}/rows").select(F.lit("events").alias("job"), "user_id")
    return log.join(loaded.groupBy("job").agg(F.sum("user_id").alias("total")), "job").drop("job")


@query(
    """
    SELECT count(*) AS "rows", CAST(sum(user_id) AS BIGINT) AS total, least(count(*), 500) AS most, true AS told FROM events
    """
)
def load_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog cut into inserts of at most 500 rows; the log has the size of each, as the files have."""
    root = shared_dir(spark)
    m.event_messages(spark, sf_dir).select("value").coalesce(1).write.parquet(f"{root}/in")
    source = SourceSpec("parquet", path=f"{root}/in", schema="value string")
    sink = SinkSpec(path=f"{root}/rows", batch_size=500, cut_inserts=True)
    drain(spark, LoadSpec("cut", m.EVENT_MAPPING[4:], source=source, sink=sink), f"{root}/checkpoint", log_path=f"{root}/log")
    logged = jobs.read_log(spark, f"{root}/log").groupBy("rows").agg(F.count("*").alias("inserts"))
    files = spark.read.parquet(f"{root}/rows").groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("size"), F.sum("user_id").alias("ids"))
    sizes = files.groupBy("size").agg(F.count("*").alias("files"), F.sum("ids").alias("ids"))
    both = logged.join(sizes, F.col("rows") == F.col("size"), "full")
    return both.agg(
        F.sum(F.col("size") * F.col("files")).alias("rows"), F.sum("ids").alias("total"), F.max("rows").alias("most"),
        F.every(F.coalesce(F.col("inserts") == F.col("files"), F.lit(False))).alias("told"),
    )


WIDE = [f"{kind}{i}" for i in range(25) for kind in ("l", "q", "d", "f")]


@query(
    """
    SELECT l_orderkey, l_linenumber, CAST({longs} AS BIGINT) AS longs, {flags} AS flags FROM lineitem
    """.format(
        longs=" + ".join(f"(l_partkey + {i})" for i in range(25)),
        flags=" || ".join("l_returnflag" for _ in range(25)),
    )
)
def load_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping of a hundred columns, all of them used."""
    types = {"l": "Int64", "q": "Float64", "d": "DateTime", "f": "String"}
    values = {"l": "l_partkey + {i}", "q": "l_quantity", "d": "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')", "f": "l_returnflag"}
    members = ", ".join(f"'{c}', {values[c[0]].format(i=c[1:])}" for c in WIDE)
    mapping = read_mapping([{"fieldPath": f"row.{c}", "column": c, "type": types[c[0]]} for c in WIDE])
    raw = m.messages(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"], f"to_json(named_struct('row', named_struct({members})))")
    rows = load_rows(raw, LoadSpec("wide", mapping), ["l_orderkey", "l_linenumber"])
    whole = F.forall(F.array(*[F.col(c) for c in WIDE if c[0] == "d"]), lambda x: x.isNotNull())
    longs = sum((F.col(c) for c in WIDE if c[0] == "l"), F.lit(0).cast("bigint"))
    flags = F.concat(*[F.col(c) for c in WIDE if c[0] == "f"])
    return rows.filter(whole).select("l_orderkey", "l_linenumber", longs.alias("longs"), flags.alias("flags"))


@query(
    """
    SELECT 'a' AS job, user_id FROM events WHERE CASE WHEN ts < '2024-01-15' THEN user_id > 100 ELSE user_id < 10 END
    UNION ALL
    SELECT 'b', user_id FROM events WHERE user_id > 50
    """
)
def fan_out_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs on one stream follow filters of their own: one changes, one becomes invalid at a restart."""
    root = shared_dir(spark)

    def bound(operator: str, value: int) -> FilterSpec:
        return rules(rule("user.id", operator, value))

    specs = [LoadSpec(name, m.EVENT_MAPPING[4:], sink=SinkSpec(path=f"{root}/{name}")) for name in "ab"]
    events = m.table(spark, sf_dir, "events")
    first, last = F.col("ts") < "2024-01-15", F.col("ts") >= "2024-01-15"
    for part, a, b in (
        (first, bound("gt", 100), bound("gt", 50)),
        (last, bound("lt", 10), sql("id >< 3", id="user.id")),
    ):
        events.filter(part).write.mode("append").parquet(f"{root}/in")
        sources = {"a": lambda _, spec=a: spec, "b": lambda _, spec=b: spec}
        drain(spark, specs, f"{root}/checkpoint", messages=event_stream(spark, f"{root}/in"), filter_source=sources)
    rows = [spark.read.parquet(f"{root}/{s.id}").select(F.lit(s.id).alias("job"), "user_id") for s in specs]
    return rows[0].union(rows[1])


@query(
    """
    SELECT * FROM (VALUES ('event_ts', 'timestamp', 1), ('event_type', 'string', 2),
      ('event_value', 'double', 3), ('user_email', 'string', 4), ('user_id', 'bigint', 5)) AS t(name, type, position)
    CROSS JOIN (SELECT count(*) AS filled FROM events)
    """
)
def target_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made from a mapping and loaded; its columns and how often each is filled."""
    name = f"jsonflow_{uuid.uuid4().hex}"
    sink = SinkSpec(table=name, path=f"{shared_dir(spark)}/{name}", create_if_missing=True)
    sinks.ensure_table(spark, sink, m.EVENT_MAPPING)
    sinks.append(load_rows(m.event_messages(spark, sf_dir), LoadSpec("events", m.EVENT_MAPPING)), sink)
    columns = [c.column for c in m.EVENT_MAPPING]
    filled = spark.table(name).agg(*[F.count(c).alias(c) for c in columns])
    counts = filled.unpivot([], columns, "name", "filled")
    return sinks.target_columns(spark, name).join(counts, "name")


def event_stream(spark: SparkSession, directory: str, sql: str = m.EVENT_MESSAGE, **options) -> DataFrame:
    """Event files of a folder as a stream of messages."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    return spark.readStream.schema(schema).options(**options).parquet(directory).selectExpr(f"{sql} AS value")


def drain(spark: SparkSession, *args, **options) -> None:
    jobs.start(spark, *args, drain=True, **options).awaitTermination()


@query(
    """
    SELECT epoch_us(ts) AS event_ts, event_type, value AS event_value,
           'user' || user_id || '@example.com' AS user_email, user_id
    FROM events WHERE event_type = 'purchase' AND value > 20
    """
)
def stream_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event load as a stream, run to the end, then started again: nothing loads twice."""
    root = shared_dir(spark)
    spec = LoadSpec("events", m.EVENT_MAPPING, sink=SinkSpec(path=f"{root}/rows"), filter=BIG_PURCHASES)
    for _ in range(2):
        stream = event_stream(spark, sf_dir, pathGlobFilter="events.parquet")
        drain(spark, spec, f"{root}/checkpoint", messages=stream)
    rows = spark.read.parquet(f"{root}/rows").drop("batch_id")
    return rows.withColumn("event_ts", F.unix_micros("event_ts"))


@query(
    """
    SELECT what, n, total FROM (
      SELECT 'rows' AS what, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS total FROM events
      UNION ALL SELECT 'log', 5, count(*) FROM events)
    """
)
def stream_table_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream into a table that is lost after every insert, before its progress is committed: every row is there once."""
    root, name = shared_dir(spark), f"jsonflow_{uuid.uuid4().hex}"
    m.event_messages(spark, sf_dir).select("value").repartition(10).write.parquet(f"{root}/in")
    source = SourceSpec("parquet", {"maxFilesPerTrigger": "2"}, f"{root}/in", schema="value string")
    sink = SinkSpec(table=name, path=f"{root}/rows", create_if_missing=True)
    spec = LoadSpec("events", m.EVENT_MAPPING[4:], source=source, sink=sink)
    sinks.ensure_table(spark, sink, spec.mapping)
    lost: set[int] = set()

    def run_once() -> None:
        loader = jobs.BatchLoader([spec], f"{root}/log", state=f"{root}/checkpoint/jsonflow")

        def insert(batch: DataFrame, batch_id: int) -> None:
            loader(batch, batch_id)
            if batch_id not in lost:
                lost.add(batch_id)
                raise RuntimeError("lost before the commit")

        messages = loader.plan(stream_messages(spark, source))
        writer = messages.writeStream.foreachBatch(insert).option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()

    while True:
        try:
            run_once()
            break
        except StreamingQueryException as e:
            if "lost before the commit" not in str(e):
                raise
    rows = spark.table(name).select(F.lit("rows").alias("what"), F.count("*").alias("n"), F.sum("user_id").alias("total"))
    log = jobs.read_log(spark, f"{root}/log")
    return rows.union(log.select(F.lit("log"), F.count("*"), F.sum("rows")))


@query(
    """
    SELECT event_id, epoch_us(ts) + 7200000000 AS ts_micros, event_type, value + 1 AS value FROM events
    """
)
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event three times on a stream, in any order over four batches: the latest state of each is kept."""
    root = shared_dir(spark)
    event = "to_json(struct(event_id, unix_micros(CAST(ts AS timestamp)) + copy * 3600000000 AS ts, event_type, value + copy - 1 AS value)) AS value"
    copies = m.table(spark, sf_dir, "events").selectExpr("*", "explode(array(2, 0, 1)) AS copy")
    copies.selectExpr("event_id", "copy", event).repartition(16, F.xxhash64("event_id", "copy")).write.parquet(f"{root}/in")
    mapping = read_mapping(
        [
            {"fieldPath": "event_id", "column": "event_id", "type": "Int64"},
            {"fieldPath": "ts", "column": "ts_micros", "type": "Int64"},
            {"fieldPath": "event_type", "column": "event_type", "type": "String"},
            {"fieldPath": "value", "column": "value", "type": "Float64"},
        ]
    )
    source = SourceSpec("parquet", {"maxFilesPerTrigger": "4"}, f"{root}/in", schema="value string")
    sink = SinkSpec(path=f"{root}/latest", latest_keys=["event_id"], latest_order=["ts_micros"])
    drain(spark, LoadSpec("events", mapping, source=source, sink=sink), f"{root}/checkpoint")
    return sinks.latest_table(sink).read(spark)


@query("SELECT event_id, event_type FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message delivered twice on a stream; repeats within a day are dropped."""
    root = shared_dir(spark)
    schema = "event_id long, ts timestamp_ntz, event_type string"
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    twice = events.selectExpr("event_id", "CAST(ts AS timestamp) AS ts", "event_type", "explode(array(1, 2)) AS copy")
    once = dedup.first_seen(twice, ["event_id"], "ts", "1 day").drop("copy", "ts")
    writer = once.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start(f"{root}/rows").awaitTermination()
    return spark.read.parquet(f"{root}/rows")


@query(
    """
    SELECT event_type, user_id, value AS event_value FROM events
    WHERE CASE WHEN ts < '2024-01-11' THEN event_type = 'purchase' ELSE event_type = 'signup' END
    """
)
def stream_filter_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter changed between micro-batches, then replaced by one that is invalid.

    The events arrive in three parts. The second part meets the changed filter; the third
    part meets an invalid one, so the changed filter stays in force.
    """
    root = shared_dir(spark)
    events = m.table(spark, sf_dir, "events")
    mapping = [c for c in m.EVENT_MAPPING if c.column in ("event_type", "user_id", "event_value")]
    first = rules(rule("event.type", "equals", "purchase"))
    spec = LoadSpec("events", mapping, sink=SinkSpec(path=f"{root}/rows"), filter=first)
    parts = [
        (F.col("ts") < "2024-01-11", first),
        (F.col("ts").between("2024-01-11", "2024-01-20 23:59:59.999999"), rules(rule("event.type", "equals", "signup"))),
        (F.col("ts") > "2024-01-20 23:59:59.999999", sql("event_type ==== 'view'")),
    ]
    # One loader lives through the parts, as it does through the batches of a long run.
    current = {}
    loader = jobs.BatchLoader([spec], filter_source=lambda _: current["filter"])
    for part, current["filter"] in parts:
        events.filter(part).write.mode("append").parquet(f"{root}/in")
        stream = event_stream(spark, f"{root}/in")
        writer = stream.writeStream.foreachBatch(loader).option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/rows").select("event_type", "user_id", "event_value")


@query(
    """
    SELECT 'purchases' AS job, event_type, user_id, value AS amount FROM events
    WHERE event_type = 'purchase' AND value > 20
    UNION ALL
    SELECT 'people', event_type, user_id, CAST(-1 AS DOUBLE) FROM events WHERE event_type IN ('signup', 'click')
    """
)
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs with their own filter, mapping and sink on one stream that is parsed once."""
    root = shared_dir(spark)
    amounts = read_mapping(
        [
            {"fieldPath": "event.type", "column": "event_type", "type": "String"},
            {"fieldPath": "user.id", "column": "user_id", "type": "Int64"},
            {"fieldPath": "event.value", "column": "amount", "type": "Float64"},
        ]
    )
    people = sql("type IN ('signup', 'click')", type="event.type")
    specs = [
        LoadSpec("purchases", amounts, sink=SinkSpec(path=f"{root}/purchases"), filter=BIG_PURCHASES),
        LoadSpec("people", amounts[:2], sink=SinkSpec(path=f"{root}/people"), filter=people),
    ]
    stream = event_stream(spark, sf_dir, pathGlobFilter="events.parquet")
    drain(spark, specs, f"{root}/checkpoint", messages=stream)
    loaded = [
        spark.read.parquet(f"{root}/{s.id}").drop("batch_id").withColumn("job", F.lit(s.id)) for s in specs
    ]
    every = loaded[0].unionByName(loaded[1], allowMissingColumns=True)
    return every.withColumn("amount", F.coalesce("amount", F.lit(-1.0)))


@query(
    """
    SELECT 'events' AS job, count(*) FILTER (event_id % 6 < 6) AS rows, 0 AS errors,
           count(*) FILTER (event_id % 6 >= 4) + count(*) FILTER (event_id % 5 = 3) + count(*) FILTER (event_id % 6 >= 4) AS rejects
    FROM events
    """
)
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that also writes its rejects and a run log, added up afterwards."""
    root = shared_dir(spark)
    sink = SinkSpec(path=f"{root}/rows", rejects_path=f"{root}/rejects")
    spec = LoadSpec("events", m.MIXED_MAPPING, sink=sink)
    stream = event_stream(spark, sf_dir, m.MIXED_MESSAGE, pathGlobFilter="events.parquet")
    drain(spark, spec, f"{root}/checkpoint", log_path=f"{root}/log", messages=stream)
    log = jobs.read_log(spark, f"{root}/log")
    sums = log.groupBy("job").agg(
        F.sum("rows").alias("rows"), F.count_if(F.col("error").isNotNull()).cast("int").alias("errors")
    )
    return sums.crossJoin(spark.read.parquet(f"{root}/rejects").agg(F.count("*").alias("rejects")))


# --- run statistics -----------------------------------------------------------------

# Every event type stands for a job, every hour for a batch; dear events are errors.
RUN_LOG = """
run_log AS (
  SELECT event_type AS job, epoch_us(date_trunc('hour', ts)) // 3600000000 AS batch_id, count(*) AS n,
         max(ts) AS logged, max(value) / 100 AS seconds, NULL AS error, NULL AS message
  FROM events GROUP BY 1, 2
  UNION ALL
  SELECT event_type, event_id, 0, ts, 0, CASE WHEN user_id % 2 = 0 THEN 'insert' ELSE 'source' END,
         'failed ' || event_id
  FROM events WHERE value > 30)
"""


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = m.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    hour = F.floor(F.unix_seconds("ts") / 3600).alias("batch_id")
    none = F.lit(None).cast("string")
    batches = events.groupBy(F.col("event_type").alias("job"), hour).agg(
        F.count("*").alias("rows"),
        F.max("ts").alias("at"),
        (F.max("value") / 100).alias("seconds"),
        none.alias("error"),
        none.alias("message"),
    )
    errors = events.filter("value > 30").select(
        F.col("event_type").alias("job"),
        F.col("event_id").alias("batch_id"),
        F.lit(0).cast("bigint").alias("rows"),
        F.col("ts").alias("at"),
        F.lit(0.0).alias("seconds"),
        F.when(F.col("user_id") % 2 == 0, "insert").otherwise("source").alias("error"),
        F.concat(F.lit("failed "), "event_id").alias("message"),
    )
    return batches.unionByName(errors)


@query(
    f"""
    WITH {RUN_LOG}
    SELECT job, count(*) AS batches_total, CAST(sum(n) AS BIGINT) AS rows_total
    FROM run_log WHERE error IS NULL GROUP BY job
    """
)
def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches and rows per job."""
    return runlog.totals(run_log(spark, sf_dir))


@query(
    f"""
    WITH {RUN_LOG},
    bounds AS (SELECT unnest(['0.005', '0.01', '0.025', '0.05', '0.1', '0.25', '0.5', '1', '2.5', '5', '10', '+Inf']) AS le)
    SELECT job, le, count(*) FILTER (le = '+Inf' OR seconds <= TRY_CAST(le AS DOUBLE)) AS count
    FROM run_log CROSS JOIN bounds WHERE error IS NULL GROUP BY job, le
    """
)
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative latency buckets per job."""
    return runlog.latency_histogram(run_log(spark, sf_dir))


@query(
    f"""
    WITH {RUN_LOG}
    SELECT job, error AS kind, count(*) AS errors FROM run_log WHERE error IS NOT NULL GROUP BY ALL
    """
)
def error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors per job and kind."""
    return runlog.error_counts(run_log(spark, sf_dir))


@query(
    f"""
    WITH {RUN_LOG},
    jobs AS (SELECT DISTINCT event_type AS id, 'type ' || event_type AS name FROM events
             UNION ALL SELECT n_name, 'nation ' || n_name FROM nation)
    SELECT j.id, j.name, coalesce(CAST(sum(n) AS BIGINT), 0) AS total_rows,
           coalesce(arg_max(n, row(logged, batch_id)) FILTER (error IS NULL), -1) AS last_batch,
           coalesce(epoch_us(max(logged) FILTER (error IS NULL)), -1) AS last_batch_at,
           coalesce(arg_max(message, row(logged, batch_id)) FILTER (error IS NOT NULL), '') AS last_error
    FROM jobs j LEFT JOIN run_log l ON l.job = j.id GROUP BY j.id, j.name
    """
)
def job_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All registered jobs with their status; nations are jobs that never ran."""
    types = m.table(spark, sf_dir, "events").select(F.col("event_type").alias("id")).distinct()
    nations = m.table(spark, sf_dir, "nation").select(F.col("n_name").alias("id"))
    specs = types.withColumn("name", F.concat(F.lit("type "), "id")).unionByName(
        nations.withColumn("name", F.concat(F.lit("nation "), "id"))
    )
    listed = runlog.job_list(specs, run_log(spark, sf_dir))
    return listed.withColumns(
        {
            "last_batch": F.coalesce("last_batch", F.lit(-1)),
            "last_batch_at": F.coalesce(F.unix_micros("last_batch_at"), F.lit(-1)),
            "last_error": F.coalesce("last_error", F.lit("")),
        }
    )
