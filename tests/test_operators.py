from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from jsonflow.operators import dedup, infer, leaves, resolve, runlog, sample
from jsonflow.operators.decode import decode
from jsonflow.operators.project import project
from jsonflow.plans.load import load_rows
from jsonflow.plans.spec import Field, LoadSpec
from jsonflow.sources.generate import test_messages as generate

SEED = [
    {"user": {"id": 1, "email": "a@example.com"}, "event": {"ts": "2025-10-05T12:00:00Z", "type": "signup", "value": 1}},
    {"user": {"id": 2, "email": "b@example.com"}, "event": {"ts": "2025-10-05T12:01:00Z", "type": "purchase", "value": 23.5}},
    {"user": {"id": 3, "email": None}, "event": {"ts": "2025-10-05T12:02:00Z", "type": "page_view", "value": None}},
]


def inferred(df):
    return [tuple(r) for r in infer.infer_mapping(decode(df)).collect()]


def test_infer_seed_messages(texts):
    assert inferred(texts(*map(json.dumps, SEED), "nope", "5")) == [
        ("event.ts", "event_ts", "String", False),
        ("event.type", "event_type", "String", False),
        ("event.value", "event_value", "Nullable(Float64)", True),
        ("user.email", "user_email", "Nullable(String)", True),
        ("user.id", "user_id", "Int64", False),
    ]


@pytest.mark.parametrize(
    "values,want",
    [
        (["null", "null"], "Nullable(Bool)"),
        (["1", "1.0"], "Int64"),
        (["1", "1e3"], "Int64"),
        (["9007199254740993"], "Int64"),
        (["1", "1.5"], "Float64"),
        (["1", "1e20"], "Float64"),
        (["12345678901234567890"], "Float64"),
        (["true", "false"], "Bool"),
        (["true", "1"], "String"),
        (["true", '"x"'], "String"),
        (["1", '"1"'], "String"),
        (["[1]"], "String"),
        (["[1]", "null"], "Nullable(String)"),
        (["null", "1.5"], "Nullable(Float64)"),
    ],
)
def test_infer_votes(texts, values, want):
    rows = inferred(texts(*[f'{{"v":{v}}}' for v in values], '{"other":1}'))
    assert rows[1] == ("v", "v", want, "Nullable" in want)


def test_infer_does_not_depend_on_order_or_partitions(texts):
    docs = [{"a": random.Random(i).choice([1, 2.5, None, True]), f"k{i % 4}": i} for i in range(200)]
    want = inferred(texts(*map(json.dumps, docs), partitions=1))
    random.Random(7).shuffle(docs)
    assert inferred(texts(*map(json.dumps, docs), partitions=7)) == want


def test_infer_messages_deeper_than_usual(texts):
    deep = 7
    for level in range(12, 0, -1):
        deep = {f"k{level}": deep}
    path = ".".join(f"k{i}" for i in range(1, 13))
    rows = inferred(texts(json.dumps(deep), '{"a":1}'))
    assert [(r[0], r[2]) for r in rows] == [("a", "Int64"), (path, "Int64")]


def test_infer_nothing_and_name_clashes(texts):
    assert inferred(texts("nope", "5", "{}")) == []
    assert inferred(texts()) == []
    df = infer.infer_mapping(decode(texts('{"a.b":1,"a-b":2,"c":3}')))
    assert [tuple(r) for r in df.collect()][0] == ("a-b", "a_b", "Int64", False)
    assert sorted(tuple(r) for r in infer.name_clashes(df).collect()) == [("a_b", "a-b", 2), ("a_b", "a.b", 2)]
    with pytest.raises(ValueError):
        infer.accept(df)


def test_accepted_mapping_loads_the_sample(texts):
    df = texts(*map(json.dumps, SEED))
    mapping = infer.accept(infer.infer_mapping(decode(df)))
    rows = sorted(load_rows(df, LoadSpec("seed", mapping)).collect(), key=lambda r: r.user_id)
    assert [(r.user_id, r.event_value, r.user_email) for r in rows] == [
        (1, 1.0, "a@example.com"), (2, 23.5, "b@example.com"), (3, None, None),
    ]


def test_samples(spark):
    topic = spark.range(1000).select(
        F.when(F.col("id") < 900, 0).when(F.col("id") < 990, 1).otherwise(2).alias("partition"),
        F.col("id").alias("offset"),
    )
    assert [r.offset for r in sample.sample_oldest(topic, 3, ["offset"]).collect()] == [0, 1, 2]
    assert sample.sample_oldest(topic, 0, ["offset"]).count() == 100
    assert sample.sample_oldest(topic.limit(0), 5, ["offset"]).count() == 0

    def even(n):
        return [(r.partition, r.offset) for r in sample.sample_even(topic.repartition(4), n).collect()]

    assert even(7) == [(0, 0), (1, 900), (2, 990), (0, 1), (1, 901), (2, 991), (0, 2)]
    assert sorted(even(40)) == [(0, i) for i in range(15)] + [(1, 900 + i) for i in range(15)] + [
        (2, 990 + i) for i in range(10)
    ]
    assert len(even(-1)) == 100 and len(even(5000)) == 1000
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        assert len(set(even(40))) == 40  # salted first
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_even_sample_is_limited_before_the_shuffle(spark):
    plan = sample.sample_even(spark.range(10).selectExpr("id % 2 AS partition", "id AS offset"), 5)
    text = plan._jdf.queryExecution().executedPlan().toString()
    shuffle = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[shuffle:], "limited inside the scan tasks"


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, 1, "a", None), (1, 3, None, 5), (1, 2, "c", 7), (2, 1, "d", None)], "k int, at int, s string, n int"
    )
    rows = dedup.latest_per_key(df, ["k"], ["at"]).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 3, None, 5), (2, 1, "d", None)]


def test_latest_per_key_reduces_a_hot_key_before_the_shuffle(spark):
    df = spark.range(100_000).selectExpr("0 AS k", "id AS at", "id AS v")
    out = dedup.latest_per_key(df, ["k"], ["at"])
    assert tuple(out.first()) == (0, 99_999, 99_999)
    assert "partial_max_by" in out._jdf.queryExecution().executedPlan().toString()


def test_resolve_mapping(spark):
    fields = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("d", 3), ("e", 4)], "fieldPath string, position long")
    edits = spark.createDataFrame(
        [("a", "x", "Int64"), ("b", "y", ""), ("c", "z", None), ("d", "", "Bool"), ("gone", "q", "Bool")],
        "fieldPath string, column string, type string",
    )
    target = spark.createDataFrame([("y", "Float64"), ("x", "String")], "name string, type string")
    current = resolve.mapping_frame(
        spark, [Field("old", "o", "Bool", True), Field("c", "was", "Int64", True), Field("last", "l", "Date")]
    )
    rows = resolve.resolve_mapping(fields, edits, target, current).collect()
    assert [tuple(r) for r in rows] == [
        ("old", "o", "Bool", True),
        ("c", "z", "String", True),
        ("last", "l", "Date", False),
        ("a", "x", "Int64", False),
        ("b", "y", "Float64", False),
    ]


def test_run_statistics(spark):
    t = datetime(2025, 1, 1)
    log = spark.createDataFrame(
        [
            ("p", 1, 10, t, 0.004, None, None),
            ("p", 2, 20, t + timedelta(seconds=1), 0.005, None, None),
            ("p", 3, 0, t + timedelta(seconds=2), 0.1, "insert", "boom"),
            ("p", 4, 5, t + timedelta(seconds=3), 99.0, None, None),
            ("q", 1, 0, t, 0.0, "source", "lost"),
        ],
        runlog.LOG_SCHEMA,
    )
    assert [tuple(r) for r in runlog.totals(log).collect()] == [("p", 3, 35)]
    buckets = {r.le: r["count"] for r in runlog.latency_histogram(log).collect()}
    assert (buckets["0.005"], buckets["0.01"], buckets["10"], buckets["+Inf"]) == (2, 2, 2, 3)
    assert list(buckets) == ["0.005", "0.01", "0.025", "0.05", "0.1", "0.25", "0.5", "1", "2.5", "5", "10", "+Inf"]
    errors = sorted(tuple(r) for r in runlog.error_counts(log).collect())
    assert errors == [("p", "insert", 1), ("q", "source", 1)]
    specs = spark.createDataFrame([("p", "P", ""), ("q", "Q", ""), ("r", "R", "")], "id string, name string, description string")
    rows = {r.id: r for r in runlog.job_list(specs, log).collect()}
    assert (rows["p"].total_rows, rows["p"].last_batch, rows["p"].last_error) == (35, 5, "boom")
    assert (rows["q"].total_rows, rows["q"].last_batch, rows["q"].last_error) == (0, None, "lost")
    assert (rows["r"].total_rows, rows["r"].last_batch_at, rows["r"].last_error) == (0, None, None)


def test_generated_messages(spark):
    rows = [json.loads(r.value) for r in generate(spark.range(0, 120, 1, 1)).collect()]
    assert rows[0]["user"] == {"id": 1, "email": "user01@example.com"}
    assert rows[119]["user"]["email"] == "user120@example.com"
    assert rows[7]["event"]["type"] == "test" and rows[7]["event"]["value"] == 7.0
    datetime.strptime(rows[0]["event"]["ts"], "%Y-%m-%d %H:%M:%S.%f")


def test_shares_fill_from_below():
    assert sample.shares([900, 90, 10], 40) == [15, 15, 10]
    assert sample.shares([3, 0, 1], 10) == [3, 0, 1]
    assert sample.shares([5, 5, 5], 7) == [3, 2, 2] and sample.shares([], 7) == [] and sample.shares([2, 9], 0) == [0, 0]


@pytest.mark.parametrize("offset", ["id", "id * id * 1000003", "CASE WHEN id = 7 THEN 8 ELSE id END", "id DIV 3", "double(id)"])
def test_a_large_even_sample_equals_a_ranking(spark, offset):
    """Offsets with and without gaps by counting, others by ranking; partitions may be missing."""
    topic = spark.range(20_000).selectExpr("CASE WHEN id % 50 < 44 THEN 1 WHEN id % 50 < 49 THEN 2 END AS partition", f"{offset} AS offset", "id")
    turns = topic.selectExpr("*", "row_number() OVER (PARTITION BY partition ORDER BY offset, id) AS turn")
    want = {(r.partition, r.offset) for r in turns.orderBy("turn", "partition").limit(5000).collect()}
    got = sample.sample_even(topic.repartition(4), 5000)
    rows = got.collect()
    assert got.columns == topic.columns and len(rows) == 5000 and len({r.id for r in rows}) == 5000
    assert {(r.partition, r.offset) for r in rows} == want
    if offset.startswith("id") and "DIV" not in offset:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "hashpartitioning" not in plan and "Window" not in plan


KINDS = ["Int64", "Float64", "Bool", "String", "DateTime", "Date"]
MEMBERS = [
    "1", "-2.5", "1e3", "12345678901234567890", "true", "null", '"text"', '"7"', '" 8.5"', '"2024-01-02"', '" 2024-01-02 03:04:05,5"',
    '"2024-01-02T3:04:05+02:00"', '"2024-01-02 03:04"', '"20240102030"', '"1700000000000"', "[1]", "{}", '{"deep": 1}', '""', '"\\"2024-01-02\\""',
]


def test_fields_read_together_are_as_each_alone(texts, monkeypatch):
    """Members of one object: of every kind, under either spelling or both, with names a struct cannot hold."""
    paths = [*(f"row.m{i}" for i in range(len(MEMBERS))), "row.odd` '\"name", "row.Case", "row.case", "row.", "row.gone", "row.a.b"]
    mapping = [Field(p, f"c{i}_{j}", k) for i, p in enumerate(paths) for j, k in enumerate(KINDS)]
    mapping.append(Field("row.m99", "map", "map<string,int>"))
    nested = ", ".join(f'"m{i}": {v}' for i, v in enumerate(MEMBERS))
    dotted = ", ".join(f'"row.m{i}": {v}' for i, v in enumerate(reversed(MEMBERS)))
    more = '"odd` \'\\"name": 5, "Case": 1, "case": 2, "": 3, "a.b": 4, "m99": {"x": 1}'
    messages = texts(
        f'{{"row": {{{nested}, {more}}}}}', f"{{{dotted}}}", f'{{"row": {{{nested}}}, {dotted}}}', '{"row": null}', '{"row": [1]}', '{"row": {}}', "3",
        f'{{"row": {{"a": {{"b": 6}}}}, {dotted}}}', "broken",
    )

    def read():
        rows = project(decode(messages, keep=["id"]), mapping, ["id"], rejects=True)
        return sorted(tuple(map(str, r)) for r in rows.collect()), "$['row']['m1']" in rows._jdf.queryExecution().executedPlan().toString()

    together, looked_up = read()
    monkeypatch.setattr(leaves, "TOGETHER", 1000)
    assert (together, looked_up) == (read()[0], False) and read()[1]
    assert sum(x != "None" for row in together for x in row[1:-1]) > 150


# Written so that the text tells the value; and what it may be instead.
PLAIN = {
    "Int64": "7", "Float64": "0.5", "Bool": "true", "String": '"text"', "DateTime": '"2024-01-02 03:04:05"', "Date": '"2024-01-02"',
}
ODD = [
    *MEMBERS, "0", "-0", "-0.0", "-0.0e0", "0.0", "1e400", "-1e400", "1e-400", "9007199254740993", "0.1000000000000000055511151231257827", "12.50", "1E22",
    "9223372036854775807", "9223372036854775808", "1700000000", "1700000000000", "false", '"NaN"', '"Infinity"', '"true"', '"TRUE"', '"007"', '"-0"', '"-0.0"', '"1.50"',
    '"1e3"', '"-"', '"-x"', '"[x"', '"{x"', '"."', '"/"', '":"', '"@"', '"\\\\"', '"|"', '"~"', '"\\u00e9"', '"\\ud800"', '" "', '"1700000000"', '"2024-01-02T03:04:05Z"',
    '"2024-01-02T03:04:05.123456789+02:30"', '"2024-01-02 03:04:05.5"', '"2024-13-45"', '"2024-01-02\\n"', '"2024-01-02 03:04:05Z"', '[ 1,  2 ]', '{"a": [1]}',
]
# Beside plain fields: what makes a message malformed, and what does not.
BESIDE = [
    "1", "NaN", "Infinity", "+1", "01", ".5", "1.", "1e400", "1" * 999, "1" * 1001, "'x'", '"\x01"', '"\\q"', '"\\ud800"', "[1,]", "[1,,2]", "/* */ 1", "// 1", "tru", "nul",
    *("[" * n + "]" * n for n in (997, 998, 999, 1000, 1001)), '"' + "x" * 1_100_000 + '"', '{"a": 1, "a": 2}', '{"": {"": 1}}', "{'a': 1}", "{a: 1}",
]


def test_fields_read_from_the_text_are_as_in_the_parsed_message(texts, monkeypatch):
    kinds = [k for k in KINDS for _ in range(3)]
    mapping = [Field(f"row.m{i}", f"c{i}", k) for i, k in enumerate(kinds)]
    mapping.append(Field("row.m17", "text", "String"))

    def row(at=None, value="", **more):
        members = {f"m{i}": value if i == at else PLAIN[k] for i, k in enumerate(kinds)} | more
        return "{" + ", ".join(f'"{k}": {v}' for k, v in members.items()) + "}"

    plain = f'{{"row": {row()}}}'
    twice = [f'{{"row": {row()[:-1]}, "m{i}": {v}}}}}' for i in (0, 3, 6, 9, 12) for v in ("null", "8", '"9"', "[]", "{}")]
    messages = texts(
        plain, *(f'{{"row": {row(at, v)}}}' for v in ODD for at in range(0, len(kinds), 3)), *(f'{{"row": {row()}, "z": {v}}}' for v in BESIDE),
        *(f'{{"z": {v}, "row": {row()}}}' for v in BESIDE), *twice, *(f'{{"row": {row()}, "row": {v}}}' for v in ("5", "null", "[]", "{}", '{"m0": 8}', "'x'")),
        f'{{"row": 5, "row": {row()}}}', f'{{"row.m0": 8, "row": {row()}}}', f'{{"row.m0": 8, "row": {row(0, "null")}}}', f'{{"row.m0": 8, "row": {row(0, "{}")}}}',
        '{"row": {}, "row.m0": 8}', f'{{"\\u0072ow": {row()}}}', f'{{"ROW": {row()}}}', f'{{"_unfit": "x", "row": {row()}}}', f'{{"z": "_unfit", "row": {row()}}}',
        *(plain + x for x in (" ", "\n", " x", ",", ",1", "]", "}", plain, ",[", "],[")), *(x + plain for x in (" ", "﻿", "1,", "[", "x")),
        f"[{plain}]", plain[:-1], plain.replace('"', "'"), "", " ", "null", "3", '"x"', "[]", "{}", "broken", None,
    )

    def seen(df):
        return sorted(tuple(map(repr, r)) for r in df.select([F.col(c).cast("string") for c in df.columns]).collect())

    def read():
        return seen(load_rows(messages, LoadSpec("x", mapping), ["id"])), seen(project(decode(messages, keep=["id"]), mapping, ["id"], rejects=True))

    from_text = read()
    assert "from_json" in load_rows(messages, LoadSpec("x", mapping))._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(leaves, "TOGETHER", 1000)
    looked_up = read()
    for got, expected in zip(from_text, looked_up, strict=True):
        assert [x for x in got if x not in expected] == [] and got == expected
    loaded, every = map(len, looked_up)
    assert 0.8 * every < loaded < every - 30
