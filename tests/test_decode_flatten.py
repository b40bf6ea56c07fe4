from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from jsonflow.operators.decode import decode, malformed, well_formed
from jsonflow.operators.flatten import flatten

MALFORMED = [
    "nope", "", " ", "NaN", "{'a':1}", '{"a":1', '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}',
    '{"a":1}]', '{"a":1}],[', '{"a":01}', '{"a":NaN}', '{"a":+1}', '{"a":.5}', '{"a":1.}', '{"a":1,}',
    '/* c */{"a":1}', '{"a":"x\ty"}', None,
]
WHOLE = ['{"a":1}', ' {"a":1}\n', "5", "null", "[1,2]", '"s"', "true", "{}", '{"a":1,"a":2}']


def test_malformed_messages_are_told_apart(texts):
    decoded = decode(texts(*MALFORMED, *WHOLE), keep=["id"])
    assert {r.id for r in well_formed(decoded).collect()} == set(
        range(len(MALFORMED), len(MALFORMED) + len(WHOLE))
    )
    letters = {r.id: r for r in malformed(decoded, ["id"]).collect()}
    assert set(letters) == set(range(len(MALFORMED)))
    assert letters[6].value == '{"a":1} x'
    assert {(r.stage, r.reason) for r in letters.values()} == {("decode", "malformed JSON")}


def test_binary_messages_and_repeated_keys(spark):
    df = spark.createDataFrame([(bytearray(b'{"a":1,"a":{"b":2}}'),)], "value binary")
    [row] = flatten(decode(df)).select("path", F.col("value").cast("string").alias("v")).collect()
    assert (row.path, row.v) == ("a.b", "2")


def leaves(df, **options):
    rows = flatten(decode(df, keep=["id"]), keep=["id"], **options)
    text = F.when(F.is_variant_null("value"), "null").otherwise(F.col("value").cast("string"))
    got = rows.select("id", "path", text.alias("v"), F.schema_of_variant("value").alias("k")).collect()
    return sorted((r.id, r.path, r.v, r.k) for r in got)


def test_flatten_rules(texts):
    df = texts(
        '{"u":{"id":1,"t":["x",{"y":1}]},"e":{},"n":null}', "5", "[1,2]", "null", "{}",
        '{"a.b":7,"a":{"c":8}}', "bad", '{"":{"b":3}}', '{"a":{"":8}}',
    )
    assert leaves(df) == [
        (0, "n", "null", "VOID"),
        (0, "u.id", "1", "BIGINT"),
        (0, "u.t", '["x",{"y":1}]', "ARRAY<VARIANT>"),
        (1, "", "5", "BIGINT"),
        (2, "", "[1,2]", "ARRAY<BIGINT>"),
        (3, "", "null", "VOID"),
        (5, "a.b", "7", "BIGINT"),
        (5, "a.c", "8", "BIGINT"),
        (7, "b", "3", "BIGINT"),
        (8, "a.", "8", "BIGINT"),
    ]
    assert [r for r in leaves(df, arrays_as_text=True) if r[1] in ("u.t", "") and r[0] in (0, 2)] == [
        (0, "u.t", '["x",{"y":1}]', "STRING"),
        (2, "", "[1,2]", "STRING"),
    ]
    assert all(path for _, path, _, _ in leaves(df, roots=False))


def nest(depth: int) -> str:
    doc = {"leaf": "} { \" {{{"}
    for level in range(depth - 1, 0, -1):
        doc = {f"k{level}": doc, "s": "{" * 30}
    return json.dumps(doc)


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 5, 6, 7, 12, 30, 500])
def test_every_leaf_is_found_whatever_texts_hold(texts, depth):
    df = texts(nest(depth), '{"a":"{{{{{{{{{{{{{{{{"}', '{"a":[{"b":{}},{},{},{},{},{},{},{},{}]}', "{" * 100_000)
    deepest = ".".join([f"k{i}" for i in range(1, depth)] + ["leaf"])
    found = leaves(df)
    assert (0, deepest, '} { " {{{', "STRING") in found
    assert len([x for x in found if x[0] == 0]) == depth


def test_texts_of_braces_in_deep_objects_are_quick(texts):
    deep = '{"a":{"b":{"c":{"d":{"e":{"f":{},"t":"' + "{" * 100_000 + '","n":null,"l":[{"x":1}]}}}}}}'
    got = leaves(texts(deep, '{"a":{"b":{"c":{"d":{}}}}}'))
    assert [x[1] for x in got] == ["a.b.c.d.e.l", "a.b.c.d.e.n", "a.b.c.d.e.t"]


def test_deeper_objects_stay_unopened(texts):
    assert leaves(texts('{"a":{"b":{"c":1}}}'), depth=2) == [(0, "a.b", '{"c":1}', "OBJECT<c: BIGINT>")]


def test_flatten_agrees_with_a_plain_walk(texts):
    docs = [
        {"a": i, "b": {"c": str(i), "d": {"e": [i], "f": None}}, f"x{i % 3}": {"y": i % 2 == 0}}
        for i in range(40)
    ]

    def walk(prefix, v):
        if isinstance(v, dict):
            for key, inner in v.items():
                yield from walk(f"{prefix}.{key}" if prefix else key, inner)
        else:
            yield prefix, json.dumps(v, separators=(",", ":"))

    want = sorted((i, p, t) for i, d in enumerate(docs) for p, t in walk("", d))
    rows = flatten(decode(texts(*map(json.dumps, docs)), keep=["id"]), keep=["id"])
    got = sorted((r.id, r.path, r.t) for r in rows.select("id", "path", F.to_json("value").alias("t")).collect())
    assert got == want


@pytest.mark.parametrize(
    "text, levels",
    [
        ("1", 0), ("[]", 0), ("{}", 1), ('{"a":{"b":{}},"c":{}}', 3), ('{"a":[{"b":{"c":{}}}],"d":{}}', 2), ('[{"a":{}}]', 0),
        (r'{"{\"{":"}\\"}', 1), (r'{"a\\":{"b\\\"{":{}}}', 3), (r'{"a":"\\\\","b":{"c":"\\\"}{"}}', 2),
    ],
)
def test_levels_are_counted_outside_texts_and_lists(spark, text, levels):
    from jsonflow.operators.flatten import _levels

    assert spark.createDataFrame([(text,)], "t string").select(_levels(F.col("t"))).first()[0] == levels


def test_wide_deep_objects_take_time_by_size(spark):
    """As many objects beside each other as took minutes when every brace was a pass over all of them."""
    import time

    members = {f"k{i}": {"x": i} for i in range(32_000)}
    flat, deep = json.dumps(members), json.dumps({"a": {"b": {"c": {"d": {"e": members}}}}})

    def seconds(text):
        df = flatten(decode(spark.createDataFrame([(text,)], "value string"))).agg(F.count("*"), F.max(F.length("path")))
        df.collect()
        started = time.monotonic()
        assert df.first()[0] == 32_000
        return time.monotonic() - started

    assert seconds(deep) < 4 * seconds(flat) + 2
