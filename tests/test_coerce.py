from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from jsonflow.functions.fields import searched, spellings
from jsonflow.operators.decode import decode
from jsonflow.operators.project import project
from jsonflow.plans.load import classify, load_rows, rejects_of, rows_of
from jsonflow.plans.spec import LoadSpec, read_mapping

# One row per branch: type, JSON value, expected value, expected reject reason.
CASES = [
    ("Int64", "1.9", 1, None),
    ("Int64", "-1.9", -1, None),
    ("Int64", "12.0", 12, None),
    ("Int64", "1e3", 1000, None),
    ("Int64", "9007199254740993", 9007199254740993, None),
    ("Int64", "1e20", None, "number->Int64"),
    ("Int64", '"12"', 12, None),
    ("Int64", '"+007"', 7, None),
    ("Int64", '"1.9"', 1, None),
    ("Int64", '"-1.9"', -1, None),
    ("Int64", '"1e3"', 1000, None),
    ("Int64", '"abc"', None, "text->Int64"),
    ("Int64", '" 5 "', None, "text->Int64"),
    ("Int64", '"5\\n"', None, "text->Int64"),
    ("Int64", '""', None, "text->Int64"),
    ("Int64", '"99999999999999999999"', None, "text->Int64"),
    ("Int64", "true", None, "boolean->Int64"),
    ("Int64", "[1]", None, "array->Int64"),
    ("Int64", "null", None, None),
    ("Nullable(Int64)", '"x"', None, "text->Nullable(Int64)"),
    ("Float64", "12.5", 12.5, None),
    ("Float64", "3", 3.0, None),
    ("Float64", "1e400", None, "number->Float64"),
    ("Float64", '"12.5"', 12.5, None),
    ("Float64", '".5"', 0.5, None),
    ("Float64", '"5."', 5.0, None),
    ("Float64", '"-1E-2"', -0.01, None),
    ("Float64", '" 5 "', None, "text->Float64"),
    ("Float64", '"1d"', None, "text->Float64"),
    ("Float64", '"0x1p4"', None, "text->Float64"),
    ("Float64", '"inf"', None, "text->Float64"),
    ("Float64", '"NaN"', None, "text->Float64"),
    ("Float64", '"1e400"', None, "text->Float64"),
    ("Float64", "true", None, "boolean->Float64"),
    ("Bool", "true", True, None),
    ("Bool", "false", False, None),
    ("Bool", '"TRUE"', True, None),
    ("Bool", '"true"', True, None),
    ("Bool", '"1"', True, None),
    ("Bool", '"FALSE"', False, None),
    ("Bool", '"0"', False, None),
    ("Bool", '"7"', True, None),
    ("Bool", '"-0"', False, None),
    ("Bool", '"True"', None, "text->Bool"),
    ("Bool", '"1.5"', None, "text->Bool"),
    ("Bool", "1", None, "number->Bool"),
    ("String", '"a \\"q\\" é"', 'a "q" é', None),
    ("String", "1", "1", None),
    ("String", "12.0", "12", None),
    ("String", "12.50", "12.5", None),
    ("String", "1e6", "1000000", None),
    ("String", "1.5e3", "1500", None),
    ("String", "1.25e-3", "0.00125", None),
    ("String", "1e-6", "0.000001", None),
    ("String", "1.5e-7", "1.5e-7", None),
    ("String", "1e-7", "1e-7", None),
    ("String", "1.2345678901234568e20", "123456789012345680000", None),
    ("String", "1e21", "1e+21", None),
    ("String", "-2.5e30", "-2.5e+30", None),
    ("String", "true", "true", None),
    ("String", '["x",1]', '["x",1]', None),
    ("String", "null", None, None),
    ("String", "{}", None, None),
    ("DateTime", '"2025-10-05T12:00:00Z"', datetime(2025, 10, 5, 12), None),
    ("DateTime", '"2025-10-05T12:00:00.123456789Z"', datetime(2025, 10, 5, 12, 0, 0, 123456), None),
    ("DateTime", '"2025-10-05T12:00:00,5Z"', datetime(2025, 10, 5, 12, 0, 0, 500000), None),
    ("DateTime", '"2025-10-05T12:00:00+02:00"', datetime(2025, 10, 5, 10), None),
    ("DateTime64(3)", '"2025-10-05 12:00:00.123"', datetime(2025, 10, 5, 12, 0, 0, 123000), None),
    ("DateTime", '"2025-10-05 12:00:00"', datetime(2025, 10, 5, 12), None),
    ("DateTime", '"2025-10-05"', datetime(2025, 10, 5), None),
    ("DateTime", '"\'2025-10-05\'"', datetime(2025, 10, 5), None),
    ("DateTime", '" \\"2025-10-05 01:02:03\\"\\t"', datetime(2025, 10, 5, 1, 2, 3), None),
    ("DateTime", '"1759665600"', datetime(2025, 10, 5, 12), None),
    ("DateTime", '"1759665600123"', datetime(2025, 10, 5, 12, 0, 0, 123000), None),
    ("DateTime", '"-1"', datetime(1969, 12, 31, 23, 59, 59), None),
    ("DateTime", "1759665600", datetime(2025, 10, 5, 12), None),
    ("DateTime", "1759665600.9", datetime(2025, 10, 5, 12), None),
    ("DateTime", '"2025"', datetime(1970, 1, 1, 0, 33, 45), None),
    ("DateTime", '"12:00"', None, "text->DateTime"),
    ("DateTime", '"2025-10-05T12:00:00"', None, "text->DateTime"),
    ("DateTime", '"2025-10-05 12:00:00Z"', None, "text->DateTime"),
    ("DateTime", '"2025-13-45"', None, "text->DateTime"),
    ("DateTime", '"9223372036854775807"', None, "text->DateTime"),
    ("DateTime", "1e18", None, "number->DateTime"),
    ("DateTime", "true", None, "boolean->DateTime"),
    ("Nullable(DateTime)", '"12:00"', None, None),
    ("Date", '"2025-10-05T23:30:00-01:00"', date(2025, 10, 6), None),
    ("Date", '"2025-10-05"', date(2025, 10, 5), None),
    ("Date", "-1", date(1969, 12, 31), None),
    ("Date", '"x"', None, "text->Date"),
    ("Nullable(Date)", '"x"', None, None),
    ("array<bigint>", "[1,2]", [1, 2], None),
    ("array<bigint>", '"x"', None, "text->array<bigint>"),
    ("array<bigint>", '{"k":1}', None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_every_branch(spark, texts, zone):
    """Each type's cases in one job; the session's time zone makes no difference."""
    for declared in dict.fromkeys(c[0] for c in CASES):
        cases = [c for c in CASES if c[0] == declared]
        df = texts(*[f'{{"v":{c[1]}}}' for c in cases])
        mapping = read_mapping([{"fieldPath": "v", "column": "c", "type": declared}])
        spark.conf.set("spark.sql.session.timeZone", zone)
        out = project(decode(df, keep=["id"]), mapping, ["id"], rejects=True)
        if "DateTime" in declared:
            out = out.withColumn("c", out.c.cast("double") * 1_000_000)
        rows = {r.id: r for r in out.collect()}
        for i, (_, given, want, reason) in enumerate(cases):
            got = rows[i].c
            if isinstance(want, datetime):
                want = round((want - datetime(1970, 1, 1)).total_seconds() * 1_000_000)
                got = round(got)
            assert got == want and type(got) is type(want), (declared, given, got)
            assert rows[i]._rejects == ([f"c: {reason}"] if reason else []), (declared, given)


def test_large_epoch_numbers_by_choice(texts):
    df = texts('{"t":1759665600123}')
    mapping = read_mapping([{"fieldPath": "t", "column": "t", "type": "DateTime"}])
    seconds = project(decode(df), mapping).selectExpr("unix_micros(t) t").first().t
    auto = project(decode(df), mapping, epoch_numbers="auto").selectExpr("unix_micros(t) t").first().t
    assert (seconds, auto) == (1759665600123 * 1_000_000, 1759665600123 * 1000)
    with pytest.raises(ValueError):
        project(decode(df), mapping, epoch_numbers="minutes")


def test_paths(texts):
    """Nested before dotted spelling, objects are no leaves, quotes in keys, root values."""
    df = texts(
        '{"a.b":7,"a":{"b":8}}', '{"a.b":7,"a":{"b":{"c":1}}}', '{"a.b":7}', '{"a":{"b.c":2}}',
        '{"a.b.c":3}', '{"it\'s \\"q\\"":4}', "5", '{"":6}', '{"A":{"b":9}}',
    )
    paths = ["a.b", "a.b.c", "it's \"q\"", ""]
    mapping = read_mapping(
        [{"fieldPath": p, "column": f"c{i}", "type": "Int64"} for i, p in enumerate(paths)]
    )
    rows = {r.id: tuple(r)[1:] for r in project(decode(df, keep=["id"]), mapping, ["id"]).collect()}
    assert rows == {
        0: (8, None, None, None),
        1: (7, 1, None, None),
        2: (7, None, None, None),
        3: (None, 2, None, None),
        4: (None, 3, None, None),
        5: (None, None, 4, None),
        6: (None, None, None, 5),
        7: (None, None, None, 6),
        8: (None, None, None, None),
    }


def spelled(keys, value):
    for key in reversed(keys):
        value = {key: value}
    return value


def test_long_paths_are_found_under_every_spelling(texts):
    """All spellings of a path of six parts, one message each, and what is no spelling."""
    path = "a.b.it's.d\\.e.f"
    chains = spellings(path)
    assert len(chains) == 32 and chains[0] == tuple(path.split("."))
    docs = [spelled(chain, i) for i, chain in enumerate(chains)]
    docs += [spelled(chains[0][:-1], 1), spelled(chains[0], {"deeper": 1}), spelled(["a.b"], 2), 5]
    both = {"a": {"b.it's.d\\.e.f": 7, "b": spelled(chains[0][2:], 8)}, path: 9}
    half = {"a": {"b": {"it's": {"d\\": {"e": {"f": {"object": 1}}}}}}, "a.b": spelled(chains[0][2:], 3), path: 4}
    docs += [both, half]
    field = read_mapping([{"fieldPath": path, "column": "c", "type": "Int64"}])
    df = texts(*map(json.dumps, docs))
    rows = {r.id: r.c for r in project(decode(df, keep=["id"]), field, ["id"]).collect()}
    assert [rows[i] for i in range(len(docs))] == [*range(32), None, None, None, None, 8, 3]


@pytest.mark.parametrize("path", ["a.b", "a.b.c", "a.b.c.d", "a..b", ".a", "a."])
def test_search_agrees_with_lookup(spark, texts, path):
    docs = [json.dumps(spelled(c, i)) for i, c in enumerate(spellings(path))]
    df = decode(texts(*docs, '{"a":{"x":1}}', "[]"), keep=["id"])
    found = df.select("id", F.expr(searched(path, "_doc")).cast("int").alias("n")).collect()
    assert sorted((r.id, r.n) for r in found if r.n is not None) == [(i, i) for i in range(len(docs))]


def test_deep_paths_make_small_plans(texts):
    parts = [f"p{i}" for i in range(14)]
    docs = [spelled(parts, 1), spelled([".".join(parts)], 2), {}]
    field = read_mapping([{"fieldPath": ".".join(parts), "column": "c", "type": "Int64"}])
    rows = project(decode(texts(*map(json.dumps, docs)), keep=["id"]), field, ["id"]).collect()
    assert {r.id: r.c for r in rows} == {0: 1, 1: 2, 2: None}


def test_rows_and_rejects_add_up(texts):
    df = texts('{"n":1}', '{"n":"x","m":true}', "bad", '{"other":1}', "[]")
    mapping = read_mapping(
        [{"fieldPath": "n", "column": "n", "type": "Int64"}, {"fieldPath": "m", "column": "m", "type": "Int64"}]
    )
    spec = LoadSpec("job", mapping)
    both = classify(decode(df, keep=["id"]), spec, ["id"])
    rows = sorted(tuple(r) for r in rows_of(both, spec, ["id"]).collect())
    assert rows == [(0, 1, None), (1, None, None), (3, None, None), (4, None, None)]
    assert sorted(tuple(r) for r in load_rows(df, spec, ["id"]).collect()) == rows
    assert sorted(tuple(r) for r in rejects_of(both, ["id"]).collect()) == [
        (1, '{"n":"x","m":true}', "coerce", "m: boolean->Int64"),
        (1, '{"n":"x","m":true}', "coerce", "n: text->Int64"),
        (2, "bad", "decode", "malformed JSON"),
    ]


def test_odd_column_names_and_wide_mappings(texts):
    doc = {f"f{i}": {"v.w": i} for i in range(120)}
    columns = [f"c`{i} x" for i in range(120)]
    mapping = read_mapping(
        [{"fieldPath": f"f{i}.v.w", "column": columns[i], "type": "Int64"} for i in range(120)]
    )
    df = texts(json.dumps(doc), "[]")
    rows = {r.id: tuple(r)[1:] for r in load_rows(df, LoadSpec("wide", mapping), ["id"]).collect()}
    assert rows == {0: tuple(range(120)), 1: (None,) * 120}
