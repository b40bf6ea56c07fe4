from __future__ import annotations

import itertools
import json
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException

from jsonflow.operators.decode import decode
from jsonflow.operators.filters import (
    FilterError,
    check_filter,
    evaluate_filter,
    filter_summary,
    keep_matching,
    operand,
    portable_regex,
)
from jsonflow.plans.spec import FilterSpec

DOCS = [
    {"t": "purchase", "u": {"e": "a@example.com"}, "v": 123},
    {"t": "signup", "u": {"e": None}, "v": "50"},
    {"t": "view", "u": {}, "v": "abc"},
    {"t": 5, "v": None},
    {"t": True, "v": [1, 2]},
    {"v": 12.5, "u": {"e": "b@example.com\n"}},
]


def rule(field, operator, value="", **more):
    return {"field": field, "operator": operator, "value": value, **more}


def group(op, *children, **more):
    return {"op": op, "children": list(children), **more}


def verdicts(df, spec):
    rows = evaluate_filter(decode(df, keep=["id"]), spec).select("id", "result", "error").collect()
    return {r.id: (None if r.error else r.result) for r in rows}


def of_rules(tree):
    return FilterSpec(enabled=True, language="rules", rules=tree)


def of_sql(expression, **fields):
    return FilterSpec(enabled=True, language="sql", expression=expression, fields=fields)


@pytest.fixture
def docs(texts):
    return texts(*map(json.dumps, DOCS))


T, N = True, None
RULES = [
    (rule("t", "equals", "purchase"), [T, False, False, False, False, False]),
    (rule("t", "equals", "5"), [False, False, False, T, False, False]),
    (rule("t", "equals", "true"), [False, False, False, False, T, False]),
    (rule("t", "equals", "purchase", **{"not": True}), [False, T, T, T, T, T]),
    (rule("u.e", "exists"), [T, T, False, False, False, T]),
    (rule("u", "exists"), [False] * 6),
    (rule("u.e", "equals", "x"), [False, N, False, False, False, False]),
    (rule("u.e", "regex", "@example.com$"), [T, N, False, False, False, False]),
    (rule("u.e", "regex", "^.@"), [T, N, False, False, False, T]),
    (rule("u.e", "contains", "b@"), [False, N, False, False, False, T]),
    (rule("v", "gt", "12.5"), [T, T, N, N, N, False]),
    (rule("v", "gt", "12.5", **{"not": True}), [False, False, N, N, N, T]),
    (rule("v", "gte", "12.5"), [T, T, N, N, N, T]),
    (rule("v", "lt", "50"), [False, False, N, N, N, T]),
    (rule("v", "lte", " 5e1 "), [False, T, N, N, N, T]),
    (rule("v", "gt", "much"), [T, T, N, N, N, T]),
    (rule("  ", "equals", "x"), [T] * 6),
    (rule("", "equals", "x", **{"not": True}), [False] * 6),
    (group("AND"), [T] * 6),
    (group("OR", **{"not": True}), [False] * 6),
    (group("OR", rule("v", "gt", 100), rule("t", "exists")), [T, T, T, T, T, False]),
    (group("AND", rule("v", "gt", 100), rule("t", "equals", "view")), [False, False, N, False, False, False]),
    (group("AND", group("OR", rule("v", "lt", 0), rule("t", "equals", "view")), rule("", "exists")),
     [False, False, T, N, N, False]),
]


@pytest.mark.parametrize("tree,want", RULES, ids=range(len(RULES)))
def test_rules(docs, tree, want):
    assert verdicts(docs, of_rules(tree)) == dict(enumerate(want))


def kleene(node, doc):
    """The rules' meaning, written out for one document."""
    if "children" in node:
        parts = [kleene(c, doc) for c in node["children"]]
        decisive = node["op"] == "OR"
        out = decisive if decisive in parts else (None if None in parts else not decisive)
        out = True if not parts else out
    else:
        here = doc
        for part in node["field"].split("."):
            here = here.get(part, ...) if isinstance(here, dict) else ...
        if here is ... or isinstance(here, dict):
            out = False
        elif node["operator"] == "exists":
            out = True
        elif node["operator"] == "equals":
            word = json.dumps(here) if isinstance(here, (bool, int, float)) else here
            out = word == node["value"] if isinstance(word, str) else None
        else:
            number = here if isinstance(here, (int, float)) and not isinstance(here, bool) else None
            if isinstance(here, str) and re.fullmatch(r"\d+", here):
                number = int(here)
            out = None if number is None else number > float(node["value"])
    return out if out is None or not node.get("not") else not out


leaf_rules = st.builds(
    lambda f, o, n: rule(f, o, "50", **{"not": n}),
    st.sampled_from(["t", "v", "u.e", "u", "gone"]),
    st.sampled_from(["equals", "exists", "gt"]),
    st.booleans(),
)
trees = st.recursive(
    leaf_rules,
    lambda inner: st.builds(
        lambda op, cs, n: group(op, *cs, **{"not": n}),
        st.sampled_from(["AND", "OR"]),
        st.lists(inner, max_size=3),
        st.booleans(),
    ),
    max_leaves=6,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tree=trees)
def test_rule_trees_follow_three_valued_logic(docs, tree):
    assert verdicts(docs, of_rules(tree)) == {i: kleene(tree, d) for i, d in enumerate(DOCS)}


def test_kept_dropped_and_errored_make_up_the_input(docs):
    decoded = decode(docs, keep=["id"])
    for tree, want in itertools.islice(RULES, 0, None, 5):
        spec = of_rules(tree)
        row = filter_summary(decoded, spec).first()
        assert tuple(row) == (want.count(True), want.count(False), want.count(None))
        kept = {r.id for r in keep_matching(decoded, spec).collect()}
        rest = {r.id for r in keep_matching(decoded, of_rules(group("AND", tree, **{"not": True}))).collect()}
        errors = {i for i, w in enumerate(want) if w is None}
        assert kept | rest | errors == set(range(6)) and not kept & rest


@pytest.mark.parametrize(
    "expression,fields,want",
    [
        ("t = 'purchase'", {"t": "t"}, [0]),
        ("t <> 'purchase'", {"t": "t"}, [1, 2, 3, 4]),
        ("NOT no_mail", {"no_mail": {"path": "u.e", "as": "is_null"}}, [0, 5]),
        ("mail RLIKE '@example.com$' AND v > 100", {"mail": "u.e", "v": {"path": "v", "as": "double"}}, [0]),
        ("exists(l, x -> x = 2) AND size(l) = 2", {"l": {"path": "v", "as": "array<bigint>"}}, [4]),
        ("here AND NOT coalesce(flag, false)", {"here": {"path": "t", "as": "present"}, "flag": {"path": "t", "as": "bool"}}, [0, 1, 2, 3]),
        ("schema_of_variant(v) = 'VOID'", {"v": {"path": "v", "as": "variant"}}, [3]),
        ("n % 2 = 1", {"n": {"path": "v", "as": "int"}}, [0]),
    ],
)
def test_sql_filters(docs, expression, fields, want):
    kept = keep_matching(decode(docs, keep=["id"]), of_sql(expression, **fields))
    assert sorted(r.id for r in kept.collect()) == want
    assert kept.columns == ["id", "_raw", "_doc"]


FUNCTIONS = [
    "char_length(s) = 5 AND contains(s, 'ell') AND startswith(s, 'h') AND endswith(s, 'o')",
    "s || '!' = 'hello!' AND s RLIKE '^h.*o$' AND s IN ('hello', 'bye') AND s BETWEEN 'a' AND 'i'",
    "try_add(i, 2) = 9 AND try_subtract(i, 2) = 5 AND try_multiply(i, 2) = 14 AND try_divide(i, 2) = 3.5",
    "i % 4 = 3 AND -i = -7 AND CASE WHEN i > 5 THEN true ELSE false END",
    "try_divide(i, 0) IS NULL AND try_add(9223372036854775807, i) IS NULL",
    "CAST(d AS STRING) = '2.5' AND CAST(d AS INT) = 2 AND try_cast(s AS INT) IS NULL AND b",
    "array_contains(l, 2) AND size(l) = 3 AND try_element_at(l, 1) = 1 AND try_element_at(l, 9) IS NULL",
    "exists(l, x -> x > 2) AND forall(l, x -> x > 0) AND size(filter(l, x -> x = 2)) = 1",
    "transform(l, x -> x * 2) = array(2, 4, 6) AND size(filter(l, x -> x > 1)) = 2",
    "year(ts) = 2024 AND month(ts) - 1 = 1 AND dayofmonth(ts) = 29 AND dayofmonth(ts) - 1 = 28",
    "dayofweek(ts) - 1 = 4 AND dayofyear(ts) - 1 = 59 AND hour(ts) = 13 AND minute(ts) = 14",
    "second(ts) = 15 AND date_format(ts, 'SSS') = '250' AND ts + INTERVAL 1 HOUR > try_to_timestamp('2024-02-29 14:14:15')",
    "ts - try_to_timestamp('2024-02-29 13:14:14.25') = INTERVAL '1' SECOND",
    "schema_of_variant(v) = 'ARRAY<BIGINT>' AND here AND NOT nothing",
]


@pytest.mark.parametrize("expression", FUNCTIONS)
def test_functions_of_sql_filters(texts, expression):
    """The operations filters are made of: text, numbers, lists, time and kinds."""
    df = texts('{"s":"hello","i":7,"d":2.5,"b":true,"l":[1,2,3],"t":"2024-02-29T13:14:15.250Z"}')
    used = {
        "s": "s", "i": {"path": "i", "as": "int"}, "d": {"path": "d", "as": "double"},
        "b": {"path": "b", "as": "bool"}, "l": {"path": "l", "as": "array<int>"},
        "ts": {"path": "t", "as": "timestamp"}, "v": {"path": "l", "as": "variant"},
        "here": {"path": "s", "as": "present"}, "nothing": {"path": "s", "as": "is_null"},
    }
    [row] = evaluate_filter(decode(df), of_sql(expression, **used)).collect()
    assert row.result and row.error is None


@pytest.mark.parametrize(
    "d", [None, {}, {"enabled": False, "expression": "x ="}, {"enabled": True, "expression": " "}, {"enabled": True, "rules": {}}]
)
def test_filters_that_are_off_add_nothing(docs, d):
    decoded = decode(docs, keep=["id"])
    kept = keep_matching(decoded, FilterSpec.from_dict(d))
    assert kept.count() == 6
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1  # the decode's own


@pytest.mark.parametrize(
    "d",
    [
        {"language": "CEL", "expression": "true"},
        {"expression": "t ==== 1", "fields": {"t": "t"}},
        {"expression": "unknown = 1"},
        {"expression": "1 + 1"},
        {"expression": "id = 1", "fields": {"_doc": "id"}},
        {"rules": {"field": "a", "operator": "like", "value": "x"}},
        {"rules": {"field": "a", "operator": "regex", "value": "("}},
        {"rules": {"children": [{"field": "a", "operator": "regex", "value": "(?=x)"}]}},
    ],
)
def test_unusable_filters_are_refused(spark, d):
    with pytest.raises(FilterError):
        check_filter(spark, FilterSpec.from_dict({"enabled": True, **d}))


def test_usable_filters_pass_the_check(spark):
    check_filter(spark, of_sql("t = 'x'", t="t"))
    check_filter(spark, of_rules(RULES[-1][0]))
    check_filter(spark, FilterSpec())


def test_an_unusable_filter_fails_when_planned(docs):
    with pytest.raises((FilterError, AnalysisException)):
        keep_matching(decode(docs), of_sql("unknown = 1"))


def test_operands():
    given_ = ["5", " 5 ", "", "abc", "1e3", "0x10", "Infinity", "NaN", "-.5", "1e999", "1_0"]
    assert [operand(s) for s in given_] == [5, 5, 0, 0, 1000, 16, 0, 0, -0.5, 0, 0]


@pytest.mark.parametrize(
    "pattern", [r"(a)\1", "(?=a)", "(?!a)", "(?<=a)b", "(?<!a)b", "(?>a)", "a++", "a*+", "a{2}+", r"(?P<x>a)\k<x>"]
)
def test_patterns_that_are_not_portable(pattern):
    with pytest.raises(FilterError):
        portable_regex(pattern)


@pytest.mark.parametrize(
    "pattern,text,want",
    [
        ("c$", "abc", True),
        ("c$", "abc\n", False),
        ("(?m)c$", "abc\nd", True),
        ("a.c", "a\rc", True),
        ("a.c", "a\nc", False),
        (r"a\$", "a$", True),
        ("[$]", "$", True),
        ("[^]]", "]", False),
        ("[]a]+", "]", True),
        ("[[]", "[", True),
        ("[[:digit:]x]", "7", True),
        ("[[:^word:]]", "a_1", False),
        ("[a&&b]", "&", True),
        ("(?P<x>a)b", "ab", True),
        (r"\d+$", "7", True),
        ("b", "abc", True),
    ],
)
def test_portable_patterns(spark, pattern, text, want):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(df.s.rlike(portable_regex(pattern))).first()[0] is want
