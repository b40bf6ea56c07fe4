"""Plans stay narrow, JVM-side, and parse each message once."""

from __future__ import annotations

import contextlib
import io

import pytest

from jsonflow.operators import infer
from jsonflow.operators.decode import decode
from jsonflow.plans.load import classify, load_rows, reject_counts, rejects_of, rows_of
from jsonflow.plans.spec import LoadSpec, read_mapping
from suite import messages as m
from suite.queries import BIG_PURCHASES, INFER_MESSAGE, sql

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def events(spark):
    """Event messages read without a repartition, as a large source would be."""
    return spark.read.parquet(f"{SF}/events.parquet").selectExpr("event_id", f"{m.EVENT_MESSAGE} AS value")


FILTERS = [
    BIG_PURCHASES,
    sql("t = 'purchase' AND length(t) > 3 AND v > 1 AND v < 100",
        t="event.type", v={"path": "event.value", "as": "double"}),
]


@pytest.mark.parametrize("spec", FILTERS, ids=["rules", "sql"])
def test_load_parses_once_and_does_not_shuffle(events, spec):
    text = physical(load_rows(events, LoadSpec("x", m.EVENT_MAPPING, filter=spec)))
    assert text.count("parseJson") == 1
    assert "Exchange" not in text and "Python" not in text and "Join" not in text


def test_classify_parses_once(events):
    text = physical(classify(decode(events), LoadSpec("x", m.EVENT_MAPPING, filter=BIG_PURCHASES)))
    assert text.count("parseJson") == 1 and "Exchange" not in text


def test_conditions_on_rejects_do_not_unfold_the_conversions(events):
    spec = LoadSpec("x", m.EVENT_MAPPING, filter=BIG_PURCHASES)
    both = classify(decode(events), spec)
    everything = len(physical(both))
    for part in (rejects_of(both), rows_of(both, spec), reject_counts(both)):
        text = physical(part)
        assert text.count("parseJson") == 1 and len(text) < 1.5 * everything


def test_only_needed_columns_are_read(spark):
    raw = spark.read.parquet(f"{SF}/conversations.parquet").withColumnRenamed("text", "value")
    text = plan(load_rows(raw, LoadSpec("x", m.EVENT_MAPPING)))
    assert "ReadSchema: struct<text:string>" in text


def test_filters_on_source_columns_reach_the_scan(spark):
    raw = spark.read.parquet(f"{SF}/conversations.parquet").withColumnRenamed("text", "value")
    text = plan(load_rows(raw, LoadSpec("x", m.EVENT_MAPPING), ["role"]).filter("role = 'user'"))
    assert "EqualTo(role,user)" in text


def test_inference_shuffles_votes_only(spark):
    raw = spark.read.parquet(f"{SF}/events.parquet").selectExpr(f"{INFER_MESSAGE} AS value")
    text = physical(infer.path_votes(decode(raw), depth=3))
    assert text.count("Exchange") == 1 and "partial_" in text and text.count("parseJson") == 1


WIDE = read_mapping([{"fieldPath": f"row.d{i}", "column": f"d{i}", "type": "DateTime"} for i in range(30)])


def test_conditions_on_loaded_columns_do_not_unfold_the_conversions(texts):
    rows = load_rows(texts("{}"), LoadSpec("x", WIDE))
    everything = len(physical(rows))
    for condition in ("d3 IS NOT NULL", "forall(array(d1, d2, d3), x -> x IS NOT NULL)", "d1 > d2 AND d2 > d3"):
        text = physical(rows.filter(condition))
        assert text.count("parseJson") == 1 and len(text) < 1.1 * everything


def test_members_of_one_object_are_read_in_one_pass(texts):
    text = physical(load_rows(texts("{}"), LoadSpec("x", WIDE)))
    assert "$['row']['d" not in text and text.count("try_variant_get(_doc") - text.count("$['row.d") == 1


def test_columns_that_are_not_used_are_not_converted(texts):
    assert "_u7" not in physical(load_rows(texts("{}"), LoadSpec("x", WIDE)).select("d1"))


def test_wide_messages_are_parsed_only_where_fields_are_left_over(texts):
    """Values are read straight from the text; the parse, and what is looked up in it, wait for a field that is not plain."""
    plain = ", ".join(f'"d{i}": "2024-01-02 03:04:05"' for i in range(30))
    rows = load_rows(texts(f'{{"row": {{{plain}}}}}'), LoadSpec("x", WIDE))
    text = physical(rows)
    assert text.count("parseJson") == 1 and "CASE WHEN (_rest" in text
    assert {str(x) for x in rows.first()} == {"2024-01-02 03:04:05"}
