from __future__ import annotations

import json

import pytest

from jsonflow.functions.coerce import target_type
from jsonflow.plans.spec import FilterSpec, LoadSpec, SinkSpec, SourceSpec, read_mapping
from jsonflow.sources.readers import kafka_batch_options, kafka_stream_options
from jsonflow.sources.sampling import from_oldest


def test_defaults_are_always_applied():
    sink = SinkSpec.from_dict({"table": "t", "batchSize": 0, "insertRatePerSecond": -3})
    assert (sink.batch_size, sink.flush_interval, sink.inserts_per_second) == (500, "2s", 0)
    assert sink.rows_per_trigger == 500_000 and not sink.create_if_missing
    assert SinkSpec(table="t", batch_size=-1, flush_interval="").flush_seconds == 2.0


@pytest.mark.parametrize("text,seconds", [("2s", 2), ("500ms", 0.5), ("1m30s", 90), ("1h", 3600), ("1.5s", 1.5)])
def test_flush_intervals(text, seconds):
    assert SinkSpec(table="t", flush_interval=text).flush_seconds == seconds


@pytest.mark.parametrize("text", ["2", "soon", "2 s", "s"])
def test_unreadable_flush_intervals(text):
    with pytest.raises(ValueError):
        SinkSpec(table="t", flush_interval=text)


def test_rate_limit_bounds_a_trigger():
    sink = SinkSpec(table="t", batch_size=500, inserts_per_second=2, flush_interval="2s")
    assert sink.rows_per_trigger == 2000


def test_sources():
    kafka = SourceSpec.from_dict(
        {"brokers": ["a:9092", "b:9092"], "topic": "events", "groupId": "g", "options": {"kafka.security.protocol": "SSL"}}
    )
    assert kafka.format == "kafka" and kafka.options == {
        "kafka.bootstrap.servers": "a:9092,b:9092", "subscribe": "events", "groupIdPrefix": "g",
        "kafka.security.protocol": "SSL",
    }
    for bad in ({"topic": "t"}, {"brokers": "b"}, {"topic": "", "brokers": []}, {}):
        with pytest.raises(ValueError):
            SourceSpec.from_dict(bad)


def test_specs_need_a_sink_target_and_distinct_columns():
    with pytest.raises(ValueError):
        SinkSpec.from_dict({})
    two = [{"fieldPath": "a", "column": "x", "type": "Int64"}, {"fieldPath": "b", "column": "x"}]
    with pytest.raises(ValueError):
        read_mapping(two)
    assert read_mapping({"columns": two[1:]})[0].type == "String"


def test_whole_spec():
    spec = LoadSpec.from_dict(
        {
            "id": "job",
            "source": {"format": "parquet", "path": "/x", "value": "body"},
            "sink": {"table": "db.t", "createTableIfMissing": True, "batchFlushInterval": "1s"},
            "filters": {"enabled": True, "rules": {"field": "a", "operator": "exists"}},
            "mapping": [{"fieldPath": "a", "column": "a", "type": "Nullable(Int64)", "nullable": True}],
        }
    )
    assert spec.filter.language == "rules" and spec.sink.create_if_missing
    assert spec.mapping[0].to_dict() == {"fieldPath": "a", "column": "a", "type": "Nullable(Int64)", "nullable": True}
    assert FilterSpec.from_dict(None) == FilterSpec()


@pytest.mark.parametrize(
    "declared,ddl,nullable",
    [
        ("Int64", "bigint", False), ("Nullable(Float64)", "double", True), ("Bool", "boolean", False),
        ("String", "string", False), ("Date", "date", False), ("DateTime", "timestamp", False),
        ("DateTime64(3, 'UTC')", "timestamp", False), ("Nullable(DateTime64(3))", "timestamp", True),
        ("decimal(10,2)", "decimal(10,2)", False),
    ],
)
def test_types(declared, ddl, nullable):
    target = target_type(declared)
    assert (target.ddl, target.nullable) == (ddl, nullable)


def kafka(**more):
    return SourceSpec.from_dict({"brokers": "a:9092", "topic": "events", **more})


def test_kafka_offsets_by_partition():
    given = kafka(startingOffsets={"1": "earliest", 0: 12}, endingOffsets={0: 40, 1: "latest"})
    assert json.loads(given.options["startingOffsets"]) == {"events": {"0": 12, "1": -2}}
    assert json.loads(given.options["endingOffsets"]) == {"events": {"0": 40, "1": -1}}
    assert kafka(startingOffsets="latest").options["startingOffsets"] == "latest"
    for bad in ("yesterday", {0: -3}, {-1: 5}, {"a": 5}, {0: "soon"}):
        with pytest.raises(ValueError):
            kafka(startingOffsets=bad)
    with pytest.raises(ValueError):
        SourceSpec.from_dict({"brokers": "a:9092", "topic": "a,b", "startingOffsets": {0: 1}})


def test_kafka_options_of_a_batch_a_stream_and_a_sample():
    whole = kafka_batch_options(kafka())
    assert (whole["startingOffsets"], whole["endingOffsets"]) == ("earliest", "latest")
    part = kafka(startingOffsets={0: 5}, endingOffsets={0: 9})
    assert kafka_batch_options(part)["endingOffsets"] == '{"events": {"0": 9}}'
    assert kafka_stream_options(kafka())["startingOffsets"] == "latest"
    assert "maxOffsetsPerTrigger" not in kafka_stream_options(kafka())
    going = kafka_stream_options(part, 700)
    assert "endingOffsets" not in going and going["startingOffsets"] == '{"events": {"0": 5}}'
    assert going["maxOffsetsPerTrigger"] == "700"
    own = kafka(options={"maxOffsetsPerTrigger": "50"})
    assert kafka_stream_options(own, 700)["maxOffsetsPerTrigger"] == "50"
    assert kafka_stream_options(from_oldest(kafka(startingOffsets="latest")), 100)["startingOffsets"] == "earliest"


def test_an_insert_rate_bounds_what_a_trigger_reads():
    sink = SinkSpec.from_dict({"path": "p", "batchSize": 200, "batchFlushInterval": "1500ms", "insertRatePerSecond": 2})
    assert kafka_stream_options(kafka(), sink.rows_per_trigger)["maxOffsetsPerTrigger"] == "600"


def test_latest_rows_are_not_cut():
    assert SinkSpec.from_dict({"path": "p", "cutInserts": True}).cut_inserts
    with pytest.raises(ValueError):
        SinkSpec.from_dict({"path": "p", "cutInserts": True, "latestBy": {"keys": ["k"], "order": ["at"]}})
