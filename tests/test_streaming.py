from __future__ import annotations

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from jsonflow.functions.coerce import target_type
from jsonflow.operators import runlog
from jsonflow.operators.dedup import first_seen
from jsonflow.plans.load import load_rows
from jsonflow.plans.spec import FilterSpec, LoadSpec, SinkSpec, SourceSpec, read_mapping
from jsonflow.session import shared_dir
from jsonflow.sources.readers import read_messages, spread, stream_messages
from jsonflow.sources.sampling import sample_topic
from jsonflow.streaming import jobs, sinks

MAPPING = read_mapping(
    [{"fieldPath": "n", "column": "n", "type": "Int64"}, {"fieldPath": "t", "column": "t", "type": "String"}]
)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


@pytest.fixture
def feed(spark, root):
    """Append one file of messages to the source folder."""

    def add(*texts):
        df = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
        df.write.mode("append").parquet(f"{root}/in")

    return add


def source(root, **options):
    return SourceSpec("parquet", path=f"{root}/in", schema="value string", options=options)


def job(root, name="job", **more):
    sink = SinkSpec(path=f"{root}/{name}", rejects_path=more.pop("rejects", None))
    return LoadSpec(name, MAPPING, source=source(root), sink=sink, **more)


def drain(spark, specs, root, **options):
    query = jobs.start(spark, specs, f"{root}/checkpoint", drain=True, **options)
    query.awaitTermination()
    return query


def loaded(spark, root, name="job"):
    rows = [(r.n, r.t) for r in spark.read.parquet(f"{root}/{name}").collect()]
    return sorted(rows, key=lambda row: (row[0] is None, row))


def message(n, t="x"):
    return json.dumps({"n": n, "t": t})


def test_stream_equals_batch_and_goes_on_after_a_restart(spark, root, feed):
    spec = job(root, filter=FilterSpec(True, rules={"field": "n", "operator": "gt", "value": "1"}))
    feed(*[message(i) for i in range(5)], "bad")
    drain(spark, spec, root)
    assert [n for n, _ in loaded(spark, root)] == [2, 3, 4]
    drain(spark, spec, root)
    feed(message(9))
    drain(spark, spec, root)
    assert [n for n, _ in loaded(spark, root)] == [2, 3, 4, 9]
    batch = load_rows(read_messages(spark, source(root)), spec)
    assert sorted((r.n, r.t) for r in batch.collect()) == loaded(spark, root)


def test_a_failed_batch_is_loaded_once_when_run_again(spark, root, feed, monkeypatch):
    """The insert works, then the run breaks before the batch is committed."""
    feed(*[message(i) for i in range(4)])
    append, calls = sinks.append, []

    def breaks_once(rows, sink, batch_id=None):
        append(rows, sink, batch_id)
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("lost the connection")

    monkeypatch.setattr(jobs.sinks, "append", breaks_once)
    with pytest.raises(StreamingQueryException):
        drain(spark, job(root), root, log_path=f"{root}/log")
    query = drain(spark, job(root), root, log_path=f"{root}/log")
    assert calls == [0, 0]
    assert [n for n, _ in loaded(spark, root)] == [0, 1, 2, 3]
    log = jobs.read_log(spark, f"{root}/log")
    assert [tuple(r) for r in runlog.totals(log).collect()] == [("job", 1, 4)]
    assert [(r.kind, r.errors) for r in runlog.error_counts(log).collect()] == [("insert", 1)]
    assert "lost the connection" in runlog.status(log).first().last_error
    assert jobs.job_state(query) == {"running": False, "last_error": None}


def test_rejects_and_rows_are_written_side_by_side(spark, root, feed):
    feed(message(1), message("no number"), "bad")
    drain(spark, job(root, rejects=f"{root}/rejects"), root, log_path=f"{root}/log")
    assert loaded(spark, root) == [(1, "x"), (None, "x")]
    rejects = spark.read.parquet(f"{root}/rejects").select("value", "stage", "reason").collect()
    assert sorted(tuple(r) for r in rejects) == [
        ("bad", "decode", "malformed JSON"),
        (message("no number"), "coerce", "n: text->Int64"),
    ]


def test_batches_without_rows_are_no_inserts(spark, root, feed):
    feed("bad")
    drain(spark, job(root), root, log_path=f"{root}/log")
    assert not os.path.exists(f"{root}/log")


def test_an_end_that_no_insert_caused_is_a_source_error(spark, root, feed):
    feed(message(1))
    os.makedirs(f"{root}/checkpoint/offsets")
    with open(f"{root}/checkpoint/offsets/0", "w") as out:
        out.write("no offsets")
    with pytest.raises(StreamingQueryException):
        jobs.run(spark, job(root), f"{root}/checkpoint", log_path=f"{root}/log", drain=True)
    [row] = runlog.error_counts(jobs.read_log(spark, f"{root}/log")).collect()
    assert (row.job, row.kind, row.errors) == ("job", "source", 1)


@pytest.mark.parametrize("reloaded", [False, True])
def test_a_filter_that_keeps_nothing(spark, root, feed, reloaded):
    feed(message(1))
    nothing = FilterSpec(True, rules={"op": "OR", "children": [], "not": True})
    source_of = (lambda _: nothing) if reloaded else None
    jobs.run(spark, job(root, filter=nothing), f"{root}/checkpoint", f"{root}/log", source_of, drain=True)
    assert loaded(spark, root) == [] and not os.path.exists(f"{root}/log")


def test_filter_file_is_followed(spark, root, feed, tmp_path):
    path = tmp_path / "filter.json"

    def keep_above(n):
        rule = {"field": "n", "operator": "gt", "value": str(n)}
        path.write_text(json.dumps({"enabled": True, "rules": rule}, indent=1))

    keep_above(1)
    loader = jobs.BatchLoader([job(root)], f"{root}/log", jobs.filter_file(str(path)))

    def run():
        stream = stream_messages(spark, source(root))
        writer = stream.writeStream.foreachBatch(loader).option("checkpointLocation", f"{root}/cp")
        writer.trigger(availableNow=True).start().awaitTermination()

    feed(message(1), message(2))
    run()
    keep_above(10)
    feed(message(2), message(11))
    run()
    path.write_text("{ not json")
    feed(message(3), message(12))
    run()
    path.write_text(json.dumps({"enabled": True, "rules": {"field": "n", "operator": "like"}}))
    feed(message(4), message(13))
    run()
    path.write_text(json.dumps({"enabled": False}))
    feed(message(5))
    run()
    assert [n for n, _ in loaded(spark, root)] == [2, 5, 11, 12, 13]
    errors = runlog.error_counts(jobs.read_log(spark, f"{root}/log")).collect()
    assert [(r.kind, r.errors) for r in errors] == [("filter", 2)]


def test_several_jobs_on_one_stream(spark, root, feed):
    low = FilterSpec(True, rules={"field": "n", "operator": "lt", "value": "2"})
    specs = [job(root, "all"), job(root, "low", filter=low)]
    feed(*[message(i) for i in range(4)])
    drain(spark, specs, root, log_path=f"{root}/log")
    assert [n for n, _ in loaded(spark, root, "all")] == [0, 1, 2, 3]
    assert [n for n, _ in loaded(spark, root, "low")] == [0, 1]
    totals = runlog.totals(jobs.read_log(spark, f"{root}/log")).collect()
    assert sorted((r.job, r.rows_total) for r in totals) == [("all", 4), ("low", 2)]


def test_jobs_that_differ_in_source_interval_or_rate_are_refused(spark, root, feed):
    from dataclasses import replace

    feed(message(1))
    a, b = job(root, "a"), job(root, "b")
    others = [
        replace(b, source=SourceSpec("parquet", path=f"{root}/other", schema="value string")),
        replace(b, sink=SinkSpec(path=f"{root}/b", flush_interval="5s")),
        replace(b, sink=SinkSpec(path=f"{root}/b", batch_size=7)),
        replace(b, id="a"),
    ]
    for other in others:
        with pytest.raises(ValueError):
            jobs.start(spark, [a, other], f"{root}/checkpoint")
    with pytest.raises(ValueError):
        jobs.start(spark, replace(a, sink=SinkSpec(path=f"{root}/a", inserts_per_second=2)), f"{root}/checkpoint")
    with pytest.raises(ValueError):
        jobs.start(spark, [a, b], f"{root}/checkpoint", filter_source=lambda _: FilterSpec())


def test_each_job_follows_its_own_filter_which_outlives_a_restart(spark, root, feed):
    def above(n):
        return FilterSpec(True, rules={"field": "n", "operator": "gt", "value": str(n)})

    now = {"a": above(1), "b": above(100)}
    sources = {name: (lambda _, name=name: now[name]) for name in now}
    specs = [job(root, "a"), job(root, "b")]

    def go():
        drain(spark, specs, root, log_path=f"{root}/log", filter_source=sources)

    feed(message(1), message(2), message(101))
    go()
    now["b"] = FilterSpec(True, "sql", expression="n ><> 1")
    feed(message(3), message(103))
    feed(message(4), message(104))
    go()
    assert [n for n, _ in loaded(spark, root, "a")] == [2, 3, 4, 101, 103, 104]
    assert [n for n, _ in loaded(spark, root, "b")] == [101, 103, 104]
    errors = runlog.error_counts(jobs.read_log(spark, f"{root}/log")).collect()
    assert [(r.job, r.kind, r.errors) for r in errors] == [("b", "filter", 1)]


def test_a_backlog_is_loaded_in_bounded_batches(spark, root, feed):
    for i in range(6):
        feed(message(i))
    spec = LoadSpec("job", MAPPING, source=source(root, maxFilesPerTrigger="2"), sink=SinkSpec(path=f"{root}/job"))
    drain(spark, spec, root, log_path=f"{root}/log")
    sizes = [r["rows"] for r in jobs.read_log(spark, f"{root}/log").collect()]
    assert sizes == [2, 2, 2] and [n for n, _ in loaded(spark, root)] == list(range(6))


def test_a_filter_that_raises_drops_the_message_only(spark, root, feed):
    from jsonflow.operators.decode import decode
    from jsonflow.operators.filters import filter_summary

    raising = FilterSpec(
        True, "sql", expression="10 / v > 1 AND (int(t) > 1 OR int(t) < -1)", fields={"v": {"path": "n", "as": "int"}, "t": "t"}
    )
    feed(message(0, "5"), message(2, "abc"), message(2, "5"), message(50, "5"))
    drain(spark, job(root, filter=raising), root)
    assert loaded(spark, root) == [(2, "5")]
    counts = filter_summary(decode(read_messages(spark, source(root))), raising).first()
    assert (counts.kept, counts.dropped, counts.errored) == (1, 1, 2)


def test_independent_jobs(spark, root, feed):
    feed(message(1))
    queries = jobs.start_all(spark, [job(root, "a"), job(root, "b")], f"{root}/cps", drain=True)
    for q in queries:
        q.awaitTermination()
    assert loaded(spark, root, "a") == loaded(spark, root, "b") == [(1, "x")]


def test_a_bad_filter_stops_a_job_before_it_starts(spark, root, feed):
    feed(message(1))
    with pytest.raises(ValueError):
        drain(spark, job(root, filter=FilterSpec(True, "cel", expression="true")), root)


def test_a_job_runs_by_its_flush_interval(spark, root, feed):
    feed(message(1))
    query = jobs.start(spark, job(root), f"{root}/checkpoint")
    try:
        query.processAllAvailable()
        assert jobs.job_state(query) == {"running": True, "last_error": None}
    finally:
        query.stop()
    assert loaded(spark, root) == [(1, "x")]


@pytest.fixture
def table(spark, root):
    name = f"t_{abs(hash(root))}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def test_tables(spark, root, table, feed):
    sink = SinkSpec(table=table, path=f"{root}/table", create_if_missing=True)
    sinks.ensure_table(spark, sink, MAPPING)
    sinks.ensure_table(spark, sink, MAPPING)
    assert not sinks.create_table(spark, table, [("other", "Int64")])
    columns = [tuple(r) for r in sinks.target_columns(spark, table).collect()]
    assert columns == [("n", "bigint", 1), ("t", "string", 2)]
    feed(message(1), message(2))
    spec = LoadSpec("job", MAPPING, source=source(root), sink=sink)
    drain(spark, spec, root)
    sinks.append(spark.createDataFrame([("late",)], "t string"), sink)
    rows = spark.table(table).orderBy(F.col("n").asc_nulls_last()).collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (2, "x"), (None, "late")]
    with pytest.raises(ValueError):
        sinks.append(spark.createDataFrame([(1,)], "nope int"), sink)


def test_values_that_a_narrow_table_cannot_hold(spark, root, table, feed):
    spark.sql(f"CREATE TABLE {table} (T string, n tinyint) USING parquet LOCATION '{root}/narrow'")
    feed(message(1), message(1000), message(None))
    sink = SinkSpec(table=table, rejects_path=f"{root}/rejects")
    drain(spark, LoadSpec("job", MAPPING, source=source(root), sink=sink), root)
    assert sorted((r.n is None, r.n, r.T) for r in spark.table(table).collect() if r.n) == [(False, 1, "x")]
    assert spark.table(table).count() == 3
    rejects = [(r.stage, r.reason) for r in spark.read.parquet(f"{root}/rejects").collect()]
    assert ("insert", "n: does not fit tinyint") in rejects


def test_tables_need_a_name_and_columns(spark, root):
    for name, columns in (("", [("a", "Int64")]), ("x.", [("a", "Int64")]), ("x", [])):
        with pytest.raises(ValueError):
            sinks.create_table(spark, name, columns)
    with pytest.raises(ValueError):
        sinks.target_columns(spark, "no_such_table")
    assert sinks.table_name("db.we`ird") == "`db`.`we``ird`"
    assert target_type("String").ddl == "string"


def test_no_table_is_made_unless_asked(spark, root):
    sinks.ensure_table(spark, SinkSpec(table="never_made"), MAPPING)
    assert not spark.catalog.tableExists("never_made")


def test_sources(spark, root, feed, tmp_path):
    feed(message(1))
    assert read_messages(spark, source(root)).count() == 1
    lines = tmp_path / "lines.txt"
    lines.write_text(message(1) + "\nbad\n")
    text = SourceSpec("text", path=str(lines))
    assert [r.value for r in read_messages(spark, text).collect()] == [message(1), "bad"]
    spark.createDataFrame([(1, message(2))], "id int, body string").createOrReplaceTempView("bodies")
    named = SourceSpec.from_dict({"table": "bodies", "value": "body"})
    assert read_messages(spark, named).first().value == message(2)
    assert stream_messages(spark, SourceSpec("rate", value="timestamp")).isStreaming


def test_topic_sample_goes_on_until_it_is_whole(spark, root, feed):
    feed(*[message(i) for i in range(5)])
    feed(*[message(i) for i in range(5, 9)])
    topic = source(root, maxFilesPerTrigger="1")
    first = sample_topic(spark, topic, 7, f"{root}/s")
    assert first.count() == 7 and first.columns == ["value"]
    assert {message(i) for i in range(5)} <= {r.value for r in first.collect()}
    # A second call in the same folder starts afresh, and what has come counts.
    again = sample_topic(spark, topic, 100, f"{root}/s", timeout=6)
    assert sorted(r.value for r in again.collect()) == [message(i) for i in range(9)]
    assert sample_topic(spark, topic, 2, f"{root}/s").count() == 2
    os.mkdir(f"{root}/empty")
    nothing = SourceSpec("parquet", path=f"{root}/empty", schema="value string")
    assert sample_topic(spark, nothing, 5, f"{root}/s3", timeout=1).collect() == []


def test_small_sources_are_spread(spark):
    assert spread(spark.range(0, 10, 1, 1), 4).rdd.getNumPartitions() == 4
    plenty = spark.range(0, 10, 1, 6)
    assert spread(plenty, 4) is plenty


def test_rows_without_a_key_are_no_copies(spark, root):
    from jsonflow.operators.dedup import latest_per_key

    rows = [(None, 1), (None, 1), (1, 1), (1, 2)]
    df = spark.createDataFrame(rows, "k int, at int")
    assert sorted(latest_per_key(df, ["k"], ["at"]).collect(), key=str) == sorted([(1, 2), (None, 1), (None, 1)], key=str)
    assert latest_per_key(df, ["k"], ["at"], null_keys_equal=True).count() == 2
    df.selectExpr("k", "timestamp_seconds(at) AS at").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("k int, at timestamp").parquet(f"{root}/in")
    out = first_seen(stream, ["k"], "at", "1 minute").writeStream.format("parquet").option("path", f"{root}/out")
    out.option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.k for r in spark.read.parquet(f"{root}/out").collect()), key=str) == [1, None, None]


@pytest.mark.parametrize("salts", [1, 4])
def test_repeats_within_a_delay_are_dropped(spark, root, salts):
    """One key holds most of the stream; its copies come in every task and in a later batch."""
    schema = "k int, at timestamp"

    def feed_keys(*rows):
        df = spark.createDataFrame(list(rows), "k int, at string").selectExpr("k", "CAST(at AS timestamp) AS at")
        df.repartition(4).write.mode("append").parquet(f"{root}/keys")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{root}/keys")
        out = first_seen(stream, ["k"], "at", "1 minute", salts).writeStream.format("parquet")
        out = out.option("checkpointLocation", f"{root}/cp").option("path", f"{root}/out")
        out.trigger(availableNow=True).start().awaitTermination()

    feed_keys(*[(1, f"2025-01-01 00:00:{i % 60:02d}") for i in range(200)], (2, "2025-01-01 00:00:10"))
    run()
    feed_keys((1, "2025-01-01 00:00:30"), (3, "2025-01-01 00:00:59"))
    run()
    rows = spark.read.parquet(f"{root}/out").collect()
    assert sorted(r.k for r in rows) == [1, 2, 3]
    assert rows[0].asDict().keys() == {"k", "at"}


class FakeSession:
    """A session with a given master and checkpoint setting."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: folder or default)})


def test_shared_dir():
    on_cluster = shared_dir(FakeSession("yarn", "hdfs://store/checkpoints/"))
    assert on_cluster.startswith("hdfs://store/checkpoints/jsonflow-")
    assert os.path.isdir(shared_dir(FakeSession("local[2]")))
    with pytest.raises(ValueError):
        shared_dir(FakeSession("yarn"))
