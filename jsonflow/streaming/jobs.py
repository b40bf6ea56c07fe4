"""Streaming load jobs.

A job is one streaming query whose micro-batches go through the same plan as a batch load.
Progress is committed after the batch was written, so a failure repeats the batch and
loses nothing. A batch that was inserted before the failure is not inserted again (``journal``).
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import asdict, replace
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jsonflow.operators.decode import decode
from jsonflow.operators.filters import FilterError, check_filter
from jsonflow.plans.load import classify, decoded_rows, rejects_of, rows_of
from jsonflow.plans.spec import FilterSpec, LoadSpec
from jsonflow.sources.readers import stream_messages
from jsonflow.streaming import journal, sinks
from jsonflow.streaming.journal import read_log  # noqa: F401

FilterSource = Callable[[SparkSession], FilterSpec]
# One source for a single job, or a source for each job by its id.
FilterSources = FilterSource | Mapping[str, FilterSource] | None


def filter_file(path: str) -> FilterSource:
    """A filter kept as a small JSON file, on any file system Spark reads."""

    def read(spark: SparkSession) -> FilterSpec:
        text = spark.read.text(path, wholetext=True).first()
        return FilterSpec.from_dict(json.loads(text[0]) if text else {})

    return read


class BatchLoader:
    """Loads micro-batches for one or several jobs that share a source.

    A single job whose filter does not change is planned once, on the stream; its batches
    are only written. Otherwise each batch is parsed once and planned per job. Frames are
    kept (in memory, else on disk) only if more than one output is written from them.

    A filter source gives a job's filter anew at every batch. With a ``state`` folder the last valid
    filter of each job is kept there and holds after a restart too, and so are the batches each job has inserted.
    """

    def __init__(
        self,
        specs: Sequence[LoadSpec],
        log_path: str | None = None,
        filter_source: FilterSources = None,
        value: str = "value",
        state: str | None = None,
    ) -> None:
        self.specs = list(specs)
        self.log_path = log_path
        self.filter_sources = _by_job(self.specs, filter_source)
        self.value = value
        self.state = state
        self.planned = False
        self.failed = False
        self._ending = threading.Lock()
        self._log: journal.RunLog | None = None
        self._inserted: dict[str, journal.Inserted] = {}
        # Each job's filter in force, and what its source gave or said last.
        self._seen: dict[str, FilterSpec] = {}
        self._said: dict[str, str] = {}

    def plan(self, messages: DataFrame) -> DataFrame:
        """The part of the work that can be planned on the stream itself."""
        if len(self.specs) > 1 or self.filter_sources:
            return messages
        self.planned = True
        return self._outcome(decode(messages, self.value), self.specs[0])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self._reload_filters(spark, batch_id)
        if self.planned:
            self._write(batch, self.specs[0], batch_id)
            return
        decoded = decode(batch, self.value)
        with _kept(decoded, len(self.specs) > 1):
            for spec in self.specs:
                self._write(self._outcome(decoded, spec), spec, batch_id)

    @staticmethod
    def _outcome(decoded: DataFrame, spec: LoadSpec) -> DataFrame:
        """Rows, or rows and rejects if the job keeps those."""
        return classify(decoded, spec) if spec.sink.rejects_path else decoded_rows(decoded, spec)

    def _write(self, outcome: DataFrame, spec: LoadSpec, batch_id: int) -> None:
        """Rejects, which replace those of a first attempt, then rows, then the note that they are in."""
        spark, done = outcome.sparkSession, self._inserted_by(outcome.sparkSession, spec.id)
        if done and done.line(batch_id):
            return
        started, counted = time.monotonic(), Observation()
        count = F.count(F.lit(1)).alias("rows")
        rejects_path = spec.sink.rejects_path
        try:
            with _kept(outcome, bool(rejects_path) or spec.sink.cut_inserts):
                rows = rows_of(outcome, spec) if rejects_path else outcome
                if rejects_path:
                    target = f"{rejects_path}/batch_id={batch_id}"
                    rejects = rejects_of(outcome)
                    if spec.sink.table:
                        rejects = rejects.union(sinks.misfits(rows, spec.sink.table))
                    rejects.write.mode("overwrite").parquet(target)
                    started = time.monotonic()
                sinks.append(rows.observe(counted, count), spec.sink, batch_id)
                seconds = time.monotonic() - started
                sizes = sinks.insert_sizes(rows, spec.sink) if spec.sink.cut_inserts else []
        except Exception as e:
            self.failed = True
            self.log(spark, spec.id, batch_id, 0, time.monotonic() - started, "insert", str(e))
            raise
        line = (spec.id, batch_id, counted.get["rows"], datetime.now(timezone.utc), seconds, None, None)
        if done:
            done.add(line, sizes)
        # A batch without rows is no insert.
        written = self._add(spark, *journal.parts(line, sizes)) if line[2] and self.log_path else True
        if done and (written or self.log_path is None):
            done.forget(batch_id)

    def _inserted_by(self, spark: SparkSession, job: str) -> journal.Inserted | None:
        """What a job has inserted; lines of batches that a lost driver did not log are logged first."""
        if not self.state:
            return None
        if job not in self._inserted:
            self._inserted[job] = journal.Inserted(spark, f"{self.state}/inserted/{job}")
            for line in self._inserted[job].lines() if self.log_path else ():
                if line[2]:
                    self._add(spark, line)
        return self._inserted[job]

    def _reload_filters(self, spark: SparkSession, batch_id: int) -> None:
        """Take up changed filters at a batch boundary; keep a job's old one if its new one is invalid.

        An invalid filter is logged once, not at every batch for as long as it stays.
        """
        for i, spec in enumerate(self.specs):
            source = self.filter_sources.get(spec.id)
            if source is None:
                continue
            try:
                latest = source(spark)
                if latest == self._seen.get(spec.id):
                    self._said.pop(spec.id, None)
                    continue
                said = repr(latest)
                if said == self._said.get(spec.id):
                    continue
                check_filter(spark, latest)
            except (FilterError, ValueError, PySparkException) as e:
                said = said if isinstance(e, FilterError) else str(e)
                if self._said.get(spec.id) != said:
                    self.log(spark, spec.id, batch_id, 0, 0.0, "filter", str(e))
                self._said[spec.id] = said
                if spec.id not in self._seen:
                    self._take(i, self._restored(spark, spec.id) or spec.filter)
                continue
            self._said.pop(spec.id, None)
            self._take(i, latest)
            self._remember(spark, spec.id, latest)

    def _take(self, i: int, latest: FilterSpec) -> None:
        self._seen[self.specs[i].id] = latest
        self.specs[i] = replace(self.specs[i], filter=latest)

    def _remember(self, spark: SparkSession, job: str, latest: FilterSpec) -> None:
        if self.state:
            line = spark.createDataFrame([(json.dumps(asdict(latest)),)], "value string").coalesce(1)
            line.write.mode("overwrite").text(f"{self.state}/filters/{job}")

    def _restored(self, spark: SparkSession, job: str) -> FilterSpec | None:
        """The last valid filter of a run before this one."""
        if not self.state:
            return None
        try:
            row = spark.read.text(f"{self.state}/filters/{job}").first()
        except PySparkException:  # none was kept yet
            return None
        return FilterSpec.from_dict(json.loads(row[0])) if row else None

    def log(self, spark, job, batch_id, rows, seconds, error, message) -> None:
        if self.log_path is not None:
            self._add(spark, (job, batch_id, rows, datetime.now(timezone.utc), seconds, error, message))

    def _add(self, spark: SparkSession, *lines: tuple) -> bool:
        if self._log is None:
            self._log = journal.RunLog(spark.getActiveSession() or spark, self.log_path)
        return self._log.add(*lines)

    def tick(self) -> None:
        """Progress was made, or there is nothing to do."""
        if self._log is not None:
            self._log.tick()

    def ended(self, spark: SparkSession, failure: str | None) -> None:
        """The query is over. An end that no insert caused is a source error; whoever tells it first is heard."""
        with self._ending:
            news, self.failed = bool(failure) and not self.failed, self.failed or bool(failure)
        if news:
            for spec in self.specs:
                self.log(spark, spec.id, -1, 0, 0.0, "source", failure)
        if self._log is not None:
            self._log.flush()


def _by_job(specs: Sequence[LoadSpec], sources: FilterSources) -> dict[str, FilterSource]:
    if sources is None:
        return {}
    if isinstance(sources, Mapping):
        unknown = sorted(set(sources) - {s.id for s in specs})
        if unknown:
            raise ValueError(f"filter sources of no job: {', '.join(unknown)}")
        return dict(sources)
    if len(specs) > 1:
        raise ValueError("several jobs need their filter sources by job id")
    return {specs[0].id: sources}


def _check_shared(specs: Sequence[LoadSpec], given: bool) -> None:
    """Refuse jobs that one query cannot serve as each of them asks."""
    if len({s.id for s in specs}) < len(specs):
        raise ValueError("jobs need ids of their own")
    lead = specs[0]
    for spec in specs[1:]:
        if spec.source != lead.source and not given:
            raise ValueError(f"{spec.id} reads another source than {lead.id}: start it as a query of its own")
        if spec.sink.flush_seconds != lead.sink.flush_seconds:
            raise ValueError(f"{spec.id} has another flush interval than {lead.id}: start it as a query of its own")
        if spec.sink.rows_per_trigger != lead.sink.rows_per_trigger:
            raise ValueError(f"{spec.id} has another rate than {lead.id}: start it as a query of its own")
    if lead.sink.inserts_per_second and (given or lead.source is None or lead.source.format != "kafka"):
        raise ValueError("an insert rate can be kept on Kafka only; bound other sources by files or bytes per trigger")


@contextmanager
def _kept(df: DataFrame, several: bool):
    """Keep a frame while several outputs are written from it."""
    if not several:
        yield
        return
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        df.unpersist()


def start(
    spark: SparkSession,
    specs: LoadSpec | Sequence[LoadSpec],
    checkpoint: str,
    log_path: str | None = None,
    filter_source: FilterSources = None,
    messages: DataFrame | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Start one streaming query for a job, or for several jobs on the same source.

    A micro-batch starts every flush interval and reads at most what the insert rate allows, or else
    a bounded number of batches. With ``drain`` the query loads what is there, in such
    micro-batches, and stops. Jobs that differ in source, flush interval or rate are refused.
    ``filter_source`` is the job's, or a mapping from job ids.
    """
    specs = [specs] if isinstance(specs, LoadSpec) else list(specs)
    loader = BatchLoader(specs, log_path, filter_source, state=f"{checkpoint.rstrip('/')}/jsonflow")
    return _start(spark, loader, checkpoint, messages, drain)


def run(
    spark: SparkSession,
    specs: LoadSpec | Sequence[LoadSpec],
    checkpoint: str,
    log_path: str | None = None,
    filter_source: FilterSources = None,
    messages: DataFrame | None = None,
    drain: bool = False,
) -> None:
    """Start jobs and stay until they end."""
    specs = [specs] if isinstance(specs, LoadSpec) else list(specs)
    loader = BatchLoader(specs, log_path, filter_source, state=f"{checkpoint.rstrip('/')}/jsonflow")
    try:
        _start(spark, loader, checkpoint, messages, drain).awaitTermination()
    except StreamingQueryException as e:
        loader.ended(spark, str(e))
        raise
    loader.ended(spark, None)


def _start(
    spark: SparkSession, loader: BatchLoader, checkpoint: str, messages: DataFrame | None, drain: bool
) -> StreamingQuery:
    _check_shared(loader.specs, messages is not None)
    for spec in loader.specs:
        check_filter(spark, spec.filter)
        sinks.ensure_table(spark, spec.sink, spec.mapping)
    lead = loader.specs[0]
    if messages is None:
        messages = stream_messages(spark, lead.source, lead.sink.rows_per_trigger)
    writer = (
        loader.plan(messages).writeStream.foreachBatch(loader)
        .queryName("+".join(s.id for s in loader.specs))
        .option("checkpointLocation", checkpoint)
    )
    ends = journal.ends_of(spark)
    if drain:
        query = writer.trigger(availableNow=True).start()
    else:
        query = writer.trigger(processingTime=f"{lead.sink.flush_seconds} seconds").start()
    ends.watch(str(query.runId), loader)
    return query


def start_all(
    spark: SparkSession, specs: Sequence[LoadSpec], checkpoint_root: str, **options
) -> list[StreamingQuery]:
    """One independent query per job, each with its own checkpoint."""
    root = checkpoint_root.rstrip("/")
    return [start(spark, spec, f"{root}/{spec.id}", **options) for spec in specs]


def job_state(query: StreamingQuery) -> dict[str, object]:
    """Whether a job runs, and the error that ended it."""
    failure = query.exception()
    return {"running": query.isActive, "last_error": str(failure) if failure else None}
