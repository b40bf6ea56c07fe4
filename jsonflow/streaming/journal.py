"""What jobs remember of their batches: which were inserted, and the run log.

After a batch was inserted a small file named by job and batch says so, with the batch's line of the run
log. It is looked for before an insert, so a batch that is run again after a failure counts once in any
sink. Spark repeats only the last batch; older files go as soon as their lines are in the log.

Lines of the log are gathered and written together, by number or by time, into one folder a day: a
thousand batches are a handful of files. Lines that were not written when a driver was lost are
found again in the files of the batches. A line may thus be written twice, and is read once.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Sequence
from datetime import datetime, timezone
from weakref import WeakSet

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from jsonflow.operators.runlog import LOG_SCHEMA

# In the files of the log a batch that was cut into several inserts has a line for each, told apart by its number.
LINE_SCHEMA = f"{LOG_SCHEMA}, part int"

# Lines and seconds after which what was gathered is written.
MOST_LINES, MOST_SECONDS = 1000, 60.0

_open: WeakSet[RunLog] = WeakSet()


# --- small files, on any file system Spark reaches ------------------------------------


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def put(spark: SparkSession, path: str, text: str) -> None:
    """Make a file that is either whole or not there; one that is there already stays."""
    fs, target = _at(spark, path)
    _, fresh = _at(spark, f"{path}.new")
    out = fs.create(fresh, True)
    out.write(text.encode())
    out.close()
    if not fs.rename(fresh, target) and not fs.exists(target):
        raise OSError(f"cannot write {path}")


def get(spark: SparkSession, path: str) -> str | None:
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    fs, place = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


# --- inserted batches -----------------------------------------------------------------


class Inserted:
    """The batches a job has inserted, below a folder of the query's checkpoint."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def line(self, batch_id: int) -> tuple | None:
        """The log line of an inserted batch."""
        text = get(self.spark, f"{self.folder}/{batch_id}")
        return _row(text)[0] if text is not None else None

    def add(self, line: tuple, sizes: Sequence[int] = ()) -> None:
        job, batch_id, rows, at, seconds, error, message = line
        note = [job, batch_id, rows, at.isoformat(), seconds, error, message, list(sizes)]
        put(self.spark, f"{self.folder}/{batch_id}", json.dumps(note))

    def lines(self) -> list[tuple]:
        """What is to be in the log: a line for each insert of each batch."""
        notes = [get(self.spark, f"{self.folder}/{name}") for name in names(self.spark, self.folder) if name.isdigit()]
        return [line for text in notes if text is not None for line in parts(*_row(text))]

    def forget(self, before: int) -> None:
        """All batches before one; Spark does not come back to them."""
        for name in names(self.spark, self.folder):
            if name.isdigit() and int(name) < before:
                remove(self.spark, f"{self.folder}/{name}")


def _row(text: str) -> tuple[tuple, list[int]]:
    job, batch_id, rows, at, seconds, error, message, *sizes = json.loads(text)
    return (job, batch_id, rows, datetime.fromisoformat(at), seconds, error, message), sizes[0] if sizes else []


def parts(line: tuple, sizes: Sequence[int] = ()) -> list[tuple]:
    """The line of a batch, or the lines of the inserts it was cut into. These went on side by side, so each took as
    long as the batch."""
    if not sizes:
        return [(*line, None)]
    job, batch_id, _, at, seconds, error, message = line
    return [(job, batch_id, n, at, seconds, error, message, i) for i, n in enumerate(sizes)]


# --- the run log ----------------------------------------------------------------------


class RunLog:
    """Gathers lines of the run log and writes them together."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._lines: list[tuple] = []
        self._written = time.monotonic()
        self._lock = threading.RLock()
        _open.add(self)

    def add(self, *lines: tuple) -> bool:
        """True if all lines up to these are written."""
        with self._lock:
            self._lines += [line if len(line) == 8 else (*line, None) for line in lines]
            return self.tick()

    def tick(self) -> bool:
        due = len(self._lines) >= MOST_LINES or time.monotonic() - self._written >= MOST_SECONDS
        if due:
            self.flush()
        return due

    def flush(self) -> None:
        with self._lock:
            if self._lines:
                made = self.spark.createDataFrame(self._lines, LINE_SCHEMA).coalesce(1)
                day = datetime.now(timezone.utc).date().isoformat()
                made.write.mode("append").parquet(f"{self.path}/day={day}")
                self._lines = []
            self._written = time.monotonic()


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The run log as one frame, each line once; what this driver has gathered is written first."""
    for log in list(_open):
        if log.path == log_path.rstrip("/"):
            log.flush()
    reader = spark.read.schema(LINE_SCHEMA).option("recursiveFileLookup", "true")
    return reader.parquet(log_path).distinct()


def compact(spark: SparkSession, log_path: str, day: str) -> None:
    """The files of a day that is over as one. Whatever ends it halfway, each line is read once."""
    path = log_path.rstrip("/")
    if f"day={day}" not in names(spark, path):
        return
    whole = spark.read.schema(LINE_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{path}/day={day}")
    whole.distinct().coalesce(1).write.mode("append").parquet(f"{path}/whole/day={day}")
    remove(spark, f"{path}/day={day}")


# --- the end of queries ---------------------------------------------------------------


class Ends(StreamingQueryListener):
    """Tells loaders of the progress and the end of their query, whoever started or stopped it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._loaders: dict[str, object] = {}
        self._over: dict[str, str | None] = {}
        self._lock = threading.Lock()

    def watch(self, run_id: str, loader) -> None:
        with self._lock:
            self._loaders[run_id] = loader
            over = run_id in self._over
        if over:
            self._end(run_id, self._over.pop(run_id))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        loader = self._loaders.get(str(event.progress.runId))
        if loader is not None:
            loader.tick()

    def onQueryIdle(self, event) -> None:
        loader = self._loaders.get(str(event.runId))
        if loader is not None:
            loader.tick()

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            known = str(event.runId) in self._loaders
            if not known:
                self._over[str(event.runId)] = event.exception
        if known:
            self._end(str(event.runId), event.exception)

    def _end(self, run_id: str, failure: str | None) -> None:
        loader = self._loaders.pop(run_id, None)
        if loader is not None:
            loader.ended(self.spark, failure)


_ends: dict[int, Ends] = {}


def ends_of(spark: SparkSession) -> Ends:
    """The listener of a session, added at the first query."""
    if id(spark) not in _ends:
        _ends[id(spark)] = Ends(spark)
        spark.streams.addListener(_ends[id(spark)])
    return _ends[id(spark)]
