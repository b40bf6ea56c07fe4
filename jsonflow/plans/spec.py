"""What a load job is made of: source, filter, mapping and sink settings.

Plain dataclasses read from dicts (for example from a YAML or JSON file). Defaults are
always filled in, however the spec was made.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

# Defaults of a load job.
DEFAULT_BATCH_SIZE = 500
DEFAULT_FLUSH_INTERVAL = "2s"

# Batches of rows that one micro-batch may read where no rate is set.
MOST_FLUSHES = 1000
# Names that the load uses itself.
RESERVED = ("_doc", "_raw", "_stage", "_rejects", "_bad", "_verdict", "_judged")


def quoted(name: str) -> str:
    """A column or table name as an SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Field:
    """One mapped field: dotted path in the message, target column, declared type."""

    path: str
    column: str
    type: str
    nullable: bool = False

    @classmethod
    def from_dict(cls, d: Mapping[str, Any]) -> Field:
        return cls(d["fieldPath"], d["column"], d.get("type") or "String", bool(d.get("nullable")))

    def to_dict(self) -> dict[str, Any]:
        return {
            "fieldPath": self.path,
            "column": self.column,
            "type": self.type,
            "nullable": self.nullable,
        }


def read_mapping(columns: Sequence[Mapping[str, Any]] | Mapping[str, Any]) -> list[Field]:
    """A mapping from a list of field dicts, or from a document with a ``columns`` list."""
    if isinstance(columns, Mapping):
        columns = columns.get("columns") or []
    mapping = [Field.from_dict(c) for c in columns]
    # To Spark, names that differ only by case are one.
    names = [m.column.lower() for m in mapping]
    twice = sorted({m.column for m in mapping if names.count(m.column.lower()) > 1})
    if twice:
        raise ValueError(f"columns mapped twice: {', '.join(twice)}")
    reserved = sorted({m.column for m in mapping if m.column.lower() in RESERVED})
    if reserved:
        raise ValueError(f"columns named as the load's own: {', '.join(reserved)}")
    return mapping


@dataclass(frozen=True)
class FilterSpec:
    """Which messages to load: a rule tree, or a Spark SQL predicate over named fields."""

    enabled: bool = False
    language: str = "rules"
    rules: Mapping[str, Any] | None = None
    expression: str = ""
    fields: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, d: Mapping[str, Any] | None) -> FilterSpec:
        d = d or {}
        language = str(d.get("language") or ("sql" if d.get("expression") else "rules"))
        return cls(
            enabled=bool(d.get("enabled")),
            language=language.strip().lower(),
            rules=d.get("rules"),
            expression=d.get("expression") or "",
            fields=d.get("fields") or {},
        )


def topic_offsets(topic: str, offsets: str | Mapping[Any, Any]) -> str:
    """Where to start or end on a topic, as Spark's Kafka options take it: ``earliest``, ``latest``, or an offset for
    each partition, which may be one of these words too."""
    # Kafka's own numbers for the ends of a partition.
    ends = {"earliest": -2, "latest": -1}
    if isinstance(offsets, str):
        if offsets not in ends:
            raise ValueError(f"offsets are earliest, latest or given by partition: {offsets!r}")
        return offsets
    by_partition = {}
    for partition, offset in offsets.items():
        number = ends.get(offset, offset)
        if int(partition) < 0 or int(number) < -2:
            raise ValueError(f"no such offset: {partition}: {offset}")
        by_partition[int(partition)] = int(number)
    if not by_partition or "," in topic:
        raise ValueError("offsets by partition need one topic and all of its partitions")
    return json.dumps({topic: {str(p): by_partition[p] for p in sorted(by_partition)}})


@dataclass(frozen=True)
class SourceSpec:
    """Where messages come from: a Spark reader format, its options and the value column."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None
    table: str | None = None
    value: str = "value"
    schema: str | None = None

    @classmethod
    def from_dict(cls, d: Mapping[str, Any]) -> SourceSpec:
        if d.get("topic") or d.get("brokers"):
            if not d.get("topic") or not d.get("brokers"):
                raise ValueError("a Kafka source needs both brokers and topic")
            brokers = d["brokers"]
            options = {
                "kafka.bootstrap.servers": brokers if isinstance(brokers, str) else ",".join(brokers),
                "subscribe": d["topic"],
            }
            if d.get("groupId"):
                options["groupIdPrefix"] = d["groupId"]
            for name in ("startingOffsets", "endingOffsets"):
                if d.get(name):
                    options[name] = topic_offsets(d["topic"], d[name])
            options.update(d.get("options") or {})
            return cls("kafka", options)
        if not d.get("format") and not d.get("table"):
            raise ValueError("a source needs brokers and topic, a format, or a table")
        return cls(
            format=d.get("format") or "table",
            options=d.get("options") or {},
            path=d.get("path"),
            table=d.get("table"),
            value=d.get("value") or "value",
            schema=d.get("schema"),
        )


@dataclass(frozen=True)
class SinkSpec:
    """Where rows go: a table, or a path in some format, plus batching settings."""

    table: str | None = None
    path: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    create_if_missing: bool = False
    batch_size: int = DEFAULT_BATCH_SIZE
    flush_interval: str = DEFAULT_FLUSH_INTERVAL
    inserts_per_second: int = 0
    rejects_path: str | None = None
    latest_keys: Sequence[str] = ()
    latest_order: Sequence[str] = ()
    cut_inserts: bool = False

    def __post_init__(self) -> None:
        if self.latest_keys and (self.table or not self.path or not self.latest_order):
            raise ValueError("to keep the latest row of a key a sink needs a path and an order")
        if not self.table and not self.path and self.format in ("parquet", "orc", "json"):
            raise ValueError("a sink needs a table or a path")
        if self.cut_inserts and self.latest_keys:
            raise ValueError("the latest row of a key is merged, not inserted: there is nothing to cut")
        if self.batch_size <= 0:
            object.__setattr__(self, "batch_size", DEFAULT_BATCH_SIZE)
        if not self.flush_interval:
            object.__setattr__(self, "flush_interval", DEFAULT_FLUSH_INTERVAL)
        if self.inserts_per_second < 0:
            object.__setattr__(self, "inserts_per_second", 0)
        self.flush_seconds  # an unreadable interval fails here, not when the job starts

    @classmethod
    def from_dict(cls, d: Mapping[str, Any]) -> SinkSpec:
        return cls(
            table=d.get("table"),
            path=d.get("path"),
            format=d.get("format") or "parquet",
            options=d.get("options") or {},
            create_if_missing=bool(d.get("createTableIfMissing")),
            batch_size=int(d.get("batchSize") or 0),
            flush_interval=str(d.get("batchFlushInterval") or ""),
            inserts_per_second=int(d.get("insertRatePerSecond") or 0),
            rejects_path=d.get("rejectsPath"),
            latest_keys=tuple((d.get("latestBy") or {}).get("keys") or ()),
            latest_order=tuple((d.get("latestBy") or {}).get("order") or ()),
            cut_inserts=bool(d.get("cutInserts")),
        )

    @property
    def flush_seconds(self) -> float:
        """The flush interval (``500ms``, ``2s``, ``1m30s``) in seconds."""
        units = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0}
        parts = re.findall(r"(\d+(?:\.\d+)?)(ms|s|m|h)", self.flush_interval)
        if not parts or "".join(n + u for n, u in parts) != self.flush_interval:
            raise ValueError(f"flush interval not understood: {self.flush_interval!r}")
        return sum(float(n) * units[u] for n, u in parts)

    @property
    def rows_per_trigger(self) -> int:
        """Rows one micro-batch may read: by the insert rate limit, else a bound on its size."""
        if not self.inserts_per_second:
            return self.batch_size * MOST_FLUSHES
        return max(1, int(self.batch_size * self.inserts_per_second * self.flush_seconds))


@dataclass(frozen=True)
class LoadSpec:
    """One load job. The filter belongs to the spec, so no start path can lose it."""

    id: str
    mapping: Sequence[Field]
    source: SourceSpec | None = None
    sink: SinkSpec | None = None
    filter: FilterSpec = FilterSpec()
    name: str = ""
    description: str = ""
    epoch_numbers: str = "seconds"

    @classmethod
    def from_dict(cls, d: Mapping[str, Any]) -> LoadSpec:
        return cls(
            id=str(d["id"]),
            mapping=read_mapping(d.get("mapping") or []),
            source=SourceSpec.from_dict(d["source"]) if d.get("source") else None,
            sink=SinkSpec.from_dict(d["sink"]) if d.get("sink") else None,
            filter=FilterSpec.from_dict(d.get("filters")),
            name=d.get("name") or "",
            description=d.get("description") or "",
            epoch_numbers=d.get("epochNumbers") or "seconds",
        )
