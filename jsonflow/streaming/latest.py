"""A target that keeps the latest row of each key, fed by a stream.

The target is a folder of runs. A batch is reduced to the latest row per key and written as a run of its own; runs of
like size are then merged into one, so there are few of them, each row is written again only about as often as
the table doubles, and a batch costs by its own size rather than the table's. A read reduces the runs once more.

A small file per batch lists the runs that count; it is written when all of them are whole. A batch that is run
again finds its list and does nothing, and what a lost driver left behind is in no list. An older
message that comes late does not replace a newer one, whichever batch it comes in.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jsonflow.operators.dedup import latest_per_key
from jsonflow.streaming import journal

# A run is merged into the one before it once it has so large a share of its rows, and lists are kept for a while, as readers
# may have one open.
SHARE, LISTS = 0.5, 10


class LatestTable:
    """The runs below ``path``; ``order`` tells which row of a key is the latest and should be unique per key."""

    def __init__(self, path: str, keys: Sequence[str], order: Sequence[str], format: str = "parquet") -> None:
        self.path, self.keys, self.order, self.format = path.rstrip("/"), list(keys), list(order), format

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lists = self._lists(spark)
        if batch_id in lists:
            return
        schema, runs = self._runs(spark, lists)
        if schema is not None and schema != _plain(batch.schema):
            raise ValueError(f"{self.path} has other columns than the rows")
        runs.append(self._write(batch, f"{batch_id}-0"))
        step = 0
        while len(runs) > 1 and runs[-1][1] >= SHARE * runs[-2][1]:
            step += 1
            both = self._read(spark, [runs.pop()[0], runs.pop()[0]], batch.schema)
            runs.append(self._write(both, f"{batch_id}-{step}"))
        runs = [r for r in runs if r[1]] or runs[:1]
        journal.put(spark, f"{self.path}/lists/{batch_id}", json.dumps({"schema": _plain(batch.schema).json(), "runs": runs}))
        self._clear(spark, [*lists, batch_id])

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per key; rows with a NULL in the key have no key and all stay."""
        schema, runs = self._runs(spark, self._lists(spark))
        if schema is None:
            raise ValueError(f"nothing was merged into {self.path} yet")
        return self._latest(self._read(spark, [name for name, _ in runs], schema))

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.keys, self.order)

    def _lists(self, spark: SparkSession) -> list[int]:
        return sorted(int(n) for n in journal.names(spark, f"{self.path}/lists") if n.isdigit())

    def _runs(self, spark: SparkSession, lists: list[int]) -> tuple[StructType | None, list[list]]:
        """Name and rows of each run, the largest first."""
        if not lists:
            return None, []
        found = json.loads(journal.get(spark, f"{self.path}/lists/{lists[-1]}"))
        return StructType.fromJson(json.loads(found["schema"])), found["runs"]

    def _read(self, spark: SparkSession, runs: Sequence[str], schema: StructType) -> DataFrame:
        parts = [spark.read.schema(schema).format(self.format).load(f"{self.path}/runs/{name}") for name in runs]
        return reduce(DataFrame.unionByName, parts)

    def _write(self, rows: DataFrame, name: str) -> list:
        counted = Observation()
        out = self._latest(rows).observe(counted, F.count(F.lit(1)).alias("rows"))
        out.write.format(self.format).mode("overwrite").save(f"{self.path}/runs/{name}")
        return [name, counted.get["rows"]]

    def _clear(self, spark: SparkSession, lists: list[int]) -> None:
        """Drop lists beyond ``LISTS`` and the runs that no list has any more."""
        gone, kept = lists[:-LISTS], lists[-LISTS:]
        if not gone:
            return
        used = {name for b in kept for name, _ in self._runs(spark, [b])[1]}
        for name in journal.names(spark, f"{self.path}/runs"):
            if name not in used and int(name.split("-")[0]) <= gone[-1]:
                journal.remove(spark, f"{self.path}/runs/{name}")
        for b in gone:
            journal.remove(spark, f"{self.path}/lists/{b}")


def _plain(schema: StructType) -> StructType:
    """As read back: every column may be NULL."""
    return StructType.fromJson(json.loads(schema.json().replace('"nullable":false', '"nullable":true').replace('"containsNull":false', '"containsNull":true')))
