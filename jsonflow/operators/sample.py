"""Bounded samples of a topic or table, oldest messages first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: messages sampled when no positive number is asked for.
DEFAULT_SAMPLE = 100

SALTS = 64
# Ranges of offsets that are counted at once in each partition.
RANGES = 1024
# Partitions of a topic whose shares are told apart on the driver.
MOST_PARTITIONS = 10_000


def _size(n: int) -> int:
    return n if n > 0 else DEFAULT_SAMPLE


def sample_oldest(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` messages in the given order; fewer, or none, if there are fewer.

    Each task keeps its ``n`` first rows and only those are merged.
    """
    return df.orderBy(*order).limit(_size(n))


def sample_even(
    df: DataFrame, n: int, partition: str = "partition", offset: str = "offset"
) -> DataFrame:
    """``n`` messages taken in turn from every partition, each from its oldest on.

    A small sample is ranked, which Spark bounds inside the scan tasks, and comes in order. For a large one
    each partition's share follows from the counts of all, and its last offset from counts of ranges of
    offsets; what is read of the messages then is one filter, without a shuffle, sort or order. Offsets that are no
    integers, missing or repeated are ranked at any size, by salted shares first, so that no task sorts
    the whole of a partition that holds most of the topic.
    """
    n = _size(n)
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        last = _last_offsets(df, n, partition, offset)
        if last is not None:
            return _up_to(df, last, partition, offset)
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(offset), F.lit(SALTS)))
        df = _ranked(salted, n, [partition, "_salt"], offset).drop("_salt", "_turn")
    ranked = _ranked(df, n, [partition], offset)
    return ranked.orderBy("_turn", partition).limit(n).drop("_turn")


def shares(counts: Sequence[int], n: int) -> list[int]:
    """How many of ``n`` turns fall to each of the partitions, given in their order: as many whole rounds as there
    are, and what is left over one by one."""
    low, high = 0, max(counts, default=0)
    while low < high:
        level = (low + high + 1) // 2
        low, high = (level, high) if sum(min(c, level) for c in counts) <= n else (low, level - 1)
    left, out = n - sum(min(c, low) for c in counts), []
    for c in counts:
        more = 1 if c > low and left > 0 else 0
        left -= more
        out.append(min(c, low) + more)
    return out


def _last_offsets(df: DataFrame, n: int, partition: str, offset: str) -> DataFrame | None:
    """``_partition, _last``: up to which offset each partition is taken, a row per partition of the topic.

    A partition without gaps needs no more than its first offset. Elsewhere ranges of offsets are counted, and
    the one that the last message lies in is counted again in finer ranges, all partitions in one job.
    """
    if dict(df.dtypes)[offset] not in ("tinyint", "smallint", "int", "bigint"):
        return None
    narrow = df.select(F.col(partition).alias("_partition"), F.col(offset).cast("long").alias("_offset"))
    stats = narrow.groupBy("_partition").agg(
        F.count("*").alias("n"), F.count("_offset").alias("told"), F.min("_offset").alias("low"), F.max("_offset").alias("high")
    )
    found = stats.limit(MOST_PARTITIONS + 1).collect()
    if len(found) > MOST_PARTITIONS or any(r["n"] != r["told"] for r in found):
        return None
    found.sort(key=lambda r: (r["_partition"] is not None, r["_partition"]))
    last, open_ = [], []
    wanted = shares([r["n"] for r in found], n)
    for row, share in zip(found, wanted):
        _settle(row["_partition"], row["n"], share, row["low"], row["high"], last, open_)
    schema = narrow.schema["_partition"].dataType.simpleString()
    while open_:
        if any(low == high for _, _, low, high in open_):
            return None  # an offset that occurs more than once
        ranges = [(p, share, low, high, -(-(high - low + 1) // RANGES)) for p, share, low, high in open_]
        bounds = df.sparkSession.createDataFrame(ranges, f"_p {schema}, share long, low long, high long, width long")
        inside = narrow.join(F.broadcast(bounds), F.col("_partition").eqNullSafe(F.col("_p")))
        inside = inside.where(F.col("_offset").between(F.col("low"), F.col("high")))
        place = F.expr("(_offset - low) div width").alias("place")
        counted = inside.groupBy("_partition", "share", place).agg(
            F.count("*").alias("n"), F.min("_offset").alias("low"), F.max("_offset").alias("high")
        )
        upto = F.sum("n").over(Window.partitionBy("_partition").orderBy("place"))
        hit = counted.withColumn("upto", upto).where("upto >= share AND upto - n < share")
        rows, open_ = hit.collect(), []
        for r in rows:
            _settle(r["_partition"], r["n"], r["share"] - (r["upto"] - r["n"]), r["low"], r["high"], last, open_)
    out = df.sparkSession.createDataFrame(last, f"_partition {schema}, _last long")
    # Offsets that occur more than once can look like offsets without gaps.
    taken = _up_to(narrow, out.withColumnRenamed("_partition", "_p"), "_partition", "_offset", "_p").count()
    return out if taken == sum(wanted) else None


def _settle(partition, n: int, share: int, low: int, high: int, last: list, open_: list) -> None:
    """The last offset of ``share`` messages out of ``n`` between two offsets, if it can be told already."""
    if share == 0:
        return
    if share == n:
        last.append((partition, high))
    elif share == 1:
        last.append((partition, low))
    elif high - low + 1 == n:
        last.append((partition, low + share - 1))
    else:
        open_.append((partition, share, low, high))


def _up_to(df: DataFrame, last: DataFrame, partition: str, offset: str, name: str = "_partition") -> DataFrame:
    """One row of ``last`` per partition goes to every task, at most ``MOST_PARTITIONS``."""
    same = df[partition].eqNullSafe(last[name]) & (df[offset] <= last["_last"])
    return df.join(F.broadcast(last), same, "left_semi")


def _ranked(df: DataFrame, n: int, groups: list[str], offset: str) -> DataFrame:
    turn = F.row_number().over(Window.partitionBy(*groups).orderBy(offset))
    return df.withColumn("_turn", turn).filter(F.col("_turn") <= n)
