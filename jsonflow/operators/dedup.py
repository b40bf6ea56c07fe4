"""One row per key, for sinks that may receive a message twice."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _by_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a whole key, and rows with a NULL in it."""
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return df.filter(whole), df.filter(~whole)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], null_keys_equal: bool = False
) -> DataFrame:
    """The row with the greatest ``order`` per key; ``order`` should be unique per key.

    A maximum, not a ranking: it is reduced on the map side, so the copies of one key are
    never gathered, however many there are. Rows with a NULL in the key have no key: they
    are not copies of each other and all stay, unless ``null_keys_equal``.
    """
    if not null_keys_equal:
        keyed, loose = _by_key(df, keys)
        return latest_per_key(keyed, keys, order, null_keys_equal=True).union(loose)
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), rank).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def first_seen(
    stream: DataFrame, keys: Sequence[str], event_time: str, within: str, salts: int = 1
) -> DataFrame:
    """Drop repeats of a key on a stream that arrive within a bounded delay of each other.

    For a key that makes up much of the stream ask for ``salts``: its copies are first reduced per share of
    the input tasks, so that it sends at most ``salts`` rows per delay to one place. That is a second step with state of its own.

    Rows with a NULL in the key have no key and all pass.
    """
    marked, loose = _by_key(stream.withWatermark(event_time, within), keys)
    if salts > 1:
        share = F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_share")
        shared = marked.select("*", share).dropDuplicatesWithinWatermark([*keys, "_share"])
        marked = shared.drop("_share")
    return marked.dropDuplicatesWithinWatermark(list(keys)).union(loose)
