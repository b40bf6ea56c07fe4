"""Bytes to parsed messages, and the messages that could not be parsed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RAW = "_raw"
DOC = "_doc"

# Closes the envelope a message is looked at in. Fixed text that no message holds.
END = "jsonflow:end-of-message"
# The parser stops after the first JSON value, so ``{"a":1} x`` would pass. A message is whole only if
# END is the second element of ``[message, END]``. That is read without building a tree of the message.
WHOLE = f"""get_json_object(concat('[', {RAW}, ',"{END}"]'), '$[1]') = '{END}'"""


def decode(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Parse the message column once: ``keep`` columns, ``_raw`` text, ``_doc`` variant.

    ``_doc`` is NULL for a malformed message.
    """
    return parsed(raw_messages(df, value, keep), WHOLE)


def raw_messages(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and the message as ``_raw`` text."""
    return df.select(*keep, F.col(value).cast("string").alias(RAW))


def parsed(raw: DataFrame, wanted: str) -> DataFrame:
    """Add ``_doc``, the parsed message, where the condition holds.

    The one-element explode costs next to nothing and keeps the optimizer from pushing
    later filters below the parse, which would parse every message again per condition.
    """
    doc = F.expr(f"CASE WHEN {wanted} THEN try_parse_json({RAW}) END")
    return raw.select("*", doc.alias("_parsed")).select("*", F.explode(F.array("_parsed")).alias(DOC)).drop("_parsed")


def well_formed(decoded: DataFrame) -> DataFrame:
    """The messages that parsed."""
    return decoded.filter(F.col(DOC).isNotNull())


def malformed(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Dead letters: ``keep`` columns, ``value``, ``stage`` and ``reason``."""
    return decoded.filter(F.col(DOC).isNull()).select(
        *keep,
        F.col(RAW).alias("value"),
        F.lit("decode").alias("stage"),
        F.lit("malformed JSON").alias("reason"),
    )
