"""Conversion of one message field to its declared column type.

Numeric getters are reached only for number kinds: asked for a number, a text variant goes
through a cast that costs many times the lookup.

A value that does not fit gives NULL and a reject reason, never a text in a typed column.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from jsonflow.functions import fields as f
from jsonflow.functions.fields import Sql, literal

# Accepted date text, the blanks trimmed around it, and the size above
# which an epoch given as text counts milliseconds.
ZONED_TEXT = r"\A\d{4}-\d{2}-\d{2}T\d{1,2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:\d{2})\z"
PLAIN_TEXT = r"\A\d{4}-\d{2}-\d{2} \d{1,2}:\d{2}:\d{2}([.,]\d+)?\z"
DATE_TEXT = r"\A\d{4}-\d{2}-\d{2}\z"
BLANKS = " \t\n\u000b\u000c\r\u0085 "
QUOTES = "\"'"
EPOCH_MILLIS_ABOVE = 1_000_000_000_000

EPOCH_NUMBER_RULES = ("seconds", "auto")


@dataclass(frozen=True)
class TargetType:
    """A declared column type: its family, its Spark type and whether null is expected."""

    declared: str
    family: str
    ddl: str
    nullable: bool


def target_type(declared: str) -> TargetType:
    """Read a declared type such as ``Int64``, ``Nullable(DateTime64(3))`` or Spark DDL."""
    wrapped = re.fullmatch(r"Nullable\((.*)\)", declared.strip())
    name = wrapped.group(1) if wrapped else declared.strip()
    # The declared types and the Spark types that hold them.
    known = {
        "Int64": ("int", "bigint"),
        "Float64": ("float", "double"),
        "Bool": ("bool", "boolean"),
        "String": ("string", "string"),
        "Date": ("date", "date"),
    }
    if name in known:
        family, ddl = known[name]
    elif name.startswith("DateTime"):
        family, ddl = "datetime", "timestamp"
    else:
        family, ddl = "other", name
    return TargetType(declared, family, ddl, bool(wrapped))


def is_date(target: TargetType) -> bool:
    return target.family in ("date", "datetime")


def _int(leaf: f.Leaf) -> Sql:
    t = leaf.text
    of_text = f"coalesce({f.text_to_int(t)}, try_cast({f.text_to_double(t)} AS BIGINT))"
    return f"""CASE WHEN {f.is_number_kind(leaf.kind)} THEN {leaf.get("bigint")}
                    WHEN {leaf.kind} = 'STRING' THEN {of_text} END"""


def _bool(leaf: f.Leaf) -> Sql:
    t = leaf.text
    return f"""CASE WHEN {leaf.kind} = 'BOOLEAN' THEN {leaf.get("boolean")}
                    WHEN {t} IN ('true', 'TRUE', '1') THEN true
                    WHEN {t} IN ('false', 'FALSE', '0') THEN false
                    ELSE {f.text_to_int(t)} <> 0 END"""


def _string(leaf: f.Leaf) -> Sql:
    return f"""CASE WHEN {leaf.kind} = 'STRING' THEN {leaf.text}
                    WHEN {f.is_number_kind(leaf.kind)} THEN {f.number_text(leaf)}
                    WHEN {leaf.kind} <> 'VOID' THEN {leaf.get("string")} END"""


def _from_epoch(n: Sql, millis_too: bool) -> Sql:
    """A timestamp from whole seconds, or also from milliseconds; NULL if out of range."""
    unit = f"CASE WHEN {n} > {EPOCH_MILLIS_ABOVE} THEN 1000L ELSE 1000000L END" if millis_too else "1000000L"
    return f"timestamp_micros(try_multiply({n}, {unit}))"


def trimmed(t: Sql) -> Sql:
    """Date text without the blanks and quotes around it."""
    return f"btrim(btrim({t}, {literal(BLANKS)}), {literal(QUOTES)})"


def text_to_timestamp(u: Sql) -> Sql:
    """Date text, or an epoch as text. Text without a zone is UTC whatever the session says."""
    # What stands after the day is looked at first: a pattern that cannot match is not tried.
    dotted, after = f"replace({u}, ',', '.')", f"substring({u}, 11, 1)"
    dated = f"""CASE WHEN {after} = 'T' AND {u} RLIKE {literal(ZONED_TEXT)} THEN {dotted}
                     WHEN {after} = ' ' AND {u} RLIKE {literal(PLAIN_TEXT)} THEN concat({dotted}, 'Z')
                     WHEN {after} = '' AND {u} RLIKE {literal(DATE_TEXT)} THEN concat({u}, ' 00:00:00Z') END"""
    return f"coalesce(try_cast({dated} AS TIMESTAMP), {_from_epoch(f.text_to_int(u), millis_too=True)})"


def _timestamp(leaf: f.Leaf, epoch_numbers: str) -> Sql:
    of_number = _from_epoch(leaf.get("bigint"), millis_too=epoch_numbers == "auto")
    return f"""CASE WHEN {leaf.kind} = 'STRING' THEN {text_to_timestamp(leaf.text)}
                    WHEN {f.is_number_kind(leaf.kind)} THEN {of_number} END"""


def _utc_date(ts: Sql) -> Sql:
    return f"date_from_unix_date(CAST(floor(unix_seconds({ts}) / 86400) AS INT))"


def coerce(leaf: f.Leaf, target: TargetType, epoch_numbers: str = "seconds") -> Sql:
    """Value of a field in its column type; NULL when absent, null or unfit.

    Date types expect the text of the leaf ``trimmed``. ``epoch_numbers="auto"`` reads large
    JSON numbers as milliseconds, as is always done for text; the default reads every JSON
    number as seconds.
    """
    if epoch_numbers not in EPOCH_NUMBER_RULES:
        raise ValueError(f"epoch_numbers must be one of {EPOCH_NUMBER_RULES}")
    if target.family == "int":
        return _int(leaf)
    if target.family == "float":
        return f.as_double(leaf)
    if target.family == "bool":
        return _bool(leaf)
    if target.family == "string":
        return _string(leaf)
    if target.family == "datetime":
        return _timestamp(leaf, epoch_numbers)
    if target.family == "date":
        return _utc_date(_timestamp(leaf, epoch_numbers))
    return f.read_as(leaf, target.ddl)


# How a field is read straight from the text of a message, by the families of the columns it fills.
PLAIN_TYPES = {"int": "bigint", "float": "double", "bool": "boolean"}
TEXT_FAMILIES = {"string", "date", "datetime"}
# Characters a number, array or object begins with, as the ranges between them (a number too large for a
# double is read as text in quotes); and numbers that are the same text as strings.
NOT_TEXT_FROM, TEXT_FROM = ('"', "-", "0", "[", "{"), ("#", ".", ":", "\\", "|")
PLAIN_NUMBER = r"\A-?[0-9]{1,18}\z"


def plain_type(targets: Iterable[TargetType]) -> str | None:
    """The Spark type ``from_json`` reads a field as for all its columns; None if there is no such type."""
    families = {target.family for target in targets}
    if families <= TEXT_FAMILIES:
        return "string"
    return PLAIN_TYPES.get(families.pop()) if len(families) == 1 else None


def plain(x: Sql, target: TargetType) -> Sql:
    """The value of a field from what ``from_json`` read; NULL if it does not follow from that alone.

    It is strict with numbers and booleans, but gives the text of whatever it finds as a string. A text
    tells its kind if no number, array or object is written so, and of dates only those in a pattern do.
    """
    if target.family == "float":  # of a zero the sign depends on how it is written
        return f"CASE WHEN abs({x}) < double('infinity') AND ({x} <> 0 OR string({x}) = '0.0') THEN {x} END"
    if target.family == "string":
        between = [f"{x} >= {literal(a)} AND {x} < {literal(b)}" for a, b in zip(TEXT_FROM, NOT_TEXT_FROM[1:])]
        text = " OR ".join([*reversed(between), f"{x} < {literal(NOT_TEXT_FROM[0])}", f"{x} >= {literal(TEXT_FROM[-1])}"])
        return f"CASE WHEN {text} OR {x} RLIKE {literal(PLAIN_NUMBER)} THEN {x} END"
    if not is_date(target):
        return x
    zoned_text, plain_text = (literal(text.replace("[.,]", r"\.")) for text in (ZONED_TEXT, PLAIN_TEXT))
    text = f"""CASE WHEN {x} RLIKE {plain_text} THEN concat({x}, 'Z') WHEN {x} RLIKE {zoned_text} THEN {x}
                    WHEN {x} RLIKE {literal(DATE_TEXT)} THEN concat({x}, ' 00:00:00Z') END"""
    ts = f"try_cast({text} AS TIMESTAMP)"
    return _utc_date(ts) if target.family == "date" else ts


def reject_reason(value: Sql, k: Sql, target: TargetType) -> Sql:
    """Why a present, non-null field gave no value, e.g. ``text->Int64``; else NULL."""
    if target.nullable and is_date(target):  # an unreadable nullable date is simply null
        return "CAST(NULL AS STRING)"
    source = f"""CASE WHEN {k} = 'STRING' THEN 'text' WHEN {k} = 'BOOLEAN' THEN 'boolean'
                      WHEN {f.is_number_kind(k)} THEN 'number' ELSE 'array' END"""
    unfit = f"{value} IS NULL AND {k} IS NOT NULL AND {k} <> 'VOID'"
    return f"CASE WHEN {unfit} THEN concat({source}, {literal('->' + target.declared)}) END"
