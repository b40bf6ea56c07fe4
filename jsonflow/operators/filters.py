"""Message filters: rule trees and Spark SQL predicates over message fields."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Mapping
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonflow.operators.decode import DOC
from jsonflow.operators.leaves import with_fields
from jsonflow.plans.spec import FilterSpec

VERDICT = "_verdict"

COMPARISONS = {
    "gt": lambda x, n: x > n,
    "gte": lambda x, n: x >= n,
    "lt": lambda x, n: x < n,
    "lte": lambda x, n: x <= n,
}


class FilterError(ValueError):
    """A filter that cannot be used: unknown language or operator, bad regex, bad SQL."""


def rule_fields(node: Mapping[str, Any]) -> list[tuple[str, str]]:
    """What a rule tree reads: ``(path, how)`` pairs."""
    if _is_group(node):
        return [pair for child in node.get("children") or [] for pair in rule_fields(child)]
    path, name = _path(node), node.get("operator") or "equals"
    if not path:
        return []
    if name == "exists":
        return [(path, "present")]
    if name in ("equals", "contains", "regex"):
        return [(path, "present"), (path, "string")]
    if name in COMPARISONS:
        return [(path, "present"), (path, "double")]
    raise FilterError(f"unknown rule operator: {name}")


def rule_predicate(node: Mapping[str, Any], read: Callable[[str, str], Column]) -> Column:
    """A rule tree as a predicate over fields, which ``read(path, how)`` provides.

    A group is ``{"op": "AND"|"OR", "not": bool, "children": [..]}``; a rule is
    ``{"field": path, "operator": name, "value": text, "not": bool}``. An empty group and
    a rule without a field hold for every message.
    """
    if _is_group(node):
        parts = [rule_predicate(child, read) for child in node.get("children") or []]
        joined = reduce(_operator(node), parts) if parts else F.lit(True)
    else:
        joined = _rule(node, read)
    return ~joined if node.get("not") else joined


def _is_group(node: Mapping[str, Any]) -> bool:
    return "children" in node or node.get("kind") == "group"


def _operator(group: Mapping[str, Any]):
    return and_ if str(group.get("op") or "AND").upper() == "AND" else or_


def _path(rule: Mapping[str, Any]) -> str:
    return str(rule.get("field") or "").strip()


def _rule(rule: Mapping[str, Any], read: Callable[[str, str], Column]) -> Column:
    path, name = _path(rule), rule.get("operator") or "equals"
    value = "" if rule.get("value") is None else str(rule["value"])
    if not path:
        return F.lit(True)
    if name == "exists":
        return read(path, "present")
    if name == "equals":
        test = read(path, "string") == value
    elif name == "contains":
        test = read(path, "string").contains(value)
    elif name == "regex":
        test = read(path, "string").rlike(portable_regex(value))
    else:
        test = COMPARISONS[name](read(path, "double"), F.lit(operand(value)))
    # Absent fields make the rule false; a value the test cannot read leaves it NULL.
    return read(path, "present") & test


def operand(text: str) -> float:
    """The number a comparison is made with; text that is no finite number counts as 0."""
    text = text.strip()
    if re.fullmatch(r"0[xX][0-9a-fA-F]+|0[oO][0-7]+|0[bB][01]+", text):
        return float(int(text, 0))
    if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", text, re.ASCII):
        number = float(text)
        return number if math.isfinite(number) else 0.0
    return 0.0


def portable_regex(pattern: str) -> str:
    """A linear-time regex in Java's syntax, matching the same texts.

    Look-around, back-references, atomic groups and possessive repeats are refused: they
    are no part of the portable syntax. ``$`` means the very end of the text (Java's also
    stops before a final newline) and ``.`` excludes only the newline.
    """
    out, in_class, i = ["(?d)"], False, 0
    multiline = re.search(r"\(\?[a-zA-Z]*m", pattern) is not None
    while i < len(pattern):
        ch, rest = pattern[i], pattern[i:]
        if ch == "\\":
            if not in_class and re.match(r"\\([1-9]|k<)", rest):
                raise FilterError(f"back-references are not supported: {pattern}")
            out.append(rest[:2])
            i += 2
            continue
        if in_class:
            named = re.match(r"\[:(\^?)(\w+):\]", rest)
            if named:
                out.append(_named_class(named.group(2), bool(named.group(1))))
                i += len(named.group(0))
                continue
            in_class = ch != "]"
            out.append("\\" + ch if ch in "[&" else ch)
        elif ch == "[":
            head = re.match(r"\[\^?\]?", rest).group(0)
            in_class = True
            out.append(head.replace("]", "\\]"))
            i += len(head)
            continue
        elif re.match(r"\(\?(=|!|<=|<!|>)", rest):
            raise FilterError(f"look-around and atomic groups are not supported: {pattern}")
        elif rest.startswith("(?P<"):
            out.append("(?<")
            i += 4
            continue
        elif re.match(r"[*+?}]\+", rest):
            raise FilterError(f"possessive repeats are not supported: {pattern}")
        else:
            out.append("\\z" if ch == "$" and not multiline else ch)
        i += 1
    return "".join(out)


def _named_class(name: str, negated: bool) -> str:
    """``digit`` of ``[[:digit:]]`` as Java writes it."""
    if name == "word":
        return "\\W" if negated else "\\w"
    java = {"ascii": "ASCII", "xdigit": "XDigit"}.get(name, name.capitalize())
    return f"\\{'P' if negated else 'p'}{{{java}}}"


def _sql_fields(spec: FilterSpec, taken: list[str]) -> list[tuple[str, str, str]]:
    """The named fields of a SQL filter, which become columns the expression refers to."""
    clash = sorted(set(spec.fields) & set(taken))
    if clash:
        raise FilterError(f"filter fields named like columns of the frame: {', '.join(clash)}")
    fields = []
    for name, how in spec.fields.items():
        how = {"path": how} if isinstance(how, str) else how
        fields.append((name, how.get("path") or name, how.get("as") or "string"))
    return fields


def guarded(test: Column) -> Column:
    """A predicate that is NULL for the rows on which evaluating it raises.

    Divisions by zero, failed casts, overflows and bad indexes end a query in ANSI mode. The
    ``try_`` functions give NULL instead; this one does so for whatever its argument raises. In
    the lambda the predicate is evaluated in one piece: parts that it uses twice are not worked
    out ahead of it, where nothing would catch what they raise.
    """
    text = F.try_to_binary((test & F.lit(True)).cast("string"), F.lit("utf-8"))
    return F.get(F.transform(F.array(F.lit(0)), lambda _: text), F.lit(0)).cast("string") == "true"


def is_off(spec: FilterSpec) -> bool:
    """Whether a filter keeps everything: disabled, or with nothing to test."""
    if not spec.enabled:
        return True
    if spec.language == "sql":
        return not spec.expression.strip()
    return spec.language == "rules" and not spec.rules


def with_verdict(decoded: DataFrame, spec: FilterSpec) -> DataFrame:
    """Add ``_verdict``, the filter's outcome: true, false, or NULL if not evaluable.

    A SQL filter names the fields it uses: ``{"email": {"path": "user.email", "as":
    "string"}}``, where ``as`` is string (the default), double, int, bool, present,
    is_null, variant, or any Spark type such as ``array<string>``. A field that is missing
    or unreadable as its type is NULL. A message on which the expression raises is not evaluable.
    """
    columns = decoded.columns
    if is_off(spec):
        return decoded.withColumn(VERDICT, F.lit(True))
    if spec.language == "rules":
        reads = list(dict.fromkeys(rule_fields(spec.rules)))
        names = {pair: f"_f{i}" for i, pair in enumerate(reads)}
        fields = [(names[pair], *pair) for pair in reads]
        verdict = rule_predicate(spec.rules, lambda path, how: F.col(names[path, how]))
    elif spec.language == "sql":
        fields, verdict = _sql_fields(spec, columns), guarded(F.expr(spec.expression))
    else:
        raise FilterError(f"unsupported filter language: {spec.language}")
    judged = with_fields(decoded, fields).select(*columns, verdict.alias("_judged"))
    # As in decode: the explode keeps a filter on the verdict from being unfolded into
    # every lookup the verdict was made of.
    return judged.select(*columns, F.explode(F.array("_judged")).alias(VERDICT))


def keep_matching(decoded: DataFrame, spec: FilterSpec) -> DataFrame:
    """The parsed messages the filter is true for; a filter that is off adds no node."""
    whole = decoded.filter(F.col(DOC).isNotNull())
    if is_off(spec):
        return whole
    return with_verdict(whole, spec).filter(F.col(VERDICT)).drop(VERDICT)


def evaluate_filter(decoded: DataFrame, spec: FilterSpec) -> DataFrame:
    """What the filter would do with each parsed message: ``result`` and ``error``."""
    whole = decoded.filter(F.col(DOC).isNotNull())
    tried = with_verdict(whole, spec)
    return tried.withColumns(
        {
            "result": F.coalesce(F.col(VERDICT), F.lit(False)),
            "error": F.when(F.col(VERDICT).isNull(), "not evaluable for this message"),
        }
    ).drop(VERDICT)


def filter_summary(decoded: DataFrame, spec: FilterSpec) -> DataFrame:
    """Messages kept, dropped and not evaluable over a whole frame, in one row."""
    error = F.col("error").isNotNull()
    return evaluate_filter(decoded, spec).agg(
        F.count_if(F.col("result")).alias("kept"),
        F.count_if(~F.col("result") & ~error).alias("dropped"),
        F.count_if(error).alias("errored"),
    )


def check_filter(spark: SparkSession, spec: FilterSpec) -> None:
    """Raise FilterError if the filter cannot be used; reads no data."""
    one = spark.range(1).select(F.lit("{}").alias("_raw"), F.parse_json(F.lit("{}")).alias(DOC))
    try:
        keep_matching(one, spec)  # Spark checks names and types as the frame is made
        patterns = [] if is_off(spec) else _patterns(spec.rules or {})
        if patterns:  # a regex is compiled when it is first used
            spark.range(1).select(*[F.lit("").rlike(p) for p in patterns]).collect()
    except PySparkException as e:
        raise FilterError(f"invalid filter: {e}") from e


def _patterns(node: Mapping[str, Any]) -> list[str]:
    if _is_group(node):
        return [p for child in node.get("children") or [] for p in _patterns(child)]
    if node.get("operator") != "regex" or not _path(node):
        return []
    return [portable_regex(str(node.get("value") or ""))]
