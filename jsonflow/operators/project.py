"""Mapped paths to typed columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonflow.functions import coerce as c
from jsonflow.functions.fields import literal
from jsonflow.operators.decode import DOC, RAW, WHOLE, parsed, raw_messages
from jsonflow.operators.leaves import FITS, REST, with_leaves, with_plain
from jsonflow.plans.spec import Field, quoted

REJECTS = "_rejects"

# What a type family needs to know of a field.
READ_AS = {"float": "double", "string": "string"}
# No message of so many bytes is too large for a variant.
PARSED_BYTES = 1_000_000


def project(
    decoded: DataFrame,
    mapping: Sequence[Field],
    keep: Sequence[str] = (),
    epoch_numbers: str = "seconds",
    rejects: bool = False,
) -> DataFrame:
    """One column per mapped field, in mapping order; a missing path gives NULL.

    With ``rejects`` a ``_rejects`` array lists ``column: reason`` for every field that
    was there but did not fit its type. All steps are narrow.
    """
    found = decoded.select(*keep, *({RAW} & {*decoded.columns} - {*keep}), DOC)
    found, plain = _with_plain(found, mapping, keep, f"{DOC} IS NOT NULL") if RAW in found.columns else (found, {})
    return _project(found, plain, mapping, keep, epoch_numbers, rejects)


def project_messages(
    messages: DataFrame, mapping: Sequence[Field], keep: Sequence[str] = (), epoch_numbers: str = "seconds", value: str = "value"
) -> DataFrame:
    """``project`` of the messages that parse. A wide mapping leaves unparsed those it finds whole and written plainly."""
    raw = raw_messages(messages, value, keep).withColumn("_whole", F.expr(WHOLE))
    # What the parser of variants would refuse for its size or a repeated key is left to it.
    small = f"octet_length({RAW}) <= {PARSED_BYTES}"
    repeats = messages.sparkSession.conf.get("spark.sql.variant.allowDuplicateKeys") == "true"
    found, plain = _with_plain(raw, mapping, keep, f"{small} AND _whole") if repeats else (raw, {})
    decoded = parsed(found, f"{REST} AND _whole" if plain else "_whole")
    decoded = decoded.filter(f"{DOC} IS NOT NULL OR NOT {REST}" if plain else f"{DOC} IS NOT NULL")
    return _project(decoded, plain, mapping, keep, epoch_numbers, rejects=False)


def _project(
    found: DataFrame, plain: dict[int, c.Sql], mapping: Sequence[Field], keep: Sequence[str], epoch_numbers: str, rejects: bool
) -> DataFrame:
    targets = [c.target_type(m.type) for m in mapping]
    reads = [(m.path, READ_AS.get(ty.family, ty.family)) for m, ty in zip(mapping, targets)]
    rest = [DOC, "_p", REST] if plain else [DOC]
    found, leaves = with_leaves(found.select(*keep, *rest), reads, _settled(plain, mapping))
    dated = {m.path: f"_u{i}" for i, (m, ty) in enumerate(zip(mapping, targets)) if c.is_date(ty)}
    if dated:
        found = found.withColumns({u: F.expr(c.trimmed(leaves[p].text)) for p, u in dated.items()})

    def value(i: int, m: Field, ty: c.TargetType):
        leaf = leaves[m.path]
        if c.is_date(ty):
            leaf = replace(leaf, text=dated[m.path])
        rest = c.coerce(leaf, ty, epoch_numbers)
        return F.expr(f"{f'coalesce({plain[i]}, {rest})' if i in plain else rest} AS _v{i}")

    kinds = {p: f"_kind{i}" for i, p in enumerate(leaves)} if rejects else {}
    seen = [F.expr(f"{leaves[p].kind} AS {k}") for p, k in kinds.items()]
    typed = found.select(*keep, *seen, *[value(i, m, ty) for i, (m, ty) in enumerate(zip(mapping, targets))])
    # A later condition is moved below the columns it names, each mention of one unfolded into its whole
    # conversion. Hung on a generated column, conversions are computed once; conditions on ``keep`` columns
    # still reach the source, and what is not used is still left out.
    typed = typed.select("*", F.explode(F.array(F.lit(True))).alias("_once"))
    hung = [F.when(F.col("_once"), F.col(f"_v{i}")).alias(m.column) for i, m in enumerate(mapping)]
    typed = typed.select(*keep, *kinds.values(), *hung)
    if not rejects:
        return typed
    columns = [quoted(m.column) for m in mapping]
    reasons = [
        f"concat({literal(m.column + ': ')}, {c.reject_reason(col, kinds[m.path], ty)})"
        for m, ty, col in zip(mapping, targets, columns)
    ]
    listed = f"array_compact(array({', '.join(reasons)})) AS {REJECTS}"
    return typed.select(*keep, *columns, F.expr(listed))


def _settled(plain: dict[int, c.Sql], mapping: Sequence[Field]) -> dict[str, c.Sql]:
    """By path, when all columns of a field have their value from the text."""
    settled: dict[str, list[str]] = {}
    for i, x in plain.items():
        settled.setdefault(mapping[i].path, []).append(f"{x} IS NOT NULL")
    return {p: " AND ".join(done) for p, done in settled.items()}


def _with_plain(
    df: DataFrame, mapping: Sequence[Field], keep: Sequence[str], wanted: c.Sql
) -> tuple[DataFrame, dict[int, c.Sql]]:
    """Add the values that can be read straight from the text; where they are, by field of the mapping.

    Casts out of variants are costly, and most fields of most messages are written plainly. Where such
    a value is NULL the field is to be looked up in the parsed message; ``_rest`` tells if there are any.
    """
    targets = [c.target_type(m.type) for m in mapping]
    types: dict[str, list[c.TargetType]] = {}
    for m, ty in zip(mapping, targets):
        types.setdefault(m.path, []).append(ty)
    read = {p: ddl for p, tys in types.items() if (ddl := c.plain_type(tys))}
    others = [quoted(x) for x in df.columns]
    df, fields = with_plain(df, read, wanted)
    if not fields:
        return df, {}
    values = {i: c.plain(fields[m.path], ty) for i, (m, ty) in enumerate(zip(mapping, targets)) if m.path in fields}
    members = ", ".join(f"'p{i}', {value}" for i, value in values.items())
    plain = {i: f"_p.p{i}" for i in values}
    settled = _settled(plain, mapping)
    rest = " OR ".join(f"NOT ({settled[p]})" if p in settled else "true" for p in types)
    df = df.select(*others, F.expr(f"CASE WHEN {FITS} THEN named_struct({members}) END AS _p"))
    return df.select("*", F.expr(f"{rest} AS {REST}")), plain
