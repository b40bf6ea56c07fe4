"""Fields of parsed messages as columns.

Each step of a lookup is a projection of its own. Spark computes a column that later
steps use more than once only once if it stands in its own projection; written as one
expression, every mention would be looked up again and the generated code would outgrow
what the JVM compiles.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonflow.functions import fields as f
from jsonflow.operators.decode import DOC, RAW
from jsonflow.plans.spec import quoted

# So many fields that are members of one object are read together. Looked up one by one, each copies
# the message and searches its names, so a wide mapping would cost its width times the message.
TOGETHER = 12
# Ways to read a field that look at its kind first; other types are looked up in the message.
BY_KIND = {"string", "double", "int", "bool", "date", "datetime", "present", "is_null", "variant"}


def together(chains: Iterable[tuple[str, ...]]) -> dict[tuple[str, ...], list[str]]:
    """Objects of which many members are read: their keys, and the members' names."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for *parent, name in chains:
        groups.setdefault(tuple(parent), []).append(name)
    found = {}
    for parent, names in groups.items():
        # A struct cannot name a member "", and takes names that differ only by case for one.
        folded = Counter(name.casefold() for name in names)
        plain = [name for name in names if name and folded[name.casefold()] == 1]
        if len(plain) >= TOGETHER:
            found[parent] = plain
    return found


# What ``from_json`` reads, its note of a message that did not fit, and whether there is none.
JSON, UNFIT = "_json", "_unfit"
FITS = f"{JSON}.{UNFIT} IS NULL"
# Whether a message has fields that are not settled.
REST = "_rest"
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _struct(tree: Mapping) -> str | None:
    """Fields of a struct type; None if a struct cannot hold the names."""
    if "" in tree or len({name.casefold() for name in tree}) < len(tree):
        return None
    types = {name: ty if isinstance(ty, str) else (inner := _struct(ty)) and f"struct<{inner}>" for name, ty in tree.items()}
    return None if None in types.values() else ", ".join(f"{quoted(name)} {ty}" for name, ty in types.items())


def with_plain(df: DataFrame, types: Mapping[str, str], wanted: f.Sql) -> tuple[DataFrame, dict[str, f.Sql]]:
    """Read the paths under their nested spelling from the message text, as the given types, in one pass.

    Returns the frame with a column added, and where in it each field is; no fields if there are too few.
    Nothing is read unless the message is ``wanted``. Fields count only where the message ``FITS``: of a name
    that comes twice, ``from_json`` keeps a value that fits its type, though the last one counts. What it
    takes for JSON is what the parser of variants does.
    """
    keys = {p: tuple(p.split(".")) for p in types}
    members = {(*parent, name) for parent, group in together(keys.values()).items() for name in group}
    keys = {p: chain for p, chain in keys.items() if chain in members}
    inner = {chain[:i] for chain in keys.values() for i in range(1, len(chain))}
    keys = {p: chain for p, chain in keys.items() if chain not in inner}
    tree: dict = {UNFIT: "string"}
    for p, chain in keys.items():
        node = tree
        for key in chain[:-1]:
            node = node.setdefault(key, {})
            if not isinstance(node, dict):
                return df, {}
        node.setdefault(chain[-1], types[p])
    schema = _struct(tree)
    if len(keys) < TOGETHER or schema is None or any(chain[0] == UNFIT for chain in keys.values()):
        return df, {}
    options = ", ".join(f"'{k}', '{v}'" for k, v in {**STRICT, "columnNameOfCorruptRecord": UNFIT}.items())
    read = f"from_json({RAW}, {f.literal(schema)}, map({options}))"
    df = df.withColumn(JSON, F.expr(f"CASE WHEN {wanted} THEN {read} END"))
    return df, {p: f"{JSON}.{'.'.join(map(quoted, chain))}" for p, chain in keys.items()}


def with_leaves(
    df: DataFrame, reads: Iterable[tuple[str, str]], settled: Mapping[str, f.Sql] | None = None
) -> tuple[DataFrame, dict[str, f.Leaf]]:
    """Find the field at each dotted path of ``(path, how it will be read)`` pairs.

    Returns the frame, with columns added, and the fields. Objects count as missing. ``settled`` has
    conditions under which a field need not be found, and counts as missing too. If it is given, each
    step is one struct, which is NULL unless ``REST`` tells that a message has fields to find: others
    pass for the cost of a column, not of one per field and step.
    """
    settled = settled or {}
    hows: dict[str, set[str]] = {}
    for path, how in reads:
        hows.setdefault(path, set()).add(how)
    names = {p: {part: f"_{part}.{part}{i}" if settled else f"_{part}{i}" for part in "xhoktn"} for i, p in enumerate(hows)}
    keys = {p: tuple(p.split(".")) for p in hows}
    others = {p: o for p in hows if (o := f.other_spellings(p, DOC)) is not None}
    objects = together(keys[p] for p in hows if hows[p] <= BY_KIND)
    members = {(*parent, name): f"_m{i}.{quoted(name)}" for i, (parent, group) in enumerate(objects.items()) for name in group}
    wide = {p: members[keys[p]] for p in hows if keys[p] in members}
    leaves = {
        p: f.Leaf((), n["x"], None, n["k"], n["t"], n["n"])
        if p in wide
        else f.Leaf(keys[p], DOC, n["o"] if p in others else None, n["k"], n["t"], n["n"])
        for p, n in names.items()
    }

    def unless(done: f.Sql | None, text: f.Sql) -> f.Sql:
        return f"CASE WHEN {done} THEN NULL ELSE {text} END" if done else text

    def add(part: str, columns: dict[str, f.Sql]) -> DataFrame:
        if not settled or not columns:
            return df.withColumns({names[p][part]: F.expr(text) for p, text in columns.items()}) if columns else df
        struct = ", ".join(f"'{names[p][part].partition('.')[2]}', {text}" for p, text in columns.items())
        return df.withColumn(f"_{part}", F.expr(f"CASE WHEN {REST} THEN named_struct({struct}) END"))

    if wide:
        read = [f.members_at(DOC, parent, group) for parent, group in objects.items()]
        read = [f"CASE WHEN {REST} THEN {text} END" for text in read] if settled else read
        df = df.select("*", *[F.expr(f"{text} AS _m{i}") for i, text in enumerate(read)])
        one = {p: f"CASE WHEN NOT {f.is_object_kind(f.kind(x))} THEN {x} ELSE {others.pop(p, 'NULL')} END" for p, x in wide.items()}
        df = add("x", {p: unless(settled.get(p), text) for p, text in one.items()})
    df = add("h", {p: f.kind(f.key_at(DOC, keys[p])) for p in hows if p not in wide})
    # Other spellings are looked at only where the nested one has no leaf.
    found, texts, numbers = {}, {}, {}
    kinds = {p: f.kind(leaves[p].doc) for p in wide}
    for p, leaf in leaves.items():
        n = names[p]
        if p not in wide:
            is_leaf = f"NOT {f.is_object_kind(n['h'])}"
            if p in others:
                found[p] = f"CASE WHEN {is_leaf} THEN NULL ELSE {others[p]} END"
            rest = f"ELSE {f.kind(n['o'])}" if p in others else ""
            kinds[p] = f"CASE WHEN {is_leaf} THEN {n['h']} {rest} END"
        if hows[p] - {"present", "is_null", "variant"}:
            texts[p] = f"CASE WHEN {leaf.kind} = 'STRING' THEN {leaf.get('string')} END"
        if "double" in hows[p]:
            numbers[p] = f"""CASE WHEN {f.is_number_kind(leaf.kind)} THEN {leaf.get("double")}
                                  ELSE {f.text_to_double(leaf.text)} END"""
        elif "string" in hows[p]:
            numbers[p] = f"CASE WHEN {leaf.kind} = 'DOUBLE' THEN {leaf.get('double')} END"
    for part, columns in (("o", found), ("k", kinds), ("t", texts), ("n", numbers)):
        df = add(part, columns)
    return df, leaves


def with_fields(df: DataFrame, fields: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Add fields given as ``(column name, dotted path, how to read it)``.

    The ways to read a field are string, double, int, bool, present, is_null, variant, or
    any Spark type.
    """
    found, leaves = with_leaves(df, [(path, how) for _, path, how in fields])
    return found.select(
        *df.columns, *[F.expr(f.read_as(leaves[path], how)).alias(name) for name, path, how in fields]
    )
