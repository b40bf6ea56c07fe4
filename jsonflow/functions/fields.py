"""SQL text that reads one field of a parsed message.

A ``Leaf`` holds what was found at a path; ``jsonflow.operators.leaves`` makes it. Three
states are kept apart, because filters depend on it:

* missing   - the path is not in the message, or names an object: the kind is NULL
* JSON null - the path is there and holds null: the kind is VOID
* a value   - number, text, boolean or array

"Cannot be evaluated" is SQL NULL too, so AND, OR and NOT over these expressions
follow three-valued logic and ``filter`` drops what could not be evaluated.

Expressions are text until a step is put together, and parsed once each: built function by function, a
wide mapping would spend most of its planning on calls into the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

Sql = str

# Text forms taken as numbers, and as true / false by `as_bool`.
INT_TEXT = r"\A[+-]?[0-9]+\z"
NUMBER_TEXT = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
TRUE_TEXT = ("1", "t", "T", "TRUE", "true", "True")
FALSE_TEXT = ("0", "f", "F", "FALSE", "false", "False")


def literal(text: str) -> Sql:
    """A text as an SQL literal; ``${`` is parted, as Spark would put a variable there."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("${", "$' '{") + "'"


def listed(texts: tuple[str, ...]) -> Sql:
    return ", ".join(map(literal, texts))


@dataclass(frozen=True)
class Leaf:
    """One field of a message: how to get it, and the names of columns with its kind, text and number.

    ``text`` is NULL unless the field is a string. ``number`` is a number or numeric text as a
    double; if the field is read as text only, that is NULL unless the field is of kind DOUBLE.

    The field itself is no column. A variant carries all key names of its message along, so
    a column of it per field would multiply the size of a row; it is looked up instead. Where many
    fields are members of one object, ``doc`` is the field alone, found under either spelling, and
    ``keys`` are empty.
    """

    keys: tuple[str, ...]
    doc: Sql
    other: Sql | None
    kind: Sql
    text: Sql
    number: Sql

    def get(self, ddl: str) -> Sql:
        """The field as a Spark type, from its other spelling if that is where it is."""
        nested = key_at(self.doc, self.keys, ddl)
        return nested if self.other is None else f"coalesce({get(self.other, ddl)}, {nested})"


def kind(x: Sql) -> Sql:
    """BIGINT, DECIMAL(p,s), DOUBLE, STRING, BOOLEAN, VOID, ARRAY<..> or OBJECT<..>."""
    return f"schema_of_variant({x})"


def is_number_kind(k: Sql) -> Sql:
    return f"({k} IN ('BIGINT', 'DOUBLE') OR startswith({k}, 'DECIMAL'))"


def is_object_kind(k: Sql) -> Sql:
    return f"startswith({k}, 'OBJECT')"


def get(x: Sql, ddl: str, path: str = "$") -> Sql:
    return f"try_variant_get({x}, {literal(path)}, {literal(ddl)})"


def key_at(doc: Sql, keys: tuple[str, ...], ddl: str = "variant") -> Sql:
    """What is under a chain of object keys; NULL when any key is absent."""
    here, path = doc, "$"
    for key in keys:
        if "'" not in key:
            path += f"['{key}']"
        elif '"' not in key:
            path += f'["{key}"]'
        else:  # the path syntax cannot quote a key holding both quote marks
            members = get(here, "map<string,variant>", path)
            here, path = f"try_element_at({members}, {literal(key)})", "$"
    return get(here, ddl, path)


def members_at(doc: Sql, parent: tuple[str, ...], names: list[str]) -> Sql:
    """Members of the object under ``parent`` as a struct of variants, from one pass over the object."""
    members = ", ".join(f"`{name.replace('`', '``')}`: variant" for name in names)
    return key_at(doc, parent, f"struct<{members}>")


def spellings(path: str) -> list[tuple[str, ...]]:
    """Every key chain that flattens to ``path``, the fully nested one first.

    ``a.b`` is reached by ``{"a": {"b": ..}}`` and by ``{"a.b": ..}``. When a
    message holds both, the nested spelling wins.
    """
    parts = path.split(".")
    chains = []
    for joins in product((False, True), repeat=len(parts) - 1):
        chain = [parts[0]]
        for joined, part in zip(joins, parts[1:]):
            if joined:
                chain[-1] += "." + part
            else:
                chain.append(part)
        chains.append(tuple(chain))
    return sorted(chains, key=lambda chain: -len(chain))


# A path of up to this many parts is looked up under each of its spellings, of which there
# are at most eight. The number doubles with every part, so longer ones are searched for.
SPELLED_PARTS = 4


def other_spellings(path: str, doc: Sql) -> Sql | None:
    """The leaf under a literal dotted key, or None if the path has no other spelling."""
    if path == "":  # a message that is not an object is itself the value at ""
        return f"CASE WHEN NOT {is_object_kind(kind(doc))} THEN {doc} END"
    if path.count(".") >= SPELLED_PARTS:
        return searched(path, doc)
    found = [key_at(doc, chain) for chain in spellings(path)[1:]]
    leaves = [f"CASE WHEN NOT {is_object_kind(kind(x))} THEN {x} END" for x in found]
    if not leaves:
        return None
    return f"coalesce({', '.join(leaves)})" if len(leaves) > 1 else leaves[0]


# One step of the search: what was reached with something left of the path, and in it the
# members whose key the rest starts with. The rest ends in a dot; it is empty at the end.
SEARCH_STEP = """
flatten(array_compact(transform({reached}, p -> CASE WHEN p.rest = '' THEN array(p) ELSE
  transform(
    filter(map_entries(try_variant_get(p.x, '$', 'map<string,variant>')),
           m -> startswith(p.rest, concat(m.key, '.'))),
    m -> named_struct('steps', p.steps + 1, 'x', m.value,
                      'rest', substring(p.rest, char_length(m.key) + 2))) END)))
"""

SEARCH_END = """
try_element_at(
  array_sort(filter({reached}, p -> p.rest = '' AND NOT startswith(schema_of_variant(p.x), 'OBJECT')),
             (a, b) -> b.steps - a.steps), 1).x
"""


def searched(path: str, doc: Sql) -> Sql:
    """The leaf at a path under any spelling, the most nested one first.

    The expression grows with the length of the path only, not with its spellings.
    """
    reached = f"array(named_struct('steps', 0, 'x', {doc}, 'rest', {literal(path + '.')}))"
    for _ in path.split("."):
        reached = SEARCH_STEP.format(reached=reached)
    return SEARCH_END.format(reached=reached)


# Plain text of a double. 22 decimals hold every digit of a fractional one from 1e-6 on.
DOUBLE_TEXT = """
CASE WHEN abs({d}) < 1e21 AND {d} = rint({d}) THEN string(CAST({d} AS DECIMAL(38, 0)))
     WHEN abs({d}) < 1e21 AND abs({d}) >= 1e-6 THEN rtrim('0', string(CAST({d} AS DECIMAL(38, 22))))
     WHEN abs({d}) < double('infinity')
       THEN replace(replace(replace(string({d}), '.0E', 'E'), 'E', 'e+'), 'e+-', 'e-') END
"""


def number_text(leaf: Leaf) -> Sql:
    """A JSON number as plain text: 12.0 and 1.2e1 are both ``12``.

    An exponent is written only below 1e-6 and from 1e21 on.
    """
    of_double = DOUBLE_TEXT.format(d=leaf.number)
    return f"CASE WHEN {leaf.kind} = 'DOUBLE' THEN {of_double} ELSE {leaf.get('string')} END"


def text_to_int(t: Sql) -> Sql:
    """Whole-number text to bigint; anything else, or out of range, is NULL."""
    return f"CASE WHEN {t} RLIKE {literal(INT_TEXT)} THEN try_cast({t} AS BIGINT) END"


def text_to_double(t: Sql) -> Sql:
    """Decimal text to a double, infinite if too large. Blanks, hex, words are NULL."""
    return f"CASE WHEN {t} RLIKE {literal(NUMBER_TEXT)} THEN try_cast({t} AS DOUBLE) END"


def present(leaf: Leaf) -> Sql:
    """True for any leaf, JSON null included; false for objects and absent keys."""
    return f"{leaf.kind} IS NOT NULL"


def is_null(leaf: Leaf) -> Sql:
    """Whether the leaf is JSON null; NULL when the path is missing."""
    return f"{leaf.kind} = 'VOID'"


def as_string(leaf: Leaf) -> Sql:
    """Text of a scalar leaf; NULL for null, arrays and missing paths."""
    return f"""CASE WHEN {leaf.kind} = 'STRING' THEN {leaf.text}
                    WHEN {is_number_kind(leaf.kind)} THEN {number_text(leaf)}
                    WHEN {leaf.kind} = 'BOOLEAN' THEN {leaf.get("string")} END"""


def as_double(leaf: Leaf) -> Sql:
    """Numbers and numeric text, if finite."""
    return f"CASE WHEN abs({leaf.number}) < double('infinity') THEN {leaf.number} END"


def as_int(leaf: Leaf) -> Sql:
    """Numbers cut toward zero, or whole-number text."""
    return f"""CASE WHEN {leaf.kind} = 'STRING' THEN {text_to_int(leaf.text)}
                    WHEN {is_number_kind(leaf.kind)} THEN {leaf.get("bigint")} END"""


def as_bool(leaf: Leaf) -> Sql:
    """Booleans and the usual words for them."""
    return f"""CASE WHEN {leaf.kind} = 'BOOLEAN' THEN {leaf.get("boolean")}
                    WHEN {leaf.text} IN ({listed(TRUE_TEXT)}) THEN true
                    WHEN {leaf.text} IN ({listed(FALSE_TEXT)}) THEN false END"""


def as_variant(leaf: Leaf) -> Sql:
    return read_as_type(leaf, "variant")


def read_as_type(leaf: Leaf, ddl: str) -> Sql:
    return f"CASE WHEN {leaf.kind} IS NOT NULL THEN {leaf.get(ddl)} END"


READERS = {
    "string": as_string,
    "double": as_double,
    "int": as_int,
    "bool": as_bool,
    "present": present,
    "is_null": is_null,
    "variant": as_variant,
}


def read_as(leaf: Leaf, how: str) -> Sql:
    """A leaf read by a named reader, or as the Spark type ``how`` names (NULL if unfit)."""
    reader = READERS.get(how)
    return reader(leaf) if reader else read_as_type(leaf, how)
