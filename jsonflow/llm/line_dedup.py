"""Line deduplication by content-defined chunks of lines.

A hash over the hashes of the last lines closes a chunk wherever it meets a mask, so boundaries
depend on the lines around them alone and come back when lines are put in or left out before them.
Candidates are of two scales: chunks of at least two lines with text, and joints, the two lines with text on both
sides of a boundary. Those that occur again anywhere in the corpus are looked at. A candidate
goes only if its bytes equal those of its first occurrence (least document id, then place), which stays; from there
the repeat is followed line by line, as long as bytes are equal, to the ends of the chunks a joint is between.
Beyond those ends the next joint is a candidate of its own, so repeats go whole. What is missed are
short repeats without a boundary inside, and lines at an end that agree with another occurrence than the first.

Hashes are grouped by a partial aggregation; only candidates travel with their text. Each candidate's
first text is copied to the parts its copies are dealt out into, so no hot chunk meets in one task.

A null text has no lines and stays null; an empty text has one empty line. Rows that repeat an id
are one document: a chunk first seen there stays in all of them, and of rows that have it at the same place
one, of the least text hash, is what copies are compared with. What goes elsewhere goes by id and text.
A row with a null id comes back unchanged and removes nothing. An empty table gives an empty
result. Columns that are neither id nor text are carried along as they are, whatever their names.

With ``pieces=_chunks`` chunks alone are compared, closed after one line in ``EVERY``. With ``pieces=_windows``
every two neighbouring lines with text are compared instead (blank lines
between them included), so that every repeated run of two lines or more goes whole, to its last line.
A line goes if a pair of lines it is in occurs earlier in the corpus as it was given; so of a line
that stands many times in a row one is left. Single repeated lines stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonflow.llm.common import as_row, from_row, stored, texts_of
from jsonflow.llm.hashing import U, mix

WINDOW = 2
# A chunk closes after one line in ``EVERY``, on average.
EVERY = 4
# A joint's boundary closes after this share of lines. The more, the fewer short repeats are missed: of
# those of two lines CLOSE + (1 - CLOSE) * CLOSE ** 2 are found.
CLOSE = 0.8
LEAST_LINES = 2
PART = 1000


def chunk_ends(hashes: np.ndarray, every: int = EVERY, window: int = WINDOW) -> np.ndarray:
    """Where chunks end (exclusive), from the lines' hashes; the last line ends one."""
    n = len(hashes)
    rolled = np.zeros(n, dtype=U)
    for back in range(min(window, n)):
        rolled[back:] += mix(hashes[: n - back], 31 + back)
    close = mix(rolled, 37) % U(every) == 0
    # The first lines have no whole window; where they close does not matter to others.
    close[: window - 1] = False
    close[-1] = True
    return np.flatnonzero(close) + 1


def _chunks(text: str) -> list[tuple[int, int, str, int]]:
    """``first line, lines, text, hash`` of each chunk."""
    import xxhash

    lines = text.split("\n")
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in lines), dtype=U, count=len(lines))
    out, start = [], 0
    for end in chunk_ends(hashes).tolist():
        body = "\n".join(lines[start:end])
        # Signed 64 bits of a hash of the whole chunk.
        out.append((start, end - start, body, xxhash.xxh3_64_intdigest(body) - (1 << 63)))
        start = end
    return out


def _windows(text: str) -> list[tuple[int, int, str, int]]:
    """``first line, lines, text, hash`` from each line with text to the next one; they overlap."""
    import xxhash

    lines = text.split("\n")
    solid = [i for i, x in enumerate(lines) if x.strip()]
    out = []
    for a, b in zip(solid, solid[1:]):
        body = "\n".join(lines[a : b + 1])
        out.append((a, b + 1 - a, body, xxhash.xxh3_64_intdigest(body) - (1 << 63)))
    return out


def _joints(text: str) -> list[tuple[int, int, str, int, int, int]]:
    """Chunks of two lines with text or more, and the two lines with text around each boundary.

    ``first line, lines, text, hash``, and how many lines before and after it belong to the same two chunks.
    """
    import xxhash

    lines = text.split("\n")
    solid = [i for i, x in enumerate(lines) if x.strip()]
    if len(solid) < LEAST_LINES:
        return []
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(lines[i]) for i in solid), dtype=U, count=len(solid))
    # A window of one line: whether a chunk closes inside a repeat is up to the repeat alone.
    close = mix(mix(hashes, 31), 37) < U(int(CLOSE * 2**64))
    cuts = [0, *(k for k in (np.flatnonzero(close) + 1).tolist() if k < len(solid)), len(solid)]
    out = []

    def add(a: int, b: int, before: int, after: int) -> None:
        body = "\n".join(lines[a:b])
        out.append((a, b - a, body, xxhash.xxh3_64_intdigest(body) - (1 << 63), before, after))

    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b - a >= LEAST_LINES:
            add(solid[a], solid[b - 1] + 1, 0, 0)
        if b < len(solid):
            add(solid[b - 1], solid[b] + 1, solid[b - 1] - solid[a], solid[cuts[i + 2] - 1] - solid[b])
    return out


# ``first line, lines, text, hash`` of candidates, none beginning where another does; more may follow: the
# lines before and after a candidate that it may be followed into.
Pieces = Callable[[str], list[tuple]]


def _with_text(body: str) -> int:
    return sum(1 for x in body.split("\n") if x.strip())


def _keys(batches: Iterator[pa.RecordBatch], pieces: Pieces) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for first, lines, body, h, *_ in pieces(text):
                if lines >= LEAST_LINES and _with_text(body) >= LEAST_LINES:
                    out.append((h, doc_id, first))
        cols = list(zip(*out)) if out else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["hash", "doc_id", "line"])


def _bodies(batches: Iterator[pa.RecordBatch], pieces: Pieces) -> Iterator[pa.RecordBatch]:
    """Texts of the pieces asked for (``wanted``: what is known of each) with the lines around them:
    ``skip`` lines come before the piece, which has ``n`` lines."""
    names = ["hash", "doc_id", "line", "mark", "body", "skip", "n", "parts", "lead"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
    for batch in batches:
        out = []
        for doc_id, text, mark, wanted in zip(*(batch.column(i).to_pylist() for i in range(4))):
            # Rows that repeat an id have different pieces, so the hash counts too.
            wanted = {(w["hash"], w["line"]): (w["parts"], w["lead"]) for w in wanted}
            lines = text.split("\n")
            for first, n, body, h, *around in pieces(text):
                if (known := wanted.get((h, first))) is not None:
                    before, after = around or (0, 0)
                    whole = "\n".join(lines[first - before : first + n + after]) if before or after else body
                    out.append((h, doc_id, first, mark, whole, before, n, *known))
        cols = list(zip(*out)) if out else [[]] * 9
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def _reach(here: list[str], there: list[str]) -> int:
    """How many lines agree from the start on, to the last one with text."""
    n = 0
    for i, (x, y) in enumerate(zip(here, there)):
        if x != y:
            break
        if x.strip():
            n = i + 1
    return n


def _same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by hash and part, the first occurrence ahead of its copies: ``doc_id, mark, line, n`` of what
    is to go, ``n`` lines from ``line`` on."""
    here, ahead, core, behind = None, [], [], []
    for batch in batches:
        out = []
        for h, part, doc_id, line, text, lead, mark, skip, n in zip(*(batch.column(i).to_pylist() for i in range(9))):
            if lead and here == (h, part):
                continue
            if not lead and here != (h, part):
                continue
            lines = text.split("\n")
            if lead:
                here, ahead, core, behind = (h, part), lines[:skip][::-1], lines[skip : skip + n], lines[skip + n :]
            elif lines[skip : skip + n] == core:
                before = _reach(lines[:skip][::-1], ahead)
                out.append((doc_id, mark, line - before, n + before + _reach(lines[skip + n :], behind)))
        cols = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "mark", "line", "n"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if text is None:
                out.append((None, 0, 0))
                continue
            lines = text.split("\n")
            cut = {i for g in gone or () for i in range(g["line"], g["line"] + g["n"])}
            left = [x for i, x in enumerate(lines) if i not in cut]
            out.append(("\n".join(left), len(lines), len(cut)))
        cols = list(zip(*out)) if out else [[]] * 3
        cut = [pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cut, batch.column(3)], ["doc_id", "text", "n_lines", "n_removed", "row"])


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pieces: Pieces = _joints) -> DataFrame:
    """``row`` (all other columns of ``docs``), ``doc_id``, ``text`` (what is left of it),
    ``n_lines`` and ``n_removed``; one row per row of ``docs``."""
    keys = stored(texts_of(docs, id_col, text_col).where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(lambda b: _keys(b, pieces), "hash long, doc_id long, line long"))
    firsts = keys.groupBy("hash").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("n")).where("n > 1")
    # The part that each copy is dealt to; a first occurrence goes to all parts of its chunk.
    parts = F.ceil(F.col("n") / PART).cast("int")
    is_first = F.struct("doc_id", "line") == F.col("first")
    asked = keys.join(firsts, "hash").select("hash", "doc_id", "line", parts.alias("parts"), is_first.alias("lead")).distinct()
    # What is known of a candidate goes to its document, so texts travel once, to where they are compared.
    wanted = asked.groupBy(F.col("doc_id").alias("asked_id")).agg(F.collect_list(F.struct("hash", "line", "parts", "lead")).alias("wanted"))

    carried = docs.select(as_row(docs, leave=text_col), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Both sides grow with the corpus: neither is to be broadcast, at any size.
    carried = stored(carried.hint("merge").join(wanted, F.col("doc_id") == F.col("asked_id"), "left").select("row", "doc_id", "text", "wanted"))
    candidates = carried.where("wanted IS NOT NULL")
    # Rows that repeat an id are told apart by their text.
    marked = candidates.where("text IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("mark"), "wanted")
    kind = "hash long, doc_id long, line long, mark long, body string, skip long, n long, parts int, lead boolean"
    found = marked.mapInArrow(lambda b: _bodies(b, pieces), kind)
    number = F.pmod(F.xxhash64("doc_id", "line"), "parts").cast("int")
    to = F.when(F.col("lead"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(number))
    dealt = found.select("hash", F.explode(to).alias("part"), "doc_id", "line", "body", "lead", "mark", "skip", "n")
    dealt = dealt.repartition("hash", "part").sortWithinPartitions("hash", "part", F.desc("lead"), "mark")
    gone = dealt.mapInArrow(_same, "doc_id long, mark long, line long, n long").groupBy(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark"))
    gone = gone.agg(F.collect_set(F.struct("line", "n")).alias("gone"))

    of_row = (F.col("doc_id") == F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_mark"))
    cut = candidates.hint("merge").join(gone, of_row, "left").select("doc_id", "text", "gone", "row")
    clean = carried.where("wanted IS NULL").select("row", "doc_id", "text", *_unchanged())
    kind = f"doc_id long, text string, n_lines long, n_removed long, row {carried.schema['row'].dataType.simpleString()}"
    return cut.mapInArrow(_cut, kind).select("row", "doc_id", "text", "n_lines", "n_removed").union(clean)


def _unchanged() -> list[Column]:
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    return [F.when(F.col("text").isNull(), 0).otherwise(lines).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed")]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, pieces: Pieces = _joints) -> DataFrame:
    """``docs`` with its columns, its text without the pieces that occurred before.

    A document of which nothing but blanks is left, though something went, goes as a whole.
    ``length_col`` is set to the characters of what is left.
    """
    left = removals(docs, id_col, text_col, pieces).where(r"n_removed = 0 OR text RLIKE '[^\\s]'")
    changed = {text_col: F.col("text")} | ({length_col: F.char_length("text").cast("long")} if length_col else {})
    return from_row(left, docs, **changed)
