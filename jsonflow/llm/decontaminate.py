"""Benchmark passages in documents, by pigeonhole edit matching.

Texts are compared as lower-cased words joined by single spaces. An item of n characters may be
off by k = ``RATE`` * n edits. Cut into k + 1 pieces, at least one piece of it must then occur
unchanged in any match: an automaton over the pieces of all items finds such hits in one pass over
each whole text, and Myers' bit-parallel edit distance verifies the stretch around every hit. Nothing is
missed. Items of fewer than ``LEAST`` characters must occur unchanged, as whole words.

Items come to the driver in blocks of at most ``BLOCK`` characters, and each block is a pass over
all documents, so what is sent to tasks is bounded however large the benchmark is. Documents are
never shuffled: a match is found inside the row.

Null or wordless items match nothing; null or wordless texts hold nothing. Rows that repeat an id
are searched as rows of their own; so are rows with a null id, whose matches have a null id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonflow.llm.common import as_row, from_row, stored, texts_of

RATE = 0.085
LEAST = 40
BLOCK = 1_000_000

_WORD = re.compile(r"\w+")


def plain(text: str) -> str:
    """Lower-cased words joined and enclosed by single spaces; empty without words."""
    words = _WORD.findall(text.lower())
    return f" {' '.join(words)} " if words else ""


def budget(item: str, rate: float = RATE) -> int:
    """Edits allowed in an item, as ``plain`` gives it."""
    return int(rate * (len(item) - 2)) if len(item) - 2 >= LEAST else 0


def cut(item: str, parts: int) -> list[tuple[int, str]]:
    """``parts`` pieces of nearly equal length, with their places."""
    edges = [len(item) * k // parts for k in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


class Myers:
    """Edit distance of one pattern to the best stretch of a text that ends at each place."""

    def __init__(self, pattern: str) -> None:
        self.m, self.masks = len(pattern), {}
        for i, c in enumerate(pattern):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """Least distance, and where the first such stretch ends (exclusive)."""
        full, top = (1 << self.m) - 1, 1 << (self.m - 1)
        up, down, score, least, at = full, 0, self.m, self.m, 0
        masks = self.masks
        for j, c in enumerate(text):
            equal = masks.get(c, 0)
            vertical = equal | down
            horizontal = (((equal & up) + up) ^ up) | equal
            plus = down | (full & ~(horizontal | up))
            minus = up & horizontal
            if plus & top:
                score += 1
            elif minus & top:
                score -= 1
                if score < least:
                    least, at = score, j + 1
            plus = (plus << 1) & full
            minus = (minus << 1) & full
            up = minus | (full & ~(vertical | plus))
            down = plus & vertical
        return least, at


class Finder:
    """All items of a block."""

    def __init__(self, items: list[tuple[int, str]], rate: float) -> None:
        import ahocorasick

        self.items, self.automaton = {}, ahocorasick.Automaton()
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (item_id, text) in enumerate(items):
            item = plain(text)
            k = budget(item, rate)
            # The enclosing spaces hold short items to whole words.
            body = item.strip() if k else item
            self.items[n] = (item_id, body, k, Myers(body), Myers(body[::-1]))
            for at, piece in cut(body, k + 1):
                pieces.setdefault(piece, []).append((n, at))
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """``item_id, distance, start, end`` in the plain text, best of each stretch."""
        starts: dict[int, set[int]] = {}
        for last, (size, places) in self.automaton.iter(text):
            for n, at in places:
                starts.setdefault(n, set()).add(last + 1 - size - at)
        out = []
        for n, diagonals in starts.items():
            item_id, item, k, forward, backward = self.items[n]
            ordered = sorted(diagonals)
            low = 0
            for i, d in enumerate(ordered):
                if i + 1 < len(ordered) and ordered[i + 1] - d <= 2 * k:
                    continue
                lo, hi = max(0, ordered[low] - k), d + len(item) + k
                low = i + 1
                exact = text.find(item, lo, hi)
                if exact >= 0:
                    out.append((item_id, 0, exact, exact + len(item)))
                elif k:
                    distance, end = forward.best(text[lo:hi])
                    if distance <= k:
                        _, back = backward.best(text[max(0, lo + end - len(item) - k) : lo + end][::-1])
                        out.append((item_id, distance, lo + end - back, lo + end))
        return out


def _words_between(text: str, start: int, end: int) -> tuple[int, int]:
    """First and last word (exclusive) of a stretch of a plain text."""
    first = text.count(" ", 0, start + (text[start] == " "))
    first = max(0, first - 1)
    last = text.count(" ", 0, max(end - 1, start + 1))
    return first, max(last, first + 1)


def _matches(batches: Iterator[pa.RecordBatch], items: list[tuple[int, str]], rate: float) -> Iterator[pa.RecordBatch]:
    finder = Finder(items, rate)
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            spaced = plain(text) if text else ""
            for item_id, distance, start, end in finder.find(spaced) if spaced else ():
                out.append((doc_id, item_id, distance, *_words_between(spaced, start, end)))
        cols = list(zip(*out)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item_id", "distance", "first_word", "end_word"])


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block: int = BLOCK) -> Iterator[list[tuple[int, str]]]:
    """Items with words, in blocks of at most ``block`` characters (or one longer item)."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    here, size = [], 0
    for row in items.where("text IS NOT NULL").dropDuplicates().toLocalIterator():
        if not plain(row["text"]):
            continue
        if here and size + len(row["text"]) > block:
            yield here
            here, size = [], 0
        here.append((row["id"], row["text"]))
        size += len(row["text"])
    if here:
        yield here


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """``doc_id, item_id, distance, first_word, end_word`` of every stretch of a document that is
    within an item's budget; words are counted from 0 over the text's runs of word characters."""
    schema = "doc_id long, item_id long, distance long, first_word long, end_word long"
    texts, found = texts_of(docs), None
    for block in item_blocks(benchmark):
        one = texts.mapInArrow(lambda b, items=block: _matches(b, items, rate), schema)
        found = one if found is None else found.union(one)
    return found if found is not None else texts.sparkSession.createDataFrame([], schema)


def _clean_rows(batches: Iterator[pa.RecordBatch], items: list[tuple[int, str]], rate: float) -> Iterator[pa.RecordBatch]:
    """The rows (``row, text``) that hold none of the items."""
    finder = Finder(items, rate)
    for batch in batches:
        spaced = (plain(t) if t else "" for t in batch.column(1).to_pylist())
        yield batch.filter(pa.array([not (t and finder.find(t)) for t in spaced], pa.bool_()))


def decontaminate(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item.

    An id that holds one goes with all of its rows; a row with a null id is judged by its own text.
    """
    id_col = docs["doc_id"].cast("long")
    bad = stored(matches(docs.where(id_col.isNotNull()), benchmark, rate).select(F.col("doc_id").alias("_bad_doc_id")).distinct())
    left = docs.where(id_col.isNotNull()).join(bad, id_col == F.col("_bad_doc_id"), "left_anti")
    nameless = docs.where(id_col.isNull()).select(as_row(docs), F.col("text").cast("string").alias("text"))
    kind = f"row {nameless.schema['row'].dataType.simpleString()}, text string"
    for block in item_blocks(benchmark):
        nameless = nameless.mapInArrow(lambda b, items=block: _clean_rows(b, items, rate), kind)
    return left.union(from_row(nameless, docs))
