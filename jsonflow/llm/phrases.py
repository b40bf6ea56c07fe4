"""Repeated byte strings across documents, by prefix-free parsing.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in a document with a
smaller id. The order of all suffixes of a corpus would tell, but no task can hold it; parsing does
the same piece by piece:

* **Triggers.** A rolling hash over ``MER`` bytes triggers wherever it is the least in a string of
  ``LENGTH`` bytes, so every such string has a trigger, the same one in all of its occurrences. Triggers cut texts into
  overlapping phrases.
* **Dictionary and parse.** A trigger's phrase is all that the strings it stands for cover.
  The dictionary holds each phrase once, with the least document it is in; the parse is the sequence of phrases of a document.
  Where a phrase occurs in an earlier document, every string of it does too, whatever
  the corpus's size, and nothing needs to be sorted.
* **Suffixes of the dictionary.** Only phrases that share a trigger and differ can hold equal strings
  besides, and only if they agree on half of what is left of the trigger or half of what is right of it. Of
  those phrases, once each, the suffixes on that side, cut to ``LENGTH`` bytes, are brought in order, and in
  each run of equal ones all but the least document's are repeats.

The corpus order is never needed beyond ``LENGTH`` bytes, so phrases and suffixes are compared by 128 bits of hash,
and Spark's shuffle and sort by those do the ordering. Repeats within a stretch of a task are settled before the shuffle,
so a passage that a third of all documents hold sends one row a stretch.

A null or empty text has no bytes. Strings are judged on the input and never cross documents. Rows
that repeat an id are one document for comparison, none is smaller than the other. A row with a null
id comes back whole and removes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonflow.llm.common import stored, texts_of
from jsonflow.llm.hashing import Rolling, U, as_bytes

LENGTH, MER = 50, 20
# Bytes hashed at a time, and bytes whose repeats are settled within a task.
BLOCK, STRETCH = 1 << 20, 1 << 24
ROWS = 100_000


def _sliding(a: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over every ``width`` neighbours."""
    out, size = a, 1
    while 2 * size <= width:
        out = op(out[:-size], out[size:])
        size *= 2
    n = len(a) - width + 1
    return op(out[:n], out[width - size : width - size + n])


class Parse:
    """Phrases of texts laid end to end: triggers' places, texts, and hashes of trigger and phrase.

    Every string of ``length`` bytes inside a text has one trigger, the least hash of ``mer`` bytes in it;
    a phrase is what neighbouring strings with the same trigger cover.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, mer: int = MER) -> None:
        self.starts, self.ends, self.length, self.mer = starts, ends, length, mer
        if len(data) < length:
            self.at = self.text = self.first = self.last = np.empty(0, dtype=np.int64)
            self.trigger = self.phrase = np.empty(0, dtype=U)
            return
        self.hashes, self.second = Rolling(data), Rolling(data, 1)
        keys = self.hashes.every(mer)
        # The low bits hold the place, so that of equal hashes the first counts.
        bits = U(int(len(keys)).bit_length())
        placed = keys >> bits << bits | np.arange(len(keys), dtype=U)
        least = (_sliding(placed, length - mer + 1, np.minimum) & ((U(1) << bits) - U(1))).astype(np.int64)
        # Strings that would cross into the next text have none.
        inside = np.zeros(len(least) + 1, dtype=np.int8)
        long = ends - starts >= length
        inside[starts[long]] += 1
        inside[ends[long] - length + 1] -= 1
        least[np.cumsum(inside[:-1]) == 0] = -1
        self.first = np.flatnonzero((np.r_[-1, least[:-1]] != least) & (least >= 0))
        self.last = np.flatnonzero((np.r_[least[1:], -1] != least) & (least >= 0))
        self.at = least[self.first]
        self.text = np.searchsorted(ends, self.at, side="right")
        self.trigger = keys[self.at]
        self.phrase = self.second.of(*self.spans(np.arange(len(self.at))))

    def spans(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the phrases of some triggers start and end."""
        return self.first[pick], self.last[pick] + self.length

    def halves(self, pick: np.ndarray) -> np.ndarray:
        """16 bits of hash of a trigger with half its reach to the left, and to the right."""
        lo, hi = self.spans(pick)
        at, half = self.at[pick], (self.length - self.mer) // 2
        left = self.second.of(np.maximum(lo, at - half), at + self.mer)
        right = self.second.of(at, np.minimum(hi, at + self.mer + half))
        return (left >> U(48) << U(16) | right >> U(48)).astype(np.int64)


def _layouts(texts: list[bytes], block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts laid end to end in blocks: bytes, starts and ends, text numbers, where each part starts
    in its text, and which places of a part are its own. A long text is cut into parts that overlap,
    each trigger belonging to one."""

    def lay(parts):
        sizes = np.array([len(p[1]) for p in parts])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(p[1] for p in parts), dtype=np.uint8)
        number, offset = np.array([p[0] for p in parts]), np.array([p[2] for p in parts])
        return data, ends - sizes, ends, number, offset, np.array([p[3] for p in parts])

    parts, size = [], 0
    halo = 2 * LENGTH
    for n, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        for a in range(0, len(text), block) if len(text) > block else (0,):
            b = a + block if len(text) > block else len(text)
            lo, hi = max(0, a - halo), min(len(text), b + halo)
            if parts and size + hi - lo > block:
                yield lay(parts)
                parts, size = [], 0
            parts.append((n, text[lo:hi], lo, (a - lo, min(b, len(text)) - lo)))
            size += hi - lo
    if parts:
        yield lay(parts)


def _parsed(texts: list[bytes]) -> Iterator[tuple[Parse, np.ndarray, np.ndarray]]:
    """Each block's parse, the triggers that are its own, and their texts' numbers."""
    for data, starts, ends, number, _, own in _layouts(texts):
        p = Parse(data, starts, ends)
        inside = p.at - starts[p.text]
        mine = np.flatnonzero((inside >= own[p.text, 0]) & (inside < own[p.text, 1]))
        yield p, mine, number


_ROW = "k long, c long, doc_id long, known boolean, halves long"
_FOUND = "doc_id long, c long, ask int"


def _settle(k: np.ndarray, c: np.ndarray, doc: np.ndarray, halves: np.ndarray) -> pa.RecordBatch:
    """One row for each key with the least document, and a known repeat for every other document."""
    order = np.lexsort((doc, c, k))
    k, c, doc = k[order], c[order], doc[order]
    new = _changes(k, c)
    keep = new | _changes(doc)
    cols = k.view(np.int64), c.view(np.int64), doc, ~new, halves[order]
    return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in cols], ["k", "c", "doc_id", "known", "halves"])


def _changes(*cols: np.ndarray) -> np.ndarray:
    """Where a sorted column is other than a row before; the first row is."""
    out = np.zeros(len(cols[0]), dtype=bool)
    out[:1] = True
    for c in cols:
        out[1:] |= c[1:] != c[:-1]
    return out


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        texts, ids = as_bytes(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
        for p, mine, number in _parsed(texts):
            held.append((p.trigger[mine], p.phrase[mine], ids[number[p.text[mine]]], p.halves(mine)))
            size += int(p.ends[-1])
            if size >= STRETCH:
                yield _settle(*map(np.concatenate, zip(*held)))
                held, size = [], 0
    if held:
        yield _settle(*map(np.concatenate, zip(*held)))


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Sorted rows in larger batches that never part rows of equal ``k``."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)])
        size += batch.num_rows
        if size < ROWS:
            continue
        cols = [np.concatenate(c) for c in zip(*held)]
        cut = int(np.searchsorted(cols[0], cols[0][-1]))
        held, size = [[c[cut:] for c in cols]], len(cols[0]) - cut
        if cut:
            yield [c[:cut] for c in cols]
    if size:
        yield [np.concatenate(c) for c in zip(*held)]


RIGHT, LEFT = 1, 2


def _sides(k: np.ndarray, halves: np.ndarray) -> np.ndarray:
    """For distinct phrases sorted by trigger: the sides on which another phrase of it agrees."""
    group = np.cumsum(_changes(k)).astype(np.int64) << 16
    out = np.zeros(len(k), dtype=np.int32)
    for side, half in ((LEFT, halves >> 16), (RIGHT, halves & 0xFFFF)):
        _, at, n = np.unique(group | half, return_inverse=True, return_counts=True)
        out |= np.where(n[at] > 1, side, 0).astype(np.int32)
    return out


def _repeats(batches: Iterator[pa.RecordBatch], requests: bool) -> Iterator[pa.RecordBatch]:
    """Rows come by ``k, c, doc_id``. Repeated keys of later documents, with ``ask`` 0; with ``requests``
    also the first document of each phrase that another phrase agrees with, and on which sides."""
    for k, c, doc, known, halves in _whole_groups(batches):
        new = _changes(k, c)
        first = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        ask = np.zeros(len(k), dtype=np.int32)
        if requests:
            ask[new] = _sides(k[new], halves[new])
        repeat = known.astype(bool) | (doc > first)
        pick = repeat | (ask > 0)
        yield pa.RecordBatch.from_arrays([pa.array(doc[pick]), pa.array(c[pick]), pa.array(ask[pick])], ["doc_id", "c", "ask"])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes, cut to ``LENGTH`` bytes, of the phrases asked for, on the sides asked for."""
    held, size = [], 0
    half = (LENGTH - MER) // 2
    for batch in batches:
        texts, ids = as_bytes(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
        sides = {side: [np.array(a or [], dtype=np.int64).view(U) for a in batch.column(i).to_pylist()] for i, side in ((2, RIGHT), (3, LEFT))}
        for p, mine, number in _parsed(texts):
            starts, text = [], []
            for side, sets in sides.items():
                wanted = _wanted(p, mine, number, sets)
                lo, last = p.first[wanted], p.last[wanted]
                # A string that reaches less than half to the left needs more than half to the right.
                middle = p.at[wanted] - half
                lo, last = (np.maximum(lo, middle), last) if side == RIGHT else (lo, np.minimum(last, middle))
                count = np.maximum(last - lo + 1, 0)
                starts.append(np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
                text.append(np.repeat(p.text[wanted], count))
            s, once = np.unique(np.concatenate(starts), return_index=True)
            if not len(s):
                continue
            of = ids[number[np.concatenate(text)[once]]]
            held.append((p.hashes.of(s, s + LENGTH), p.second.of(s, s + LENGTH), of, np.zeros(len(s), dtype=np.int64)))
            size += len(s)
            if size >= 1_000_000:
                yield _settle(*map(np.concatenate, zip(*held)))
                held, size = [], 0
    if held:
        yield _settle(*map(np.concatenate, zip(*held)))


def _wanted(p: Parse, mine: np.ndarray, number: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Triggers whose phrase its own text's set holds."""
    text = p.text[mine]
    cuts = np.searchsorted(text, np.arange(len(number) + 1))
    picked = [mine[a:b][np.isin(p.phrase[mine[a:b]], sets[number[t]])] for t, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a and len(sets[number[t]])]
    return np.concatenate(picked) if picked else np.empty(0, dtype=np.int64)


def covered(text: bytes, phrases: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """Which bytes lie in a repeated phrase or string, given by their hashes."""
    step = np.zeros(len(text) + 1, dtype=np.int32)
    for data, starts, ends, number, offset, own in _layouts([text]):
        p = Parse(data, starts, ends)
        if len(phrases):
            inside = p.at - starts[p.text]
            mine = np.flatnonzero((inside >= own[p.text, 0]) & (inside < own[p.text, 1]))
            lo, hi = p.spans(_wanted(p, mine, number, [phrases]))
            np.add.at(step, lo + int(offset[0]), 1)
            np.add.at(step, hi + int(offset[0]), -1)
        if len(strings):
            s = np.flatnonzero(np.isin(p.second.every(LENGTH), strings))
            np.add.at(step, s + int(offset[0]), 1)
            np.add.at(step, s + int(offset[0]) + LENGTH, -1)
    return np.cumsum(step[:-1]) > 0


def _spans(gone: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.r_[0, gone.astype(np.int8), 0])
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def _removed(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        ids, marks, strings = (batch.column(i).to_pylist() for i in (0, 2, 3))
        for doc_id, text, m, s in zip(ids, as_bytes(batch.column(1)), marks, strings):
            gone = covered(text, np.array(m or [], dtype=np.int64).view(U), np.array(s or [], dtype=np.int64).view(U))
            kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
            spans = _spans(gone)
            out.append((doc_id, len(text), int(gone.sum()), len(spans), hashlib.sha256(kept).hexdigest(), [{"start": a, "end": b} for a, b in spans], kept if with_text else None))
        cols = list(zip(*out)) if out else [[]] * 7
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.int64()] * 4 + [pa.string(), span, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` and, if asked for, ``kept``, the
    remaining bytes; one row per document."""
    texts = texts_of(docs)
    parsed = texts.where("doc_id IS NOT NULL").mapInArrow(_phrases, _ROW)
    parsed = parsed.repartition("k").sortWithinPartitions("k", "c", "doc_id")
    found = stored(parsed.mapInArrow(lambda b: _repeats(b, True), _FOUND))
    by_doc = found.groupBy(F.col("doc_id").alias("id")).agg(
        F.collect_list(F.when(F.col("ask") == 0, F.col("c"))).alias("marks"),
        F.collect_list(F.when(F.col("ask").bitwiseAND(RIGHT) > 0, F.col("c"))).alias("right"),
        F.collect_list(F.when(F.col("ask").bitwiseAND(LEFT) > 0, F.col("c"))).alias("left"),
    )
    # Text is carried on only where something in it may go.
    whole = F.coalesce("text", F.lit("")).cast("binary")
    joined = texts.join(by_doc, F.col("doc_id") == F.col("id"), "left")
    touched = F.col("id").isNotNull()
    joined = stored(
        joined.select(
            "doc_id",
            F.when(touched, whole).alias("text"),
            "marks",
            "right",
            "left",
            F.octet_length(whole).cast("long").alias("n_bytes"),
            F.sha2(whole, 256).alias("sha256"),
            touched.alias("touched"),
            *([whole.alias("kept")] if with_text else []),
        )
    )
    asked = joined.where("touched AND size(right) + size(left) > 0").select("doc_id", "text", "right", "left")
    suffixes = asked.mapInArrow(_suffixes, _ROW).repartition("k").sortWithinPartitions("k", "c", "doc_id")
    more = stored(suffixes.mapInArrow(lambda b: _repeats(b, False), _FOUND))
    strings = more.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list("c").alias("strings"))
    cut = joined.where("touched").join(strings, F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", "marks", "strings")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start long, end long>>, kept binary"
    done = cut.mapInArrow(lambda b: _removed(b, with_text), schema)
    none = F.array().cast("array<struct<start: long, end: long>>")
    zero = F.lit(0).cast("long")
    clean = joined.where("NOT touched").select(
        "doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha256").alias("kept_sha256"), none.alias("spans"),
        (F.col("kept") if with_text else F.lit(None).cast("binary")).alias("kept"),
    )
    out = done.union(clean)
    return out if with_text else out.drop("kept")
