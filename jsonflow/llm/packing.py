"""Best-fit packing of tokenised documents into sequences of a fixed length.

Pieces are dealt by hash into groups of about ``GROUP`` pieces, so that a task holds a bounded
number of lengths and the number of groups grows with the corpus. In a group, pieces go from the
longest to the shortest into the open sequence with the least room that still fits them; a segment
tree over the possible remaining capacities finds it in log2(capacity) steps. A group leaves a few
sequences short of full, which is next to nothing against its tens of thousands.

A null text counts as empty and gives one piece, the end mark alone. A null id is packed like any
other; rows that repeat an id are documents of their own. Piece numbers, starts and lengths are
those of each row. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonflow.llm.common import stored, texts_of
from jsonflow.llm.hashing import as_bytes

CAPACITY = 2048
END_ID = 0
GROUP = 100_000
# Words whose ids a task remembers, and bytes of text that are split into words at a time.
REMEMBERED, STRETCH = 800_000, 1 << 20
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


# Signs that may follow a word; the vocabulary's splitting rule keeps them apart from its letters.
_SIGNS = b".,;:!?*$%&#|<>()"


class WordIds:
    """Ids of whole texts, word by word: no token of this vocabulary crosses white space.

    Ids are held as little-endian 32-bit bytes. A word of letters, and signs after it, is looked up
    as letters and signs, as the vocabulary's own splitting rule has it; letters not met yet are encoded many at a time
    and told apart by the tokens that end a word. Any other word is encoded by itself.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._known: dict[bytes, bytes] = {}
        self._cores: dict[str, bytes] = {}

    def _encode_cores(self, cores: list[str]) -> None:
        for at in range(0, len(cores), 1000):
            some = cores[at : at + 1000]
            ids = np.array(self._tokenizer.encode(" ".join(some), add_special_tokens=False).ids, dtype="<u4")
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) != len(some):
                self._cores.update((c, self._alone(c)) for c in some)
                continue
            raw, start = ids.tobytes(), 0
            for core, end in zip(some, (4 * ends).tolist()):
                self._cores[core] = raw[start:end]
                start = end

    def _alone(self, word: str) -> bytes:
        return np.array(self._tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: list[bytes]) -> None:
        known, cores = self._known, self._cores
        if len(known) + len(words) > REMEMBERED:
            known.clear()
        if len(cores) > REMEMBERED:
            cores.clear()
        split, new = [], set()
        for word in words:
            letters = word.rstrip(_SIGNS)
            core = letters.decode()
            low = core.lower()
            # The final sigma depends on its place when put in lower case; some capitals give a mark.
            if core.isalpha() and low.isalpha() and "Σ" not in core:
                core, signs = low, word[len(letters) :].decode()
                split.append((word, core, signs))
                if core not in cores:
                    new.add(core)
                if signs and signs not in cores:
                    cores[signs] = self._alone(signs)
            else:
                known[word] = self._alone(word.decode())
        self._encode_cores(list(new))
        for word, core, signs in split:
            known[word] = cores[core] + cores[signs] if signs else cores[core]

    def learn(self, texts: list[bytes]) -> None:
        """Words of all these texts at once, so that few calls do the encoding."""
        new: set[bytes] = set()
        for text in texts:
            new.update(set(text.split()).difference(self._known))
        if new:
            self._learn(list(new))

    def of(self, text: bytes) -> bytes:
        words = text.split()
        try:
            return b"".join(map(self._known.__getitem__, words))
        except KeyError:
            # The table was emptied since, or these words are new.
            self._learn(list(set(words).difference(self._known)))
        try:
            return b"".join(map(self._known.__getitem__, words))
        except KeyError:
            self._learn(list(set(words)))
            return b"".join(map(self._known.__getitem__, words))


@functools.lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    """One table for all tasks that a worker process runs."""
    return WordIds(path)


def _stretches(text: bytes) -> Iterator[bytes]:
    """The text in parts that end at white space."""
    at = 0
    while len(text) - at > STRETCH:
        cut = re.compile(rb"[ \t\n\r\x0b\f]").search(text, at + STRETCH)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    ids_of, end = _word_ids(path), np.array([end_id], dtype="<u4").tobytes()
    width = 4 * capacity
    for batch in batches:
        out: list[tuple] = []
        texts = as_bytes(batch.column(1))
        ids_of.learn([t for t in texts if len(t) <= STRETCH])
        for doc_id, text in zip(batch.column(0).to_pylist(), texts):
            # Ids of a stretch are cut off as soon as a piece is full.
            rest, piece = b"", 0
            for part in [*_stretches(text), None]:
                rest += end if part is None else ids_of.of(part)
                whole = len(rest) // width if part is not None else -(-len(rest) // width)
                for k in range(whole):
                    ids = rest[k * width : (k + 1) * width]
                    out.append((doc_id, piece, piece * capacity, len(ids) // 4, zlib.crc32(ids), ids if with_ids else None))
                    piece += 1
                rest = rest[whole * width :]
        cols = list(zip(*out)) if out else [[]] * 6
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 6 if with_ids else 5]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(kinds)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every document's ids and an end mark, cut only where longer than ``capacity``.

    ``with_ids`` adds the ids themselves as little-endian 32-bit bytes.
    """
    schema = _PIECE + (", ids binary" if with_ids else "")
    return texts_of(docs).mapInArrow(lambda b: _pieces(b, tokenizer, capacity, end_id, with_ids), schema)


class OpenBins:
    """A segment tree over remaining capacities: how many open bins there are below each node."""

    def __init__(self, capacity: int) -> None:
        self._size = 1 << capacity.bit_length()
        self._count = [0] * (2 * self._size)
        self._bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, bin_id: int) -> None:
        self._bins[room].append(bin_id)
        node = room + self._size
        while node:
            self._count[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The bin with the least room of at least ``length``, taken out, and its room."""
        count, node = self._count, length + self._size
        if not count[node]:
            # Up to the first right-hand neighbour that has a bin, then down its left side.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._size:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self._size
        while node:
            count[node] -= 1
            node >>= 1
        return room, self._bins[room].pop()


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, which must come from the longest to the shortest."""
    tree, bins, offsets, n = OpenBins(capacity), [], [], 0
    for length in lengths:
        found = tree.take(length)
        room, b = found if found else (capacity, n)
        n += found is None
        bins.append(b)
        offsets.append(capacity - room)
        if room > length:
            tree.put(room - length, b)
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    ``pieces`` is read twice, once to count it; pass a stored table.
    """
    groups = -(-max(1, pieces.count()) // group)
    key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("long")
    dealt = pieces.withColumn("_group", key)

    def fit(rows):
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets = best_fit(rows["length"].to_pylist(), capacity)
        first = rows["_group"][0].as_py() << 32
        rows = rows.append_column("sequence_id", pa.array([first + b for b in bins], pa.int64()))
        return rows.append_column("offset", pa.array(offsets, pa.int64())).drop_columns(["_group"])

    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    return dealt.groupBy("_group").applyInArrow(fit, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    return pack(stored(pieces_of(docs, tokenizer, capacity)), capacity)
