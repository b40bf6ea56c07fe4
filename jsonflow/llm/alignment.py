"""Two tokenizers aligned on the bytes of every text, with an inverted index of linked token pairs.

Tokenizer A is a byte-level BPE, B a sentencepiece model. Both cut the same bytes, so a token of A and
one of B are linked where their byte ranges overlap, and offsets at which tokens of both end cut a
text into groups.

1. Tasks cut their texts into blocks of bounded size and number the documents of a block. For each
   pair of ids linked in a block they write a compressed bitmap of its documents: their numbers as
   16-bit integers or, where that is shorter, one bit a document. How often a document holds the
   link is kept in bit planes: plane j has the documents whose number of links, less one, has bit j.
2. A pair's document count is the popcount of its bitmaps, OR-merged over blocks. Blocks hold
   different documents, so it is a sum, reduced on the map side.
3. Postings meet the counts of their pair and return to their block, where every bitmap and plane adds
   its weight to its documents' scores.

All shuffles carry postings, not texts; a hot pair sends one row a block and plane. Joins are merge joins
at every size. A document is never
cut, so a block is ``BLOCK`` bytes or one document.

Nulls and edge cases: null and empty texts, and texts that either tokenizer does not give back byte
by byte, have no tokens, zeros and an empty digest. Rows that repeat an id or a text are documents of
their own, and each counts; a null id comes back as null. Pairs whose counts are equal are all best.
An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonflow.llm.common import stored, texts_of

# Characters of text and documents in a block, and characters aligned at a time; bits of a token id in
# a pair and of a document's number.
BLOCK, DOCS, PART = 8 << 20, 1 << 13, 1 << 19
ID_BITS, DOC_BITS = 20, 13
# Fixed value: how a byte-level BPE parts a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_FACTS = ["doc_id", "ordinal", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_POSTING = ["pair", "plane", "n", "bits"]
_TYPES = {"block": pa.int64(), "plane": pa.int32(), "ordinal": pa.int32(), "groups_sha256": pa.string(), "bits": pa.binary()}
_ROW = ["block", *_FACTS, *_POSTING]
_DDL = {"block": "long", "plane": "int", "ordinal": "int", "groups_sha256": "string", "bits": "binary"}


def _schema(names: list[str]) -> str:
    return ", ".join(f"{c} {_DDL.get(c, 'long')}" for c in names)


def _byte_of() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is visible in
    Latin-1, or else the next one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def byte_level(path: str) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """Encoder and bytes of every id of a byte-level BPE in the format of ``tokenizers``.

    Where ids ascend with the merges, the vocabulary itself ranks them, and ``tiktoken`` gives the same ids
    in a quarter of the time.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec["added_tokens"]}
    vocab, byte = spec["model"]["vocab"], _byte_of()
    tokens = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
    for token, i in vocab.items():
        tokens[i] = token.encode() if token in special else bytes(byte[c] for c in token)
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    ranked = merged == sorted(set(merged)) and all(i < merged[0] for t, i in vocab.items() if len(t) == 1)
    parts = spec["pre_tokenizer"] or {}
    if ranked and parts.get("type") == "ByteLevel" and parts.get("use_regex") and not parts.get("add_prefix_space") and not spec["normalizer"]:
        ranks = {tokens[i]: i for t, i in vocab.items() if t not in special}
        return tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, tokens
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return lambda text: library.encode(text, add_special_tokens=False).ids, tokens


def pieces(path: str) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """Encoder and bytes of every id of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    tokens = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
    return model.encode, tokens


class Aligner:
    """Tokens of both kinds for texts, checked to be the same bytes."""

    _made: dict[tuple[str, str], Aligner] = {}

    def __init__(self, a_path: str, b_path: str) -> None:
        self.encode_a, self.a_bytes = byte_level(a_path)
        self.encode_b, self.b_bytes = pieces(b_path)
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes))
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << ID_BITS:
            raise ValueError(f"token ids of more than {ID_BITS} bits")
        # Ids in decimal, one row each, with room for what comes after.
        width = len(str(max(len(self.a_bytes), len(self.b_bytes)))) + 1
        ids = [str(i).encode() for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.digits = np.frombuffer(b"".join(s.ljust(width) for s in ids), dtype=np.uint8).reshape(-1, width)
        self.n_digits = np.array([len(s) for s in ids])

    @classmethod
    def of(cls, *paths: str) -> Aligner:
        """One per worker process."""
        if paths not in cls._made:
            cls._made[paths] = cls(*paths)
        return cls._made[paths]

    def tokens(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both kinds for each text; none where either does not give the bytes back."""
        none = np.empty(0, dtype=np.int64)
        for text in texts:
            if not text:
                yield none, none
                continue
            a, b, want = self.encode_a(" " + text), self.encode_b(text), (" " + text).encode()
            if b"".join(map(self.a_bytes.__getitem__, a)) == want == b"".join(map(self.b_bytes.__getitem__, b)):
                yield np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
            else:
                yield none, none


class Part:
    """The alignment of a few documents laid end to end."""

    def __init__(self, aligner: Aligner, tokens: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.aligner, self.n_docs = aligner, len(tokens)
        self.n_a, self.n_b = (np.array([len(t[side]) for t in tokens], dtype=np.int64) for side in (0, 1))
        a, b = (np.concatenate([t[side] for t in tokens]) for side in (0, 1))
        a_end, b_end = np.cumsum(aligner.a_sizes[a]), np.cumsum(aligner.b_sizes[b])
        size = int(a_end[-1]) if len(a_end) else 0
        in_a, in_b = np.zeros(size + 1, dtype=bool), np.zeros(size + 1, dtype=bool)
        in_a[a_end], in_b[b_end] = True, True
        # Tokens that end at or before each place.
        a_upto, b_upto = np.cumsum(in_a, dtype=np.int32), np.cumsum(in_b, dtype=np.int32)
        both, either = np.flatnonzero(in_a & in_b), np.flatnonzero(in_a | in_b)
        doc_end = np.r_[0, a_end][np.cumsum(self.n_a)]
        # Between two neighbouring ends lies what one token of A and one of B share.
        self.doc = np.searchsorted(doc_end, either)
        self.pair = a[a_upto[either] - in_a[either]] << ID_BITS | b[b_upto[either] - in_b[either]]
        self.n_links = np.bincount(self.doc, minlength=self.n_docs)
        self.n_groups = np.bincount(np.searchsorted(doc_end, both), minlength=self.n_docs)
        self.digests = self._digests(a, b, a_end, b_end, in_a & in_b, both, a_upto, b_upto, doc_end)

    def _digests(self, a, b, a_end, b_end, shared, both, a_upto, b_upto, doc_end) -> list[str]:
        """Of each document's groups as text: A's ids, B's ids, group by group."""
        starts = np.r_[0, both]
        before = np.cumsum(shared, dtype=np.int32)
        place_a = np.arange(len(a)) + b_upto[starts[before[a_end] - shared[a_end]]]
        place_b = np.arange(len(b)) + a_upto[both[before[b_end] - shared[b_end]]]
        ids, after = np.empty(len(a) + len(b), dtype=np.int64), np.empty(len(a) + len(b), dtype=np.uint8)
        ids[place_a], ids[place_b] = a, b
        after[place_a] = np.where(shared[a_end], ord("|"), ord(","))
        after[place_b] = np.where(shared[b_end], ord(";"), ord(","))
        ends = (a_upto + b_upto)[doc_end]
        sizes = self.aligner.n_digits[ids] + 1
        # A document's last group has nothing after it.
        last = ends[(self.n_a > 0)] - 1
        sizes[last] -= 1
        out, lo = [], 0
        for n, hi in zip(self.n_a, ends):
            if not n:
                out.append("")
                continue
            text = hashlib.sha256()
            # A million tokens at a time, so that a long document's text is never whole in memory.
            for p in range(lo, hi, 1 << 20):
                q = min(hi, p + (1 << 20))
                rows = self.aligner.digits[ids[p:q]]
                n_digits = self.aligner.n_digits[ids[p:q]]
                rows[np.arange(q - p), n_digits] = after[p:q]
                text.update(rows[np.arange(rows.shape[1]) < sizes[p:q, None]].tobytes())
            out.append(text.hexdigest())
            lo = hi
        return out


def postings(keys: np.ndarray, n_docs: int) -> pa.Table:
    """``pair, plane, n, bits``: the documents of each pair (plane 0) and its multiplicity planes (from 1 on).

    ``keys`` holds pair and document of every link of a block.
    """
    keys.sort()
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, dtype=np.int64)
    more = np.diff(np.r_[new, len(keys)]) - 1
    keys = keys[new]
    planes = [_bitmaps(keys, 0, n_docs)]
    for j in range(int(more.max(initial=0)).bit_length()):
        planes.append(_bitmaps(keys[(more >> j & 1).astype(bool)], j + 1, n_docs))
    return pa.concat_tables(planes)


def _bitmaps(keys: np.ndarray, plane: int, n_docs: int) -> pa.Table:
    """One compressed bitmap for each pair among sorted keys of pair and document."""
    pairs, docs = keys >> DOC_BITS, (keys & ((1 << DOC_BITS) - 1)).astype("<u2")
    head = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(keys) else np.empty(0, dtype=np.int64)
    n = np.diff(np.r_[head, len(keys)])
    offsets = np.r_[0, np.cumsum(2 * n)].astype(np.int32)
    bits = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(docs.tobytes())])
    whole = -(-n_docs // 8)
    dense = 2 * n > whole
    if dense.any():
        rows = np.zeros((int(dense.sum()), n_docs), dtype=bool)
        rows[np.repeat(np.arange(len(rows)), n[dense]), docs[np.repeat(dense, n)]] = True
        packed = np.packbits(rows, axis=1, bitorder="little")
        bits = pc.replace_with_mask(bits, pa.array(dense), pa.array([r.tobytes() for r in packed], pa.binary()))
    return pa.table({"pair": pairs[head], "plane": pa.array(np.full(len(n), plane), pa.int32()), "n": n, "bits": bits})


def _weigh(table: pa.Table, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document of a block: links whose pair is its A id's best, and the counts of all links."""
    bits, n = table["bits"].combine_chunks(), table["n"].to_numpy()
    plane = table["plane"].to_numpy().astype(np.int64)
    times = np.int64(1) << np.maximum(plane - 1, 0)
    weights = np.stack((times * table["best"].to_numpy().astype(np.int64), times * table["docs"].to_numpy()))
    out = np.zeros((2, n_docs), dtype=np.int64)
    whole = -(-n_docs // 8)
    sparse = 2 * n <= whole
    if sparse.any():
        docs = np.frombuffer(b"".join(bits.filter(pa.array(sparse)).to_pylist()), dtype="<u2")
        for side in (0, 1):
            np.add.at(out[side], docs, np.repeat(weights[side][sparse], n[sparse]))
    dense = np.flatnonzero(~sparse)
    for lo in range(0, len(dense), 512):
        some = dense[lo : lo + 512]
        packed = np.frombuffer(b"".join(bits.take(pa.array(some)).to_pylist()), dtype=np.uint8).reshape(len(some), whole)
        out += weights[:, some] @ np.unpackbits(packed, axis=1, bitorder="little", count=n_docs).astype(np.int64)
    return out[0], out[1]


def _blocks(batches: Iterator[pa.RecordBatch], paths: tuple[str, str], limit: int, most: int) -> Iterator[pa.RecordBatch]:
    """Facts of documents and postings of blocks, in one layout."""
    from pyspark import TaskContext

    aligner, number = Aligner.of(*paths), TaskContext.get().partitionId() << 32
    # Documents whose tokens wait to be aligned, and of the block so far facts and keys of links.
    ids: list = []
    tokens: list = []
    facts: list[pa.Table] = []
    keys: list[np.ndarray] = []
    waiting = size = n_docs = 0

    def align_part() -> None:
        nonlocal waiting, n_docs
        if not ids:
            return
        part = Part(aligner, tokens)
        ordinal = pa.array(range(n_docs, n_docs + len(ids)), pa.int32())
        told = [pa.array(ids, pa.int64()), ordinal, part.n_a, part.n_b, part.n_groups, part.n_links, pa.array(part.digests, pa.string())]
        facts.append(pa.table(told, names=_FACTS))
        keys.append(part.pair << DOC_BITS | (part.doc + n_docs))
        n_docs += len(ids)
        ids.clear()
        tokens.clear()
        waiting = 0

    def written() -> Iterator[pa.RecordBatch]:
        nonlocal size, n_docs, number
        align_part()
        links = np.concatenate(keys)
        keys.clear()
        for part in (pa.concat_tables(facts), postings(links, n_docs)):
            cols = [part[c] if c in part.column_names else pa.nulls(part.num_rows, _TYPES.get(c, pa.int64())) for c in _ROW[1:]]
            whole = pa.table([pa.array(np.full(part.num_rows, number)), *cols], names=_ROW)
            yield from whole.cast(pa.schema([(c, _TYPES.get(c, pa.int64())) for c in _ROW])).to_batches(max_chunksize=50_000)
        facts.clear()
        size, n_docs, number = 0, 0, number + 1

    for batch in batches:
        texts = batch.column(1).to_pylist()
        for doc_id, text, pair in zip(batch.column(0).to_pylist(), texts, aligner.tokens(texts)):
            more = len(text or "")
            if n_docs + len(ids) and (size + more > limit or n_docs + len(ids) == most):
                yield from written()
            elif waiting + more > PART:
                align_part()
            ids.append(doc_id)
            tokens.append(pair)
            size, waiting = size + more, waiting + more
    if n_docs + len(ids):
        yield from written()


def _scores(table: pa.Table) -> pa.Table:
    """One block's documents with the weight its postings return."""
    facts = table.filter(pc.is_valid(table["ordinal"])).sort_by("ordinal")
    best, total = _weigh(table.filter(pc.is_valid(table["pair"])), facts.num_rows)
    return facts.select(_FACTS).drop(["ordinal"]).append_column("n_best", pa.array(best)).append_column("count_sum", pa.array(total))


def index(docs: DataFrame, a_path: str, b_path: str, block: int = BLOCK, block_docs: int = DOCS) -> DataFrame:
    """The written index: rows of documents (``ordinal`` set) and of postings (``pair`` set), by block."""
    most = min(block_docs, 1 << DOC_BITS)
    return stored(texts_of(docs).mapInArrow(lambda b: _blocks(b, (a_path, b_path), block, most), _schema(_ROW)))


def pair_counts(made: DataFrame) -> DataFrame:
    """``pair, docs, best``: in how many documents a pair is linked, and if no pair of its A id is in more."""
    counts = stored(made.where("plane = 0").groupBy("pair").agg(F.sum("n").alias("docs")))
    a = F.shiftright("pair", ID_BITS).alias("a")
    most = counts.groupBy(a).agg(F.max("docs").alias("most"))
    return counts.select("pair", "docs", a).join(most.hint("merge"), "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, **blocks: int) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum``, one row per document."""
    made = index(docs, a_path, b_path, **blocks)
    postings = made.where("pair IS NOT NULL").select("block", *_POSTING).join(pair_counts(made).hint("merge"), "pair")
    facts = made.where("ordinal IS NOT NULL").select("block", *_FACTS)
    dealt = postings.unionByName(facts, allowMissingColumns=True)
    out = [c for c in _FACTS if c != "ordinal"] + ["n_best", "count_sum"]
    return dealt.groupBy("block").applyInArrow(_scores, _schema(out))
