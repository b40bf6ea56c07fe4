from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import jsonflow.llm.queries as q
from jsonflow.llm import packing as p
from tests.llm.conftest import ODD_TEXTS, SF

PATH = q.tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def expected(tokenizer, docs, capacity):
    out = []
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            out.append((doc_id, k // capacity, k, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    return sorted(out, key=str)


def checked(rows, capacity):
    """Pieces, after a look at their places: gapless from 0, none beyond the capacity."""
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str), len(bins)


def test_query(llm, tables, tokenizer):
    rows = q.QUERIES["op8_packing"](llm, SF).collect()
    pieces, bins = checked(rows, 2048)
    assert pieces == expected(tokenizer, [(d, t) for d, t, *_ in tables("documents")], 2048)
    assert bins <= 1.01 * sum(x[3] for x in pieces) / 2048 + 1


def test_odd_rows_and_small_sequences(odd_docs, tokenizer):
    rows = p.pack_documents(odd_docs, PATH, capacity=7).collect()
    pieces, _ = checked(rows, 7)
    docs = [*enumerate(ODD_TEXTS), (3, "one"), (5, "another text under an id that is taken"), (None, "no id at all")]
    assert pieces == expected(tokenizer, docs, 7)


def test_ids_and_empty_table(make_docs, tokenizer):
    (row,) = p.pieces_of(make_docs("some words"), PATH, with_ids=True).collect()
    assert np.frombuffer(row["ids"], dtype="<u4").tolist() == [*tokenizer.encode("some words", add_special_tokens=False).ids, 0]
    assert p.pack_documents(make_docs("x").limit(0), PATH).count() == 0


def test_word_ids_are_those_of_whole_texts(tokenizer):
    ids, r = p.WordIds(PATH), random.Random(3)
    signs = "aAbBzZéÉßİΣσς'’.,!?;:*$%&#|<>()0123½²Ⅷ_-–́   \x1c\x85\t\n\r\x0b\x0c 日本語ǅﬁ\U0001f600"
    for _ in range(4000):
        text = "".join(r.choice(signs) for _ in range(r.randint(0, 25))) + r.choice(["", "", "it's WE'LL", "<|endoftext|>"])
        assert np.frombuffer(ids.of(text.encode()), dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_tables_may_be_emptied(tokenizer, monkeypatch):
    monkeypatch.setattr(p, "REMEMBERED", 3)
    ids = p.WordIds(PATH)
    for text in ("one two three four five", "six, seven. eight! one", "nine ten one"):
        ids.learn([text.encode()])
        assert np.frombuffer(ids.of(text.encode()), dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_long_texts_are_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(p, "STRETCH", 10)
    for text in (b"aaaa bbbb cccc dddd eeee", b"x" * 50, b"x" * 20 + b" y", b""):
        parts = list(p._stretches(text))
        assert b"".join(parts) == text and b" ".join(parts).split() == text.split()


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_matches_a_plain_search(seed):
    r = random.Random(seed)
    capacity = r.choice([1, 5, 16, 100])
    lengths = sorted((r.randint(1, capacity) for _ in range(300)), reverse=True)
    bins, offsets = p.best_fit(lengths, capacity)
    used = defaultdict(int)
    for length, b, offset in zip(lengths, bins, offsets):
        rooms = [capacity - u for u in used.values() if capacity - u >= length]
        room = capacity - used[b] if b in used else None
        assert offset == used[b] and (room == min(rooms) if rooms else room is None)
        used[b] += length
    assert max(used.values()) <= capacity


def test_groups_grow_with_the_pieces(llm):
    rows = [(i, 0, 0, 1 + i % 9, i) for i in range(1000)]
    pieces = llm.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = p.pack(pieces, capacity=10, group=100).collect()
    _, bins = checked(got, 10)
    assert len({r["sequence_id"] >> 32 for r in got}) == 10
    assert bins <= sum(x[3] for x in rows) / 10 * 1.05 + 10
