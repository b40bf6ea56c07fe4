from __future__ import annotations

import random
import re

import numpy as np
import pytest

import jsonflow.llm.queries as q
from jsonflow.llm import minhash as mh
from jsonflow.llm.components import components
from jsonflow.llm.hashing import U, shingle_set
from tests.llm.conftest import ODD_TEXTS, SF


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(docs, percent):
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and label[i] != label[j] and 100 * len(a & b) >= percent * len(a | b):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    least = {}
    for (d, _), x in zip(docs, label):
        least[x] = min(least.get(x, d), d)
    return sorted((d, len(s), least[x], least[x] == d) for (d, _), s, x in zip(docs, sets, label))


def found(docs, percent):
    return sorted(tuple(r) for r in mh.near_duplicates(docs, percent).collect())


@pytest.mark.parametrize("percent", [80, 85])
def test_query_matches_brute_force(llm, tables, percent):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    want = brute([(d, t) for d, t, *_ in tables("documents")], percent)
    assert found(docs, percent) == want and any(not r[3] for r in want)
    if percent == 85:
        assert sorted(tuple(r) for r in q.QUERIES["op10_minhash"](llm, SF).collect()) == want


def family(r, words, n, edits):
    """Near copies of one text, each with its own edits, so that many pairs are close to the threshold."""
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(r.randint(0, edits)):
            copy[r.randrange(len(copy))] = f"e{r.randrange(10**6)}"
        yield " ".join(copy)


def test_border_families_in_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(mh, "BLOCK", 7)
    monkeypatch.setattr(mh, "PART", 5)
    r = random.Random(4)
    texts = [t for _ in range(3) for t in family(r, 150, 25, 5)]
    r.shuffle(texts)
    docs = [(10 * i, t) for i, t in enumerate(texts)]
    assert found(make_docs(*docs), 85) == brute(docs, 85)


def test_odd_rows(odd_docs, make_docs):
    rows = mh.near_duplicates(odd_docs).collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)]
    plain = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    assert found(make_docs(*plain), 85) == brute(plain, 85)
    kept = mh.drop_copies(make_docs(*plain))
    assert kept.columns == odd_docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10]


def test_empty_table(make_docs):
    assert mh.near_duplicates(make_docs("x").limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 60, 100, 1000])
def test_sketches_fill_and_estimate(n):
    r = np.random.default_rng(n)
    errors = []
    for _ in range(60):
        pool = r.integers(0, 2**63, size=2 * n, dtype=np.uint64).astype(U)
        share = int(r.integers(0, n + 1))
        a, b = np.unique(pool[:n]), np.unique(np.r_[pool[:share], pool[n : 2 * n - share]])
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = mh.sketch(a), mh.sketch(b)
        assert len(x) == mh.COORDS and (x == mh.sketch(a[::-1].copy())).all()
        errors.append((x == y).mean() - exact)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_sketch_keeps_the_first_to_reach_each_bin():
    """Coordinate by coordinate against the definition."""
    elements = np.array([3, 99, 12345, 2**60], dtype=U)
    want = [None] * mh.COORDS
    for rnd in range(2 * mh.COORDS):
        for e in elements:
            step = np.array([e + U(rnd * 0x9E3779B97F4A7C15 % 2**64)], dtype=U)
            h = int(mh.mix(step, 11)[0])
            b = (h >> 32) * mh.COORDS >> 32 if rnd < mh.COORDS else rnd - mh.COORDS
            value = rnd << 32 | h & 0xFFFFFFFF
            want[b] = value if want[b] is None else min(want[b], value)
    assert mh.sketch(elements).tolist() == want


def test_shingle_sets_are_those_of_the_words():
    for text in [t or "" for t in ODD_TEXTS] + ["A b C d E f a B c D e F", "a b\tc\nd\x0be\x0cf\rg", "É é É é É é"]:
        assert len(shingle_set(text.encode())) == len(shingles(text))
    assert (shingle_set(b"A b c d e") == shingle_set(b" a\tB c d e ")).all()
    assert (shingle_set("É b c d e".encode()) != shingle_set("é b c d e".encode())).all()


def test_components(llm):
    chain = [(i + 1, i) for i in range(40)] + [(100, 200), (200, 150), (7, 7)]
    edges = llm.createDataFrame(chain, "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 150: 100, 200: 100}


A = "alpha " + " ".join(f"a{i}" for i in range(60))
B = "beta " + " ".join(f"b{i}" for i in range(60))


def test_repeated_ids_keep_the_links_of_each_text(make_docs):
    """Two texts under one id: a near copy of either finds it."""
    rows = mh.near_duplicates(make_docs((1, A), (1, B), (2, B + " more"), (3, A + " more"), (4, "something else")), 85).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in rows) == [
        (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True),
    ]


def test_copies_go_by_id_and_text(make_docs):
    def left(*pairs):
        return sorted((r["doc_id"], r["text"]) for r in mh.drop_copies(make_docs(*pairs)).collect())

    assert left((1, A), (5, A), (5, B)) == [(1, A), (5, B)]
    assert left((1, A), (1, B), (2, B + " more")) == [(1, A), (1, B)]
    # Equal rows are one document, and texts without words are nobody's copies.
    assert left((1, A), (1, A), (1, A), (2, B), (3, ""), (3, "")) == [(1, A), (2, B), (3, ""), (3, "")]
