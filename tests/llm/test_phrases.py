from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

import jsonflow.llm.queries as q
from jsonflow.llm import phrases as ph
from tests.llm.conftest import ODD_TEXTS, SF


def brute(docs, length=ph.LENGTH):
    first = {}
    rows = sorted(((d, (t or "").encode()) for d, t in docs if d is not None), key=lambda x: x[0])
    for d, b in rows:
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], d)
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        if d is not None:
            for i in range(len(b) - length + 1):
                if first[b[i : i + length]] < d:
                    gone[i : i + length] = True
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(docs):
    rows = ph.remove_repeats(docs).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows), key=str)


def test_query_matches_brute_force(llm, tables):
    want = brute([(d, t) for d, t, *_ in tables("documents")])
    got = sorted((tuple(r) for r in q.QUERIES["op9_phrases"](llm, SF).collect()), key=str)
    assert got == want and any(r[2] for r in want)


def test_odd_rows(odd_docs):
    docs = [*enumerate(ODD_TEXTS), (3, "one"), (5, "another text under an id that is taken"), (None, "no id at all")]
    assert found(odd_docs) == brute(docs)


@pytest.mark.parametrize("seed", range(4))
def test_random_documents(make_docs, seed):
    """Texts over few letters, with copies, edits, runs and strings just below and at the length."""
    r = random.Random(seed)
    letters = ["ab", "abcdefgh ", "é日a "][seed % 3]
    passage = ["".join(r.choice(letters) for _ in range(n)) for n in (49, 50, 51, 120, 400)]
    docs = []
    for i in range(40):
        text = "".join(r.choice([r.choice(passage), "a" * r.randint(0, 90), "".join(r.choice(letters) for _ in range(r.randint(0, 80)))]) for _ in range(r.randint(0, 5)))
        if text and r.random() < 0.5:
            at = r.randrange(len(text))
            text = text[:at] + r.choice("xyz") + text[at + r.randint(0, 1) :]
        docs.append((r.choice([i, 100 + i]), text))
    assert found(make_docs(*docs)) == brute(docs)


def test_long_texts_are_parsed_in_overlapping_blocks(make_docs, monkeypatch):
    r = random.Random(9)
    long = "".join(r.choice("abcdef ") for _ in range(3000))
    docs = [(1, long), (2, long[500:1700] + "zzz" + long[1700:2900]), (3, "q" + long)]
    monkeypatch.setattr(ph, "BLOCK", 700)
    texts = [t.encode() for _, t in docs]
    triggers = {(n, p.trigger[i], p.phrase[i]) for p, mine, number in _parsed(texts, 700) for i in mine for n in [number[p.text[i]]]}
    whole = {(n, p.trigger[i], p.phrase[i]) for p, mine, number in _parsed(texts, 1 << 20) for i in mine for n in [number[p.text[i]]]}
    assert triggers == whole
    for text in texts:
        spans = {(a, b) for a, b in [(0, len(text))]}
        phrases = np.concatenate([p.phrase[mine] for p, mine, _ in _parsed([text], 1 << 20)])
        assert spans == set(ph._spans(ph.covered(text, phrases, np.empty(0, dtype=ph.U))))


def _parsed(texts, block):
    for data, starts, ends, number, _, own in ph._layouts(texts, block):
        p = ph.Parse(data, starts, ends)
        inside = p.at - starts[p.text]
        yield p, np.flatnonzero((inside >= own[p.text, 0]) & (inside < own[p.text, 1])), number


def test_every_string_has_one_trigger():
    r = random.Random(1)
    texts = ["".join(r.choice("ab ") for _ in range(n)).encode() for n in (0, 49, 50, 300, 51)]
    for p, _, _ in _parsed(texts, 1 << 20):
        covers = np.zeros(int(p.ends[-1]), dtype=int)
        for a, b in zip(p.first, p.last):
            covers[a : b + 1] += 1
        valid = [s for lo, hi in zip(p.starts, p.ends) for s in range(lo, hi - ph.LENGTH + 1)]
        assert covers[valid].tolist() == [1] * len(valid) and covers.sum() == len(valid)


def test_text_and_empty_table(make_docs):
    passage = "this passage stands in both documents and is longer than fifty bytes"
    docs = make_docs(f"start {passage}", f"other {passage} end")
    got = {r["doc_id"]: (bytes(r["kept"]), [tuple(s) for s in r["spans"]]) for r in ph.remove_repeats(docs, with_text=True).collect()}
    assert got == {0: (f"start {passage}".encode(), []), 1: (b"other end", [(5, 6 + len(passage))])} or got[1][0] in (b"other end", b"othe end")
    assert ph.remove_repeats(docs.limit(0)).count() == 0
