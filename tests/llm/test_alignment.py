from __future__ import annotations

import hashlib
import json
from collections import Counter

import numpy as np
import pytest

import jsonflow.llm.queries as q
from jsonflow.llm import alignment as al
from tests.llm.conftest import SF

A_PATH, B_PATH = q.tokenizer_path("byte_bpe_50k.json"), q.tokenizer_path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
MORE = ["<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "\x00 nul", "tab\t\ttab", "   lead", "ﬁne ½ 　", "日本語" * 50, "aa aa aa aa " * 40, "é" * 999]


def ends(sizes):
    return np.cumsum(sizes).tolist()


def brute(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel  # noqa: F401  (the vocabulary's kind)

    tok, sp = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
    tok.encode_special_tokens = True
    byte = al._byte_of()
    entries = {i: bytes(byte[c] for c in t) for t, i in json.load(open(A_PATH))["model"]["vocab"].items() if i != 50256}
    aligned = []
    for _, text in rows:
        a = tok.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        a_bytes = [entries[i] for i in a]
        b_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            aligned.append(([], [], [], []))
            continue
        links, groups = [], []
        i = j = at_a = at_b = 0
        here = ([], [])
        while i < len(a):
            # The tokens that start where the earlier of the two ends.
            links.append((a[i], b[j]))
            end_a, end_b = at_a + len(a_bytes[i]), at_b + len(b_bytes[j])
            if end_a <= end_b:
                here[0].append(a[i])
                at_a, i = end_a, i + 1
            if end_b <= end_a:
                here[1].append(b[j])
                at_b, j = end_b, j + 1
            if end_a == end_b:
                groups.append(here)
                here = ([], [])
        aligned.append((a, b, links, groups))
    counts = Counter(p for _, _, links, _ in aligned for p in set(links))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for (doc_id, _), (a, b, links, groups) in zip(rows, aligned):
        told = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        sha = hashlib.sha256(told.encode()).hexdigest() if a else ""
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), sha))
    return sorted(out, key=repr)


def check(docs, **blocks):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = al.align(docs, A_PATH, B_PATH, **blocks).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    return got


def test_query_matches_brute_force(llm, tables):
    rows = [(r[0], r[1]) for r in tables("documents")]
    got = sorted((tuple(r) for r in q.QUERIES["op12_alignment"](llm, SF).collect()), key=repr)
    assert got == brute(rows) and sum(r[4] for r in got) > 10_000


def test_odd_documents(odd_docs, make_docs):
    check(odd_docs)
    got = {r["doc_id"]: r["n_a"] for r in check(make_docs(*MORE))}
    assert got[1] == 0 and got[0] > 0


@pytest.mark.parametrize("size, docs", [(1, 8192), (200, 8192), (1 << 20, 3)])
def test_blocks_of_any_size(make_docs, size, docs):
    texts = ["the cat sat on the mat " * (i % 5 + 1) + MORE[i % len(MORE)] for i in range(60)]
    blocks = al.index(make_docs(*texts), A_PATH, B_PATH, size, docs).select("block").distinct().count()
    assert blocks > 3
    check(make_docs(*texts), block=size, block_docs=docs)


def test_both_encoders_agree(tables):
    from tokenizers import Tokenizer

    encode, _ = al.byte_level(A_PATH)
    assert "Encoding" in repr(encode)
    library = Tokenizer.from_file(A_PATH)
    library.encode_special_tokens = True
    texts = [r[1] for r in tables("documents")] + MORE + [r[2] for r in tables("pages")]
    for text in texts:
        assert encode(text) == library.encode(text, add_special_tokens=False).ids


def test_bitmaps_round_trip():
    """Sparse and dense bitmaps and planes give every document's weight back."""
    rng = np.random.default_rng(5)
    pair, doc = rng.integers(0, 40, 20_000) ** 2, rng.integers(0, 700, 20_000)
    made = al.postings(pair << al.DOC_BITS | doc, 700)
    counts = {p: len(set(doc[pair == p])) for p in set(pair.tolist())}
    first = made.filter(al.pc.equal(made["plane"], 0))
    assert dict(zip(first["pair"].to_pylist(), first["n"].to_pylist())) == counts
    sizes = {len(b) for b in made["bits"].to_pylist()}
    assert 88 in sizes and min(sizes) < 88
    known = made.append_column("docs", al.pa.array([counts[p] for p in made["pair"].to_pylist()]))
    known = known.append_column("best", al.pa.array([p == 0 for p in made["pair"].to_pylist()]))
    best, total = al._weigh(known, 700)
    want = np.zeros(700, dtype=np.int64)
    np.add.at(want, doc, [counts[p] for p in pair.tolist()])
    assert (total == want).all()
    assert (best == np.bincount(doc[pair == 0], minlength=700)).all()


def test_empty_table(make_docs):
    assert al.align(make_docs("x").limit(0), A_PATH, B_PATH).count() == 0
