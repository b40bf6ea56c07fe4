from __future__ import annotations

import re
import zlib
from collections import Counter

import jsonflow.llm.queries as q
from jsonflow.llm import spellings as sp
from tests.llm.conftest import SF
from tests.oracle import compare, connect

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, times=10):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWERED)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out = {}
    for w, n in words.items():
        beside = [v for v in words if v != w and near(w, v)]
        best = min(beside, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= times * n else None
        out[w] = [form, w, n, len(beside), words[form] if form else None]
    for row in out.values():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {w: tuple(r) for w, r in out.items()}


def found(docs):
    rows = sp.group_spellings(docs).collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r)[1:] for r in rows}


def test_query_matches_its_sql(llm):
    assert compare(llm, connect(SF), "op11", q.QUERIES["op11_spellings"], q.ORACLES["op11_spellings"], SF) is None


def test_odd_documents(odd_docs):
    assert found(odd_docs) == brute((r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect())


def test_edits_of_every_kind(make_docs):
    """Replacements, deletions and insertions at both ends and inside runs, ties, chains of forms."""
    counts = {
        "letters": 400, "lettera": 400, "leters": 30, "letterss": 30, "lettters": 3, "xletters": 2, "eletters": 2, "etters": 99,
        "letterb": 40, "letterbb": 4, "aaaaaaa": 50, "aaaaaaaa": 5, "aaaaaaaaa": 2, "étudiant": 30, "Étudiant": 3, "etudiant": 3,
        "Letters": 7, "straßen": 2, "strasen": 2, "×÷×÷×÷×": 2,
    }
    docs = make_docs(*[(i, (w + " ") * n) for i, (w, n) in enumerate(counts.items())])
    got = found(docs)
    assert got == brute((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    assert sum(form is not None for form, *_ in got.values()) >= 5
    assert any(got[form][0] for form, *_ in got.values() if form)


def test_groups_span_batches(llm):
    """A batch boundary inside a group changes nothing."""
    words = llm.createDataFrame([(f"{c}anguage", i + 1) for i, c in enumerate("abcdefghij")], "word string, n long")
    rows = sp.rotations(words).sort("prefix", "last").toArrow()
    whole = [r for b in sp._scan(iter(rows.to_batches())) for r in b.to_pylist()]
    for size in (1, 2, 7):
        assert [r for b in sp._scan(iter(rows.to_batches(max_chunksize=size))) for r in b.to_pylist()] == whole
    assert len(whole) == 10 and all(r["n_near"] == 9 for r in whole)


def test_empty_table(make_docs):
    assert sp.group_spellings(make_docs("letters letters").limit(0)).count() == 0
