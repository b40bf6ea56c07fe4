from __future__ import annotations

import jsonflow.llm.queries as q
from jsonflow.llm import line_dedup as ld
from tests.llm.conftest import ODD_TEXTS, SF


def brute(docs):
    """Chunks and joints that came before go, followed into the chunks around a joint."""
    first, out = {}, {}
    for doc_id, text in sorted(docs):
        lines, gone = text.split("\n"), set()
        for at, n, body, _, before, after in ld._joints(text):
            assert body == "\n".join(lines[at : at + n])
            if body not in first:
                first[body] = lines, at, before, after
                continue
            there, start, b, a = first[body]
            low, high = at, at + n
            for k in range(1, min(b, before) + 1):
                if lines[at - k] != there[start - k]:
                    break
                low = at - k if lines[at - k].strip() else low
            for k in range(min(a, after)):
                if lines[at + n + k] != there[start + n + k]:
                    break
                high = at + n + k + 1 if lines[at + n + k].strip() else high
            gone |= set(range(low, high))
        out[doc_id] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def brute_chunks(docs):
    """Chunks of at least two lines with text stay where they come first."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        left, n = [], 0
        for _, lines, body, _ in ld._chunks(text):
            if lines >= ld.LEAST_LINES and ld._with_text(body) >= ld.LEAST_LINES:
                if body in seen:
                    n += lines
                    continue
                seen.add(body)
            left.append(body)
        out[doc_id] = ("\n".join(left), text.count("\n") + 1, n)
    return out


def test_query_matches_brute_force(llm, tables):
    want = brute([(d, t) for d, t, *_ in tables("documents")])
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in q.QUERIES["op4_line_dedup"](llm, SF).collect()}
    assert got == want and any(n for _, _, n in want.values())


def test_chunks_alone_match_brute_force(llm, tables):
    docs = [(d, t) for d, t, *_ in tables("documents")]
    rows = ld.removals(llm.read.parquet(f"{SF}/documents.parquet"), pieces=ld._chunks).collect()
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in rows} == brute_chunks(docs)


def test_recall_against_all_repeated_runs(llm):
    """Nine in ten of the lines in repeated runs of two lines or more go, and no others."""
    sf = "/root/testdata/sf0.1"
    docs = [(r["doc_id"], r["text"]) for r in llm.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = {d: n for d, (_, _, n) in repeated_lines(docs).items()}
    got = {r["doc_id"]: r["n_removed"] for r in q.QUERIES["op4_line_dedup"](llm, sf).select("doc_id", "n_removed").collect()}
    assert all(got[d] <= n for d, n in want.items())
    assert sum(got.values()) >= 0.9 * sum(want.values())


def test_ids_that_repeat_are_told_apart_by_text(make_docs):
    passage = "\n".join(f"passage line {i}" for i in range(12))
    docs = make_docs((1, f"own\n{passage}"), (2, f"a\n{passage}\nend of a"), (2, f"b\n{passage[:40]}"), (2, "a text\nof its own\nand long"))
    got = sorted((r["doc_id"], r["text"]) for r in ld.removals(docs).collect())
    assert got[0] == (1, f"own\n{passage}") and (2, "a\nend of a") in got and (2, "a text\nof its own\nand long") in got


def test_boundaries_come_back_after_shifts():
    lines = [f"line number {i}" for i in range(200)]
    plain = {c[2] for c in ld._chunks("\n".join(lines))}
    shifted = {c[2] for c in ld._chunks("\n".join(["new", "other", *lines]))}
    changed = {c[2] for c in ld._chunks("\n".join([*lines[:100], "new", *lines[100:]]))}
    assert len(plain - shifted) <= 2 and len(plain - changed) <= 2


def test_chunks_make_up_the_text():
    for text in [t for t in ODD_TEXTS if t is not None]:
        assert "\n".join(c[2] for c in ld._chunks(text)) == text


def test_hot_chunk_is_dealt_out(make_docs, monkeypatch):
    monkeypatch.setattr(ld, "PART", 3)
    passage = "\n".join(f"common line {i}" for i in range(30))
    docs = [(i, f"own {i}\n{passage}\nend {i}") for i in range(40)]
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in ld.removals(make_docs(*docs)).collect()}
    assert got == brute(docs) and got[39][2] > 15
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in ld.removals(make_docs(*docs), pieces=ld._chunks).collect()}
    assert got == brute_chunks(docs) and got[39][2] > 15


def test_equal_hashes_of_different_bytes_stay(make_docs):
    """A row whose hash is that of other bytes is no copy."""
    import pyarrow as pa

    rows = [(1, 0, 1, 0, "a\nb", True, 7, 0, 2), (1, 0, 2, 0, "a\nc", False, 8, 0, 2), (1, 0, 3, 0, "a\nb", False, 9, 0, 2)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], "hash part doc_id line body lead mark skip n".split())
    (out,) = ld._same(iter([batch]))
    assert out.column(0).to_pylist() == [3]


def test_odd_rows_keep_their_columns(odd_docs):
    out = ld.dedup_lines(odd_docs, length_col="n_chars")
    assert out.columns == odd_docs.columns and out.schema["text"].dataType.simpleString() == "string"
    rows = out.collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)
    assert [r["text"] for r in rows if r["doc_id"] is None] == ["no id at all"]


def test_a_whole_copy_goes(make_docs):
    text = "some line\nanother line"
    out = ld.dedup_lines(make_docs(text, text, "kept\nas it is"))
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 2]


def test_empty_table(make_docs):
    assert ld.removals(make_docs("x").limit(0)).count() == 0


def repeated_lines(docs):
    """Lines of the runs of two lines with text, or more, that occur earlier, place by place."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        lines = text.split("\n")
        solid = [i for i, x in enumerate(lines) if x.strip()]
        gone = set()
        for a, b in zip(solid, solid[1:]):
            pair = tuple(lines[a : b + 1])
            if pair in seen:
                gone.update(range(a, b + 1))
            seen.add(pair)
        out[doc_id] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def test_every_repeated_run_goes(llm, tables):
    want = repeated_lines([(d, t) for d, t, *_ in tables("documents")])
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in q.QUERIES["op4_line_runs"](llm, SF).collect()}
    assert got == want
    assert sum(n for *_, n in want.values()) > sum(n for *_, n in brute_chunks([(d, t) for d, t, *_ in tables("documents")]).values())


def test_runs_of_any_length_go_whole(make_docs):
    passages = ["\n".join(f"passage {n} line {i}" for i in range(n)) for n in range(1, 9)]
    first = [f"own {n}\n{p}\nend {n}" for n, p in enumerate(passages)]
    again = [f"other {n}\nforeign {n}\n{p}\nrest {n}" for n, p in enumerate(passages)]
    blank = ["x one\n\n \nx two", "new\nx one\n\n \nx two\nmore"]
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in ld.removals(make_docs(*first, *again, *blank), pieces=ld._windows).collect()}
    assert all(got[n] == (t, 0) for n, t in enumerate(first))
    assert got[8] == (again[0], 0)
    assert [got[8 + n] for n in range(1, 8)] == [(f"other {n}\nforeign {n}\nrest {n}", n + 1) for n in range(1, 8)]
    assert got[17] == ("new\nmore", 4)


def test_hot_run_is_dealt_out(make_docs, monkeypatch):
    monkeypatch.setattr(ld, "PART", 3)
    passage = "\n".join(f"common line {i}" for i in range(30))
    docs = [(i, f"own {i}\n{passage}\nend {i}") for i in range(40)]
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in ld.removals(make_docs(*docs), pieces=ld._windows).collect()}
    assert got[0] == (docs[0][1], 0) and all(got[i] == (f"own {i}\nend {i}", 30) for i in range(1, 40))


def test_documents_without_repeated_runs(make_docs):
    docs = make_docs("own\none line\ntwo line\nend", "other\none line\ntwo line\nrest", "one line\ntwo line")
    out = ld.dedup_lines(docs, length_col="n_chars", pieces=ld._windows)
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()} == {0: ("own\none line\ntwo line\nend", 25), 1: ("other\nrest", 10)}


def test_texts_travel_once_to_where_they_are_compared(make_docs):
    """One join of texts, with the lines to go; the candidates' texts are in none."""
    docs = make_docs((1, "a b\nc d\ne f"), (2, "a b\nc d\ng h"))
    plan = ld.removals(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("Python") == 0


def test_an_id_with_two_texts_that_have_other_candidates_at_the_same_line(make_docs):
    docs = make_docs((1, "a b\nc d"), (2, "e f\ng h"), (3, "a b\nc d"), (3, "e f\ng h"), (3, "i j\nk l"))
    left = sorted((r["doc_id"], r["text"], r["n_removed"]) for r in ld.removals(docs).collect())
    assert left == [(1, "a b\nc d", 0), (2, "e f\ng h", 0), (3, "", 2), (3, "", 2), (3, "i j\nk l", 0)]
