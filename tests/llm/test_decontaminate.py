from __future__ import annotations

import random

import pytest

import jsonflow.llm.queries as q
from jsonflow.llm import decontaminate as d
from tests.llm.conftest import SF

ITEM = "Which of these cities was the seat of the council that met in the year of the great flood, and who led it there?"


def edit_distance(pattern, text):
    """Least edits to any stretch of the text."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        before, row = row, [0]
        for i, x in enumerate(pattern):
            row.append(min(before[i] + (x != c), before[i + 1] + 1, row[i] + 1))
        best = min(best, row[-1])
    return best


@pytest.mark.parametrize("seed", range(30))
def test_myers_matches_dynamic_programming(seed):
    r = random.Random(seed)
    pattern = "".join(r.choice("abc") for _ in range(r.randint(1, 90)))
    text = "".join(r.choice("abc") for _ in range(r.randint(0, 200)))
    distance, end = d.Myers(pattern).best(text)
    assert distance == edit_distance(pattern, text) == edit_distance(pattern, text[:end] if distance < len(pattern) else text)


def test_query_matches_brute_force(llm, tables):
    docs, items = tables("documents"), tables("benchmark")
    got = {(r["doc_id"], r["item_id"]) for r in q.QUERIES["op7_decontaminate"](llm, SF).collect()}
    want = set()
    for item_id, item in items:
        body = d.plain(item).strip()
        for doc_id, text, *_ in docs:
            spaced = d.plain(text)
            # Full distances only where a word of the item is near, to keep this quick.
            if body in spaced or (body[: len(body) // 2] in spaced and edit_distance(body, spaced) <= d.budget(d.plain(item))):
                want.add((doc_id, item_id))
    assert want and want <= got
    texts, bodies = {x[0]: d.plain(x[1]) for x in docs}, {i: d.plain(t) for i, t in items}
    for doc_id, item_id in got:
        assert edit_distance(bodies[item_id].strip(), texts[doc_id]) <= d.budget(bodies[item_id])


@pytest.mark.parametrize("edits", range(12))
def test_every_edit_within_budget_is_found(edits):
    r = random.Random(edits)
    k = d.budget(d.plain(ITEM))
    finder = d.Finder([(7, ITEM)], d.RATE)
    body = list(d.plain(ITEM).strip())
    for _ in range(min(edits, k)):
        at = r.randrange(len(body))
        what = r.randrange(3)
        if what == 0:
            body[at] = r.choice("xyz")
        elif what == 1:
            body.insert(at, r.choice("xyz"))
        else:
            del body[at]
    text = " some words before " + "".join(body) + " some words after "
    ((item_id, distance, start, end),) = finder.find(text)
    assert item_id == 7 and distance <= k and edit_distance(d.plain(ITEM).strip(), text[start:end]) == distance


def test_beyond_the_budget_nothing_is_found():
    finder = d.Finder([(7, ITEM)], d.RATE)
    words = d.plain(ITEM).split()
    assert finder.find(" " + " ".join(words[: len(words) // 2]) + " ") == []


def test_spans_blocks_and_odd_rows(llm, odd_docs, make_docs):
    items = llm.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "..."), (5, "one"), (1, ITEM)], "item_id long, text string")
    docs = make_docs(f"Well: {ITEM.upper()} Yes.", "prone to", "one", None, f"{ITEM} {ITEM}")
    found = sorted((r["doc_id"], r["item_id"], r["distance"], r["first_word"], r["end_word"]) for r in d.matches(docs, items).collect())
    n = len(d.plain(ITEM).split())
    assert found == [(0, 1, 0, 1, 1 + n), (2, 5, 0, 0, 1), (4, 1, 0, 0, n), (4, 1, 0, n, 2 * n)]
    assert [len(b) for b in d.item_blocks(items, block=1)] == [1, 1]
    kept = d.decontaminate(odd_docs, items.filter("item_id <> 5"))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    # Short items are whole words; an id that holds one goes with all of its rows.
    left = d.decontaminate(odd_docs, items).select("doc_id").distinct()
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == [0, 1, 2, 4, 7, 8, 9]


def test_empty_tables(llm, make_docs):
    items = llm.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = make_docs(ITEM)
    assert d.matches(docs.limit(0), items).count() == 0
    assert d.matches(docs, items.limit(0)).count() == 0
    assert d.decontaminate(docs, items.limit(0)).count() == 1


def test_rows_without_an_id_are_judged_by_their_own_text(llm, make_docs):
    items = llm.createDataFrame([(1, ITEM), (2, "one")], "item_id long, text string")
    docs = make_docs((None, ITEM), (None, "clean"), (None, "only one"), (None, None), (4, ITEM), (5, "clean too"))
    left = d.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted((r["text"] or "") for r in left.collect()) == ["", "clean", "clean too"]


def test_two_words_replaced_are_found():
    """An item of 17 words with two of them replaced by others."""
    item = "the quick answer to this question was given by the second speaker at the annual meeting in town"
    copy = item.replace("quick", "short").replace("given", "taken")
    assert [x[0] for x in d.Finder([(7, item)], d.RATE).find(f" before {copy} after ")] == [7]
