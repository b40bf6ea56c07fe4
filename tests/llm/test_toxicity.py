from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

import jsonflow.llm.queries as q
from jsonflow.llm import toxicity as t
from jsonflow.llm.common import is_held_out
from tests.llm.conftest import ODD_TEXTS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def language():
    import duckdb

    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    (counted,) = t._trigrams(iter([batch]))
    return t.LanguageModel(list(zip(*[c.to_pylist() for c in counted.columns]))).log


def brute_best(word, model):
    """The likeliest reading over all paths of the lattice."""
    paths = [(0.0, "", 0, 0)]
    for i in range(len(word)):
        step = []
        for s, text, a, b in paths:
            for letter, cost in t._options(word, i):
                c = t.CLASS.get(letter, 0)
                step.append((s - cost + float(model[a, b, c]), text + letter, b, c) if letter else (s - cost, text, a, b))
        paths = step
    return max((s + float(model[a, b, 0]), text) for s, text, a, b in paths if text)[1]


@pytest.mark.parametrize("word", ["1d10t", "m0r0n", "sc.u.m", "idiooot", "w0rthl3ss", "5tup1d", "p@thet1c", "c|own"])
def test_viterbi_finds_the_best_path(language, word):
    assert t.readings(word, language, 8)[0] == brute_best(word, language)


@pytest.mark.parametrize(
    "word, meant", [("1d10t", "idiot"), ("m0r0n", "moron"), ("sc.u.m", "scum"), ("idiooooot", "idiot"), ("w0rthl3ss", "worthless"), ("$tupid", "stupid")]
)
def test_disguised_words_are_restored(language, word, meant):
    assert meant in t.restored(word, language)


@pytest.mark.parametrize("word", ["plain", "THE!!", "thnd***", "été,"])
def test_plain_words_stand(language, word):
    assert t.restored(word, language) == [word.lower().strip("!*,")]


def test_trigrams_grow_with_the_corpus(make_docs):
    one = {r["trigram"]: r["n"] for r in t.trigram_counts(make_docs("abc")).collect()}
    two = {r["trigram"]: r["n"] for r in t.trigram_counts(make_docs("abc", "abc")).collect()}
    inner = [k for k in one if k]
    assert inner and all(two[k] == 2 * one[k] for k in inner)


def test_logistic_fit_separates():
    r = np.random.default_rng(0)
    x = r.normal(size=(400, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.1 * r.normal(size=400) > 0).astype(float)
    mean, scale, w = t.fit_logistic(x, y)
    assert (((x - mean) / scale @ w[:-1] + w[-1] > 0) == y).mean() > 0.95


@pytest.fixture(scope="module")
def scored(session):
    return q.QUERIES["op2_toxicity"](session, SF).collect()


def test_held_out_accuracy(llm, scored):
    toxic = {r["doc_id"]: r["toxic"] for r in llm.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r for r in scored if r["held_out"] and r["doc_id"] in toxic]
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in scored)
    assert np.mean([r["predicted"] == toxic[r["doc_id"]] for r in held]) > 0.93
    assert len(scored) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)


def test_disguised_documents_score_as_plain_ones(llm, make_docs):
    docs, labels = (llm.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    model = t.learn(docs, labels)
    prose = "the ones that were here and the other " * 10
    texts = [prose, prose + "idiot moron scum loser", prose + "1d10t m0r0n sc.u.m l0ser", prose + "i d i o t and m o r o n and s c u m and l o s e r"]
    got = {r["doc_id"]: r["score"] for r in model.score(make_docs(*texts)).collect()}
    assert got[0] < 0.5 <= min(got[1], got[2], got[3])
    assert [r["doc_id"] for r in model.keep(make_docs(*texts)).collect()] == [0]


def test_odd_rows(llm, odd_docs):
    labels = llm.createDataFrame([(5, 1), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    rows = t.judge(odd_docs, labels).collect()
    assert len(rows) == len(ODD_TEXTS) + 3 and all(0 <= r["score"] <= 1 for r in rows)
    kept = t.learn(odd_docs, labels).keep(odd_docs, threshold=1.1)
    assert kept.columns == odd_docs.columns and kept.count() == len(rows)


def test_without_labels_or_rows(llm, odd_docs):
    none = llm.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in t.judge(odd_docs, none).collect()} == {0.5}
    assert t.judge(odd_docs.limit(0), none).count() == 0


LONG = ["s...t...u...p...i...d...i...o...t", "st" + "u" * 40 + "p1d", "y0uareast" + "-" * 30 + "up1d"]


@pytest.mark.parametrize("word, meant", list(zip(LONG, ["stupidiot", "stupid", "youareastupid"])))
def test_long_disguises_are_restored(language, word, meant):
    assert meant in t.restored(word, language)


def test_long_words_cost_no_more_a_letter(language):
    import time

    took = []
    for n in (200, 20_000):
        start = time.perf_counter()
        (best, *_) = t.readings("m0r0nic" * n, language)
        took.append((time.perf_counter() - start) / n)
        assert best == "moronic" * n
    assert took[1] < 5 * took[0]


def test_runs_of_single_characters_are_split_into_words(language):
    run = "y 0 u a r e t h e w 0 r t h l e s s m 0 r o n o f t h e h o u s e"
    (joined,) = t.held_apart(run)
    assert len(joined) > 20 and t.phrase(joined, language)[0] == joined
    assert {"are", "the", "m0ron", "of"} <= set(t.phrase(joined, language))
    assert any("worthless" in w for w in t.restored(joined, language))


def test_long_disguises_score_as_plain_ones(llm, make_docs):
    docs, labels = (llm.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    model = t.learn(docs, labels)
    prose = "the ones that were here and the other " * 10
    long = " ".join("...".join(w) + "..." * 10 + "1" for w in ("idiot", "moron", "scum", "loser"))
    apart = " ".join("1d10tandm0ronandscumandloserandidiot")
    texts = [prose, f"{prose} {long}", f"{prose} {apart}"]
    got = {r["doc_id"]: r["score"] for r in model.score(make_docs(*texts)).collect()}
    assert got[0] < 0.5 <= min(got[1], got[2]), got


ODD_SIGNS = [
    ("“stupid”", "stupid"), ("stupid…", "stupid"), ("stupid—he", "stupid"), ("he…stupid", "stupid"), ("s#t#u#p#i#d", "stupid"),
    ("s—t—u—p—i—d", "stupid"), ("&stup1d%or", "stupid"), ("café", "café"), ("s̶t̶u̶p̶i̶d̶", "stupid"),
    ("stu​pid", "stupid"), ("ид-иот", "идиот"), ("白痴，真", "白痴"), ("«идиот»", "идиот"),
    ("głupi3c", "głupiec"), ("मूर्ख", "मूर्ख"), ("f#ck", "fck"), ("wé#", "wé"),
]


@pytest.mark.parametrize("word, meant", ODD_SIGNS)
def test_words_with_any_sign_are_read(language, word, meant):
    assert meant in t.restored(word, language)


def test_signs_do_not_hide_words(llm, make_docs):
    docs, labels = (llm.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    model = t.learn(docs, labels)
    prose = "the ones that were here and the other " * 10
    words = ("idiot", "moron", "scum", "loser")
    texts = [prose, *(prose + " ".join(f.format(w) for w in words) for f in ("“{}”", "{}…", "he—{}", "&{}#1"))]
    got = {r["doc_id"]: r["score"] for r in model.score(make_docs(*texts)).collect()}
    assert got[0] < 0.5 <= min(got[i] for i in range(1, 5)), got
