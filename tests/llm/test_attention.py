from __future__ import annotations

import numpy as np
import pytest

import jsonflow.llm.queries as q
from jsonflow.llm import attention as at
from tests.llm.conftest import ODD_TEXTS

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(llm):
    rows = q.QUERIES["op5_attention"](llm, SF).collect()
    good = {r["doc_id"]: r["quality"] for r in llm.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in good]
    assert np.mean([r["predicted"] == good[r["doc_id"]] for r in held]) > 0.95
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_gradients_match_differences():
    r = np.random.default_rng(1)
    x, counts, y = r.normal(size=(9, at.WIDTH)), np.array([4, 1, 4]), np.array([1.0, 0.0, 1.0])
    net = at.Network(np.zeros(at.WIDTH), np.ones(at.WIDTH))

    def loss():
        p = net.score(x, counts)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = net.gradients(x, counts, y)
    for i, g in enumerate(grads):
        flat = net.p[i].reshape(-1)
        for k in r.choice(flat.size, min(4, flat.size), replace=False):
            old = flat[k]
            flat[k] = old + 1e-5
            up = loss()
            flat[k] = old - 1e-5
            down = loss()
            flat[k] = old
            assert g.reshape(-1)[k] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_attention_adds_up_and_finds_the_odd_passage():
    bad = ("### $$$ &&& %%% " * 16).encode()
    good = ("plain words of a sentence that goes on and on " * 40).encode()
    r = np.random.default_rng(0)
    texts, y = [], []
    for i in range(80):
        y.append(float(i % 2))
        texts.append(good if i % 2 else good + bad)
        if r.random() < 0.5:
            texts[-1] = b"Short start. " + texts[-1]
    x, counts = at.passages(texts)
    net = at.fit(np.split(x, np.cumsum(counts)[:-1]), np.array(y))
    attention = net.forward(x, counts)[5]
    begins = np.r_[0, np.cumsum(counts)[:-1]]
    assert np.allclose(np.add.reduceat(attention, begins), 1)
    assert ((net.score(x, counts) > 0.5) == (np.array(y) == 1)).all()


def test_passages_cover_the_text_and_stand_alone():
    texts = [(t or "").encode() for t in ODD_TEXTS]
    together, counts = at.passages(texts)
    assert counts.tolist() == [max(1, -(-len(t.split()) // at.PASSAGE)) for t in texts]
    begin = 0
    for t, n in zip(texts, counts):
        alone, m = at.passages([t])
        assert m.tolist() == [n]
        assert (alone == together[begin : begin + n]).all()
        begin += n


def test_scores_do_not_depend_on_the_rows_beside():
    net = at.Network(np.zeros(at.WIDTH), np.ones(at.WIDTH))
    texts = [(t or "").encode() for t in ODD_TEXTS]
    alone = [net.score(*at.passages([t]))[0] for t in texts]
    assert net.score(*at.passages(texts)).tolist() == alone
    assert net.score(*at.passages(texts[::-1])).tolist() == alone[::-1]
    assert net.score(*at.passages(texts[3:4] * 50)).tolist() == alone[3:4] * 50


def slow_score(net, text):
    """A text's score passage by passage and byte by byte."""
    data = text + b"\n"
    spans, at_ = [], None
    for i, c in enumerate(data):
        if not at.BLANK[c] and at_ is None:
            at_ = i
        elif at.BLANK[c] and at_ is not None:
            spans.append((at_, i))
            at_ = None
    groups = [spans[k : k + at.PASSAGE] for k in range(0, len(spans), at.PASSAGE)] or [[]]
    begins = [0, *(g[0][0] for g in groups[1:]), len(data)]
    rows = []
    for g, lo, hi in zip(groups, begins, begins[1:]):
        kinds, pairs = np.zeros(at.KINDS), np.zeros(at.PAIRS)
        for i in range(lo, hi):
            kinds[at._KIND[data[i]]] += 1
            if i + 1 < len(data):
                pairs[((data[i] * 31 + data[i + 1]) * 2654435761 >> 7) % at.PAIRS] += 1
        words = [data[a:b] for a, b in g]
        n = max(len(words), 1)
        again = sum(a == b for a, b in zip(words, words[1:]))
        extra = [sum(map(len, words)) / n, len(set(words)) / n, again / n, np.log1p(len(words))]
        rows.append(np.r_[np.sqrt(kinds / (hi - lo)), np.sqrt(pairs / (hi - lo)), extra])
    e, be, v, u, w, c, b = net.p
    hidden = [np.tanh((x - net.mean) / net.scale @ e + be) for x in rows]
    weight = np.array([np.exp((np.tanh(h @ v) / (1 + np.exp(-(h @ u)))) @ w) for h in hidden])
    z = sum(a * h for a, h in zip(weight / weight.sum(), hidden))
    return 1 / (1 + np.exp(-(z @ c + b[0])))


def test_scores_match_a_plain_scorer(tables):
    net = at.Network(np.full(at.WIDTH, 0.1), np.full(at.WIDTH, 0.7), seed=5)
    texts = [(t or "").encode() for t in ODD_TEXTS] + [(t or "").encode() for _, t, *_ in tables("documents")[:30]]
    assert net.score(*at.passages(texts)) == pytest.approx([slow_score(net, t) for t in texts], abs=1e-5)


def test_the_sample_is_of_whole_documents(llm):
    rows = [(i, i % 2, bytes(2 * n), n) for i, n in enumerate([5, 3, 4, 900, 2, 6])]
    bags = llm.createDataFrame([*rows, rows[0]], "doc_id long, label int, bag binary, n long")
    everything = {r["doc_id"] for r in at._sample(bags, 1000, 100).collect()}
    some = at._sample(bags, 12, 100).collect()
    assert everything == {0, 1, 2, 4, 5} and 0 < sum(r["n"] for r in some) <= 12
    assert {r["doc_id"] for r in some} < everything


def test_odd_rows_and_no_labels(llm, odd_docs):
    labels = llm.createDataFrame([(5, 1), (6, 0), (None, 1), (7, None)], "doc_id long, quality int")
    rows = at.judge(odd_docs, labels).collect()
    assert len(rows) == len(ODD_TEXTS) + 3 and all(0 <= r["score"] <= 1 for r in rows)
    none = labels.limit(0)
    assert {r["score"] for r in at.judge(odd_docs, none).collect()} == {0.5}
    assert at.judge(odd_docs.limit(0), none).count() == 0
