from __future__ import annotations

import pytest

import jsonflow.llm.queries as q
from jsonflow.llm import quality_rules as qr
from tests.llm.conftest import ODD_TEXTS, SF
from tests.oracle import compare, connect


def test_query_matches_its_sql(llm):
    assert compare(llm, connect(SF), "op1", q.QUERIES["op1_quality_rules"], q.ORACLES["op1_quality_rules"], SF) is None


def brute_counts(text):
    words = [w for w in _split(text or "") if w]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    lines = [line for line in (text or "").split("\n") if _split(line)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def _split(text):
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]


def test_counts_match_brute_force(odd_docs, make_docs):
    more = make_docs("a b c a b c a b c", "a a a a", "x y\nx y\n \nx y", "## $ a | <b>", "a b c d a b")
    for docs in (odd_docs, more):
        for row in qr.text_counts(docs.filter("doc_id <> 3 AND doc_id <> 5")).collect():
            text = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] == row["doc_id"]}[row["doc_id"]]
            got = tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
            assert got == brute_counts(text)


def test_odd_rows_each_get_a_verdict(odd_docs):
    rows = qr.judge(odd_docs).collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 50)


def test_empty_table(make_docs):
    assert qr.judge(make_docs("x").limit(0)).count() == 0


def test_rules_learn_who_is_right(llm):
    """A rule that flags what two others flag gets a high accuracy, one at odds with them a low one."""
    rows = [("2222", 800), ("0002", 150), ("2220", 40), ("0022", 5)]
    patterns = llm.createDataFrame(rows, "votes string, n long")
    rules = qr.RULES[:4]
    model = qr.learn_rules(patterns, rules)
    right = list(qr.accuracies(model, rules).values())
    assert right[0] > 0.95 and right[1] > 0.95 and right[3] < right[0]
    scored = {r["votes"]: r["p"] for r in patterns.select("votes", qr.posterior(rules, model).alias("p")).collect()}
    assert scored["0002"] < 0.1 < 0.9 < scored["2222"]


def test_junk_goes_and_prose_stays(llm):
    out = q.QUERIES["op1_quality_rules"](llm, "/root/testdata/sf0.01")
    labels = llm.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = out.join(labels, "doc_id").filter("NOT base_failed").groupBy("quality").agg({"*": "count", "votes": "min"}).count()
    assert judged == 2
    right = out.join(labels, "doc_id").filter("NOT base_failed AND kept = (quality = 1)").count()
    total = out.join(labels, "doc_id").filter("NOT base_failed").count()
    assert right / total > 0.95


@pytest.mark.parametrize("threshold", [0.0, 1.1])
def test_threshold(odd_docs, make_docs, threshold):
    long = make_docs(" ".join(f"word{i}" for i in range(200)))
    assert [r["kept"] for r in qr.judge(long, threshold=threshold).collect()] == [threshold == 0.0]


def test_shares_of_junk_and_prose_at_scale(llm):
    """Of labelled documents that pass the base checks over 90 % of the bad ones go and under 1 % of the good ones."""
    sf = "/root/testdata/sf0.1"
    labels = llm.read.parquet(f"{sf}/labels.parquet")
    judged = qr.judge(llm.read.parquet(f"{sf}/documents.parquet")).where("NOT base_failed").join(labels, "doc_id")
    shares = judged.selectExpr("quality", "CAST(NOT kept AS int) AS gone").groupBy("quality").agg({"gone": "avg"})
    gone = {r["quality"]: r["avg(gone)"] for r in shares.collect()}
    assert gone[0] > 0.9 and gone[1] < 0.01


def test_a_common_good_vote_does_not_outweigh_a_bad_one(llm):
    rows = [("22222", 900), ("02222", 60), ("20222", 40)]
    patterns = llm.createDataFrame(rows, "votes string, n long")
    model = qr.learn_rules(patterns)
    scored = {r["votes"]: r["p"] for r in patterns.select("votes", qr.posterior(qr.RULES, model).alias("p")).collect()}
    assert scored["02222"] < 0.5 and scored["20222"] < 0.5 < scored["22222"]


def test_good_votes_count_where_none_is_bad(llm):
    rows = [("21111", 200), ("11111", 700), ("00111", 80), ("20111", 10)]
    patterns = llm.createDataFrame(rows, "votes string, n long")
    model = qr.learn_rules(patterns)
    scored = {r["votes"]: r["p"] for r in patterns.select("votes", qr.posterior(qr.RULES, model).alias("p")).collect()}
    assert scored["00111"] < scored["20111"] < 0.5 < scored["11111"] < scored["21111"]
