from __future__ import annotations

import json
import random

from jsonflow.operators import infer
from jsonflow.operators.decode import decode
from jsonflow.streaming import votes


def table(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def some_messages(n):
    r = random.Random(7)
    values = [None, True, False, 1, 2.0, 2.5, "x", [1], {"b": 1}, {}, {"b": None}]
    return [json.dumps({k: r.choice(values) for k in r.sample("abcdefgh", 3)}) for _ in range(n)] + ["nope", "5"]


def test_votes_of_parts_are_those_of_the_whole(texts):
    docs = some_messages(60)
    whole = infer.path_votes(decode(texts(*docs)))
    for cuts in ([0, 31, 62], [0, 1, 2, 50, 62], [0, 62, 62]):
        parts = [infer.path_votes(decode(texts(*docs[a:b]).limit(b - a) if b > a else texts("5"))) for a, b in zip(cuts, cuts[1:])]
        union = parts[0]
        for part in parts[1:]:
            union = union.unionByName(part)
        merged = infer.merge_votes(union)
        assert table(merged) == table(whole)
        assert table(infer.propose(merged)) == table(infer.infer_mapping(decode(texts(*docs))))


def test_no_votes(texts):
    none = infer.merge_votes(infer.path_votes(decode(texts("nope"))))
    assert none.count() == 0 and infer.propose(none).count() == 0


def test_a_repeated_batch_votes_once(spark, texts, tmp_path):
    docs, root = some_messages(20), str(tmp_path)
    texts(*docs).select("value").write.parquet(f"{root}/in")

    def run(checkpoint):
        stream = spark.readStream.schema("value string").parquet(f"{root}/in")
        votes.keep(stream, f"{root}/votes", f"{root}/{checkpoint}", availableNow=True).awaitTermination()
        return table(votes.read(spark, f"{root}/votes"))

    # The second run has lost its checkpoint and does batch 0 again.
    assert run("one") == run("two") == table(infer.path_votes(decode(texts(*docs))))
