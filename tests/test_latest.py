from __future__ import annotations

import random

import pytest

from jsonflow.plans.spec import SinkSpec
from jsonflow.streaming import journal, sinks
from jsonflow.streaming.latest import LatestTable

SCHEMA = "k long, at long, v string"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA).coalesce(1)


def state(spark, target):
    return sorted((tuple(r) for r in target.read(spark).collect()), key=repr)


def test_batches_in_any_order_keep_the_latest(spark, root):
    rng, target, want = random.Random(3), LatestTable(f"{root}/t", ["k"], ["at"]), {}
    order = list(range(300))
    rng.shuffle(order)
    for batch_id in range(14):
        data = [(rng.randrange(40), at, f"v{at}") for at in order[batch_id * 20 : batch_id * 20 + 20]]
        target.merge(rows(spark, *data), batch_id)
        for k, at, v in data:
            want[k] = max(want.get(k, (-1, "")), (at, v))
    assert state(spark, target) == sorted(((k, at, v) for k, (at, v) in want.items()), key=repr)
    # Few runs count, and what no list has any more is gone.
    _, runs = target._runs(spark, target._lists(spark))
    assert len(runs) <= 5 and len(target._lists(spark)) == 10
    used = {name for b in target._lists(spark) for name, _ in target._runs(spark, [b])[1]}
    old = min(target._lists(spark))
    assert all(n in used for n in journal.names(spark, f"{root}/t/runs") if int(n.split("-")[0]) < old)


def test_a_repeated_batch_changes_nothing(spark, root):
    target = LatestTable(f"{root}/t", ["k"], ["at"])
    target.merge(rows(spark, (1, 1, "a"), (None, 1, "n"), (None, 1, "n")), 0)
    target.merge(rows(spark, (1, 2, "b"), (2, 1, "c"), (None, 1, "n")), 1)
    before = state(spark, target)
    target.merge(rows(spark, (1, 2, "b"), (2, 1, "c"), (None, 1, "n")), 1)
    assert state(spark, target) == before == [(1, 2, "b"), (2, 1, "c"), (None, 1, "n"), (None, 1, "n"), (None, 1, "n")]


def test_what_a_lost_driver_left_is_not_read(spark, root, monkeypatch):
    target = LatestTable(f"{root}/t", ["k"], ["at"])
    target.merge(rows(spark, (1, 1, "a")), 0)
    with monkeypatch.context() as lost:
        lost.setattr(journal, "put", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            target.merge(rows(spark, (1, 2, "b"), (3, 1, "x")), 1)
    assert state(spark, target) == [(1, 1, "a")]
    target.merge(rows(spark, (1, 2, "b")), 1)
    assert state(spark, target) == [(1, 2, "b")]


def test_empty_batches_and_other_columns(spark, root):
    target = LatestTable(f"{root}/t", ["k"], ["at"])
    with pytest.raises(ValueError, match="nothing was merged"):
        target.read(spark)
    target.merge(rows(spark, (1, 1, "a")).limit(0), 0)
    assert state(spark, target) == []
    target.merge(rows(spark, (1, 1, "a")), 1)
    target.merge(rows(spark, (1, 1, "a")).limit(0), 2)
    assert state(spark, target) == [(1, 1, "a")]
    with pytest.raises(ValueError, match="other columns"):
        target.merge(rows(spark, (1, 1, "a")).drop("v"), 3)


def test_a_sink_that_keeps_the_latest_needs_a_path_and_an_order(spark, root):
    sink = SinkSpec.from_dict({"path": root, "latestBy": {"keys": ["k"], "order": ["at"]}})
    assert (sink.latest_keys, sink.latest_order) == (("k",), ("at",))
    for wrong in ({"table": "t", "latestBy": {"keys": ["k"], "order": ["at"]}}, {"path": root, "latestBy": {"keys": ["k"]}}):
        with pytest.raises(ValueError, match="needs a path and an order"):
            SinkSpec.from_dict(wrong)
    with pytest.raises(ValueError, match="numbered batches"):
        sinks.append(rows(spark, (1, 1, "a")), sink)
