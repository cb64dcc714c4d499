import random

import pytest

from signmine.operators import metas


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_transitions_over_the_edges_of_ranges(spark, monkeypatch, size):
    monkeypatch.setattr(metas, "RANGE", size, raising=False)
    rng = random.Random(size)
    items = [(n, rng.choice(["a", "b", None])) for n in rng.sample(range(-50, 500), 200)]
    in_order = sorted(items)
    want = [(n, shard, before) for (n, shard), before in zip(in_order, [None, *(s for _, s in in_order)]) if before is None or (shard is not None and shard != before)]
    found = metas.transitions(spark.createDataFrame(items, "n long, shard string"))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))
    # No window may bring all items into one task.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 0 or all("__range" in x for x in plan.splitlines() if "Window [" in x)
