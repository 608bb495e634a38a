"""Top-k search over several shards, bundles and sets of queries."""

import numpy as np

from tests.llm.test_operators import results, workers  # noqa: F401  a fixture
from tickloom.llm import topk


def best(live, step, k=10):
    """(query, rank, vec_id, score) by brute force."""
    want = []
    for n, (q, own) in enumerate(live):
        if q % step == 0:
            others = [(-int(own @ v), i) for m, (i, v) in enumerate(live) if m != n and len(v) == len(own)]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(others)[:k], 1)]
    return sorted(want, key=repr)


def test_queries_that_meet_many_shards_are_not_broadcast(spark):
    """The blocks of queries, once a shard, were broadcast, as their size was judged before they were copied."""
    rng = np.random.default_rng(9)
    table = spark.createDataFrame([(int(i), rng.normal(size=4).tolist()) for i in range(400)], "vec_id long, embedding array<float>")
    found = topk.search(table)
    plan = found._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Broadcast" not in plan and "Join" not in plan


def test_shards_bundles_and_sets_give_the_best_of_all(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 40)
    monkeypatch.setattr(topk, "BLOCK", 8)
    monkeypatch.setattr(topk, "SET", 16)
    rng = np.random.default_rng(10)
    rows = [(int(i), rng.integers(-2, 3, 6 if i % 9 else 3).tolist()) for i in rng.integers(0, 500, 700)]
    rows += [(i, [0.0] * 6) for i in range(0, 40, 5)] + [(20, []), (25, []), (7, [1e9, 0.0, 0.0, 1e3, 0.0, 0.0]), (10, [1e2] * 6)]
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    live = [(i, np.floor(1024 * np.array(v, float)).astype(int)) for i, v in rows]
    assert results(topk.search(table, step=5), "query_id", "rank", "vec_id", "score") == best(live, 5)


def test_blocks_keep_the_best_of_the_shards_they_meet():
    rng = np.random.default_rng(11)
    for spread in (1, 3, 1000, 1 << 27):  # the last one's scores do not fit a double
        for width in (0, 1, 5, 64):
            rows, keys, ids = rng.integers(-spread, spread + 1, (200, width)), rng.permutation(200), rng.integers(0, 60, 200)
            asked = rng.choice(200, 15, replace=False)
            block = topk.Block(keys[asked], ids[asked], rows[asked], 10)
            for part in np.array_split(np.arange(200), 3):
                topk.Shard(keys[part], ids[part], rows[part]).meet(block)
            query, score, found = block.found
            for n, own in enumerate(asked.tolist()):
                want = sorted((-int(rows[own] @ rows[m]), int(ids[m])) for m in range(200) if m != own)[:10]
                assert list(zip((-score[query == n]).tolist(), found[query == n].tolist())) == want
