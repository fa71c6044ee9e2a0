"""The three phases of the top-k search: what they add up in full, and that groups, chunks and blocks lose nothing."""

import numpy as np

from vaultweave.llm import topk


def _clustered(n, dims=32, seed=5):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 1, (12, dims))
    x = centre[rng.integers(0, 12, n)] * rng.uniform(0.2, 2.0, (n, 1)) + rng.normal(0, 0.2, (n, dims))
    return np.floor(x * 256)


def test_few_scores_are_added_up_in_full_and_none_is_lost():
    x = _clustered(4000)
    q, k = x[::50], 5
    other = np.arange(0, 4000, 50)[:, None] != np.arange(4000)[None, :]
    full = q @ x.T
    at, score = topk.gather(q, x, other, k)
    assert (full.ravel()[at] == score).all() and len(at) <= k * topk.LISTS * len(q)
    floor = np.array([np.sort(score[at // len(x) == i])[-k] for i in range(len(q))], float)
    at, score = topk.resolve(q, x, other, floor)
    assert (full.ravel()[at] == score).all()
    assert set(np.flatnonzero(((full >= floor[:, None]) & other).ravel())) <= set(at)
    assert len(at) < 0.1 * full.size


def test_bounds_hold_for_negative_missing_and_unreachable_floors():
    x = _clustered(300, dims=5)
    q = np.vstack([x[:6], np.zeros((1, 5))])
    other = np.ones((7, 300), bool)
    full = q @ x.T
    for floor in (np.full(7, -np.inf), np.full(7, -1e5), np.zeros(7), np.median(full, axis=1), full.max(axis=1), np.full(7, 1e17)):
        at, score = topk.resolve(q, x, other, floor)
        assert (full.ravel()[at] == score).all()
        assert set(np.flatnonzero((full >= floor[:, None]).ravel())) <= set(at)


def test_groups_blocks_and_chunks_equal_plain_ranking(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP_BYTES", 2048)  # several groups of queries
    x = _clustered(700, dims=6)
    x[100:400] = x[100]                             # a hot vector: ties beyond k
    rows = [(i, [float(c) / 256 for c in v]) for i, v in enumerate(x)]
    v = spark.createDataFrame(rows, "vec_id long, vec array<double>").repartition(5)
    got = sorted(tuple(r) for r in topk.top_k(v, v.filter("vec_id % 20 = 0"), 4).collect())
    want = []
    for i in range(0, 700, 20):
        s = sorted((-int(x[i] @ x[j]), j) for j in range(700) if j != i)[:4]
        want += [(i, r + 1, j, -t) for r, (t, j) in enumerate(s)]
    assert got == sorted(want)
