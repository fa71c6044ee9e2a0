"""Connected components against a plain union-find, on shapes that need no step, one step or several."""

import random

import pytest

from vaultweave.llm.components import components


def _plain(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((root(u), root(v)))
            up[b] = a
    return sorted((x, root(x)) for x in up)


def _random(n, m, seed):
    rng = random.Random(seed)
    return [(rng.randrange(-n, n), rng.randrange(-n, n)) for _ in range(m)]


@pytest.mark.parametrize("edges", [
    [], [(3, 3)], [(1, 2), (2, 1), (1, 2)], [(9, i) for i in range(9)], [(0, i) for i in range(1, 60)] + [(100, 101)],
    [(i, i + 1) for i in range(40)], [(40 - i, 41 + i) for i in range(40)] + [(i, 80 - i) for i in range(40)], _random(60, 45, 1), _random(30, 90, 2)])
def test_components_equal_union_find(spark, edges):
    got = components(spark.createDataFrame(edges, "u long, v long"))
    assert sorted(map(tuple, got.collect())) == _plain(edges)
