"""Shingles that unrelated documents share do not tie them into one group, and long and short lists find the same links."""

import random

import pytest
from pyspark.sql import functions as F

from vaultweave.llm import near_dedup as N


def classes(spark, rows, monkeypatch, percent=85, **options):
    """Texts that the block comparison gets, and the classes."""
    texts, pairs_of = [0], N._block_pairs

    def spy(member):
        out = N.saved(pairs_of(member), "spy")
        texts.append(out.count())
        return out

    with monkeypatch.context() as m:
        m.setattr(N, "_block_pairs", spy)
        got = {r.doc_id: r.component_id for r in N.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent, **options).collect()}
    return texts[-1], got


def linked(rows, percent):
    """Plain union of all pairs at the threshold."""
    grams = {i: {tuple(t.split()[j:j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i in grams}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in grams:
        for b in grams:
            if a < b and 100 * len(grams[a] & grams[b]) >= percent * len(grams[a] | grams[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in grams}


def test_chains_of_documents_that_share_little_make_no_group(spark, monkeypatch):
    """Each document shares half of its shingles with the next one: all are connected, none is similar."""
    part = [" ".join(f"p{i}w{j}" for j in range(60)) for i in range(1601)]
    for n in (800, 1600):
        rows = [(i, f"{part[i]} {part[i + 1]}") for i in range(n)] + [(n + i, f"{part[i]} {part[i + 1]} tail") for i in range(15)]
        texts, got = classes(spark, rows, monkeypatch)
        assert texts <= 300                                     # the whole chain, several times, when lists alone made groups
        assert {i: c for i, c in got.items() if i != c} == {n + i: i for i in range(15)}


@pytest.mark.parametrize("longest", [1, 4, N.LIST])
def test_long_and_short_lists_equal_all_pairs(spark, monkeypatch, longest):
    monkeypatch.setattr(N, "LIST", longest)
    rng = random.Random(5)
    rows = []
    for g in range(10):
        base = [f"g{g}w{j}" for j in range(90)]
        for c in range(8):
            words = base[:rng.randint(74, 90)]
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"new{g}x{rng.randrange(3)}"
            rows.append((100 * g + c, " ".join(words)))
    for percent in (80, 85):
        want = linked(rows, percent)
        assert 10 < len(set(want.values())) < len(rows)
        assert classes(spark, rows, monkeypatch, percent, pivots=0)[1] == want


def test_similar_sets_share_as_many_of_their_prefixes(spark):
    """The bound that pairs of short lists must reach, on random pairs close to the threshold."""
    rng = random.Random(3)
    cases = []
    for percent in (60, 80, 85, 95):
        for _ in range(1500):
            n = rng.randint(1, 60)
            a = set(rng.sample(range(90), n))
            b = set(rng.sample(sorted(a), rng.randint(max(1, n * percent // 100 - 1), n))) | set(rng.sample(range(90, 100), rng.randint(0, min(6, n))))
            if 100 * len(a & b) >= percent * len(a | b):
                order = rng.sample(range(100), 100)
                short = [set(sorted(s, key=order.index)[:len(s) - -(-len(s) * percent // 100) + 1]) for s in (a, b)]
                cases.append((percent, len(a), len(b), len(short[0] & short[1])))
    for percent in (60, 80, 85, 95):
        some = spark.createDataFrame([c for c in cases if c[0] == percent], "percent int, n long, m long, shared long")
        least = N._common(F.col("n"), F.col("m"), percent)
        assert some.filter(F.col("shared") < least).isEmpty() and not some.filter(F.col("shared") == least).isEmpty()
        assert some.filter(least < 1).isEmpty()
