"""Documents that share a template, and are no near-duplicates, are not compared with each other."""

import random

from vaultweave.llm import near_dedup as N


def sent(spark, rows, monkeypatch, percent=85):
    """Texts that the block comparison gets, and the classes."""
    seen, pairs_of = {}, N._block_pairs

    def spy(live):
        out = N.saved(pairs_of(live), "spy")
        seen["texts"] = out.count()
        return out

    with monkeypatch.context() as m:
        m.setattr(N, "_block_pairs", spy)
        got = {r.doc_id: r.component_id for r in N.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()}
    return seen.get("texts", 0), got                            # no block is made where no list is left


def test_templates_are_not_compared_and_near_copies_are_found(spark, monkeypatch):
    template = [f"t{j}" for j in range(200)]
    for n in (700, 2100):
        rows = [(i, " ".join(template + [f"u{i}x{j}" for j in range(100)])) for i in range(n)]
        rows += [(n + i, rows[i][1] + " tail") for i in range(15)]
        texts, got = sent(spark, rows, monkeypatch)
        assert texts <= 60                                      # no more than the copies and their sources, twice
        assert {i for i, c in got.items() if i != c} == set(range(n, n + 15)) and all(got[n + i] == i for i in range(15))


def test_prefix_lists_equal_all_pairs_near_the_threshold(spark, monkeypatch):
    """Groups whose members are similar around the threshold, with pivots that cannot join them all."""
    rng = random.Random(8)
    rows = []
    for g in range(12):
        base = [f"g{g}w{j}" for j in range(160)]
        for c in range(9):
            words = list(base)
            for _ in range(rng.randint(0, 5)):
                words[rng.randrange(160)] = f"new{g}x{rng.randrange(4)}"
            rows.append((100 * g + c, " ".join(words)))
    grams = {i: {tuple(t.split()[j:j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    for percent in (80, 85):
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
        _, got = sent(spark, rows, monkeypatch, percent)
        assert got == {i: find(i) for i in grams}
