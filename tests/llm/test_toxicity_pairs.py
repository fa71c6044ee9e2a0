"""The factorization machine learns pairs of terms that are harmless alone, through ``fit``, from every hashed term."""

import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa

from vaultweave.llm import toxicity

TERMS = ("amber", "bronze", "cedar", "delta")
TOXIC = ({"amber", "bronze"}, {"cedar", "delta"})


def pair_rows(n):
    """Each text holds two of four terms; the label follows from the pair, and every term alone is toxic in a third."""
    draw = random.Random(5)
    pairs = list(itertools.combinations(TERMS, 2))
    for i in range(n):
        pair = draw.choice(pairs)
        words = [f"{draw.randrange(2000)}w" for _ in range(20)] + list(pair)
        draw.shuffle(words)
        yield i, " ".join(words), int(set(pair) in TOXIC)


def test_pairs_harmless_alone(spark):
    rows = list(pair_rows(7500))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    for term in TERMS:
        assert abs(np.mean([y for _, t, y in rows if term in t.split()]) - np.mean([y for *_, y in rows])) < 0.04
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [(got[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([p > n for p in pos for n in neg]) > 0.95


def test_score_is_the_sum_over_terms_and_pairs(spark):
    rng = np.random.default_rng(2)
    texts = ["Some words, some More words", "", "x", "Ünder über 12 twelve", "some words"]
    feats = [sorted(set(toxicity._texts(pa.array([t], pa.string())).__next__()[1].tolist())) for t in texts]
    known = np.unique(np.concatenate([np.array(f, np.int64) for f in feats[:4]]))
    m = toxicity.FactorizationMachine(toxicity.BUCKETS, known[1:], 3)  # one feature that no training row held
    m.w0, m.w[:-1], m.v[:-1] = -0.3, rng.normal(size=len(known) - 1), rng.normal(size=(len(known) - 1, 3))
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), m).collect()}
    for i, f in enumerate(feats):
        at = [int(np.searchsorted(known[1:], x)) for x in f if x in known[1:]]
        z = m.w0 + sum(float(m.w[a]) for a in at) + sum(float(np.dot(m.v[a], m.v[b])) for a, b in itertools.combinations(at, 2))
        assert math.isclose(got[i], 1 / (1 + math.exp(-z)), rel_tol=1e-4)


def test_repeated_ids_are_one_training_row(spark, monkeypatch):
    seen = []
    plain = toxicity.FactorizationMachine.fit
    monkeypatch.setattr(toxicity.FactorizationMachine, "fit", lambda self, feats, label: (seen.append(len(feats)), plain(self, feats, label)))
    docs = spark.createDataFrame([(i % 4, f"text {i}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 4, i % 2) for i in range(40)], "doc_id long, toxic int")
    toxicity.fit(docs, labels)
    assert seen == [sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(4))]
