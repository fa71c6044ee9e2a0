"""Rejection limits of op5 in a table above 8,000 rows, with languages of one row."""

import numpy as np

from vaultweave.llm import langid


def test_every_language_has_a_limit(spark):
    rng = np.random.default_rng(4)
    letters = {"l1": "abcdefghijklm", "l2": "nopqrstuvwxyz", "r1": "αβγδεζηθικλμ", "r2": "бвгджзклмнпр", "r3": "აბგდევზთიკლმ"}
    vocab = {k: ["".join(rng.choice(list(a), rng.integers(3, 8))) for _ in range(30)] for k, a in letters.items()}
    text = lambda k, n=40: " ".join(rng.choice(vocab[k], n))
    train = [(i, k, text(k)) for i, k in enumerate(["l1"] * 6100 + ["l2"] * 6000 + ["r1", "r2", "r3"])]
    model = langid.fit(spark.createDataFrame(train, "doc_id long, lang string, text string"))
    assert set(model.limits) == set(letters) and np.isfinite(list(model.limits.values())).all()
    known = [text(k) for k in letters for _ in range(20)]
    noise = [" ".join("".join(rng.choice(list(a) + list("ϡѮჱ漢字あ한ñüß"), 7)) for _ in range(40)) for a in letters.values() for _ in range(5)]
    rows = list(enumerate(known + noise))
    got = {r.doc_id: r for r in langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [got[i].lang_pred for i in range(len(known))] == [k for k in letters for _ in range(20)]
    assert not any(got[i].rejected for i in range(len(known)))
    assert all(got[i].rejected for i in range(len(known), len(rows)))
    assert {"r1", "r2", "r3"} <= {got[i].lang_pred for i in range(len(known), len(rows))}
