"""op5 learns every trigram of a language, however many there are."""

import numpy as np

from vaultweave.llm import langid


def test_no_trigram_is_left_out(spark):
    rng = np.random.default_rng(6)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x4E00 + 5000, 3000))) for _ in range(100)]
    model = langid.fit(spark.createDataFrame([(i, "zh", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string"))
    want = {("  " + t)[i:i + 3] for t in texts for i in range(len(t))}
    assert len(want) > 250_000 and len(model.tables[2].keys) == len(want)
