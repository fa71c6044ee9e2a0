"""The near-dedup stage of the pipeline leaves no shuffle files behind its writes, and leaves the session's switch as it was."""

from pyspark.sql import functions as F

import corpus_pipeline
from vaultweave.llm import common


def test_switch_is_put_back(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    for before in (None, "false"):
        spark.conf.set(common.CLEAN_UP, before) if before else spark.conf.unset(common.CLEAN_UP)
        assert common.saved_alone(df, "test").count() == 7
        assert spark.conf.get(common.CLEAN_UP, None) == before
    spark.conf.unset(common.CLEAN_UP)


def test_near_dedup_drops_the_shuffles_of_its_writes(spark, monkeypatch):
    """Each write of the stage runs with the switch on."""
    seen, plain = [], common.saved

    def spy(df, label):
        seen.append((label, spark.conf.get(common.CLEAN_UP, None)))
        return plain(df, label)

    monkeypatch.setattr(common, "saved", spy)
    words = [f"w{j}" for j in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "tail"])), (3, "other words that nobody else has here")]
    got = corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r.doc_id for r in got.collect()} == {1, 3}
    assert {label for label, _ in seen} == {"near", "cc"} and {on for _, on in seen} == {"true"}
