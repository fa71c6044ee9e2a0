"""The corpus pipeline: language ID, near-dedup, pseudonyms, mixing and packing, in this order.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaultweave.llm import langid, mixing, near_dedup, packing, pii
from vaultweave.llm.common import saved, table

NEAR_PERCENT = 80

def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the language models, fitted on this stage's input, do not reject."""
    return langid.keep_known(docs, langid.fit_on(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates, linked from a similarity of 0.8 on."""
    return near_dedup.drop_near(docs, percent=NEAR_PERCENT)


def without_private_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal numbers, dates, addresses and keys replaced by pseudonyms."""
    return pii.pseudonymise(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate draws, all sources weighing the same, shuffled."""
    return mixing.mix_sources(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", known_language),
    ("MinHash near-dedup", one_of_each_group),
    ("PII pseudonyms", without_private_values),
    ("mixing to target weights", mixed_sources),
    ("packing", packed),
]

#: SQL cannot express the language models, the sketches or the tokenizer; tests hold each stage against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "pipeline")
    return docs
