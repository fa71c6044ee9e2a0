"""Sharding by proportional stratified interleaving.

Every source's rows are shuffled by a seeded hash and ranked ``r = 1, 2, ...``. With ``n`` rows of the
source and a start ``u`` in (0, 1) hashed from its name, a row's fractional rank is ``(r - u) / n``. Sorting
all rows by it interleaves the sources in proportion, and cutting the sorted rows into equal stretches gives
shards whose counts differ by at most one and that hold every source in its share, to within two rows a
source plus the rows by which the starts of the sources shift the cuts. The hashed start keeps sources of a few
rows from all falling in the middle.

Both ranks are taken without a group that grows with the data: rows fall into cells (of a source by their
hash; of all rows by their fractional rank), cells are counted, the counts are summed up in two steps
(1,024 cells at a time, then over those sums), and rows are numbered only inside their cell of about
``ROWS`` rows. A source holding a third of all rows is therefore spread over as many tasks as its cells.
DataFrame functions only; texts are not shuffled unless the caller asks for them.

Defined cases: null is a source of its own; a null text has no bytes; rows are shuffled by a
hash of all their columns, so rows that share an id need not lie together and rows equal in every column are interchangeable; an empty table
gives no rows; with fewer rows than shards the last shards stay empty; an input column named ``shard`` or
``slot`` keeps its values and the new one is called ``shard_of`` or ``slot_of``, names of other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultweave.llm.common import CRC_TABLE_SQL, crc_sql, saved, sums_before, table

SEED = "shard-1"
ROWS = 64


def _hash52(digest: Column) -> Column:
    """A number below 2**52 from the first 13 digits of a hex digest."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def interleave(docs: DataFrame, shards: int, source_col: str = "source", seed: str = SEED) -> DataFrame:
    """The rows and columns of ``docs`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard)."""
    taken = {c.lower() for c in docs.columns}
    shard, slot = (f"{c}_of" if c in taken else c for c in ("shard", "slot"))
    source = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    whole = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")) for c in docs.columns]
    rows = saved(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), source.alias("source"),
                             F.md5(F.concat_ws("|", F.lit(seed), *whole)).alias("key")), "shard")
    n = rows.count()
    cells = max(1, -(-n // ROWS))
    cell = lambda x: F.least(F.floor(x * cells), F.lit(cells - 1))

    first = rows.withColumn("cell", cell(_hash52(F.col("key")) / float(1 << 52)))
    counts = saved(sums_before(first.groupBy("source", "cell").agg(F.count("*").alias("n")), ["source"], "cell", ["n"]), "shard")
    rank = F.row_number().over(Window.partitionBy("source", "cell").orderBy("key")) + F.col("n_before")
    start = (_hash52(F.md5(F.concat_ws("|", F.lit(seed), F.lit("start"), F.col("source")))) + 1) / float((1 << 52) + 2)
    ranked = (first.join(counts, ["source", "cell"]).withColumn("rank", rank)
              .select("row", "source", "rank", ((F.col("rank") - start) / F.col("n_total")).alias("part")))
    ranked = saved(ranked.withColumn("cell", cell(F.col("part"))), "shard")

    counts = saved(sums_before(ranked.groupBy("cell").agg(F.count("*").alias("n")), [], "cell", ["n"]), "shard")
    place = F.row_number().over(Window.partitionBy("cell").orderBy("part", "source", "rank")) + F.col("n_before") - 1
    placed = (ranked.join(counts, "cell").withColumn("place", place)
              .withColumn("s", F.expr(f"cast(place * {int(shards)} div {n or 1} as int)")))
    first_place = F.expr(f"(s * {n}L + {int(shards) - 1}) div {int(shards)}")
    return placed.select("row.*", F.col("s").alias(shard), (F.col("place") - first_place).alias(slot))


def op13_proportional_shards(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"),
                                                    F.crc32(text.cast("binary")).alias("text_crc32"))
    return interleave(docs, 8).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                      F.lit(None).cast("int").alias("grown_shard"))


def _hash52_sql(digest: str) -> str:
    return f"('0x' || substr({digest}, 1, 13))::BIGINT"


OP13_SQL = f"""
WITH {CRC_TABLE_SQL},
docs AS (SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size, {crc_sql("coalesce(text, '')")} AS text_crc32 FROM documents, crc),
keyed AS (SELECT *, coalesce('=' || source, '') AS stratum, md5(concat_ws('|', '{SEED}', coalesce(doc_id::VARCHAR, 'null'),
  coalesce(source, 'null'), size::VARCHAR, text_crc32::VARCHAR)) AS key FROM docs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY key) AS r, count(*) OVER (PARTITION BY stratum) AS n_source,
  ({_hash52_sql(f"md5('{SEED}|start|' || stratum)")} + 1)::DOUBLE / 4503599627370498.0::DOUBLE AS start FROM keyed),
placed AS (SELECT *, row_number() OVER (ORDER BY (r::DOUBLE - start) / n_source::DOUBLE, stratum, r) - 1 AS place, count(*) OVER () AS n FROM ranked)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (place * 8 // n)::INT AS shard,
  (place - ((place * 8 // n) * n + 7) // 8)::BIGINT AS slot, NULL::INT AS grown_shard FROM placed
"""
