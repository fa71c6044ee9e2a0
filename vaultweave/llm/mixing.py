"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate, ``share * budget / rows of the source``. Each document
draws its number of copies from a Poisson distribution of that mean by inverting the distribution
at a uniform number hashed from the seed and the document's id, so the draw needs no state, is the
same on every run and on every machine, and each executor decides alone. A mean above ``PIECE`` is
drawn as the sum of that many equal pieces, each with a hash of its own, which keeps the inverted
table short and is the same distribution. The copies are then shuffled globally: dealt over all
partitions, and sorted in them, by a hash of id and copy number.

The rates are one small row per source, counted over all documents and written first; Spark sends
them to the executors only when the file is below its broadcast limit, else it joins by source and
splits the hot ones.

Defined cases: null is a source of its own; a source without a target gets none of the budget; rows
that share an id draw alike; null, empty and very long texts count as one document each;
equal rows are documents of their own; an empty table gives no rows; input columns of any name keep their values (where one
is named ``copy`` or ``shuffle_key``, the new one is called ``mix_copy`` or ``mix_shuffle_key``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultweave.llm.common import fresh, saved, table

SEED = "mix-1"
PIECE = 16.0
STEPS = 80


def rates(docs: DataFrame, source_col: str = "source", targets: dict | None = None, budget: float | None = None) -> DataFrame:
    """``src, pieces, cdf`` per source. ``targets``: weight by source, scaled to 1; without it all sources
    weigh the same. ``budget``: expected rows of the mixture; without it as many as there are."""
    n = docs.groupBy(F.col(source_col).alias("src")).agg(F.count("*").alias("n"))
    if targets is None:
        weighed = n.withColumn("weight", F.lit(1.0))
    else:
        w = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in targets.items()], "t string, weight double")
        weighed = n.join(w, n["src"].eqNullSafe(w["t"]), "left").select("src", "n", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    weighed = saved(weighed, "mix")
    rows, weights = (float(x or 0) for x in weighed.agg(F.sum("n"), F.sum("weight")).first())
    amount = rows if budget is None else float(budget)
    mean = F.col("weight") / F.lit(weights) * F.lit(amount) / F.col("n") if weights > 0 else F.lit(0.0)
    rate = weighed.withColumn("rate", mean).withColumn("pieces", F.greatest(F.ceil(F.col("rate") / PIECE), F.lit(1)).cast("int"))
    mu = F.col("rate") / F.col("pieces")
    first = F.struct(F.array(F.exp(-mu)).alias("cdf"), F.exp(-mu).alias("p"))
    step = lambda a, k: F.struct(F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * mu / k)).alias("cdf"), (a["p"] * mu / k).alias("p"))
    return rate.select("src", "rate", "pieces", F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), first, step, lambda a: a["cdf"]).alias("cdf"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", targets: dict | None = None,
                budget: float | None = None, seed: str = SEED) -> DataFrame:
    """The columns of ``docs`` once per drawn copy, with ``copy`` (from 1) and ``shuffle_key``, in shuffled order."""
    table_of = saved(rates(docs, source_col, targets, budget), "mix")
    taken = {c.lower() for c in docs.columns}
    copy, order = (f"mix_{c}" if c in taken else c for c in ("copy", "shuffle_key"))
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    names = docs.columns
    src, pieces, cdf, rate, n = fresh(names, "__src", "__pieces", "__cdf", "__rate", "__n")
    uniform = lambda i: F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), ident, i.cast("string"))), 1, 13), 16, 10).cast("double") / float(1 << 52)
    draw = lambda i: F.size(F.filter(cdf, lambda c: c <= uniform(i)))
    copies = F.aggregate(F.transform(F.sequence(F.lit(1), F.col(pieces)), draw), F.lit(0), lambda a, x: a + x)
    r = table_of.select(F.col("src").alias(src), F.col("pieces").alias(pieces), F.col("cdf").alias(cdf), F.col("rate").alias(rate))
    drawn = (docs.join(r, docs[source_col].eqNullSafe(r[src])).filter(F.col(rate) > 0).withColumn(n, copies)
             .filter(F.col(n) > 0).select(*[docs[c] for c in names], F.explode(F.sequence(F.lit(1), F.col(n))).alias(copy)))
    key = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), ident, F.col(copy).cast("string"))), 1, 15), 16, 10).cast("long")
    return drawn.withColumn(order, key).repartition(order).sortWithinPartitions(order, id_col, copy)


def op6_mixing_sources(spark, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "copy", "shuffle_key", F.md5("text").alias("text_md5"))


OP6_SQL = f"""
WITH src AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rate AS (SELECT source, 1.0::DOUBLE / (SELECT count(*) FROM src) * (SELECT sum(n) FROM src)::DOUBLE / n AS rate FROM src),
pieces AS (SELECT source, rate, greatest(ceil(rate / {PIECE}), 1)::INT AS pieces, rate / greatest(ceil(rate / {PIECE}), 1) AS mu FROM rate),
terms AS (SELECT source, k, exp(-mu + k * ln(mu) - lgamma(k + 1)) AS p FROM pieces, range(0, {STEPS + 1}) t(k)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
cdfs AS (SELECT source, list(c ORDER BY k) AS cdf FROM cdf GROUP BY source),
drawn AS (SELECT d.doc_id, d.source, d.text, p.pieces,
  list_sum(list_transform(range(1, p.pieces + 1), lambda i: len(list_filter(c.cdf, lambda x: x <=
    (('0x' || substr(md5('{SEED}|' || d.doc_id || '|' || i), 1, 13))::BIGINT)::DOUBLE / 4503599627370496.0)))) AS n
  FROM documents d JOIN pieces p ON d.source IS NOT DISTINCT FROM p.source JOIN cdfs c ON d.source IS NOT DISTINCT FROM c.source),
copies AS (SELECT doc_id, source, text, unnest(range(1, n::BIGINT + 1))::INT AS copy FROM drawn WHERE n > 0)
SELECT doc_id, source, copy, ('0x' || substr(md5('{SEED}|order|' || doc_id || '|' || copy), 1, 15))::BIGINT AS shuffle_key,
  md5(text) AS text_md5 FROM copies
"""
