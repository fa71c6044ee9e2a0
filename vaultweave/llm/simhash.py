"""SimHash document fingerprints and search within a Hamming radius. DataFrame functions only.

Terms are the pairs of neighbouring words (white space ``\\s`` separates words; the first word also
pairs with a start mark), weighted by how often they occur. Each term's hash votes on each of
``BITS`` signed bits; a fingerprint bit is 1 when the 1-votes outweigh the 0-votes. Votes are sums
over exploded terms: bits i and i + 32 of a 64-bit hash share one long sum of two 32-bit lanes, so
64 sums carry 128 bits for texts of any length.

``within_radius`` finds all fingerprints near a set of query fingerprints with permuted block
tables: of ``radius + 1`` blocks one is equal whenever at most ``radius`` bits differ, so a table per
block, keyed by that block, holds every answer; the pair is reported by the first table only.

Defined cases: null text is empty; a text without words has the all-zero fingerprint; rows that
share an id are ordered by text; a null id sorts before all others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultweave.llm.common import saved, shuffle_parts, table

BITS = 128
RADIUS = 3
_LANE = 0x0000000100000001
START = "\u0001"


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` (unique per row) and ``fingerprint``, ``BITS`` bits as lowercase hex. Stays in place when ``rows``
    is already partitioned by some of ``keys``."""
    words = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    terms = (rows.select(*keys, words.alias("w"))
             .select(*keys, F.explode_outer(F.zip_with(F.concat(F.array(F.lit(START)), F.col("w")), F.col("w"),
                                                       lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))).alias("term"))
             # the zip is one longer than the words, so a text without words keeps its row, with no vote
             .select(*keys, F.col("term").isNotNull().cast("long").alias("n"),
                     *[F.when(F.col("term").isNotNull(), F.xxhash64(F.lit(s), "term")).otherwise(F.lit(0)).alias(f"h{s}") for s in (0, 1)]))
    lanes = [F.sum(F.shiftright(F.col(f"h{s}"), i).bitwiseAND(F.lit(_LANE))).alias(f"s{s}_{i}") for s in (0, 1) for i in range(32)]
    votes = terms.groupBy(*keys).agg(F.sum("n").alias("n"), *lanes)

    def word(s: int, half: int) -> Column:  # 32 bits as a long
        lane = lambda i: F.shiftrightunsigned(F.col(f"s{s}_{i}"), 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
        return reduce(lambda a, b: a + b, [F.when(lane(i) * 2 > F.col("n"), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(32)])

    return votes.select(*keys, F.lower(F.concat(*[F.lpad(F.hex(word(s, half)), 8, "0") for s in (0, 1) for half in (1, 0)])).alias("fingerprint"))


def _words64(fp: str) -> list[Column]:
    """The fingerprint's eight-digit groups as longs."""
    return [F.conv(F.substring(fp, 8 * i + 1, 8), 16, 10).cast("long") for i in range(BITS // 32)]


def distance(a: str, b: str) -> Column:
    """Hamming distance of two hex fingerprints."""
    return reduce(lambda x, y: x + y, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(_words64(a), _words64(b), strict=True)])


def likeness(a: str, b: str) -> Column:
    return 1.0 - distance(a, b) / F.lit(float(BITS))


def within_radius(queries: DataFrame, points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All ``(query, point, distance)`` of distinct fingerprints (columns ``query`` and ``point``) within ``radius``."""
    digits = BITS // 4
    cut = [i * digits // (radius + 1) for i in range(radius + 2)]
    blocks = lambda c: [F.substring(c, cut[i] + 1, cut[i + 1] - cut[i]) for i in range(radius + 1)]
    tables = lambda df, c: df.select(c).distinct().select(c, F.posexplode(F.array(*blocks(c))).alias("tab", "key"))
    q, p = tables(queries, "query"), tables(points, "point").withColumnRenamed("tab", "ptab").withColumnRenamed("key", "pkey")
    earlier = reduce(lambda a, b: a | b, [(F.col("tab") > i) & (x == y) for i, (x, y) in enumerate(zip(blocks("query"), blocks("point"), strict=True))])
    near = distance("query", "point")
    return (q.join(p, (q["tab"] == p["ptab"]) & (q["key"] == p["pkey"]) & ~earlier & (near <= radius))
            .select("query", "point", near.alias("distance")))


def with_next_text(docs: DataFrame, parts: int) -> DataFrame:
    """``bucket, place, id, text, next_text``: rows in the order of their ids, cut into ranges. Each
    range also gets the first row of the following range (``place`` null-free, ``tail`` true), so one
    shuffle suffices; no range is the whole table."""
    shape = docs.agg(F.count("*"), F.count("id"), F.min("id"), F.percentile_approx("id", [i / parts for i in range(1, parts)] or [0.5], 10000)).first()
    nulls, cuts = shape[0] - shape[1], sorted({shape[2], *shape[3]}) if shape[1] else []
    heads = ([None] if nulls else []) + [c for c in cuts if not (nulls and c == cuts[0])]  # first id of each range
    bounds = F.array(*[F.lit(c).cast("long") for c in heads if c is not None]) if any(c is not None for c in heads) else F.array().cast("array<long>")
    lead = 1 if nulls else 0
    # a null id, and ids up to the second cut, are range 0 when nulls lead the order
    bucket = F.when(F.col("id").isNull(), F.lit(0)).otherwise(F.size(F.filter(bounds, lambda b: b <= F.col("id"))) + F.lit(lead - 1))
    bucket = F.greatest(bucket, F.lit(0))
    last = max(len(heads) - 1, 0)
    is_head = F.col("id").isNull() if nulls else F.col("id") == F.lit(cuts[0] if cuts else 0)
    head = F.when(F.col("bucket") == 0, is_head).otherwise(F.array_contains(bounds, F.col("id")))
    prev = F.when(F.col("bucket") == 0, F.lit(last)).otherwise(F.col("bucket") - 1)
    spread = (docs.withColumn("bucket", bucket)
              .select("id", "text", F.explode(F.when(F.coalesce(head, F.lit(False)), F.array(
                  F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("tail")),
                  F.struct(prev.alias("bucket"), F.when(F.col("bucket") == 0, F.lit(2)).otherwise(F.lit(1)).alias("tail"))))
                  .otherwise(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("tail"))))).alias("to"))
              .select("to.bucket", "to.tail", "id", "text"))
    order = Window.partitionBy("bucket").orderBy("tail", F.col("id").asc_nulls_first(), "text")
    return spread.select("bucket", F.row_number().over(order).alias("place"), "tail", "id", "text", F.lead("text").over(order).alias("next_text"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The fingerprint of each text and of its edited text (its last half replaced by the start of the next
    text), their likeness, and for ids divisible by 50 the number of other distinct fingerprints within ``radius``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 2) AS int))"),
                      F.expr("left(next_text, cast(floor(char_length(text) / 2) AS int))"))
    both = (with_next_text(rows, 2 * shuffle_parts(spark))
            .withColumn("edited", F.when(F.col("tail") == 0, F.when(half > 0, edited).otherwise(F.col("text"))))
            .select("bucket", "place", "tail", "id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("sha"),
                    F.explode(F.when(F.col("tail") == 0, F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")),
                                                                 F.struct(F.lit(1).alias("side"), F.col("edited").alias("t"))))
                              .otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t"))))).alias("e"))
            .select("bucket", "place", "tail", "id", "n_chars", "sha", "e.side", "e.t"))
    keys = ["bucket", "place", "side", "tail", "id", "n_chars", "sha"]
    fps = saved(fingerprints(both, keys, "t"), "simhash")
    own = fps.groupBy("bucket", "place").agg(
        F.min("tail").alias("tail"), F.min("id").alias("doc_id"), F.min("n_chars").alias("n_chars"), F.min("sha").alias("edited_sha256"),
        F.max(F.when(F.col("side") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("side") == 1, F.col("fingerprint"))).alias("edited_fingerprint"))
    following = F.lead("fingerprint").over(Window.partitionBy("bucket").orderBy("place"))
    out = own.withColumn("following", following).filter("tail = 0")
    texts = fps.filter("side = 0 AND tail = 0")
    found = within_radius(texts.filter("id % 50 = 0").select(F.col("fingerprint").alias("query")),
                          texts.select(F.col("fingerprint").alias("point")), radius)
    near = found.filter("query != point").groupBy("query").agg(F.count("*").alias("n_near"))
    return (out.join(near, out["fingerprint"] == near["query"], "left")
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                    likeness("fingerprint", "following").alias("near_next"),
                    F.when(F.col("doc_id") % 50 == 0, F.coalesce("n_near", F.lit(0))).alias("near_fingerprints")))


def op1_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
