"""Proportional shards: law, mixture, determinism, odd rows."""

import contextlib
import io
import zlib
from collections import Counter, defaultdict

import duckdb
from conftest import SF0001
from odd_rows import edge_docs, edge_rows, no_docs  # noqa: F401
from pyspark.sql import functions as F

from vaultweave.llm import sharding as S
from vaultweave.llm.common import sums_before


def check(rows, shards, shard="shard", slot="slot"):
    by = defaultdict(list)
    for r in rows:
        by[r[shard]].append(r[slot])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by[k]) for k in range(shards)]
    assert set(by) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    return sizes


def test_op13_equals_its_sql(spark):
    got = sorted(tuple(r) for r in S.op13_proportional_shards(spark, SF0001).collect())
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF0001}/documents.parquet')")
    assert got == sorted(con.execute(S.OP13_SQL).fetchall())
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    assert all((size, crc) == (len(texts[i]) + 1, zlib.crc32(texts[i])) for i, size, crc, *_ in got)


def test_every_shard_matches_the_mixture_under_a_hot_source(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, F.lit("hot"))
                                    .when(F.col("id") < 5900, F.concat(F.lit("s"), (F.col("id") % 13).cast("string")))
                                    .when(F.col("id") < 5950, F.concat(F.lit("rare"), F.col("id").cast("string"))).alias("source"))
    rows = S.interleave(docs, 8).collect()
    assert sorted(r.doc_id for r in rows) == list(range(6000))
    assert check(rows, 8) == [750] * 8
    mix, whole = Counter((r.shard, r.source) for r in rows), Counter(r.source for r in rows)
    for s, n in whole.items():
        if n > 8:
            # the share, two rows, and what the starts of 64 sources move a cut by
            assert all(abs(mix[k, s] - n / 8) <= 3 for k in range(8)), s
    # inside a shard too: each tenth of it holds the hot source in its share
    tenth = Counter((r.shard, r.slot // 75) for r in rows if r.source == "hot")
    assert all(20 <= tenth[k, t] <= 30 for k in range(8) for t in range(10))
    assert [r.doc_id for r in rows if r.shard == 0] != sorted(r.doc_id for r in rows if r.shard == 0)
    again = S.interleave(docs.repartition(5, "source"), 8)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in rows}
    other = {(r.doc_id, r.shard) for r in S.interleave(docs, 8, seed="other").collect()}
    assert len(other - {(r.doc_id, r.shard) for r in rows}) > 4000


def test_odd_rows(spark, edge_docs, no_docs):
    docs = edge_docs
    for c in ("shard", "Slot", "cell", "key", "row", "rank", "part", "place", "s", "n_before", "n_total"):
        docs = docs.withColumn(c, F.lit("mine"))
    out = S.interleave(docs, 4)
    assert out.columns == [*docs.columns, "shard_of", "slot_of"]
    rows = out.collect()
    check(rows, 4, "shard_of", "slot_of")
    assert Counter(tuple(r)[:len(docs.columns)] for r in rows) == Counter(tuple(r) for r in docs.collect())
    assert S.interleave(no_docs, 8).count() == 0
    few = S.interleave(edge_docs.limit(3), 8).collect()
    assert sorted(r.slot for r in few) == [0, 0, 0] and len({r.shard for r in few}) == 3


def test_main_path_is_native_and_keeps_the_text_out_of_the_shuffles(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        S.op13_proportional_shards(spark, SF0001).explain("formatted")
    plan = buf.getvalue()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
    assert not any("text#" in ln for ln in plan.splitlines())


def test_sums_before_over_many_cells(spark):
    rows = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").alias("cell"), (F.col("id") % 7).alias("v"))
    got = {r.cell: (r.v_before, r.v_total) for r in sums_before(rows, ["g"], "cell", ["v"]).collect()}
    before, total = [0, 0], [sum(i % 7 for i in range(g, 5000, 2)) for g in (0, 1)]
    for i in range(5000):
        assert got[i] == (before[i % 2], total[i % 2])
        before[i % 2] += i % 7
