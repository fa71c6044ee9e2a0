"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
from conftest import SF001
from pyspark.sql import functions as F

from vaultweave.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, rebuild=True):
    convs = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            convs[r[0]].append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    h = lambda c: zlib.crc32(str(c).encode()) % 4
    seqs = {c: (own.get(c - c % 20, [])[:h(c)] + own[c][h(c):] if rebuild else own[c]) for c in own}
    members = defaultdict(list)
    for c in sorted(seqs):
        for d in range(len(seqs[c]) + 1):
            members[tuple(seqs[c][:d])].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        gain = (len(m) - 1) * len(WORDS.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += gain
    ends = lambda p, m: hashlib.sha256(",".join(str(c) for c in m if len(seqs[c]) == len(p)).encode()).hexdigest()
    return sorted((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids.get(p, 0), leaves[p], saved[p], ends(p, m))
                  for p, m in members.items())


COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def run(spark, rows, rebuild, monkeypatch=None, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    placed, cells = T.positions(T.turn_ids(df))
    if rebuild:
        nodes, ends = T.prefix_trie(*T.with_shared_heads(placed, cells))
    else:
        turns = placed.join(cells, ["conv_id", "part"]).select("conv_id", (F.col("near") + F.col("n_before")).alias("pos"), "tid", "words")
        nodes, ends = T.prefix_trie(turns.select("conv_id").distinct(), turns)
    out = nodes.join(T.ends_digest(ends), ["depth", "node"], "left").fillna(T.EMPTY_SHA, ["ends_sha256"])
    return sorted((tuple(r) for r in out.select(*COLS).collect()), key=str), df


def test_op12_equals_the_dictionary_and_the_sql(spark):
    rows = spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = sorted(T.op12_conversation_prefix_trie(spark, SF001).select(*COLS).collect(), key=str)
    want = sorted(brute(rows), key=str)
    assert [tuple(r) for r in got] == want
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{SF001}/conversations.parquet')")
    assert sorted(con.execute(f"select {', '.join(COLS)} from ({T.OP12_SQL})").fetchall(), key=str) == want


def test_long_shared_and_odd_conversations(spark):
    base = [("user", f"word{i} and more") for i in range(70)]
    rows = [(c, i, *t) for c in (1, 2, 3, 40, 47) for i, t in enumerate(base[:70 - c])]                # shared over many blocks
    rows += [(5, i, *t) for i, t in enumerate(base[:20] + [("user", "other")] * 21)]
    rows += [(6, None, None, None), (6, 0, "user", ""), (7, 3, "user", "a b"), (7, 3, "user", "a b"), (8, None, None, None)]
    rows += [(9, 0, "", ""), (-3, 1, "user", " \t\n"), (None, 0, "user", "lost"), (62, 0, "x", "only"), (63, 0, "y", "short")]
    rows += [(10_000 + c, 0, "user", "hello there") for c in range(60)] + [(30_000, 0, "system", "long " * 20_000)]
    for rebuild in (False, True):
        got, _ = run(spark, rows, rebuild)
        assert got == sorted(brute(rows, rebuild), key=str)
    assert any(r[1] == 0 and r[3] > 60 for r in got) and max(r[1] for r in got) >= 60


def test_conversations_spread_over_partitions_and_digest_chunks(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(1, i, "user", f"t{i % 3}") for i in range(300)] + [(c, 0, "user", "same") for c in range(100, 160)]
        got, _ = run(spark, rows, False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == sorted(brute(rows, False), key=str)


def test_empty_table_and_extra_columns(spark):
    empty, _ = run(spark, [], True)
    assert empty == []
    rows = [(c, i, "user", f"w {i} {c % 2}") for c in range(25) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("pos", "tid", "part", "block", "node", "n", "words", "h"):
        df = df.withColumn(c, F.lit("x"))
    placed, cells = T.positions(T.turn_ids(df))
    nodes, _ = T.prefix_trie(*T.with_shared_heads(placed, cells))
    assert nodes.count() == len(brute(rows))


def test_one_rollup_aggregate_for_all_blocks(spark):
    import contextlib
    import io

    rows = [(c, i, "user", f"w{i}") for c in range(3) for i in range(30)]
    placed, cells = T.positions(T.turn_ids(spark.createDataFrame(rows, SCHEMA)))
    turns = placed.join(cells, ["conv_id", "part"]).select("conv_id", (F.col("near") + F.col("n_before")).alias("pos"), "tid", "words")
    blocks = T._blocks(turns.select("conv_id").distinct(), turns)
    assert blocks.count() == 3 * 4
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        T._rolled(blocks, "count(*) AS n").explain()
    assert buf.getvalue().count("Expand [") == 1 and "Python" not in buf.getvalue()
