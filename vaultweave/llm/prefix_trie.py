"""Conversation prefix trie by ROLLUP over positional turn-id columns.

A turn's id is a 96-bit number hashed from its role, its text and its place; a prefix of a conversation is named
by the sum of its turns' ids, so names of prefixes come from running sums and no conversation is gathered whole.
Conversations are cut into blocks of ``BLOCK`` turns: one row per block, the block's turn ids side by side in
positional columns, keyed by the node that the block before it ends in. One ``GROUP BY block, prior, ROLLUP(t1, ...)``
then yields every prefix of every conversation at once, and ``grouping_id`` tells how many of the columns a row kept,
that is its depth inside the block; long conversations just have more blocks, all in the same aggregate. Equal
prefixes are merged before the shuffle, so a first turn shared by a third of all rows is no hot key.

Totals over subtrees need no walk: every node is represented by its smallest member, whose path holds all its
ancestors. What a node adds (saved tokens; one for a childless node) is put on its representative's turns, summed
from each turn to the end of that conversation, and a second ROLLUP over the same blocks sums it for all prefixes.

Positions of turns come from a range sort written once with the number of its partition, so one conversation may
span many tasks; running sums over blocks are taken in two steps (``sums_before``).

Defined cases: rows without a conv_id belong to no conversation; a null turn sorts first; turns of one conversation
that share a turn number are ordered by a hash of role and text, and repeated rows are repeated turns; null role or
text is empty, and empty turns are turns; very long texts are only hashed and counted; an empty table gives no nodes;
other input columns, whatever their names, take no part.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultweave.llm.common import CRC_TABLE_SQL, crc_sql, saved, sums_before, table

BLOCK = 8
CHUNK = 4096
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_ID = "decimal(38,0)"


def turn_ids(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, tid, words``: 128 bits that stand for role and text, and the number of the text's words."""
    who, what = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    whole = F.concat(F.length(who).cast("string"), F.lit(":"), who, what)
    return rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("tid"),
        F.size(F.regexp_extract_all(what, F.lit(WORD), F.lit(0))).alias("words"))


def positions(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their place: rows ``conv_id, part, near, tid, words`` and cells ``conv_id, part, n, n_before, n_total``;
    a turn's place, from 1, is ``near + n_before``."""
    rows = saved(ids.repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), "tid").withColumn("part", F.spark_partition_id()), "trie")
    of = Window.partitionBy("conv_id")
    cells = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select("*", F.coalesce(before, F.lit(0)).alias("n_before"), F.sum("n").over(of).alias("n_total"))
    order = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "tid")
    return rows.select("conv_id", "part", F.row_number().over(order).alias("near"), "tid", "words"), saved(cells, "trie")


def _place_id():
    """The 96-bit id of a turn at its place."""
    digest = F.md5(F.concat_ws(":", F.col("pos").cast("string"), F.hex("tid")))
    part = lambda a: F.conv(F.substring(digest, a, 12), 16, 10).cast("decimal(18,0)")
    return (part(1) * F.lit(1 << 48).cast("decimal(18,0)") + part(13)).cast(_ID)


def _rolled(blocks: DataFrame, aggregates: str) -> DataFrame:
    """Every prefix of ``blocks``: ``depth, node, parent, words`` and the aggregates over the conversations in it."""
    turns = ", ".join(f"t{k}" for k in range(1, BLOCK + 1))
    rolled = blocks.sparkSession.sql(f"""SELECT block, prior, {turns}, {BLOCK} - bit_count(grouping_id()) AS level, {aggregates}
        FROM {{blocks}} GROUP BY block, prior, ROLLUP({turns})""", blocks=blocks)
    kept = F.slice(F.array(*[f"t{k}" for k in range(1, BLOCK + 1)]), 1, F.col("level"))
    last = F.when(F.col("level") > 0, F.element_at(kept, F.greatest(F.col("level"), F.lit(1))))
    rolled = rolled.withColumn("kept", kept).withColumn("last", last)
    node = F.aggregate("kept", F.col("prior"), lambda a, t: (a + t["id"]).cast(_ID))
    names = [c for c in rolled.columns if c not in {"block", "prior", "kept", "last", *turns.split(", ")}]
    return (rolled.where("(level = 0 AND block = 0) OR last IS NOT NULL")
            .select((F.col("block") * BLOCK + F.col("level")).alias("depth"), node.alias("node"),
                    (node - F.col("last.id")).cast(_ID).alias("parent"), F.coalesce("last.words", F.lit(0)).alias("words"), *names))


def _blocks(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per conversation and block: ``conv_id, block, prior, t1..``; a conversation without turns has an empty one."""
    t = turns.withColumn("id", _place_id()).withColumn("block", F.floor((F.col("pos") - 1) / BLOCK)).withColumn("k", F.pmod(F.col("pos") - 1, F.lit(BLOCK)) + 1)
    at = lambda c, k: F.max(F.when(F.col("k") == k, F.col(c)))
    cols = [a for k in range(1, BLOCK + 1) for a in (at("id", k).alias(f"i{k}"), at("words", k).alias(f"w{k}"))]
    blocks = t.groupBy("conv_id", "block").agg(F.sum("id").cast(_ID).alias("id"), F.count("*").alias("n"), *cols)
    blocks = sums_before(blocks, ["conv_id"], "block", ["id", "n"])
    blocks = blocks.withColumn("id_before", F.col("id_before").cast(_ID))
    empty = convs.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").withColumn("block", F.lit(0).cast("long"))
    turn = lambda k: F.when(F.col(f"i{k}").isNotNull(), F.struct(F.col(f"i{k}").alias("id"), F.col(f"w{k}").alias("words"))).alias(f"t{k}")
    blocks = blocks.unionByName(empty, allowMissingColumns=True)
    return saved(blocks.select("conv_id", "block", F.coalesce("id_before", F.lit(0)).cast(_ID).alias("prior"),
                               F.coalesce("id_total", F.lit(0)).cast(_ID).alias("end"), F.coalesce("n_total", F.lit(0)).alias("turns"),
                               *[turn(k) for k in range(1, BLOCK + 1)]), "trie")


def _subtree_sums(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """``depth, node, n_leaves, saved_tokens``: what the nodes of each subtree add, through their smallest members."""
    slot = F.pmod(F.greatest(F.col("depth"), F.lit(1)) - 1, F.lit(BLOCK)) + 1
    adds = nodes.select("conv_id", F.floor((F.greatest(F.col("depth"), F.lit(1)) - 1) / BLOCK).alias("block"), slot.alias("k"),
                        ((F.col("n_convs") - 1) * F.col("words")).alias("v"), (F.col("n_children") == 0).cast("long").alias("leaf"))
    adds = adds.groupBy("conv_id", "block").agg(F.sum("v").alias("v"), F.sum("leaf").alias("leaf"),
                                                *[F.sum(F.when(F.col("k") == k, F.col("v")).otherwise(0)).alias(f"v{k}") for k in range(1, BLOCK + 1)])
    rows = blocks.join(adds, ["conv_id", "block"], "left").fillna(0, ["v", "leaf", *[f"v{k}" for k in range(1, BLOCK + 1)]])
    rows = sums_before(rows, ["conv_id"], "block", ["v", "leaf"])
    later = F.col("v_total") - F.col("v_before")
    cols, sums = [later.alias("s0")], later
    for k in range(1, BLOCK + 1):
        cols.append(sums.alias(f"s{k}"))
        sums = sums - F.col(f"v{k}")
    rows = rows.select("block", "prior", *[f"t{k}" for k in range(1, BLOCK + 1)], *cols, (F.col("leaf_total") - F.col("leaf_before")).alias("leaf"))
    totals = ", ".join(f"sum(s{k}) AS s{k}" for k in range(BLOCK + 1))
    rolled = _rolled(rows.where("s0 > 0 OR leaf > 0"), f"sum(leaf) AS n_leaves, {totals}")
    at = F.element_at(F.array(*[f"s{k}" for k in range(BLOCK + 1)]), F.col("level") + 1)
    return rolled.select("depth", "node", "n_leaves", at.alias("saved_tokens"))


def prefix_trie(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie of ``turns`` (``conv_id, pos`` from 1 without gaps, ``tid, words``) of the conversations ``convs`` (``conv_id``,
    each once). Nodes: ``conv_id`` (smallest member), ``depth, node, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens``.
    Ends: ``conv_id, depth, node``, the node that holds each whole conversation."""
    blocks = _blocks(convs, turns)
    nodes = saved(_rolled(blocks, "count(*) AS n_convs, min(conv_id) AS conv_id").drop("level"), "trie")
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids, ["depth", "node"], "left").fillna(0, ["n_children"])
    nodes = saved(nodes, "trie")
    parents = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(parents, ["depth", "parent"], "left").join(_subtree_sums(blocks, nodes), ["depth", "node"], "left")
    ends = blocks.where("block = 0").select("conv_id", F.col("turns").alias("depth"), F.col("end").alias("node"))
    return out.select("conv_id", "depth", "node", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
                      F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens")), ends


def _hash_chunks(batches):
    """SHA-256 over the chunks of each node, which arrive in order; only the running digest is held."""
    key, digest = None, None
    schema = pa.schema([("depth", pa.int64()), ("node", pa.decimal128(38, 0)), ("ends_sha256", pa.string())])

    def done(rows):
        cols = list(zip(*rows)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    for b in batches:
        out = []
        for depth, node, ids in zip(*(b.column(c).to_pylist() for c in ("depth", "node", "ids"))):
            if (depth, node) != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (depth, node), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield done(out)
    if key is not None:
        yield done([(*key, digest.hexdigest())])


def ends_digest(ends: DataFrame) -> DataFrame:
    """``depth, node, ends_sha256`` over each node's conversation ids, joined by commas in numeric order. Ids are joined
    in chunks of at most ``CHUNK`` first; one task then runs the digest, which has no parallel form, over a node's chunks."""
    chunks = ends.groupBy("depth", "node", F.floor(F.col("conv_id") / CHUNK).alias("chunk")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    chunks = chunks.select("depth", "node", "chunk", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    return (chunks.repartition("depth", "node").sortWithinPartitions("depth", "node", "chunk")
            .mapInArrow(_hash_chunks, f"depth long, node {_ID}, ends_sha256 string"))


def with_shared_heads(rows: DataFrame, cells: DataFrame, every: int = 20) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt so that prefixes are shared: each takes the first ``h`` turns of the conversation whose id is
    the next lower multiple of ``every``, then its own turns after its first ``h``, with ``h`` = crc32(id) % 4."""
    c = F.col("conv_id")
    convs = cells.groupBy("conv_id").agg(F.max("n_total").alias("n_own"))
    convs = convs.select("conv_id", (F.crc32(c.cast("string").cast("binary")) % 4).alias("h"), (c - c % every).alias("base"))
    of_base = cells.groupBy(c.alias("base")).agg(F.max("n_total").alias("n_base"))
    convs = saved(convs.join(of_base, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("head")), "trie")
    places = cells.join(convs, "conv_id").select("conv_id", "part", "n_before", "h", "head")
    own = rows.join(places, ["conv_id", "part"]).withColumn("pos", F.col("near") + F.col("n_before"))
    heads = own.where(f"pos <= 3 AND conv_id % {every} = 0").select(F.col("conv_id").alias("base"), "pos", "tid", "words")
    heads = convs.where("h > 0").join(heads, "base").where("pos <= h").select("conv_id", "pos", "tid", "words")
    own = own.where("pos > h").select("conv_id", (F.col("head") + F.col("pos") - F.col("h")).alias("pos"), "tid", "words")
    return convs.select("conv_id"), saved(own.unionByName(heads), "trie")


def op12_conversation_prefix_trie(spark, sf_dir: str) -> DataFrame:
    rows, cells = positions(turn_ids(table(spark, sf_dir, "conversations")))
    nodes, ends = prefix_trie(*with_shared_heads(rows, cells))
    out = nodes.join(ends_digest(ends), ["depth", "node"], "left")
    longs = ["depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return out.select("conv_id", *[F.col(x).cast("long").alias(x) for x in longs], F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


OP12_SQL = f"""
WITH {CRC_TABLE_SQL},
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY pos) AS own FROM turns GROUP BY conv_id),
rebuilt AS (SELECT l.conv_id, list_concat(list_slice(coalesce(b.own, []), 1, h), list_slice(l.own, h + 1, len(l.own))) AS seq
  FROM (SELECT *, {crc_sql("conv_id::VARCHAR")} % 4 AS h FROM lists, crc) l LEFT JOIN lists b ON b.conv_id = l.conv_id - l.conv_id % 20),
member AS (SELECT conv_id, len(seq) AS n, unnest(range(0, len(seq) + 1)) AS depth, seq FROM rebuilt),
prefix AS (SELECT conv_id, n, depth, list_slice(seq, 1, depth) AS path FROM member),
node AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(CASE WHEN n = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM prefix GROUP BY depth, path),
kids AS (SELECT depth - 1 AS depth, list_slice(path, 1, depth - 1) AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
adds AS (SELECT node.*, coalesce(kids.n, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE
  (n_convs - 1) * len(regexp_extract_all(path[depth].text, '[^\\x20\\x09-\\x0D]+')) END AS saved FROM node LEFT JOIN kids USING (depth, path)),
up AS (SELECT unnest(range(0, depth + 1)) AS top, path, (n_children = 0)::INT AS leaf, saved FROM adds),
sums AS (SELECT top AS depth, list_slice(path, 1, top) AS path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY ALL)
SELECT a.conv_id, a.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
  s.saved_tokens::BIGINT AS saved_tokens, a.ends_sha256
FROM adds a JOIN sums s USING (depth, path) LEFT JOIN node p ON a.depth > 0 AND p.depth = a.depth - 1 AND p.path = list_slice(a.path, 1, a.depth - 1)
"""
