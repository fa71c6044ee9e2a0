"""Exact substring dedup by a depth-limited radix sort of suffixes.

A byte goes when a string of ``depth`` (50) bytes that covers it also starts in a document with a
smaller id. Suffixes are ordered only through their first ``depth`` bytes, most significant digits
first, and a group leaves the sort as soon as its outcome is known:

1. The suffixes that enter are the minimiser positions of the text: of each window of ``depth``
   bytes, the ``ANCHOR``-byte gram with the smallest hash. Equal windows hold equal grams at equal
   offsets, so every repeated window shares its gram. First digit: the gram. Grams of one document
   only are singletons and leave.
2. Second digit: the gram with all the bytes that any window around it can hold. A suffix whose
   whole neighbourhood occurs in a smaller document is settled: all its windows are repeated.
3. Last digits, for neighbourhoods that differ but share their gram (the ends of a repeated
   passage): each window of ``depth`` bytes by itself. Equal groups are the repeated windows.

Each pass sends, per block of documents, one record per distinct digit with the smallest document
that has it, so a digit that half of all documents share costs one record per block and no group
grows with its number of copies. Records are dealt by the digit's top bits; what comes back is one
bit or two per record. The blocks are one bucketed table in the checkpoint folder: passes read it
in place and only move digests. Digits are 64-bit hashes.

Defined cases: null text is empty; a null id counts as the smallest; rows that share an id do not
remove each other's bytes; texts shorter than ``depth`` stay whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultweave.llm import textbytes as tb
from vaultweave.llm.common import saved, shuffle_parts
from vaultweave.session import new_work_dir

DEPTH = 50
ANCHOR = 20
BLOCK_BYTES = 1 << 20
_U = np.uint64
_NULL_ID = np.iinfo(np.int64).min

GRAM, AREA, NEAR, WINDOW = 0, 1, 2, 3  # kinds of record


def _blocks(batches):
    """Packs consecutive documents into rows of about ``BLOCK_BYTES``."""
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids = batch.column(0).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
        data, offs = tb.utf8(batch.column(1))
        for i, j in tb.slabs(offs, BLOCK_BYTES):
            yield pa.RecordBatch.from_arrays([
                pa.array([part << 32 | n], pa.int64()),
                pa.array([ids[i:j].astype(np.int64).tobytes()], pa.binary()),
                pa.array([(offs[i:j + 1] - offs[i]).tobytes()], pa.binary()),
                pa.array([data[offs[i]:offs[j]].tobytes()], pa.binary())],
                ["block", "ids", "offs", "data"])
            n += 1


class _Block:
    """One block: its suffixes that enter the sort, and their digits."""

    def __init__(self, ids: bytes, offs: bytes, data: bytes, depth: int):
        self.ids, self.depth = np.frombuffer(ids, np.int64), depth
        self.offs, self.data = np.frombuffer(offs, np.int64), np.frombuffer(data, np.uint8)
        parts = [self._anchors(i, j) for i, j in tb.slabs(self.offs, tb.SLAB_BYTES)]
        self.gram, self.area, self.pos, self.doc = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.id = self.ids[self.doc]

    def _anchors(self, i: int, j: int):
        """Of rows i to j: gram, neighbourhood, place in the block and row of each anchor."""
        depth, w = self.depth, self.depth - ANCHOR + 1
        base = int(self.offs[i])
        o = self.offs[i:j + 1] - base
        d = self.data[base:int(self.offs[j])]
        if len(d) < depth:
            z = np.zeros(0, np.int64)
            return z.astype(np.uint64), z.astype(np.uint64), z, z
        roll = tb.Rolling(d)
        gram = roll.fixed(ANCHOR)
        least = tb.sliding(gram, w, np.minimum)
        end = np.repeat(o[1:], np.diff(o))[:len(least)]
        least = np.where(np.arange(len(least)) + depth <= end, least, _U(0))
        edge = np.zeros(w - 1, np.uint64)
        m = np.flatnonzero(tb.sliding(np.concatenate([edge, least, edge]), w, np.maximum) == gram)
        row = np.searchsorted(o, m, "right") - 1
        s, e = self._area(m, o[row], o[row + 1])
        area = tb.mix(roll.raw(s, e) + ((m - s) * 4096 + (e - m)).astype(np.uint64))
        return gram[m], area, m + base, row + i

    def _area(self, m, start, end):
        return np.maximum(m + ANCHOR - self.depth, start), np.minimum(m + self.depth, end)

    def windows(self, which: np.ndarray):
        """Starts and digests of the windows around the chosen anchors, each start once."""
        if not len(which):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        m, row = self.pos[which], self.doc[which]
        s, e = self._area(m, self.offs[row], self.offs[row + 1])
        n = np.maximum(np.minimum(m, e - self.depth) - s + 1, 0)
        first = np.repeat(s - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        at = np.unique(first + np.arange(len(first)))
        row = np.searchsorted(self.offs, at, "right") - 1
        out = np.empty(len(at), np.uint64)
        for i, j in tb.slabs(self.offs, tb.SLAB_BYTES):
            lo, hi = np.searchsorted(at, [self.offs[i], self.offs[j]])
            if hi > lo:
                p = at[lo:hi] - self.offs[i]
                out[lo:hi] = tb.mix(tb.Rolling(self.data[self.offs[i]:self.offs[j]]).raw(p, p + self.depth))
        return at, out, row


def _least(key: np.ndarray, value: np.ndarray):
    """Distinct keys in order, the least value of each, and where each entry's key stands."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    group = np.zeros(len(k), np.int64)
    group[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(k))))
    return k[first], np.minimum.reduceat(value[order], first) if len(k) else value[:0], group


class _Told:
    """The answers to a block's records: bits in the order of its distinct digits."""

    def __init__(self, answers):
        self.by = {}
        for a in sorted(answers or [], key=lambda a: (a["kind"], a["slot"])):
            self.by.setdefault(a["kind"], []).append(np.frombuffer(a["bits"], np.uint8))

    def bits(self, kind: int, n: int) -> np.ndarray:
        got = np.concatenate(self.by[kind]) if kind in self.by else np.zeros(0, np.uint8)
        assert len(got) == n, "answers do not fit the block"
        return got


def _gram_digits(b: _Block):
    key, least, at = _least(b.gram, b.id)
    _, most, _ = _least(b.gram, ~b.id)
    return key, least, at, least != ~most


def _shared(b: _Block, told: _Told) -> np.ndarray:
    """Anchors whose gram two documents hold."""
    key, _, at, two = _gram_digits(b)
    return np.flatnonzero((two | (told.bits(GRAM, len(key)) > 0))[at])


def _settle(b: _Block, told: _Told):
    """After the second digit: settled anchors; first holders of their neighbourhood whose gram has others."""
    live = _shared(b, told)
    akey, aleast, at = _least(b.area[live], b.id[live])
    hit = told.bits(AREA, len(akey)) > 0
    settled = hit[at] | (b.id[live] > aleast[at])
    gkey, gleast, gat = _least(b.gram[live], b.area[live])
    _, gmost, _ = _least(b.gram[live], ~b.area[live])
    other = (gleast != ~gmost) | (told.bits(NEAR, len(gkey)) > 0)
    return live[settled], live[~settled & other[gat]]


def _records(block: int, kind: int, key: np.ndarray, value: np.ndarray, slots: int):
    """One row per slot: digits (sorted) and their values."""
    cut = np.searchsorted((key >> _U(32)).astype(np.int64) * slots >> 32, np.arange(slots + 1))
    for s in range(slots):
        if cut[s + 1] > cut[s]:
            yield block, kind, s, key[cut[s]:cut[s + 1]].tobytes(), value[cut[s]:cut[s + 1]].tobytes()


ASK = "block long, kind int, slot int, keys binary, vals binary"
TOLD = "block long, kind int, slot int, bits binary"
_ASK = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("slot", pa.int32()), ("keys", pa.binary()), ("vals", pa.binary())])
_TOLD = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("slot", pa.int32()), ("bits", pa.binary())])


def _asker(stage: int, depth: int, slots: int):
    def ask(batches):
        for batch in batches:
            for r in batch.to_pylist():
                b = _Block(r["ids"], r["offs"], r["data"], depth)
                told = _Told(r.get("told"))
                if stage == 0:
                    key, least, _, _ = _gram_digits(b)
                    rows = list(_records(r["block"], GRAM, key, least, slots))
                elif stage == 1:
                    live = _shared(b, told)
                    key, least, _ = _least(b.area[live], b.id[live])
                    rows = list(_records(r["block"], AREA, key, least, slots))
                    gkey, low, _ = _least(b.gram[live], b.area[live])
                    _, high, _ = _least(b.gram[live], ~b.area[live])
                    # 0: several neighbourhoods here; else the only one
                    only = np.where(low == ~high, low | _U(1), _U(0))
                    rows += _records(r["block"], NEAR, gkey, only, slots)
                else:
                    _, ends = _settle(b, told)
                    _, key, row = b.windows(ends)
                    key, least, _ = _least(key, b.ids[row])
                    rows = list(_records(r["block"], WINDOW, key, least, slots))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _ASK, strict=True)], schema=_ASK)
    return ask


def _answer(group: pa.Table) -> pa.Table:
    """All records of one kind and slot, one per block and digit at most: what each block is told."""
    kind = group["kind"][0].as_py()
    keys = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["keys"].combine_chunks()]
    vals = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64 if kind == NEAR else np.int64) for x in group["vals"].combine_chunks()])
    cut = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    key = np.concatenate(keys)
    _, least, at = _least(key, vals)
    if kind in (AREA, WINDOW):  # a smaller document holds it
        bits = vals > least[at]
    elif kind == GRAM:  # another block holds it
        bits = np.bincount(at)[at] > 1
    else:  # another neighbourhood in some block
        _, most, _ = _least(key, ~vals)
        bits = ((least != ~most) | (least == 0))[at]
    bits = bits.astype(np.uint8)
    return pa.Table.from_arrays([group["block"], group["kind"], group["slot"],
                                 pa.array([bits[cut[i]:cut[i + 1]].tobytes() for i in range(len(keys))], pa.binary())], schema=_TOLD)


def _removed(b: _Block, told: _Told) -> np.ndarray:
    """Per byte of the block: is it covered by a repeated window?"""
    full, ends = _settle(b, told)
    at, key, row = b.windows(ends)
    wkey, least, where = _least(key, b.ids[row])
    hit = (told.bits(WINDOW, len(wkey)) > 0)[where] | (b.ids[row] > least[where])
    m = b.pos[full]
    s, e = b._area(m, b.offs[b.doc[full]], b.offs[b.doc[full] + 1])
    step = np.zeros(len(b.data) + 1, np.int64)
    np.add.at(step, np.concatenate([s, at[hit]]), 1)
    np.add.at(step, np.concatenate([e, at[hit] + b.depth]), -1)
    return np.cumsum(step[:-1]) > 0


def _finish(depth: int, with_text: bool):
    def finish(batches):
        for batch in batches:
            for r in batch.to_pylist():
                b = _Block(r["ids"], r["offs"], r["data"], depth)
                gone = _removed(b, _Told(r["told"]))
                runs = gone & ~np.concatenate([[False], gone[:-1]])
                runs[b.offs[:-1][np.diff(b.offs) > 0]] |= gone[b.offs[:-1][np.diff(b.offs) > 0]]
                out = []
                for i in range(len(b.ids)):
                    s, e = int(b.offs[i]), int(b.offs[i + 1])
                    keep = b.data[s:e][~gone[s:e]].tobytes()
                    out.append((None if b.ids[i] == _NULL_ID else int(b.ids[i]), e - s, int(gone[s:e].sum()),
                                int(runs[s:e].sum()), keep if with_text else hashlib.sha256(keep).hexdigest()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(),) * 4 + (pa.binary() if with_text else pa.string(),), strict=True)],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept" if with_text else "kept_sha256"])
    return finish


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                 with_text: bool = False) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans`` and the SHA-256 of the kept bytes
    (``with_text``: the kept bytes themselves, column ``kept``)."""
    spark = docs.sparkSession
    slots = 2 * shuffle_parts(spark)
    name, path = f"suffix_blocks_{uuid.uuid4().hex}", f"{new_work_dir(spark, 'suffix')}/blocks"
    blocks = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _blocks, "block long, ids binary, offs binary, data binary")
    (blocks.write.option("path", path).option("compression", "zstd").format("parquet").bucketBy(slots, "block").saveAsTable(name))
    try:
        told = None
        for stage in range(3):
            src = spark.table(name)
            if told is not None:
                src = src.join(told.hint("shuffle_hash"), "block", "left")
            asked = src.mapInArrow(_asker(stage, depth, slots), ASK)
            answer = asked.groupBy("kind", "slot").applyInArrow(_answer, TOLD)
            got = saved(answer, "suffix")
            told = got if told is None else told_rows.unionByName(got)
            told_rows = told
            told = told_rows.groupBy("block").agg(F.collect_list(F.struct("kind", "slot", "bits")).alias("told"))
        out = spark.table(name).join(told.hint("shuffle_hash"), "block", "left").mapInArrow(
            _finish(depth, with_text),
            "doc_id long, n_bytes long, n_removed long, n_spans long, " + ("kept binary" if with_text else "kept_sha256 string"))
        return saved(out, "suffix")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    from vaultweave.llm.common import table
    return suffix_dedup(table(spark, sf_dir, "documents"))
