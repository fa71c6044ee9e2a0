"""Toxicity scores from a factorization machine over hashed terms.

Terms are runs of letters and digits, lower-cased, and their beginnings of ``PREFIX`` characters (inflected
forms share a beginning); each distinct term is hashed to one of ``BUCKETS`` features. The score is
sigmoid(w0 + sum w_i + sum over pairs <v_i, v_j>) over the features of a text: the pairs, taken through
``FACTORS``-dimensional vectors, let two terms that are harmless alone count together, such as an insult and
the mention of a group.

The model is fitted on the driver on at most ``TRAIN_ROWS`` labelled rows outside the evaluation fold, taken in the
order of a hash of the id; nothing but text is an input of a score. Every hashed feature of these rows is learned, rare
or not: no feature is picked by its label. The penalties of ``fit`` hold back what few rows speak for, and a pair
grows from small random vectors as soon as it tells the labels apart. The size is bounded by ``BUCKETS``.

Defined cases: null, empty and termless texts get the score of the bias alone; without labelled rows, or
with one label only, every score is that label's share (0 without rows); repeated rows score alike, and of several
rows of one id in training the one with the least features counts; labels that are null, and repeated labels of one id
after the least, are not used; very long texts count whole, each feature once; other columns of any name are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultweave.llm import textbytes as tb
from vaultweave.llm.common import held_out, table

BUCKETS = 1 << 20
FACTORS = 4
PREFIX = 4
TRAIN_ROWS = 16_000
EPOCHS = 10
RATE = 0.5
V_RATE = 0.05
W_PENALTY = 2.0
V_PENALTY = 0.03
INIT = 0.01
_U = np.uint64


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct features of each text of a slab of lower-case UTF-8; offsets per text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = (data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | ((data >= 65) & (data <= 90))
    cut = np.zeros(len(data) + 1, bool)
    cut[offs] = True
    start = np.flatnonzero(solid[1:-1] & (~solid[:-2] | cut[:-1]))
    end = np.flatnonzero(solid[1:-1] & (~solid[2:] | cut[1:])) + 1
    doc = np.searchsorted(offs, start, "right") - 1
    roll = tb.Rolling(data)
    word = tb.mix(roll.raw(start, end))
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters before each byte
    first = np.flatnonzero((data & 0xC0) != 0x80)
    to = lead[start] + PREFIX
    stop = np.where(to < len(first), first[np.minimum(to, len(first) - 1)], len(data))
    long = stop < end
    begin = tb.mix(roll.raw(start[long], stop[long]) ^ _U(0xABCD))
    h = np.concatenate([word, begin]) & _U(BUCKETS - 1)
    both = np.unique(np.concatenate([doc, doc[long]]).astype(np.uint64) << _U(32) | h)
    of = (both >> _U(32)).astype(np.int64)
    return (both & _U(0xFFFFFFFF)).astype(np.int64), np.searchsorted(of, np.arange(len(offs)))


def _texts(col):
    """Feature arrays of consecutive rows: (first row, features, offsets)."""
    data, offs = tb.utf8(col)
    for i, j in tb.slabs(offs):
        raw = data[offs[i]:offs[j]].tobytes()
        o = offs[i:j + 1] - offs[i]
        low = [raw[o[k]:o[k + 1]].decode("utf-8", "replace").lower().encode("utf-8", "replace") for k in range(j - i)]
        yield (i, *features(np.frombuffer(b"".join(low), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in low])]).astype(np.int64)))


class FactorizationMachine:
    """w0, w and v; features that no training row holds share the last, zero, entry."""

    def __init__(self, buckets: int, known: np.ndarray, factors: int, seed: int = 7):
        self.index = np.full(buckets, len(known), np.int32)
        self.index[known] = np.arange(len(known), dtype=np.int32)
        self.w0, self.w = 0.0, np.zeros(len(known) + 1, np.float32)
        self.v = np.random.default_rng(seed).normal(0, INIT, (len(known) + 1, factors)).astype(np.float32)
        self.v[-1] = 0

    def raw(self, feats: np.ndarray, offs: np.ndarray):
        """Scores before the sigmoid; known features, their text and the summed vectors of each text."""
        at = self.index[feats]
        use = at < len(self.w) - 1
        n = len(offs) - 1
        doc = np.repeat(np.arange(n), np.diff(offs))[use]
        at = at[use]
        lin = np.bincount(doc, self.w[at], n)
        v = self.v[at]
        total = np.stack([np.bincount(doc, v[:, f], n) for f in range(v.shape[1])], 1)
        square = np.bincount(doc, (v * v).sum(1), n)
        return self.w0 + lin + 0.5 * ((total ** 2).sum(1) - square), at, doc, total

    def fit(self, feats: list[np.ndarray], label: np.ndarray, epochs: int = EPOCHS, batch: int = 128, seed: int = 11):
        """AdaGrad with a rate that falls to 0. After each step w is shrunk by a constant (an L1 penalty of ``W_PENALTY``
        on the summed loss) and v by a share (an L2 penalty of ``V_PENALTY`` on the mean loss); a feature's penalty is spread
        over its steps."""
        rng = np.random.default_rng(seed)
        n, steps = len(label), -(-len(label) // batch)
        held = np.bincount(self.index[np.concatenate(feats)], minlength=len(self.w))
        spread = (steps / np.clip(held, 1, steps)).astype(np.float32)
        g0, gw, gv = 1e-6, np.full(self.w.shape, 1e-6), np.full(self.v.shape, 1e-6)
        share = np.clip(label.mean(), 1e-3, 1 - 1e-3)
        self.w0 = float(np.log(share / (1 - share)))
        for epoch in range(epochs):
            rate = RATE * (1 - epoch / epochs)
            order = rng.permutation(n)
            for s in range(0, n, batch):
                pick = order[s:s + batch]
                x = [feats[i] for i in pick]
                z, at, doc, total = self.raw(np.concatenate(x), np.concatenate([[0], np.cumsum([len(f) for f in x])]))
                err = (sigmoid(z) - label[pick]) / len(pick)
                cols, inv = np.unique(at, return_inverse=True)
                e = err[doc]
                dw = np.bincount(inv, e, len(cols))
                own = self.v[at]
                step = e[:, None] * (total[doc] - own)
                dv = np.stack([np.bincount(inv, step[:, f], len(cols)) for f in range(own.shape[1])], 1)
                gw[cols] += dw ** 2
                gv[cols] += dv ** 2
                g0 += err.sum() ** 2
                to = rate / np.sqrt(gw[cols])
                w = self.w[cols] - to * dw
                self.w[cols] = np.sign(w) * np.maximum(np.abs(w) - to * W_PENALTY / n * spread[cols], 0)
                to = rate * V_RATE / np.sqrt(gv[cols])
                self.v[cols] = (self.v[cols] - to * dv) / (1 + to * V_PENALTY * spread[cols][:, None])
                self.w0 -= rate * 0.1 * err.sum() / np.sqrt(g0)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> FactorizationMachine:
    """``docs``: doc_id, text; ``labels``: doc_id, toxic."""
    picked = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))

    def run(batches):
        for batch in batches:
            for i, feats, offs in _texts(batch.column(1)):
                out = [feats[offs[k]:offs[k + 1]].astype(np.int32).tobytes() for k in range(len(offs) - 1)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(out)), batch.column(2).slice(i, len(out)), pa.array(out, pa.binary())], ["doc_id", "toxic", "x"])

    got = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")  # at most train_rows
           .select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
           .mapInArrow(run, "doc_id long, toxic int, x binary")
           .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.min("x").alias("x"))  # one row of each id
           .toArrow().sort_by([("doc_id", "ascending")]))
    feats = [np.frombuffer(x.as_buffer(), np.int32) for chunk in got["x"].chunks for x in chunk]
    label = got["toxic"].to_numpy().astype(np.float64) if got.num_rows else np.zeros(0)
    if not len(label) or label.min() == label.max():
        model = FactorizationMachine(BUCKETS, np.zeros(0, np.int64), FACTORS)
        model.w0 = 60.0 if len(label) and label[0] else -60.0
        return model
    model = FactorizationMachine(BUCKETS, np.unique(np.concatenate(feats)), FACTORS)
    model.fit(feats, label)
    return model


def score(docs: DataFrame, model: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` per row."""

    def run(batches):
        for batch in batches:
            s = np.zeros(batch.num_rows)
            for i, feats, offs in _texts(batch.column(1)):
                s[i:i + len(offs) - 1] = sigmoid(model.raw(feats, offs)[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, "doc_id long, score double, predicted int")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
