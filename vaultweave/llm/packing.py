"""Packing documents into sequences along a space-filling curve.

A document's ids, then one end id, form a stream with those of all other documents, in the order of a
Hilbert curve, and the stream is cut every ``LENGTH`` ids: neighbours in a sequence are neighbours on
the curve. A document's point: its ids, hashed to +-1 per dimension (a random projection of the hashed
term counts), averaged and put on a grid of ``2**GRID_BITS`` steps per dimension.

The order key is the curve position, then a hash of the id, so that copies of one text, which share a
point, still spread over the ranges. Steps: tokenize once into a table; take range bounds from its
keys; sum the ids of each range; deal the rows to their ranges, and number them with a running sum on
top of the range's first place. Only one number per range passes through the driver. The stream's end,
shorter than ``LENGTH``, is cut into pieces whose lengths are powers of two, which need no padding.

Texts are cut where no token of the tokenizer can cross, at white space and where a letter meets an ASCII sign,
and each word is encoded by the library once per process; the ids are those of the whole text.

Defined cases: null and empty texts have just the end id; rows that share an id are packed one by one;
a null id sorts first; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultweave.llm import textbytes as tb
from vaultweave.llm.common import saved, shuffle_parts, table

LENGTH = 2048
END_ID = 1
DIMS = 3
GRID_BITS = 10
MAX_WORDS = 700_000
#: a word may also end where a letter a-z meets an ASCII sign: the library parts letters from signs
_LETTER_THEN_SIGN = (np.array([97 <= b <= 122 for b in range(256)]), np.array([33 <= b <= 47 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 126 for b in range(256)]))
_LOADED: dict[str, Encoder] = {}


def hilbert(points: np.ndarray, bits: int = GRID_BITS) -> np.ndarray:
    """Position on the Hilbert curve of each row of grid coordinates (below 2**bits).

    Bits are taken from the top: each level's cell gives one digit of the position, in the reflected order
    (Gray code) that keeps neighbouring cells adjacent, and turns the axes for the levels below."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    top = np.int64(1) << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            on = (x[i] & q) > 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip = np.where((x[n - 1] & q) > 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | (x[i] >> b & 1)
    return out


class Encoder:
    """Ids of whole texts, with those of each blank-delimited piece remembered."""

    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        size = self.library.get_vocab_size(with_added_tokens=True)
        letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        self.folds = self.library.encode(letters).ids == self.library.encode(letters.lower()).ids
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        term = tb.mix(np.arange(size, dtype=np.uint64) + np.uint64(0x51ED))
        self.project = np.stack([np.where(term >> np.uint64(b) & np.uint64(1), 1, -1) for b in range(DIMS)], 1).astype(np.int64)
        self.marks = [t.content for t in self.library.get_added_tokens_decoder().values()]
        suffix = json.loads(self.library.to_str())["model"].get("end_of_word_suffix") or ""
        #: ids that end a word of letters only or of signs only
        self.last = np.array([bool(suffix) and (self.library.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        self._forget()

    def _forget(self) -> None:
        """Known words: sorted hashes, and of each the place and number of its ids in the pool."""
        self.known, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.at, self.size, self.pool, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1 << 20, self.kind), 0

    def _learn(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, end to end, and their numbers. Plain words go to the library many at a time."""
        got: list = [None] * len(keys)
        plain = []
        for i, k in enumerate(keys):
            w = k.decode("utf-8", "replace")
            if w.isalpha() or (w.isascii() and w.isprintable() and not any(c.isalnum() or c in "' " for c in w) and not any(m in w for m in self.marks)):
                plain.append((i, w))
            else:
                got[i] = np.array(self.library.encode_batch_fast([w], add_special_tokens=False)[0].ids, self.kind)
        for s in range(0, len(plain), 2048):
            part = plain[s:s + 2048]
            ids = np.array(self.library.encode_batch_fast([" ".join(w for _, w in part)], add_special_tokens=False)[0].ids, self.kind)
            stop = np.flatnonzero(self.last[ids]) + 1
            if len(stop) == len(part) and stop[-1] == len(ids):
                for (i, _), x in zip(part, np.split(ids, stop[:-1]), strict=True):
                    got[i] = x
            else:  # a tokenizer without word ends
                for (i, w), e in zip(part, self.library.encode_batch_fast([w for _, w in part], add_special_tokens=False), strict=True):
                    got[i] = np.array(e.ids, self.kind)
        return np.concatenate(got), np.array([len(g) for g in got], np.int64)

    def _rows(self, h: np.ndarray, keys) -> np.ndarray:
        """Rows of the words with sorted distinct hashes ``h``; ``keys(which)`` gives the bytes of those not yet known."""
        if len(self.known) + len(h) > MAX_WORDS:
            self._forget()
        place = np.searchsorted(self.known, h)
        hit = self.known[np.minimum(place, len(self.known) - 1)] == h if len(self.known) else np.zeros(len(h), bool)
        new = np.flatnonzero(~hit)
        if len(new):
            ids, size = self._learn(keys(new))
            while self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[self.used:self.used + len(ids)] = ids
            self.row = np.insert(self.row, place[new], len(self.size) + np.arange(len(new)))
            self.known = np.insert(self.known, place[new], h[new])
            self.at = np.concatenate([self.at, self.used + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.used += len(ids)
            place = np.searchsorted(self.known, h)
        return self.row[place]

    def slab(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a slab, each with the end id; offsets per text. Words are told apart by 64-bit hashes."""
        raw = data.tobytes()
        plain = not any(m.encode() in raw for m in self.marks)
        if self.folds and plain:  # A-Z only, as the library will: fewer distinct words
            data = tb.ascii_lower(data)
            raw = data.tobytes()
        start, end, doc = tb.words(data, offs, _LETTER_THEN_SIGN if plain else None)
        h, first, of = np.unique(tb.mix(tb.Rolling(data).raw(start, end) + (end - start).astype(np.uint64)), return_index=True, return_inverse=True)
        row = self._rows(h, lambda which: [raw[a:b] for a, b in zip(start[first[which]].tolist(), end[first[which]].tolist(), strict=True)])[of]
        n = self.size[row]
        place = np.cumsum(n) - n
        total = int(n.sum())
        token_doc = np.repeat(doc, n)
        out = np.empty(total + len(offs) - 1, self.kind)
        out[np.arange(total) + token_doc] = self.pool[np.repeat(self.at[row] - place, n) + np.arange(total)]
        ends = np.cumsum(np.bincount(token_doc, minlength=len(offs) - 1) + 1)
        out[ends - 1] = END_ID
        return out, np.concatenate([[0], ends])

    def curve(self, ids: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Curve position of each document of a run of ids (none is empty)."""
        sums = np.add.reduceat(self.project[ids], offs[:-1], axis=0)
        mean = sums / np.diff(offs)[:, None]
        grid = np.clip((np.clip(2 * mean, -1, 1) + 1) / 2 * (1 << GRID_BITS), 0, (1 << GRID_BITS) - 1)
        return hilbert(grid.astype(np.int64))


def encoder(file: str) -> Encoder:
    if file not in _LOADED:
        _LOADED[file] = Encoder(file)
    return _LOADED[file]


def _tokenize(file: str):
    def run(batches):
        enc = encoder(file)
        for batch in batches:
            data, offs = tb.utf8(batch.column(1))
            for i, j in tb.slabs(offs):
                ids, o = enc.slab(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                raw = pa.py_buffer(ids.view(np.uint8))
                got = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer((o * ids.itemsize).astype(np.int32)), raw])
                curve, n = enc.curve(ids, o), np.diff(o)
                doc = batch.column(0).slice(i, j - i)
                yield pa.RecordBatch.from_arrays([doc, pa.array(curve), pa.array(n), got], ["doc_id", "curve", "n", "ids"])
    return run


def _pieces(length: int, total: int, width: int, with_ids: bool):
    kind = {2: np.uint16, 4: np.uint32}[width]
    full, rest = divmod(total, length)
    ends = np.cumsum([1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1], dtype=np.int64) + full * length
    tail = np.concatenate([[full * length], ends]).astype(np.int64)

    def run(batches):
        for batch in batches:
            out = []
            for doc, at, n, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                wide = np.frombuffer(ids, kind).astype("<u4")
                p = at
                while p < at + n:
                    if p < full * length:
                        seq, first, stop = p // length, p // length * length, (p // length + 1) * length
                    else:
                        t = int(np.searchsorted(tail, p, "right")) - 1
                        seq, first, stop = full + t, int(tail[t]), int(tail[t + 1])
                    q = min(at + n, stop)
                    piece = wide[p - at:q - at].tobytes()
                    out.append((doc, p - at, q - p, zlib.crc32(piece), n, seq, p - first) + ((piece,) if with_ids else ()))
                    p = q
            cols = list(zip(*out, strict=True)) if out else [()] * (7 + with_ids)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if m == "ids" else pa.int64()) for c, m in zip(cols, names, strict=True)], names)
    return run


def pack(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and the ids as
    little-endian unsigned 32-bit numbers). The tokenizer file must be readable on the executors."""
    spark = docs.sparkSession
    width = 2 if encoder(tokenizer_file).kind is np.uint16 else 4
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(_tokenize(tokenizer_file), "doc_id long, curve long, n long, ids binary")
    key = F.shiftleft(F.col("curve"), 24).bitwiseOR(F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 24) - 1)))
    rows = saved(rows.withColumn("key", key), "pack")
    ranges = 2 * shuffle_parts(spark)
    cuts = rows.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)] or [0.5], 10000)).first()[0] or []
    bounds = F.array(*[F.lit(c).cast("long") for c in sorted(set(cuts))]) if cuts else F.array().cast("array<long>")
    rows = rows.withColumn("range", F.size(F.filter(bounds, lambda b: b <= F.col("key"))))
    first, total = {}, 0
    for r, n in sorted(rows.groupBy("range").agg(F.sum("n")).collect()):  # one row per range
        first[r], total = total, total + n
    base = F.element_at(F.array(*[F.lit(first.get(r, 0)).cast("long") for r in range(max(first, default=0) + 1)]), F.col("range") + 1)
    order = Window.partitionBy("range").orderBy("key", "doc_id", "n", "ids").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.select("doc_id", (base + F.sum("n").over(order) - F.col("n")).alias("at"), "n", "ids")
    names = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.mapInArrow(_pieces(length, total, width, with_ids), names + (", ids binary" if with_ids else ""))


def op8_curve_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
