"""Periodic run detection with grammar extensions.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal), at least
``max(least, times * q)`` words long, that no neighbouring word extends. Such a run holds two places ``x`` and
``x + q`` with ``x`` on the grid of step ``(times - 2) * q``, and every word from ``x`` to ``x + q`` equals the one ``q`` later.
So for each period only the grid (in total n * (1 + 1/2 + 1/3 + ...) / (times - 2) places) is compared, and
places that agree are candidates. Exact extensions to both sides come from longest common extensions in a run-length
grammar built by recompression (``recompression``), with no suffix array; the grammar covers the texts that hold
candidates. A stretch found with several periods is kept with the smallest.

Spark deals the documents; a task works on slabs of whole texts (``textbytes``), so memory is bounded by the slab or
one longer text, and no document meets another: there is no shuffle. Words are told apart by 64-bit hashes.

Defined cases: null, empty and blank texts have no words, no runs and an empty collapsed text; very long texts are
searched whole; rows are judged one by one, so repeated rows, equal texts and null ids change nothing; an empty table
gives no rows; other columns pass through, and an input column named ``runs`` or ``collapsed`` keeps its values, the
new one is called ``runs_found`` or ``collapsed_text``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from vaultweave.llm.common import table
from vaultweave.llm.recompression import extensions, grammar, mirror
from vaultweave.llm.textbytes import Rolling, mix, slabs, utf8, words

TIMES, LEAST = 4, 6
#: extensions asked for at a time
ASK = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"


def _candidates(seq: np.ndarray, longest: int, times: int, least: int):
    """Grid places ``x`` and periods whose words from ``x`` on look periodic. ``longest``: words of the longest text."""
    n = len(seq)
    for q in range(1, longest // times + 1):
        step = (times - 2) * q
        x = np.flatnonzero(seq[:max(0, n - 2 * q):step] == seq[q:max(q, n - q):step]) * step
        for off in (q, 1, q // 2):
            if not len(x):
                break
            x = x[seq[x + off] == seq[x + off + q]]
        if len(x):
            yield q, x


def runs_of(seq: np.ndarray, texts: np.ndarray, times: int = TIMES, least: int = LEAST):
    """All runs in ``seq``, the word numbers (from 0) of texts laid end to end; word ``k`` is of text ``texts[k]``, in
    ascending order. Returns the starts, ends and periods of the runs, by start and period."""
    if times < 3:
        raise ValueError("times must be 3 or more")
    none = np.zeros(0, np.int64)
    if not len(seq):
        return none, none, none
    # every text is followed by a number of its own, which equals nothing
    count = np.bincount(texts)
    sep = np.cumsum(count) + np.arange(len(count))
    place = np.arange(len(seq)) + texts
    line = np.empty(len(seq) + len(count), np.int64)
    line[sep], line[place] = -1 - np.arange(len(count)), seq
    found, cover = [], np.zeros(len(line), np.int64)           # cover: the furthest end of a known run over each place
    pend, size, level = [], 0, 1

    def settle():
        q, x = (np.concatenate([p[k] for p in pend]) for k in (0, 1))
        # all of x .. x + 2q lies in one text; inside a run of smaller period it is a multiple of that
        keep = (cover[x] < x + 2 * q) & (sep[np.searchsorted(sep, x)] > x + 2 * q - 1)
        s, e, q = _extend(line, q[keep], x[keep])
        long = e - s >= np.maximum(least, times * q)
        s, e, q = s[long], e[long], q[long]
        order = np.lexsort((q, e, s))
        s, e, q = s[order], e[order], q[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])         # the smallest period of each stretch
        for a, b in zip(s[new], e[new]):
            np.maximum(cover[a:b], b, out=cover[a:b])
        found.append((s[new], e[new], q[new]))

    for q, x in _candidates(line, int(count.max()), times, least):
        if pend and (q >= 2 * level or size > ASK):             # settle smaller periods first
            settle()
            pend, size = [], 0
        if not pend:
            level = q
        pend.append((np.full(len(x), q), x))
        size += len(x)
    if pend:
        settle()
    if not found:
        return none, none, none
    s, e, q = (np.concatenate([f[k] for f in found]) for k in range(3))
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, q = s[new], e[new], q[new]
    order = np.lexsort((q, s))
    s, e, q = s[order], e[order], q[order]
    back = np.searchsorted(sep, s)                              # texts before: their separators do not count
    return s - back, e - back, q


def _extend(line: np.ndarray, q: np.ndarray, x: np.ndarray):
    """The stretch of period ``q`` around each candidate, from the grammar of the texts that hold candidates."""
    if not len(x):
        return x, x, q
    ends = np.flatnonzero(line < 0)
    begins = np.append(0, ends[:-1] + 1)
    of = np.searchsorted(ends, x)
    held = np.unique(of)
    size = ends[held] - begins[held] + 1
    base = np.cumsum(size) - size + 1                           # place of each held text in the part, after a first number
    part = np.empty(int(size.sum()) + 1, np.int64)
    part[0] = int(line.min()) - 1
    for b, a, n in zip(base, begins[held], size):
        part[b:b + n] = line[a:a + n]
    shift = begins[held] - base
    mine = np.searchsorted(held, of)
    p = x - shift[mine]
    forward = grammar(part)
    backward, n = mirror(forward), len(part)
    s, e = np.empty_like(x), np.empty_like(x)
    for k in range(0, len(x), ASK):
        i, j = p[k:k + ASK], p[k:k + ASK] + q[k:k + ASK]
        e[k:k + ASK] = j + extensions(forward, i, j)
        s[k:k + ASK] = i - extensions(backward, n - j, n - i)
    return s + shift[mine], e + shift[mine], q


def _work(times: int, least: int):
    out_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def tasks(batches):
        for b in batches:
            data, offs = utf8(b.column("__text"))
            found, texts = [], []
            for i, j in slabs(offs):
                part, at = data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
                begin, end, doc = words(part, at)
                ids = np.unique(mix(Rolling(part).raw(begin, end) + (end - begin).astype(np.uint64)), return_inverse=True)[1]
                s, e, q = runs_of(ids.astype(np.int64), doc, times, least)
                first = np.searchsorted(doc, np.arange(j - i))
                change = np.zeros(len(doc) + 1, np.int64)       # words after a run's first period go
                np.add.at(change, s + q, 1)
                np.add.at(change, e, -1)
                keep = np.cumsum(change[:-1]) == 0
                texts += _joined(part, begin[keep], end[keep], doc[keep], j - i)
                of = doc[s] if len(s) else s
                rows = pa.StructArray.from_arrays([pa.array(s - first[of]), pa.array(e - s), pa.array(q)], names=["start", "length", "period"])
                found.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(j - i + 1)), pa.int32()), rows))
            runs = pa.concat_arrays([f.cast(out_type) for f in found]) if found else pa.array([], out_type)
            cols = [b.column(k) for k in range(b.num_columns - 1)] + [runs, pa.array(texts, pa.string())]
            names = [f"c{k}" for k in range(b.num_columns - 1)] + ["runs", "collapsed"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return tasks


def _joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray, doc: np.ndarray, n: int) -> list[str]:
    """The words of each of ``n`` texts joined by one space."""
    size = end - begin + 1                                      # with the space after it
    stop = np.cumsum(size)
    buf = np.empty(int(stop[-1]) if len(stop) else 0, np.uint8)
    src = np.repeat(begin - (stop - size), size) + np.arange(len(buf))
    last = stop - 1
    src[last] = 0
    buf[:] = data[src] if len(buf) else 0
    buf[last] = 32
    cut = np.append(0, stop)[np.searchsorted(doc, np.arange(n + 1))]
    raw = buf.tobytes()
    return [raw[a:max(a, b - 1)].decode("utf-8") for a, b in zip(cut[:-1], cut[1:])]


def periodic_runs(docs: DataFrame, text_col: str = "text", times: int = TIMES, least: int = LEAST) -> DataFrame:
    """``docs`` with ``runs`` (array of start, length, period; by start, then period) and ``collapsed``, the words joined
    by one space without those of a run after its first period."""
    taken = {c.lower() for c in docs.columns}
    runs = "runs_found" if "runs" in taken else "runs"
    collapsed = "collapsed_text" if "collapsed" in taken else "collapsed"
    fields = [StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema.fields)]
    run = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)], F.col(f"`{text_col}`").cast("string").alias("__text"))
    out = inner.mapInArrow(_work(times, least), StructType([*fields, StructField("runs", ArrayType(run)), StructField("collapsed", StringType())]))
    return out.toDF(*docs.columns, runs, collapsed)


def edited(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in one document of ten (by the id's hash) the words from a hashed place on repeat with a hashed period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    w = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    g = F.floor(F.col("h") / 10)
    with_words = docs.select("doc_id", "text", h.alias("h")).select("doc_id", "text", "h", F.when(F.col("h") % 10 == 0, w).alias("w"))
    n = F.size("w")
    cut = with_words.withColumn("a", F.when(n > 0, (g % n).cast("int")))
    cut = cut.withColumn("p", F.when(n > 0, (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int")))
    places = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    text = F.array_join(F.transform(places, lambda i: F.get("w", i)), " ")
    return cut.select("doc_id", F.when(n > 0, text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(edited(table(spark, sf_dir, "documents"))).drop("text")
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    found = found.withColumn("best", best)
    start, length, period = -F.col("best.s"), F.col("best.length"), -F.col("best.p")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(1000 * length / period).cast("long").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
