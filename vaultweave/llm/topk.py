"""Exact top-k inner-product search by a three-phase uniform threshold.

A score is a sum of ``LISTS`` partial scores, one list per block of dimensions. For each query:

1. Gather: per list, every chunk of vectors gives the ``k`` entries of best partial score; only their
   totals are added up. The k-th best total seen is a floor below which no answer can lie.
2. Broadcast: the floor goes out with the queries. A vector whose total reaches the floor has a partial
   score of at least floor / LISTS in some list; each list, held in descending order of norm, is read
   only as far as a partial score can be that high, and gives the entries that are.
3. Resolve: an entry whose known parts, with the least of floor / LISTS and the product of norms for
   each unknown part, cannot reach the floor goes; only what remains is added up in full, and what
   reaches the floor meets for the final ranking.

Vectors stay where they were written: no row of them is shuffled or copied per query. Queries go out in
groups of at most about ``GROUP_BYTES`` (sized from their number and longest vector), one group after the
other; a task passes over its vectors in chunks of ``CHUNK`` rows against blocks of ``QUERY_BLOCK``
queries and hands on at most ``k`` rows per query, so hot vectors (ties) do not add up. Components are integers,
floor(256 x); products run in doubles while they are exact. Where they are not, every total of that
chunk and block is added up in whole numbers.

Defined cases: vectors that are null or hold a null or non-finite component take no part, nor do
rows with a null id; of rows that share an id the least vector counts; shorter vectors are filled
with zeros; scores beyond a long are cut to its range; no vectors or no queries, no rows; other columns
are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultweave.llm.common import saved, shuffle_parts, table

LISTS = 4
QUERY_BLOCK = 1024
CHUNK = 2048
GROUP_BYTES = 1 << 24
SCALE = 256
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_ABOVE, _SLACK = 1 + 1e-9, 8  # norms and sums of bounds are rounded; they must not fall short


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Floors of the scaled components as doubles, one row per vector, zeros at the end of short ones."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(vectors.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)
    out = np.zeros((len(size), int(size.max(initial=0))))
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = np.floor(flat * SCALE)
    return out


def _cut(m: np.ndarray, d: int) -> list[np.ndarray]:
    edge = [i * d // LISTS for i in range(LISTS + 1)]
    return [m[:, a:b] for a, b in zip(edge, edge[1:], strict=False)]


def _norms(lists: list[np.ndarray]) -> list[np.ndarray]:
    return [np.sqrt((m * m).sum(1)) * _ABOVE for m in lists]


def _exact(q: np.ndarray, x: np.ndarray) -> bool:
    """Whether every sum of products of the two is exact in doubles."""
    return (np.abs(q).max(initial=0.0) + 1) * (np.abs(x).max(initial=0.0) + 1) * max(q.shape[1], 1) < 2.0 ** 52


def _all_totals(q: np.ndarray, x: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells (query, vector; row by row) and scores of all pairs, in whole numbers, cut to a long's range."""
    whole = np.vectorize(int, otypes=[object])
    q, x = (whole(a) if a.size else a.astype(object) for a in (q, x))
    at = np.flatnonzero(other.ravel())
    total = (q @ x.T).ravel()[at] if q.shape[1] else np.zeros(len(at), object)
    return at, np.array([min(max(int(s), _LOW), _HIGH) for s in total], np.int64)


def gather(q: np.ndarray, x: np.ndarray, other: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1 for a block of queries and a chunk: cells among the ``k`` best of some list, and their totals."""
    d, n = q.shape[1], len(x)
    if not _exact(q, x):
        return _all_totals(q, x, other)
    parts, best = [], []
    for a, b in zip(_cut(q, d), _cut(x, d), strict=True):
        p = a @ b.T
        parts.append(p)
        low = np.where(other, -p, np.inf)
        best.append(np.argpartition(low, k - 1, axis=1)[:, :k] if k < n else np.tile(np.arange(n), (len(q), 1)))
    at = np.unique((np.arange(len(q))[:, None] * n + np.concatenate(best, axis=1)).ravel())
    at = at[other.ravel()[at]]
    return at, sum(p.ravel()[at] for p in parts).astype(np.int64)


def resolve(q: np.ndarray, x: np.ndarray, other: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phases 2 and 3 for a block of queries and a chunk: the cells that the bounds leave, and their totals.
    ``floor`` is a float per query, minus infinity where it has none."""
    d, n = q.shape[1], len(x)
    if not _exact(q, x):
        return _all_totals(q, x, other)
    need = floor / LISTS
    qs, xs = _cut(q, d), _cut(x, d)
    nq, nx = _norms(qs), _norms(xs)
    hit = np.zeros((len(q), n), bool)
    known = []  # per list: partial scores of its leading entries, and the place of each vector in its order
    for a, b, na, nb in zip(qs, xs, nq, nx, strict=True):
        order = np.argsort(-nb, kind="stable")
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(need <= 0, 0.0, need / na).min(initial=np.inf)  # norm that a vector of this list needs
        far = int(np.searchsorted(-nb[order], -least, "right"))
        p = a @ b[order[:far]].T
        hit[:, order[:far]] |= p >= need[:, None]
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        known.append((p, place, far))
    at = np.flatnonzero((hit & other).ravel())
    of, v = at // n, at % n
    bound = np.zeros(len(at))
    for (p, place, far), na, nb in zip(known, nq, nx, strict=True):
        part = np.minimum(need[of], na[of] * nb[v])
        if far:
            got = p[of, np.minimum(place[v], far - 1)]
            part = np.where((place[v] < far) & (got >= need[of]), got, part)
        bound += part
    left = bound + _SLACK >= floor[of]
    at, of, v = at[left], of[left], v[left]
    total = np.zeros(len(at))
    for (p, place, far), a, b in zip(known, qs, xs, strict=True):
        there = place[v] < far
        total[there] += p[of[there], place[v[there]]]
        total[~there] += np.einsum("ij,ij->i", a[of[~there]], b[v[~there]])
    return at, total.astype(np.int64)


def _best_of(of: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best entries of each query, ties to the smaller id."""
    order = np.lexsort((ids, ~score, of))
    of, ids, score = of[order], ids[order], score[order]
    nth = np.arange(len(of)) - np.searchsorted(of, of, "left")
    return of[nth < k], ids[nth < k], score[nth < k]


def _search(qids: np.ndarray, queries: np.ndarray, floors: np.ndarray | None, k: int):
    """Passes over a task's vectors; at the end, the ``k`` best entries it found for each query."""
    def run(batches):
        blocks = [slice(i, i + QUERY_BLOCK) for i in range(0, len(qids), QUERY_BLOCK)]
        held = [(np.zeros(0, np.int64),) * 3 for _ in blocks]
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK):
                part = batch.slice(i, CHUNK)
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                x = _matrix(pa.concat_arrays([part.column(1)]))
                d = min(queries.shape[1], x.shape[1])
                for n, s in enumerate(blocks):
                    q, other = queries[s, :d], ids[None, :] != qids[s][:, None]
                    if floors is None:
                        at, score = gather(q, x[:, :d], other, k)
                    else:
                        at, score = resolve(q, x[:, :d], other, floors[s])
                        enough = score >= floors[s][at // len(ids)]
                        at, score = at[enough], score[enough]
                    now = (at // len(ids), ids[at % len(ids)], score)
                    held[n] = _best_of(*(np.concatenate(z) for z in zip(held[n], now, strict=True)), k)
        for s, (of, ids, score) in zip(blocks, held, strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(qids[s][of]), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"])
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``. Both inputs: ``vec_id`` long, ``vec`` array<double> without null or non-finite
    parts. ``vectors`` is read twice per group of queries: pass a written table, in enough files to keep the cluster busy."""
    spark = vectors.sparkSession
    schema = "query_id long, vec_id long, score long"
    n, dims = queries.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    groups = -(-2 * n * max(dims, 1) * 8 // GROUP_BYTES)
    out = None
    for g in range(groups):
        rows = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g).select("vec_id", "vec").toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        ids = rows["vec_id"].to_numpy().astype(np.int64)
        m = _matrix(pa.concat_arrays(rows["vec"].chunks))
        place = vectors.select("vec_id", "vec")
        seen = _best(place.mapInArrow(_search(ids, m, None, k), schema), k).groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
        low = seen.filter(F.col("n") >= k).toArrow()  # at most a row per query of the group
        floors = np.full(len(ids), -np.inf)
        order = np.argsort(ids)
        floors[order[np.searchsorted(ids[order], low["query_id"].to_numpy())]] = low["floor"].to_numpy()
        found = saved(_best(place.mapInArrow(_search(ids, m, floors, k), schema), k)
                      .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "topk")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long") if out is None else out


def clean_vectors(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    vec = F.transform(vec_col, lambda x: x.cast("double"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (embeddings.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).filter("vec_id IS NOT NULL AND vec IS NOT NULL")
            .filter(sound).groupBy("vec_id").agg(F.min("vec").alias("vec")))


def op10_exact_top_k(spark, sf_dir: str) -> DataFrame:
    vectors = saved(clean_vectors(table(spark, sf_dir, "embeddings")).repartition(2 * shuffle_parts(spark), "vec_id"), "topk")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


OP10_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""
