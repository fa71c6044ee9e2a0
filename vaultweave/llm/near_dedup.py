"""MinHash near-duplicate detection with bottom-k sketches of one hash function.

A document's set: hashes of its distinct ``SHINGLE``-word shingles (A-Z lower-cased; with fewer
words the whole sequence is the one shingle). Its sketch: the ``k`` least hashes. Two documents
are linked when ``100 * |A and B| >= percent * |A or B|``; the result is one component id per
document.

* Equal sets become one vertex first, so copies cost one row whatever their number.
* Inverted lists of retained values generate the candidates. A pair that is similar enough shares
  at least ``need`` of its retained values (``_need``), so it shares one of the rarest
  ``retained - need + 1`` of either side; only those are listed. Boilerplate values, which half of
  all documents may hold, are never among them unless they make up most of a document.
* The union of two sketches is a sketch of the union: the share of its ``k`` least values that both
  hold estimates the similarity. Pairs with fewer than ``need`` of ``k`` go.
* The rest is verified on the full sets, computed from the texts of the pair.

Not all pairs of a list are formed. First each list's pivot is compared with its members and the
links are merged to components, ``PIVOTS`` times with other pivots. Documents that still lie in one list but in
different components get lists of their whole sets: a similar pair shares one of the ``n - ceil(n * percent / 100) + 1``
first shingles of either side in any common order, and the order is rarest first, by a histogram of all their shingles
in ``BUCKETS`` counters. So documents that only share a template, however many, have no list in common, as long as their own
shingles fill that prefix. A similar pair shares not one but ``_common`` of these shingles at least; pairs of a list of up to
``LIST`` documents that share as many and whose sketches allow a link, and the members of each longer list, are connected to
families. So single shingles that unrelated documents share by chance, which grow more with the corpus, tie no families
together. What lies in one family and in different components is compared in blocks of about
``BLOCK`` documents: a task holds two blocks, takes overlaps, estimates and exact sizes as products of 0/1 matrices, and
returns only as many links as connect what is linked. Pairs inside a component cannot change the result and are left out.

Exactness: for sets of up to ``k * percent / 100`` shingles ``need`` is a theorem, else a binomial tail
(``shared_least``): both the shared values and the estimate pass whenever the pair shares ``need`` of the
``k`` least values of its union, so both filters together miss a pair at the threshold with a probability of
``MISS`` at most, at every ``percent``. Sets are compared by 64-bit hashes.

Defined cases: null, empty and blank texts have no shingles and are linked with nothing; rows that
share an id are one vertex; a row with a null id is linked with nothing and kept, its component null.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultweave.llm import textbytes as tb
from vaultweave.llm.common import saved_alone as saved, table
from vaultweave.llm.components import components

SHINGLE = 5
PERCENT = 85
K = 48
MISS = 3e-9
PIVOTS = 2
BLOCK = 512
#: longest list of whole sets whose pairs are formed one by one
LIST = 256
#: counters of the histogram that orders shingles; collisions cost lists, never links
BUCKETS = 1 << 17
_U = np.uint64
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], np.uint64)


def shingle_sets(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (as int64) of each text of a slab."""
    low = tb.ascii_lower(data)
    start, end, doc = tb.words(low, offs)
    word = tb.mix(tb.Rolling(low).raw(start, end) + (end - start).astype(np.uint64))
    n = len(word)
    full = n - SHINGLE + 1
    sets = [np.zeros(0, np.int64)] * (len(offs) - 1)
    if full > 0:
        h = np.full(full, _U(SHINGLE))
        for j in range(SHINGLE):
            h += word[j:j + full] * _ODD[j]
        h = tb.mix(h).view(np.int64)
    first = np.searchsorted(doc, np.arange(len(offs)))
    for i in range(len(offs) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= SHINGLE:
            sets[i] = np.unique(h[a:b - SHINGLE + 1])
        elif b > a:
            with np.errstate(over="ignore"):
                one = (word[a:b] * _ODD[:b - a]).sum(dtype=np.uint64) + _U(b - a)
            sets[i] = tb.mix(np.array([one], np.uint64)).view(np.int64)
    return sets


def _sketches(k: int):
    def run(batches):
        for batch in batches:
            data, offs = tb.utf8(batch.column(1))
            for i, j in tb.slabs(offs):
                sets = shingle_sets(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                key = [tb.mix(s.view(np.uint64) ^ _ODD[0]) for s in sets]
                kept = [s[:k] for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array([x.sum(dtype=np.uint64) for x in key], np.uint64).view(np.int64)),
                    pa.array(np.array([np.bitwise_xor.reduce(x, initial=_U(0)) for x in key], np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in kept])]), pa.int32()),
                                             pa.array(np.concatenate(kept) if kept else np.zeros(0, np.int64)))],
                    ["doc_id", "n", "s1", "s2", "sketch"])
    return run


def _overlaps(batches):
    """Exact overlap of the two texts of each row."""
    for batch in batches:
        (da, oa), (db, ob) = tb.utf8(batch.column(2)), tb.utf8(batch.column(3))
        both = []
        for i in range(batch.num_rows):
            a, = shingle_sets(da[oa[i]:oa[i + 1]], np.array([0, oa[i + 1] - oa[i]]))
            b, = shingle_sets(db[ob[i]:ob[i + 1]], np.array([0, ob[i + 1] - ob[i]]))
            both.append((len(np.intersect1d(a, b, assume_unique=True)), len(a) + len(b)))
        x = np.array(both, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x[:, 0]), pa.array(x[:, 1] - x[:, 0])],
                                         ["u", "v", "both", "either"])


def shared_least(percent: int, k: int) -> int:
    """The most of ``k`` values of the union's sketch that a pair at the threshold shares but with probability ``MISS``."""
    p, tail, need = percent / 100, 0.0, 0
    while need < k and (tail := tail + comb(k, need) * p ** need * (1 - p) ** (k - need)) <= MISS:
        need += 1
    return max(1, need)


def _need(n: Column, percent: int, k: int, need_large: int) -> Column:
    """How many retained values a similar pair shares at least."""
    exact = F.ceil(n * F.lit(percent) / F.lit(100))
    return F.when(n * 100 <= k * percent, exact).otherwise(F.lit(need_large)).cast("int")


def _listed(reps: DataFrame, percent: int, k: int, need_large: int) -> DataFrame:
    """Rows (rep, n, value): the rarest values of each rep that another rep shares."""
    each = reps.select("rep", "n", F.explode("sketch").alias("value"))
    often = each.groupBy("value").agg(F.count("*").alias("often")).filter("often > 1")
    held = each.join(often, "value").groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("often", "value"))).alias("held"))
    retained = F.least(F.col("n"), F.lit(k)).cast("int")
    room = retained - _need(F.col("n"), percent, k, need_large) + 1 - (retained - F.size("held"))
    return (held.withColumn("mine", F.slice("held", F.lit(1), F.greatest(room, F.lit(0))).getField("value"))
            .select("rep", "n", F.explode("mine").alias("value")))


def _estimate(a: str, b: str, k: int) -> Column:
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    return F.size(F.array_intersect(F.array_intersect(union, F.col(a)), F.col(b))) / F.size(union)


def _likely(pairs: DataFrame, sketches: DataFrame, k: int, least: float) -> DataFrame:
    """Pairs ``u, v`` whose sketches share ``least`` of the union's sketch."""
    su = sketches.select(F.col("rep").alias("u"), F.col("sketch").alias("su"))
    sv = sketches.select(F.col("rep").alias("v"), F.col("sketch").alias("sv"))
    return pairs.join(su, "u").join(sv, "v").filter(_estimate("su", "sv", k) >= least).select("u", "v")


def _with_component(lists: DataFrame, comp: DataFrame) -> DataFrame:
    return lists.join(comp, lists["rep"] == comp["node"], "left").select("value", "rep", "n", F.coalesce("component", "rep").alias("comp"))


def _bucket(values: np.ndarray) -> np.ndarray:
    return (tb.mix(values.view(np.uint64) ^ _ODD[1]) % _U(BUCKETS)).astype(np.int64)


def _sets_of(texts):
    """Row ranges and shingle sets of a column of texts, slab by slab."""
    data, offs = tb.utf8(texts)
    for i, j in tb.slabs(offs):
        yield i, shingle_sets(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])


def _histogram(batches):
    """How often the shingles of each bucket occur in a partition, each set counting once."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, sets in _sets_of(batch.column(2)):
            if sets:
                total += np.bincount(_bucket(np.concatenate(sets)), minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])


def _prefixes(often: np.ndarray, percent: int):
    """``value, rep, comp, n``: the rarest shingles of each set of ``n``, one of which a similar set shares."""
    def run(batches):
        for batch in batches:
            rep, comp = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for i, sets in _sets_of(batch.column(2)):
                kept = [v[np.lexsort((v, often[_bucket(v)]))[:len(v) - -(-len(v) * percent // 100) + 1]] if len(v) else v for v in sets]
                row = np.repeat(np.arange(i, i + len(sets)), [len(v) for v in kept])
                n = np.array([len(v) for v in sets], np.int64)[row - i]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*kept, np.zeros(0, np.int64)])), pa.array(rep[row]), pa.array(comp[row]), pa.array(n)],
                                                 ["value", "rep", "comp", "n"])
    return run


def _apart(lists: DataFrame) -> DataFrame:
    """Rows of lists that hold more than one component, with the list's length and least rep."""
    several = (lists.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("length"), F.min("rep").alias("least"))
               .filter("lo != hi").select("value", "length", "least"))
    return lists.join(several, "value")


def _common(n: Column, m: Column, percent: int) -> Column:
    """How many shingles the prefixes of a similar pair of sets of ``n`` and ``m`` share at least: of its ``both`` common
    shingles a set has at most ``n - both`` others, and the prefix that ends first, in the one order of all, is short of
    ``ceil(n * percent / 100) - 1``."""
    both = F.ceil((n + m) * percent / F.lit(100 + percent))
    return 1 + both - F.ceil(F.greatest(n, m) * percent / F.lit(100))


def _families(live: DataFrame, sketches: DataFrame, percent: int, k: int, least: float) -> DataFrame:
    """``rep, comp, grp``: what pairs that may be similar connect, each in different components.
    A pair shares either only values of short lists, whose number decides, or one of a long list, which connects all it holds."""
    stars = live.filter(F.col("length") > LIST).select(F.col("rep").alias("u"), F.col("least").alias("v")).filter("u != v").distinct()
    # lists with the same members, of which families have many, become one
    short = (live.filter(F.col("length") <= LIST).groupBy("value").agg(F.sort_array(F.collect_list(F.struct("rep", "n", "comp"))).alias("docs"))
             .groupBy("docs").agg(F.count("*").alias("times")))
    two = (short.select("docs", "times", F.posexplode("docs").alias("i", "a"))
           .select("times", "a", F.explode(F.slice("docs", F.col("i") + 2, F.size("docs"))).alias("b"))
           .filter((F.col("a.comp") != F.col("b.comp")) & (F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent)))
    pairs = (two.groupBy(F.col("a.rep").alias("u"), F.col("b.rep").alias("v"))
             .agg(F.sum("times").alias("shared"), F.max(_common(F.col("a.n"), F.col("b.n"), percent)).alias("need")).filter("shared >= need"))
    edges = _likely(pairs.select("u", "v"), sketches, k, least).unionByName(stars)
    group = components(edges).withColumnRenamed("node", "rep").withColumnRenamed("component", "grp")
    return saved(live.select("rep", "comp").distinct().join(group, "rep"), "near")


def _block_pairs(member: DataFrame) -> DataFrame:
    """``pair, side, rep, comp``: a group is cut into blocks of about ``BLOCK`` documents, and each two blocks meet
    in one pair, but for blocks of one and the same component. Small groups share blocks, which meet themselves only."""
    size = member.groupBy("grp", "comp").agg(F.count("*").alias("n_comp"))
    whole = size.groupBy("grp").agg(F.sum("n_comp").alias("n_grp"), F.sum(F.when(F.col("n_comp") < BLOCK, F.col("n_comp")).otherwise(0)).alias("n_rest"))
    small = whole.filter(F.col("n_grp") < BLOCK).agg(F.coalesce(F.sum("n_grp"), F.lit(0))).first()[0]
    parts = lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("int")
    pool = F.pmod(F.xxhash64("grp"), F.lit(max(1, -(-small // BLOCK)))).cast("int")
    own = F.col("n_comp") >= BLOCK
    at = F.when(own, F.pmod(F.xxhash64("rep"), parts(F.col("n_comp")))).otherwise(F.pmod(F.xxhash64("comp"), parts(F.col("n_rest"))))
    placed = member.join(size, ["grp", "comp"]).join(whole, "grp").select(
        "rep", "comp", F.when(F.col("n_grp") < BLOCK, F.struct(F.lit(None).cast("long").alias("grp"), F.lit(None).cast("long").alias("of"), pool.cast("int").alias("at")))
        .otherwise(F.struct("grp", F.when(own, F.col("comp")).alias("of"), at.cast("int").alias("at"))).alias("block"))
    placed = saved(placed, "near")
    blocks = placed.select("block").distinct()
    alone = blocks.filter("block.grp IS NULL OR block.of IS NULL").select(F.col("block").alias("x"), F.col("block").alias("y"))
    a, b = (blocks.filter("block.grp IS NOT NULL").select(F.col("block.grp").alias("grp"), F.col("block").alias(c)) for c in "xy")
    two = a.join(b, "grp").filter((F.col("x") < F.col("y")) & ~F.coalesce(F.col("x.of") == F.col("y.of"), F.lit(False))).select("x", "y")
    meet = alone.unionByName(two).select(F.struct("x", "y").alias("pair"))
    key = F.to_json(F.col("pair"))
    sides = meet.select(key.alias("pair"), F.col("pair.x").alias("block"), F.lit(0).alias("side")).unionByName(
        meet.filter("pair.x != pair.y").select(key.alias("pair"), F.col("pair.y").alias("block"), F.lit(1).alias("side")))
    eq = (F.col("p.block.grp").eqNullSafe(F.col("s.block.grp")) & F.col("p.block.of").eqNullSafe(F.col("s.block.of"))
          & (F.col("p.block.at") == F.col("s.block.at")))
    return placed.alias("p").join(sides.alias("s"), eq).select("pair", "side", "p.rep", "p.comp")


def _counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of ``a`` with each of ``b``."""
    out = np.zeros((len(a), len(b)), np.float32)
    va, vb = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (a, b))
    both = np.intersect1d(va, vb)
    rows = []
    for sets, v in ((a, va), (b, vb)):
        at = np.searchsorted(both, v)
        hit = both[np.minimum(at, len(both) - 1)] == v if len(both) else np.zeros(len(v), bool)
        doc = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[hit]
        order = np.argsort(at[hit], kind="stable")
        rows.append((at[hit][order], doc[order], len(sets)))
    for lo in range(0, len(both), 4096):
        dense = []
        for col, doc, n in rows:
            i, j = np.searchsorted(col, [lo, lo + 4096])
            m = np.zeros((n, min(4096, len(both) - lo)), np.float32)
            m[doc[i:j], col[i:j] - lo] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out.astype(np.int64)


def _estimates(sa: np.ndarray, sb: np.ndarray, k: int) -> np.ndarray:
    """Union-sketch estimates of pairs of sketches (rows, filled up with the largest long)."""
    end = np.iinfo(np.int64).max
    both = np.sort(np.concatenate([sa, sb], axis=1), axis=1)
    twice = np.concatenate([both[:, 1:] == both[:, :-1], np.zeros((len(both), 1), bool)], axis=1) & (both != end)
    first = np.concatenate([np.ones((len(both), 1), bool), both[:, 1:] != both[:, :-1]], axis=1) & (both != end)
    place = np.cumsum(first, axis=1)
    within = place <= k
    return (twice & within).sum(1) / np.maximum((first & within).sum(1), 1)


def _linker(percent: int, k: int, need_large: int):
    """Links of one pair of blocks, as few as connect what is linked."""
    def link(group: pa.Table) -> pa.Table:
        rep, comp, side = (group[c].to_numpy() for c in ("rep", "comp", "side"))
        data, offs = tb.utf8(group["text"])
        sets: list[np.ndarray] = []
        for i, j in tb.slabs(offs):
            sets += shingle_sets(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        size = np.array([len(s) for s in sets])
        ia = np.flatnonzero(side == 0)
        ib = np.flatnonzero(side == 1) if (side == 1).any() else ia
        need = np.where(size * 100 <= k * percent, -(-size * percent // 100), need_large)
        short = [s[:k] for s in sets]
        pads = np.full((len(sets), k), np.iinfo(np.int64).max)
        for i, s in enumerate(short):
            pads[i, :len(s)] = s
        over = _counts([short[i] for i in ia], [short[i] for i in ib])
        maybe = (over >= np.maximum(need[ia][:, None], need[ib][None, :])) & (comp[ia][:, None] != comp[ib][None, :])
        maybe &= np.minimum(size[ia][:, None], size[ib][None, :]) * 100 >= np.maximum(size[ia][:, None], size[ib][None, :]) * percent
        x, y = np.nonzero(maybe)
        likely = [np.zeros(0, bool)] + [_estimates(pads[ia[x[s:s + 8192]]], pads[ib[y[s:s + 8192]]], k) >= need_large / k
                                        for s in range(0, len(x), 8192)]
        keep = np.concatenate(likely)
        x, y = x[keep], y[keep]
        ux, uy = np.unique(x), np.unique(y)
        both = _counts([sets[ia[i]] for i in ux], [sets[ib[i]] for i in uy])[np.searchsorted(ux, x), np.searchsorted(uy, y)]
        linked = both * 100 >= (size[ia[x]] + size[ib[y]] - both) * percent
        u, v = ia[x[linked]], ib[y[linked]]
        label = np.arange(len(rep))
        while len(u):  # the least row that each row reaches
            low = np.minimum(label[u], label[v])
            new = label.copy()
            np.minimum.at(new, u, low)
            np.minimum.at(new, v, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        at = np.flatnonzero(label != np.arange(len(rep)))
        return pa.table({"u": pa.array(rep[at], pa.int64()), "v": pa.array(rep[label[at]], pa.int64())})
    return link


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                 k: int = K, need_large: int | None = None, pivots: int = PIVOTS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``."""
    need_large = shared_least(percent, k) if need_large is None else need_large
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sk = saved(docs.mapInArrow(_sketches(k), "doc_id long, n long, s1 long, s2 long, sketch array<long>"), "near")
    named = sk.filter("doc_id IS NOT NULL AND n > 0")
    key = ["n", "s1", "s2"]
    classes = named.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    members = saved(named.select("doc_id", *key).join(classes, key).select("doc_id", "n", "rep").distinct(), "near")
    # rows that share an id join their classes
    twice = members.groupBy("doc_id").agg(F.min("rep").alias("u"), F.max("rep").alias("v")).filter("u != v").select("doc_id", "u")
    links = twice.join(members, "doc_id").select("u", F.col("rep").alias("v"))
    reps = named.join(classes.withColumn("doc_id", F.col("rep")), [*key, "doc_id"]).select("rep", "n", "sketch").dropDuplicates(["rep", "n", "sketch"])
    lists = saved(_listed(reps, percent, k, need_large), "near")
    lists = lists.join(lists.groupBy("value").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo != hi").select("value"), "value")
    lists = saved(lists, "near")
    party = lists.select("rep").distinct()
    sketches = saved(reps.join(party, "rep").groupBy("rep").agg(F.min("n").alias("n"), F.min("sketch").alias("sketch")), "near")
    texts = saved(docs.join(party.withColumnRenamed("rep", "doc_id"), "doc_id")
                  .groupBy("doc_id").agg(F.min("text").alias("text")).withColumnRenamed("doc_id", "rep"), "near")
    links = saved(links, "near")
    comp = components(links)
    for t in range(pivots):
        now = _with_component(lists, comp)
        spread = now.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                          F.min(F.struct(F.xxhash64("rep", F.lit(t)).alias("h"), "rep", "n", "comp")).alias("p")).filter("lo != hi")
        close = F.least("n", "p.n") * 100 >= F.greatest("n", "p.n") * percent  # sizes alone allow a link
        pairs = (now.join(spread.select("value", "p"), "value").filter((F.col("comp") != F.col("p.comp")) & close)
                 .select(F.least("rep", "p.rep").alias("u"), F.greatest("rep", "p.rep").alias("v")).distinct())
        likely = _likely(pairs, sketches, k, need_large / k)
        tu = texts.select(F.col("rep").alias("u"), F.col("text").alias("tu"))
        tv = texts.select(F.col("rep").alias("v"), F.col("text").alias("tv"))
        new = saved(likely.join(tu, "u").join(tv, "v").select("u", "v", "tu", "tv")
                    .mapInArrow(_overlaps, "u long, v long, both long, either long")
                    .filter(F.col("both") * 100 >= F.col("either") * percent).select("u", "v"), "near")
        if not new.isEmpty():
            links = links.unionByName(new)
            comp = components(links)
    now = _with_component(lists, comp)
    apart = saved(_apart(now).select("rep", "comp").distinct(), "near")
    if not apart.isEmpty():
        texts = saved(texts.join(apart, "rep").select("rep", "comp", "text"), "near")
        counters = texts.mapInArrow(_histogram, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # BUCKETS rows at most
        often = np.zeros(BUCKETS, np.int64)
        often[[r.bucket for r in counters]] = [r.n for r in counters]
        live = saved(_apart(texts.mapInArrow(_prefixes(often, percent), "value long, rep long, comp long, n long")), "near")
        member = _families(live, sketches, percent, k, need_large / k)
        if not member.isEmpty():
            pairs = _block_pairs(member).join(texts.select("rep", "text"), "rep")
            new = saved(pairs.groupBy("pair").applyInArrow(_linker(percent, k, need_large), "u long, v long"), "near")
            if not new.isEmpty():
                comp = components(links.unionByName(new))
    found = members.groupBy("doc_id").agg(F.min("rep").alias("rep")).join(comp, F.col("rep") == comp["node"], "left") \
        .select("doc_id", F.coalesce("component", "rep").alias("component_id"))
    out = sk.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group: the one with the least id; of rows that share an id the least row."""
    classes = near_classes(docs, id_col, text_col, **options)
    gone = saved(classes.filter("NOT kept").select(F.col("doc_id").alias("__id")).distinct(), "near")
    twice = saved(docs.groupBy(F.col(id_col).cast("long").alias("__id")).count().filter("count > 1 AND __id IS NOT NULL").select("__id"), "near")
    ident = F.col(id_col).cast("long")
    rest = docs.join(gone, ident == gone["__id"], "left_anti")
    if twice.isEmpty():
        return rest
    least = Window.partitionBy(id_col).orderBy(text_col, *[c for c in docs.columns if c not in (id_col, text_col)])
    again = (rest.join(twice, ident == twice["__id"], "left_semi").withColumn("__n", F.row_number().over(least)).filter("__n = 1").drop("__n"))
    return rest.join(twice, ident == twice["__id"], "left_anti").unionByName(again)


def op4_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))
