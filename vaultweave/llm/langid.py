"""Language identification with interpolated Kneser-Ney character models, one per language.

Texts are lower-cased; runs of characters that are no letters become one space. Per language, counts of
all character trigrams of the training rows (rows outside the evaluation fold with a language) are
gathered with Spark and give an interpolated Kneser-Ney model of order 3: absolute discounts per order
from the counts of counts, continuation counts below the top order, a uniform floor. The models of all
languages are stored as arrays sorted by the hash of the n-gram, with one column of log probabilities
per language, so one search of an array scores a character in every language; n-grams unseen in all
languages back off to shorter ones.

The prediction is the language with the lowest cross-entropy per character. A text is rejected when it
has no letter, or when its cross-entropy lies above the limit calibrated for that language: half-way from
the mean over all training rows to that of letters drawn at random, at least ``REJECT_SD`` standard
deviations above the mean, with an allowance for short texts. Mean and deviation of a language are those of
its rows that are predicted as it, or of all its rows where none is, with ``PRIOR_ROWS`` rows like those of
all languages together added, so a language with one row has a limit too.

Every trigram enters the model, which passes through the driver and is held whole by each Python worker, so
its size grows with the distinct trigrams of the training rows. More than ``MAX_LANGS`` languages raise ValueError. Texts above one slab are scored piece by piece.

Defined cases: null texts and texts without a letter are ``und`` with score 0 and rejected; without
training rows every text is ``und``; a null id is in the evaluation fold; repeated rows are scored alike.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultweave.llm import textbytes as tb
from vaultweave.llm.common import held_out, saved, table

MAX_LANGS = 512
REJECT_SD = 8.0
PRIOR_ROWS = 8
SPACE = 32
UND = "und"
_TABLES: dict[str, np.ndarray] = {}


def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case form (where it is one character) and letter property of every code point."""
    if not _TABLES:
        lower = np.arange(sys.maxunicode + 1, dtype=np.int64)
        alpha = np.zeros(sys.maxunicode + 1, bool)
        for i in range(sys.maxunicode + 1):
            c = chr(i)
            if c.isalpha():
                alpha[i] = True
                if len(c.lower()) == 1:
                    lower[i] = ord(c.lower())
        _TABLES["lower"], _TABLES["alpha"] = np.where(alpha, lower, SPACE), alpha
    return _TABLES["lower"], _TABLES["alpha"]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed trigrams of the texts, one per letter and per space after a word; offsets per text."""
    lower, alpha = _characters()
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    letter = alpha[cps]
    start = np.zeros(len(cps) + 1, bool)
    start[offs] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1] & ~start[1:-1]  # the first other character after a word is its space
    at = np.flatnonzero(keep)
    c = lower[cps[at]]
    o = np.searchsorted(at, offs)
    begin = np.zeros(len(c) + 1, bool)
    begin[o] = True
    one = np.where(begin[:-1], SPACE, np.concatenate([[SPACE], c[:-1]])) if len(c) else c
    two = np.where(begin[:-1] | np.concatenate([[True], begin[:-2]]), SPACE, np.concatenate([[SPACE, SPACE], c[:-2]])[:len(c)]) if len(c) else c
    return two << 42 | one << 21 | c, o


_LOW = (1 << 21) - 1


def _pieces(batch):
    """Lists of texts of bounded size, with the row of each text; long texts come in pieces."""
    data, offs = tb.utf8(batch)
    for i, j in tb.slabs(offs):
        raw = data[offs[i]:offs[j]].tobytes()
        o = offs[i:j + 1] - offs[i]
        texts = [raw[o[k]:o[k + 1]].decode("utf-8", "replace") for k in range(j - i)]
        if j - i == 1 and len(texts[0]) > tb.SLAB_BYTES:
            for a in range(0, len(texts[0]), tb.SLAB_BYTES):
                yield np.array([i]), [texts[0][a:a + tb.SLAB_BYTES]]
        else:
            yield np.arange(i, j), texts


def _count(batches):
    """Trigram counts per language of a partition."""
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang, grams, n):
        if lang in total:
            grams, n = np.concatenate([total[lang][0], grams]), np.concatenate([total[lang][1], n])
        keys, at = np.unique(grams, return_inverse=True)
        total[lang] = keys, np.bincount(at, n, len(keys)).astype(np.int64)

    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for rows, texts in _pieces(batch.column(1)):
            grams, o = trigrams(texts)
            of = np.repeat(langs[rows], np.diff(o))
            for lang in set(langs[rows]):
                keys, n = np.unique(grams[of == lang], return_counts=True)
                add(lang, keys, n)
    for lang, (keys, n) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)], ["lang", "gram", "n"])


def _discount(n: np.ndarray) -> float:
    one, two = int((n == 1).sum()), int((n == 2).sum())
    return one / (one + 2 * two) if one and two else 0.5


class _Level:
    """One order of one language: discounted share of each n-gram, and what each context leaves."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.grams = grams
        ctx, at = np.unique(grams >> 21, return_inverse=True)
        total, types = np.bincount(at, n), np.bincount(at)
        d = _discount(n)
        self.share = np.maximum(n - d, 0) / total[at]
        self.ctx, self.left = ctx, d * types / total

    def probability(self, grams: np.ndarray, below: np.ndarray) -> np.ndarray:
        return _find(self.grams, self.share, grams, 0.0) + _find(self.ctx, self.left, grams >> 21, 1.0) * below


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


class _Sorted:
    """N-grams sorted by hash, with a row of values per language."""

    def __init__(self, grams: np.ndarray, values: np.ndarray):
        h = tb.mix(grams.astype(np.uint64))
        order = np.argsort(h)
        self.keys, self.values = h[order], values[order].astype(np.float32)

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = tb.mix(grams.astype(np.uint64))
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return at, self.keys[at] == h


class Model:
    """Kneser-Ney models of all languages over shared sorted arrays. ``counts``: language to (grams, counts)."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        self.limits: dict[str, float] = {}
        levels, letters = [], set()
        for lang in self.langs:
            g3, n3 = counts[lang]
            order = np.argsort(g3)
            g3, n3 = g3[order], n3[order]
            g2, c2 = np.unique(g3 & (_LOW << 21 | _LOW), return_counts=True)
            g1, c1 = np.unique(g2 & _LOW, return_counts=True)
            levels.append((_Level(g1, c1), _Level(g2, c2), _Level(g3, n3)))
            letters.update(g1.tolist())
        self.letters = sorted(letters - {SPACE})
        self.floor = 1.0 / (len(letters) + 1)
        every = [np.unique(np.concatenate([lv[i].grams for lv in levels])) for i in range(3)] if levels else []

        def chance(lv, grams, order):
            p = np.full(len(grams), self.floor)
            for i in range(order):
                p = lv[i].probability(grams & ((1 << 21 * (i + 1)) - 1), p)
            return p

        if levels:
            self.tables = [_Sorted(every[i], np.stack([np.log(chance(lv, every[i], i + 1)) for lv in levels], 1)) for i in range(3)]
            ctx = [np.unique(np.concatenate([lv[i].ctx for lv in levels])) for i in range(3)]
            self.left = [_Sorted(ctx[i], np.stack([np.log(_find(lv[i].ctx, lv[i].left, ctx[i], 1.0)) for lv in levels], 1)) for i in range(3)]

    def log_probabilities(self, grams: np.ndarray, order: int = 3) -> np.ndarray:
        """Row per n-gram, column per language."""
        if order == 0:
            return np.full((len(grams), len(self.langs)), np.log(self.floor), np.float32)
        t = self.tables[order - 1]
        at, hit = t.find(grams)
        out = t.values[at]
        miss = np.flatnonzero(~hit)
        if len(miss):
            g = grams[miss]
            out[miss] = self.log_probabilities(g & ((1 << 21 * (order - 1)) - 1), order - 1)
            left = self.left[order - 1]
            cat, chit = left.find(g >> 21)
            out[miss] += np.where(chit[:, None], left.values[cat], 0)
        return out

    def junk_entropy(self) -> np.ndarray:
        """Cross-entropy per language of letters drawn at random from all that are known."""
        if not self.letters:
            return np.zeros(len(self.langs))
        draw = np.random.default_rng(5).integers(0, len(self.letters), (500, 5))
        sums, n = self.totals([" ".join("".join(chr(self.letters[i]) for i in word) for word in draw)])
        return -sums[0] / n[0]

    def totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Summed log probability per text and language, and the number of characters."""
        grams, o = trigrams(texts)
        sums = np.zeros((len(texts), len(self.langs)))
        full = np.flatnonzero(np.diff(o))
        if len(full) and self.langs:
            sums[full] = np.add.reduceat(self.log_probabilities(grams).astype(np.float64), o[full], axis=0)
        return sums, np.diff(o)


def _scored(model: Model):
    def run(batches):
        for batch in batches:
            n_rows = batch.num_rows
            sums, chars = np.zeros((n_rows, len(model.langs))), np.zeros(n_rows, np.int64)
            for rows, texts in _pieces(batch.column(1)):
                s, c = model.totals(texts)
                sums[rows] += s
                chars[rows] += c
            pred, score, entropy, reject = [UND] * n_rows, np.zeros(n_rows), np.full(n_rows, np.nan), np.ones(n_rows, bool)
            for i in np.flatnonzero(chars > 0) if model.langs else ():
                h = -sums[i] / chars[i]
                b = int(h.argmin())
                lang = model.langs[b]
                pred[i], entropy[i] = lang, h[b]
                score[i] = 1 / np.exp(-np.minimum((h - h[b]) * min(chars[i], 40), 700)).sum()
                reject[i] = h[b] > model.limits.get(lang, np.inf) + 4 / np.sqrt(chars[i])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score), pa.array(entropy, from_pandas=True), pa.array(reject)],
                                             ["row", "lang_pred", "score", "entropy", "rejected"])
    return run


_SCORED = "lang_pred string, score double, entropy double, rejected boolean"


def _own_entropies(model: Model):
    """Per row with a letter: its language, whether that is predicted, and the entropy under its model."""
    def run(batches):
        for batch in batches:
            sums, chars = np.zeros((batch.num_rows, len(model.langs))), np.zeros(batch.num_rows, np.int64)
            for rows, texts in _pieces(batch.column(1)):
                s, c = model.totals(texts)
                sums[rows] += s
                chars[rows] += c
            at = np.flatnonzero(chars)
            own = np.searchsorted(np.array(model.langs, object), np.array(batch.column(0).to_pylist(), object)[at]) if len(at) else at
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(sums[at].argmax(1) == own if len(at) else np.zeros(0, bool)),
                                              pa.array(-sums[at, own] / chars[at])], ["lang", "itself", "h"])
    return run


def _limits(train: DataFrame, model: Model) -> dict[str, float]:
    """The rejection limit of every language, from the entropies of all training rows; a row per language is collected."""
    stats = {}
    rows = (train.select("lang", "text").mapInArrow(_own_entropies(model), "lang string, itself boolean, h double")
            .groupBy("lang", "itself").agg(F.count("h").alias("n"), F.avg("h").alias("mean"), F.var_pop("h").alias("var")).collect())
    for r in sorted(rows, key=lambda r: r.itself):
        stats[r.lang] = r.n, r.mean, r.var
    if not stats:
        return {}
    n, mean, var = np.array(list(stats.values())).T
    centre = (n * mean).sum() / n.sum()
    spread = (n * var).sum() / n.sum()
    w = PRIOR_ROWS
    junk = dict(zip(model.langs, model.junk_entropy(), strict=True))
    out = {}
    for lang, (n, mean, var) in stats.items():
        m, sd = (n * mean + w * centre) / (n + w), np.sqrt((n * var + w * spread) / (n + w))
        out[lang] = max(m + REJECT_SD * sd, (m + junk[lang]) / 2)
    return out


def fit(train: DataFrame) -> Model:
    """A calibrated model from ``train`` (columns ``doc_id``, ``lang``, ``text``)."""
    train = train.filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = saved(train.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
                   .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "langid")
    langs = [r[0] for r in counts.select("lang").distinct().limit(MAX_LANGS + 1).collect()]
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    got = {}
    for lang in langs:
        every = counts.filter(F.col("lang") == lang).select("gram", "n").toArrow()
        got[lang] = every["gram"].to_numpy(), every["n"].to_numpy()
    model = Model(got)
    model.limits = _limits(train, model)
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, entropy, rejected`` per row."""
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col))
            .mapInArrow(_scored(model), "row long, " + _SCORED).withColumnRenamed("row", "doc_id"))


def fit_on(docs: DataFrame) -> Model:
    return fit(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "lang", "text"))


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all columns as they are."""
    names = docs.columns
    schema = docs.schema

    def run(batches):
        at = [n.lower() for n in names].index("text")
        score = _scored(model)
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(at)], ["row", "text"])
            rejected, = (r.column(4) for r in score([pair]))
            yield batch.filter(pa.array(~rejected.to_numpy(zero_copy_only=False)))

    return docs.mapInArrow(run, schema)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit_on(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "entropy", "rejected")
