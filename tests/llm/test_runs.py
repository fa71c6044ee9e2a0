"""Periodic runs: grammar extensions, the run search and op11 against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from conftest import SF0001
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from odd_rows import edge_docs, edge_rows, no_docs  # noqa: F401

from vaultweave.llm.periodic_runs import edited, op11_periodic_runs, periodic_runs, runs_of
from vaultweave.llm.recompression import extensions, grammar, mirror

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, times=4, least=6):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, times * q):
                found.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def edit(doc_id, text):
    w = WORDS.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


periodic = st.builds(lambda head, unit, k, tail: head + unit * k + tail, st.lists(st.integers(0, 2), max_size=12),
                     st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(0, 9), st.lists(st.integers(0, 2), max_size=12))


@settings(max_examples=150, deadline=None)
@given(periodic)
def test_extensions_equal_plain_comparison(seq):
    s = np.array([-1, *seq, -2], np.int64)
    forward = grammar(s)
    i, j = np.triu_indices(len(s), 1)
    for levels, line in ((forward, s), (mirror(forward), s[::-1])):
        for a, b, got in zip(i, j, extensions(levels, i, j)):
            want = next((k for k in range(len(line) - b) if line[a + k] != line[b + k]), len(line) - b)
            assert got == want


@settings(max_examples=200, deadline=None)
@given(st.lists(periodic, min_size=1, max_size=4), st.sampled_from([3, 4, 6]))
def test_runs_of_several_texts_equal_brute_force(texts, times):
    seq, of = np.array(sum(texts, []), np.int64), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    s, e, q = runs_of(seq, of, times)
    begin = np.cumsum([0, *[len(t) for t in texts]])
    assert list(zip(s, e - s, q)) == [(b + a, n, p) for b, t in zip(begin, texts) for a, n, p in brute_runs(t, times)]


def test_grammar_of_a_long_periodic_line_stays_short():
    s = np.append(np.tile(np.arange(7), 20_000), -1)
    levels = grammar(s)
    assert sum(len(lv.sym) for lv in levels) < 8 * len(s) and len(levels) < 80
    assert extensions(levels, np.array([3, 0]), np.array([10, 1])).tolist() == [140_000 - 10, 0]


def test_a_step_below_one_period_is_refused():
    with pytest.raises(ValueError, match="times"):
        runs_of(np.zeros(3, np.int64), np.zeros(3, np.int64), 2)


def test_op11_equals_brute_force_on_every_document(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    got = {r.doc_id: r for r in op11_periodic_runs(spark, SF0001).collect()}
    assert len(got) == len(docs)
    total = 0
    for d in docs:
        w = edit(d.doc_id, d.text)
        runs = brute_runs(w)
        total += len(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert tuple(got[d.doc_id]) == (d.doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
                                        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapse(w, runs).encode()).hexdigest())
    assert total > 20


def test_odd_rows_and_clashing_columns(spark, edge_docs, no_docs):
    docs = edge_docs.withColumn("runs", F.lit(3)).withColumn("Collapsed", F.lit("kept")).withColumn("__text", F.lit(None).cast("string"))
    docs = docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(99).cast("long")).withColumn("text", F.lit("a b " * 9 + "c c c c c c é é")))
    rows = periodic_runs(docs).collect()
    assert len(rows) == docs.count() and list(rows[0].asDict())[:len(docs.columns)] == docs.columns
    for r in rows:
        w = WORDS.findall(r.text or "")
        runs = brute_runs(w) if len(w) < 10_000 else [tuple(x) for x in r.runs_found]
        assert [tuple(x) for x in r.runs_found] == runs and r.collapsed_text == collapse(w, runs)
        assert (r.runs, r.Collapsed) == (3, "kept")
    long = next(r for r in rows if r.doc_id == 9)               # 60,000 words of period 997
    assert [tuple(x) for x in long.runs_found] == [(0, 60_000, 997)]
    assert next(tuple(x) for r in rows if r.doc_id == 99 for x in r.runs_found) == (0, 18, 2)
    assert periodic_runs(no_docs).count() == 0
    assert {r.doc_id: WORDS.findall(r.text or "") for r in edited(edge_docs).collect()} == {
        r.doc_id: edit(r.doc_id, r.text) for r in edge_docs.collect()}
