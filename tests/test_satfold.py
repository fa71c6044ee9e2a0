"""The one-pass satellite fold against a fold load by load, its plan, and its bounds."""

import contextlib
import io
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vaultweave.plans import satfold
from vaultweave.session import new_work_dir

KEYS = "sat string, pk string, hd string, load int"


def by_load(keys, loads, latest=()):
    held, out, batch = defaultdict(set), set(), defaultdict(lambda: defaultdict(set))
    for s, p, h in latest:
        held[s, p].add(h)
    for s, p, h, n in keys:
        batch[n][s, p].add(h)
    for n in range(loads):
        for k, hds in batch[n].items():
            new = {h for h in hds if h == "" or h not in held[k]}
            if new:
                held[k] = new
                out |= {(*k, h, n) for h in new}
    return out


def folded(spark, keys, loads, latest=None):
    held = None if latest is None else spark.createDataFrame(latest, "sat string, pk string, hd string")
    rows = [tuple(r) for r in satfold.fold(spark.createDataFrame(keys, KEYS), loads, held, new_work_dir(spark, "fold")).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


row = st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["p", "q"]), st.sampled_from(["", "x", "y", "z"]), st.integers(0, 6))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=60), st.lists(row, max_size=8))
def test_fold_equals_load_by_load(spark, keys, before):
    latest = [r[:3] for r in before]
    assert folded(spark, keys, 7, latest) == by_load(keys, 7, latest)


@pytest.mark.parametrize("bits,patterns,stretch", [(62, 1 << 13, 11), (9, 1 << 13, 11), (62, 3, 3), (20, 3, 4)])
def test_many_loads_masks_and_stretches(spark, monkeypatch, bits, patterns, stretch):
    """More loads than a mask holds, and pks of more patterns than one row may hold, give the same rows."""
    monkeypatch.setattr(satfold, "MASK_BITS", bits)
    monkeypatch.setattr(satfold, "PATTERNS", patterns)
    monkeypatch.setattr(satfold, "STRETCH", stretch)
    keys = [("a", "hot", f"h{i}", n) for i in range(40) for n in range(30) if (i * 7 + n * n * (i + 3)) % 5 < 2]
    keys += [("a", f"p{i}", f"h{(i + n) % 3}", n) for i in range(12) for n in range(0, 30, 1 + i % 4)] + [("b", "same", f"h{i}", n) for i in range(3) for n in range(30)]
    latest = [("a", "hot", f"h{i}") for i in range(0, 60, 3)] + [("a", "gone", "h1"), ("b", "same", "h0")]
    assert folded(spark, keys, 30, latest) == by_load(keys, 30, latest)


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_exchanges_do_not_grow_with_loads_and_no_table_per_load(spark, work):
    counts, tables = [], []
    for loads in (7, 30):
        keys = spark.createDataFrame([("a", f"p{i % 5}", f"h{i % 3}", i % loads) for i in range(90)], KEYS)
        occurs = satfold.occurrences(keys, None)
        p = plan(satfold._one_stretch(occurs, loads))
        assert not any(x in p for x in ("PythonUDF", "InPandas", "InArrow", "Cartesian", "NestedLoop"))
        counts.append(sum(ln.endswith(" Exchange") for ln in p.splitlines() if ln.startswith("(")))
        satfold.fold(keys, loads, None, f"{work}/{loads}")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{work}/{loads}/0")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        tables.append(sorted(s.getPath().getName() for s in fs.listStatus(path)))
    assert counts[0] == counts[1] and set(tables[1]) <= {"answers", "many", "occurs"} and set(tables[0]) <= set(tables[1])


def test_a_hot_pk_is_spread_over_tasks(spark, work):
    """One pk with most hash diffs, all in one pattern: the join back deals it over the salts."""
    keys = spark.range(20_000).selectExpr("'a' as sat", "'hot' as pk", "cast(id as string) as hd", "cast(id % 2 as int) as load")
    occurs = satfold.occurrences(keys, None)
    codes = satfold._patterns(occurs)
    assert codes.count() == 2                                   # what reaches the fold of this pk
    salted = satfold._answers(occurs, satfold._folded(codes, 2))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(salted)
        assert any("salt" in ln for ln in p.splitlines() if "hashpartitioning" in ln or "Arguments: hash" in ln)
        from pyspark.sql import functions as F
        sizes = [r["count"] for r in salted.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20_000 and max(sizes) <= 10_000
