"""Random load histories: Spark operators vs a brute-force Python model of the reference rules."""

import datetime as dt

from helpers import HUB_SCHEMA, SAT_SCHEMA, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vaultweave.operators.hub import hub_rows
from vaultweave.operators.satellite import sat_rows
from vaultweave.plans.specs import HubSpec, SatSpec
from vaultweave.plans.yearly import _inserted_rows, fold_satellite_keys

SAT = SatSpec("s", "x", "pk", "hd", ("v",))
HUB = HubSpec("h", "x", "pk", ("k",))
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.sampled_from(["p", "q", "r", None])
hds = st.sampled_from(["A", "B", "C", None])
load = st.lists(st.tuples(keys, hds), min_size=1, max_size=6)
history = st.lists(load, min_size=1, max_size=4)


def ld(i):
    return dt.datetime(2001 + i, 1, 1)


def model_sat(loads):
    """The reference rule, literally: latest = rows of the pk's max load_date <= D (ties kept)."""
    table = []
    for i, items in enumerate(loads):
        d = ld(i)
        batch = sorted(set((pk, hd) for pk, hd in items), key=str)
        inserts = []
        for pk, hd in batch:
            prior = [r for r in table if r[0] == pk and pk is not None and r[2] <= d]
            last = max((r[2] for r in prior), default=None)
            latest = {r[1] for r in prior if r[2] == last}
            if pk is None or hd is None or hd not in latest:     # NULL never matches
                inserts.append((pk, hd, d))
        table += inserts
    return sorted(table, key=str)


def model_hub(loads):
    table, out = set(), []
    for i, items in enumerate(loads):
        groups = {}
        for pk, k in items:
            groups.setdefault(pk, []).append(k)
        for pk, ks in groups.items():
            if pk is None or pk not in table:
                out.append((pk, min(ks), ld(i)))
                if pk is not None:
                    table.add(pk)
    return sorted(out, key=str)


def sat_frame(spark, loads):
    rows = [(pk, hd, hd, ld(i), ld(i), "src") for i, items in enumerate(loads) for pk, hd in items]
    return spark.createDataFrame(rows, SAT_SCHEMA)


@SETTINGS
@given(history)
def test_satellite_load_by_load_matches_model(spark, loads):
    allrows = sat_frame(spark, loads)
    tgt = None
    for i in range(len(loads)):
        batch = allrows.where(F.col("load_date") == F.lit(ld(i)))
        ins = spark.createDataFrame(sat_rows(batch, tgt, SAT, ld(i)).collect(), SAT_SCHEMA)
        tgt = ins if tgt is None else tgt.unionByName(ins)
        tgt = spark.createDataFrame(tgt.collect(), SAT_SCHEMA)
    assert rows_of(tgt, ["pk", "hd", "load_date"]) == model_sat(loads)


@SETTINGS
@given(history)
def test_satellite_key_fold_matches_model(spark, loads):
    from vaultweave.session import new_work_dir

    staged = sat_frame(spark, loads).withColumn("load_year", F.year("load_date"))
    years = [2001 + i for i in range(len(loads))]
    keys_ = fold_satellite_keys(spark, [(SAT, staged, None)], years, new_work_dir(spark, "prop"))
    got = _inserted_rows(staged.drop("load_year"), SAT, keys_)
    assert rows_of(got, ["pk", "hd", "load_date"]) == model_sat(loads)


@SETTINGS
@given(st.lists(st.lists(st.tuples(keys, st.sampled_from(["a", "b", " A"])), min_size=1, max_size=6),
                min_size=1, max_size=4))
def test_hub_bulk_matches_model(spark, loads):
    rows = [(pk, k, "d", ld(i), "src") for i, items in enumerate(loads) for pk, k in items]
    df = spark.createDataFrame(rows, HUB_SCHEMA)
    got = rows_of(hub_rows(df, None, HUB), ["pk", "k", "load_date"])
    assert got == model_hub(loads)
    # own-pk hub: non-NULL pks are unique
    pks = [r[0] for r in got if r[0] is not None]
    assert len(pks) == len(set(pks))
