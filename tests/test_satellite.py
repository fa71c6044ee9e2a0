from helpers import SAT_SCHEMA, apply_loads, ld, rows_of, sat_batch

from vaultweave.operators.satellite import latest_hashdiffs, sat_rows
from vaultweave.plans.specs import SatSpec

SPEC = SatSpec("sat", "x", "pk", "hd", ("v",))


def run(spark, loads):
    step = lambda b, t, y: sat_rows(b, t, SPEC, ld(y))
    return apply_loads(spark, [(y, sat_batch(spark, y, items)) for y, items in loads], step, SAT_SCHEMA)


def test_set_rule_and_revival(spark):
    _, counts = run(spark, [(2001, [("p", "A"), ("p", "B")]), (2002, [("p", "B"), ("p", "C")]),
                            (2003, [("p", "B")])])
    assert counts == [2, 1, 1]        # C only; then B comes back because latest is {C}


def test_rerun_of_a_load(spark):
    _, counts = run(spark, [(2001, [("p", "A"), ("p", "B")]), (2002, [("p", "B"), ("p", "C")]),
                            (2002, [("p", "B"), ("p", "C")]), (2002, [("p", "B"), ("p", "C")])])
    assert counts == [2, 1, 1, 0]


def test_out_of_order_loads(spark):
    _, counts = run(spark, [(2003, [("p", "A")]), (2002, [("p", "A")])])
    assert counts == [1, 1]           # load 2002 only compares with loads <= 2002


def test_null_pk_inserted_every_load(spark):
    _, counts = run(spark, [(2001, [(None, "A")]), (2002, [(None, "A")])])
    assert counts == [1, 1]


def test_latest_matches_brute_force(spark):
    tgt, _ = run(spark, [(2001, [("p", "A"), ("p", "B"), ("q", "A")]), (2002, [("p", "C"), ("q", "A")]),
                         (2003, [("p", "A"), ("r", "Z")])])
    rows = tgt.collect()
    expect = set()
    for pk in {r.pk for r in rows}:
        last = max(r.load_date for r in rows if r.pk == pk)
        expect |= {(pk, r.hd) for r in rows if r.pk == pk and r.load_date == last}
    assert set(rows_of(latest_hashdiffs(tgt, SPEC))) == expect


def test_key_fold_of_two_satellites_equals_general_rule(spark, work):
    from pyspark.sql import functions as F

    from vaultweave.plans.yearly import _inserted_rows, fold_satellite_keys

    loads = [(2001, [("p", "A"), ("p", "B"), ("q", "A"), (None, "N")]),
             (2002, [("p", "B"), ("p", "C"), ("q", "A"), (None, "N")]),
             (2003, [("p", "B"), ("q", "B"), ("r", "A")]),
             (2004, [("p", "C"), ("q", "A"), ("q", "B")])]
    other = SatSpec("sat2", "x", "pk", "hd", ("v",))
    general, _ = run(spark, loads)
    staged = None
    for y, items in loads:
        b = sat_batch(spark, y, items).withColumn("load_year", F.lit(y))
        staged = b if staged is None else staged.unionByName(b)
    years = [y for y, _ in loads]
    keys = fold_satellite_keys(spark, [(SPEC, staged, None), (other, staged, None)], years, f"{work}/st")
    for spec in (SPEC, other):
        got = _inserted_rows(staged.drop("load_year"), spec, keys)
        assert rows_of(got) == rows_of(general), spec.name
