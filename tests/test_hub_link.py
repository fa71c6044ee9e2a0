from helpers import HUB_SCHEMA, apply_loads, ld, rows_of

from vaultweave.operators.hub import hub_rows
from vaultweave.operators.link import link_rows
from vaultweave.plans.specs import HubSpec, LinkSpec

OWN = HubSpec("h", "x", "pk", ("k",))
LIT = HubSpec("h", "x", "pk", ("k",), dedup_by="dk")
HUB_OUT = "pk string, k string, load_date timestamp_ntz, record_source string"


def batch(spark, year, rows):
    return spark.createDataFrame([(pk, k, dk, ld(year), "src") for pk, k, dk in rows], HUB_SCHEMA)


def test_tie_break_and_first_load_wins(spark):
    loads = [(2001, batch(spark, 2001, [("P", " ab", "d1"), ("P", "AB", "d1")])),
             (2002, batch(spark, 2002, [("P", "aa", "d1"), ("Q", "q", "d2")]))]
    tgt, counts = apply_loads(spark, loads, lambda b, t, y: hub_rows(b, t, OWN), HUB_OUT)
    assert counts == [1, 1]
    assert rows_of(tgt, ["pk", "k"]) == [("P", " ab"), ("Q", "q")]   # ' ab' < 'AB'; later 'aa' ignored


def test_null_pk_once_per_load_and_rerun_adds_nothing(spark):
    b = batch(spark, 2001, [(None, "x", "d"), (None, "y", "d"), ("P", "p", "d")])
    _, counts = apply_loads(spark, [(2001, b), (2001, b)], lambda b, t, y: hub_rows(b, t, OWN), HUB_OUT)
    assert counts == [2, 1]           # one NULL row per load; P only once


def test_literal_dedup_inserts_duplicates_and_can_miss(spark):
    b = batch(spark, 2001, [("P", "p", "d1"), ("P", "p", "d2"), ("Q", "q", "d1")])
    out = rows_of(hub_rows(b, None, LIT), ["pk", "k"])
    assert out == [("P", "p"), ("P", "p")]   # Q lost the pick within d1, P picked twice


def test_bulk_equals_fold(spark):
    data = {2001: [("P", "p", "d1"), ("Q", "q", "d1"), (None, "n", "d2")],
            2002: [("P", "p2", "d3"), ("R", "r", "d1"), (None, "m", "d2")],
            2003: [("Q", "q", "d9"), ("S", "s", "d1"), ("S", "s", "d4")]}
    loads = [(y, batch(spark, y, r)) for y, r in data.items()]
    for spec in (OWN, LIT):
        fold, _ = apply_loads(spark, loads, lambda b, t, y: hub_rows(b, t, spec), HUB_OUT)
        allb = loads[0][1].unionByName(loads[1][1]).unionByName(loads[2][1])
        assert rows_of(hub_rows(allb, None, spec)) == rows_of(fold)


def test_link_bulk_equals_fold_and_extra_distinct_column(spark):
    schema = "lpk string, a string, b string, x string, load_date timestamp_ntz, record_source string"
    spec = LinkSpec("l", "s", "lpk", ("a", "b"), also_distinct_on=("x",))
    mk = lambda y, rows: spark.createDataFrame([(*r, ld(y), "src") for r in rows], schema)
    loads = [(2001, mk(2001, [("L1", "a", "b", "x1"), ("L1", "a", "b", "x1"), ("L1", "a", "b", "x2")])),
             (2002, mk(2002, [("L1", "a", "b", "x3"), ("L2", "a", "c", "x"), (None, None, None, "x")])),
             (2003, mk(2003, [(None, None, None, "x")]))]
    out = "lpk string, a string, b string, load_date timestamp_ntz, record_source string"
    fold, counts = apply_loads(spark, loads, lambda b, t, y: link_rows(b, t, spec, single_load=True), out)
    assert counts == [2, 2, 1]        # x1/x2 make two distinct rows of L1, projected to duplicates
    allb = loads[0][1].unionByName(loads[1][1]).unionByName(loads[2][1])
    assert rows_of(link_rows(allb, None, spec)) == rows_of(fold)
