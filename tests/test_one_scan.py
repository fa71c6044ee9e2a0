"""Hubs and links of a source from one reading of its batch."""

import contextlib
import io

import pytest
from conftest import SF0001
from helpers import rows_of

from vaultweave.operators.staging import stage
from vaultweave.plans.one_scan import distinct_keys, split_keys
from vaultweave.plans.specs import FP
from vaultweave.plans.yearly import backfill, run_year
from vaultweave.sources.fixtures import dirty_payment, ods_source
from vaultweave.sources.store import TableStore


def targets_of(source):
    return [t for t in (*FP.hubs, *FP.links) if t.source == source]


@pytest.mark.parametrize("source", ["payment", "billing"])
def test_one_scan_and_one_exchange_for_all_targets(spark, work, source):
    stage(ods_source(spark, SF0001, source), FP.stages[source]).write.parquet(f"{work}/stg")
    keys = distinct_keys(spark.read.parquet(f"{work}/stg"), targets_of(source))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        keys.explain()
    p = buf.getvalue()
    assert p.count("FileScan") == 1 and p.count("Exchange ") == 1 and p.count("Expand") == 1
    scan = next(ln for ln in p.splitlines() if "FileScan" in ln)
    assert "phone" not in scan and "created_at" not in scan    # only what the targets read
    names = {r[0] for r in keys.select("_target").distinct().collect()}
    assert names == {t.name for t in targets_of(source)}


def test_distinct_rows_equal_an_aggregate_per_target(spark, work):
    stg = stage(dirty_payment(spark, SF0001), FP.stages["payment"])
    parts = split_keys(stg, targets_of("payment"), work)
    for t in targets_of("payment"):
        group = [c for c in parts[t.name].columns if c not in ("_null_load", "load_date")]
        assert rows_of(parts[t.name].select(*group).distinct()) == rows_of(stg.select(*group).distinct()), t.name


def test_runs_and_backfill_give_the_same_tables(spark, work):
    src = {"payment": dirty_payment(spark, SF0001)}
    only = [t.name for t in targets_of("payment")]
    stores = {k: TableStore(spark, f"{work}/{k}") for k in ("plain", "one", "bulk")}
    for y in (1995, 1996, 1997):
        run_year(spark, FP, src, stores["plain"], y, only=only, work_dir=f"{work}/p{y}")
        run_year(spark, FP, src, stores["one"], y, only=only, work_dir=f"{work}/o{y}", one_scan=True)
    backfill(spark, FP, src, stores["bulk"], [1995, 1996, 1997], only=only, work_dir=f"{work}/b", one_scan=True)
    for n in only:
        want = rows_of(stores["plain"].read_public(n))
        assert want and rows_of(stores["one"].read_public(n)) == want and rows_of(stores["bulk"].read_public(n)) == want, n
