"""Plan properties the design relies on, checked on the physical plans Spark produces."""

import contextlib
import datetime as dt
import io

from conftest import SF0001

from vaultweave.operators.hub import hub_rows
from vaultweave.operators.link import link_rows
from vaultweave.operators.mart import traffic_mart
from vaultweave.operators.satellite import sat_rows
from vaultweave.operators.staging import stage
from vaultweave.plans.specs import FP
from vaultweave.sources.fixtures import ods_source

BAD_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def test_year_filter_reaches_the_scan_and_columns_are_pruned(spark):
    st = stage(ods_source(spark, SF0001, "payment"), FP.stages["payment"], 1997)
    p = plan(st.select("user_pk", "user_key"))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in p
    assert "LessThan(o_orderdate,1998-01-01T00:00)" in p
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_vault_operators_use_no_cartesian_or_nested_loop_joins(spark):
    billing = stage(ods_source(spark, SF0001, "billing"), FP.stages["billing"])
    payment = stage(ods_source(spark, SF0001, "payment"), FP.stages["payment"])
    frames = [hub_rows(billing, None, FP.target("hub_service_literal")),
              hub_rows(payment, payment.select("user_pk"), FP.target("hub_user")),
              link_rows(billing, None, FP.target("link_user_service_billing_period")),
              sat_rows(billing, billing.select("service_pk", "service_hashdiff", "load_date"),
                       FP.target("sat_service_details"), dt.datetime(1997, 1, 1))]
    for df in frames:
        p = plan(df)
        assert not any(b in p for b in BAD_JOINS), p


def test_mart_reads_only_its_year_partition(spark, work):
    from vaultweave.operators.ods import ods_load
    from vaultweave.sources.fixtures import stg_source

    ods = ods_load(stg_source(spark, SF0001, "traffic"), "traffic")
    ods.write.partitionBy("year").parquet(f"{work}/ods_traffic")
    p = plan(traffic_mart(spark.read.parquet(f"{work}/ods_traffic"), 2024))
    assert "PartitionFilters: [isnotnull(year" in p and "(year#" in p and "= 2024)" in p


def test_satellite_history_scanned_once(spark, work):
    from vaultweave.sources.store import TableStore

    billing = stage(ods_source(spark, SF0001, "billing"), FP.stages["billing"], 1996)
    t = FP.target("sat_service_details")
    store = TableStore(spark, work)
    store.append(sat_rows(billing, None, t, dt.datetime(1996, 1, 1)), t.name)
    tgt = store.read(t.name)
    nxt = sat_rows(stage(ods_source(spark, SF0001, "billing"), FP.stages["billing"], 1997), tgt, t,
                   dt.datetime(1997, 1, 1))
    spark.conf.set("spark.sql.adaptive.enabled", "false")     # static plan shows exchange reuse
    try:
        p = plan(nxt)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in p
    scans_of_target = [ln for ln in p.splitlines() if ln.startswith("Location") and t.name in ln]
    assert len(scans_of_target) == 1, scans_of_target


def test_hubs_and_links_do_not_sort_the_staged_rows(spark, work):
    path = f"{work}/stg"
    stage(ods_source(spark, SF0001, "billing"), FP.stages["billing"]).write.parquet(path)
    staged = spark.read.parquet(path)
    frames = [hub_rows(staged, None, FP.target(h)) for h in ("hub_tariff", "hub_service", "hub_service_literal")]
    frames += [link_rows(staged, None, FP.target("link_user_service_billing_period"))]
    for df in frames:
        tree = plan(df, "simple").splitlines()
        scan = max(i for i, ln in enumerate(tree) if "FileScan" in ln)
        below = max(i for i, ln in enumerate(tree) if "Exchange" in ln and i < scan)
        near_scan = "\n".join(tree[below:scan])
        assert "HashAggregate" in near_scan and "Sort" not in near_scan, near_scan
