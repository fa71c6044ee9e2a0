import datetime as dt

import pytest
from conftest import SF0001
from helpers import rows_of
from pyspark.sql import functions as F

from vaultweave.operators.staging import stage
from vaultweave.plans.specs import DWL, FP
from vaultweave.plans.yearly import backfill, run_year, target_columns
from vaultweave.sources.fixtures import ods_source
from vaultweave.sources.store import TableStore


def _sources(spark):
    return {s: ods_source(spark, SF0001, s) for s in FP.stages}


def _schema(src, vault, t):
    return stage(src[t.source], vault.stages[t.source]).select(*target_columns(t)).schema


def test_backfill_equals_year_by_year_runs(spark, work):
    src = _sources(spark)
    years = [1995, 1996, 1997, 2024]
    folded, bulk = TableStore(spark, f"{work}/fold"), TableStore(spark, f"{work}/bulk")
    for y in years:
        run_year(spark, FP, src, folded, y, work_dir=f"{work}/tmp{y}", hub_form="both")
    backfill(spark, FP, src, bulk, years, work_dir=f"{work}/tmpb", hub_form="both")
    for t in FP.targets():
        sch = _schema(src, FP, t)
        a, b = folded.read_public(t.name, sch), bulk.read_public(t.name, sch)
        assert rows_of(a) == rows_of(b), t.name
    # link parents are the staging hash keys of the same rows, so the payment links only point at
    # keys of the payment hubs
    keys = lambda name, col: {r[0] for r in bulk.read(name).select(col).distinct().collect()}
    assert keys("link_user_account", "user_pk") - {None} <= keys("hub_user", "user_pk")
    assert keys("link_user_account", "account_pk") - {None} <= keys("hub_account", "account_pk")
    assert keys("link_account_billing_pay", "pay_doc_pk") - {None} <= keys("hub_pay_doc", "pay_doc_pk")
    assert keys("link_account_billing_pay", "billing_period_pk") - {None} <= keys("hub_billing_period",
                                                                                   "billing_period_pk")


def test_backfill_on_top_of_existing_target_and_rerun(spark, work):
    src = {"payment": ods_source(spark, SF0001, "payment")}
    store, ref = TableStore(spark, f"{work}/s"), TableStore(spark, f"{work}/r")
    backfill(spark, DWL, src, store, [1995, 1996], work_dir=f"{work}/t1")
    backfill(spark, DWL, src, store, [1997, 1998], work_dir=f"{work}/t2")     # state from the target
    backfill(spark, DWL, src, store, [1998], work_dir=f"{work}/t3")           # rerun: general rule
    for y in (1995, 1996, 1997, 1998, 1998):
        run_year(spark, DWL, src, ref, y, work_dir=f"{work}/r{y}-{len(str(ref))}")
    for t in DWL.targets("literal"):
        sch = _schema(src, DWL, t)
        assert rows_of(store.read_public(t.name, sch)) == rows_of(ref.read_public(t.name, sch)), t.name


def test_hub_rerun_adds_nothing_for_non_null_keys(spark, work):
    src = {"payment": ods_source(spark, SF0001, "payment")}
    store = TableStore(spark, work)
    only = ["hub_user", "link_user_account"]
    run_year(spark, DWL, src, store, 1996, dt.datetime(1996, 1, 1), only=only, work_dir=f"{work}/a")
    n = [store.read(t).count() for t in only]
    run_year(spark, DWL, src, store, 1996, dt.datetime(1996, 1, 1), only=only, work_dir=f"{work}/b")
    assert [store.read(t).count() for t in only] == n


def test_staging_views_exist_during_run_and_are_dropped(spark, work):
    from vaultweave.plans.yearly import drop_year_views, view_name

    src = {"payment": ods_source(spark, SF0001, "payment")}
    store = TableStore(spark, work)
    seen = {}
    orig = TableStore.append

    def spy(self, rows, name):
        seen[name] = spark.catalog.tableExists(view_name(DWL, "payment", 1997))
        orig(self, rows, name)

    TableStore.append = spy
    try:
        run_year(spark, DWL, src, store, 1997, only=["hub_user"], work_dir=f"{work}/t")
    finally:
        TableStore.append = orig
    assert seen == {"hub_user": True}
    assert not spark.catalog.tableExists(view_name(DWL, "payment", 1997))
    spark.range(1).createOrReplaceTempView(view_name(DWL, "payment", 1990))
    assert drop_year_views(spark, DWL, 1990) == ["dwl_view_payment_1990"]
    assert drop_year_views(spark, DWL, 1990) == []


def test_reloaded_middle_year_counts_for_the_next_run(spark, work):
    """A partition replaced by as many, other rows must change what the next run inserts."""
    day = "TIMESTAMP_NTZ'{}-05-05 00:00:00'"

    def pay(year, phone):
        return spark.sql(f"""select 1 as user_id, 'x' as pay_doc_type, {year} as pay_doc_num, 'FL-1' as account, '{phone}' as phone,
            '{year}-05' as billing_period, {day.format(year)} as pay_date, cast(1 as decimal(10,2)) as sum""")

    store, t = TableStore(spark, f"{work}/s"), DWL.target("sat_user_details")
    for i, y in enumerate((1995, 1996, 1997)):
        run_year(spark, DWL, {"payment": pay(y, f"+{y}")}, store, y, only=[t.name], work_dir=f"{work}/{i}")
    other = TableStore(spark, f"{work}/o")
    run_year(spark, DWL, {"payment": pay(1997, "+7")}, other, 1997, only=[t.name], work_dir=f"{work}/x")
    store.overwrite_year(other.read(t.name), t.name, 1997, col="load_year")
    run_year(spark, DWL, {"payment": pay(1998, "+1997")}, store, 1998, only=[t.name], work_dir=f"{work}/4")
    assert sorted(r.phone for r in store.read_public(t.name).collect()) == ["+1995", "+1996", "+1997", "+7"]


def test_empty_satellite_source_leaves_the_other_targets_loaded(spark, work):
    src = {s: ods_source(spark, SF0001, s) for s in ("payment", "billing")}
    src["payment"] = src["payment"].limit(0)
    store = TableStore(spark, f"{work}/s")
    assert backfill(spark, FP, src, store, only=["hub_tariff", "sat_user_details"], work_dir=f"{work}/t") == []
    assert store.read_public("hub_tariff").count() > 0
    empty = store.read_public("sat_user_details", _schema(src, FP, FP.target("sat_user_details")))
    assert empty.count() == 0 and "user_pk" in [c.lower() for c in empty.columns]


def test_years_come_from_the_folder_names(spark, work):
    store = TableStore(spark, f"{work}/s")
    assert store.years(store.path("hub_user")) == []
    src = {"payment": ods_source(spark, SF0001, "payment")}
    backfill(spark, DWL, src, store, [1995, 1997], only=["hub_pay_doc"], work_dir=f"{work}/t")
    assert store.years(store.path("hub_pay_doc")) == [1995, 1997]


def test_hub_form_decides_which_of_the_two_hubs_is_loaded(spark, work):
    for form, there, absent in (("literal", "hub_billing_period_literal", "hub_billing_period"),
                                ("own_pk", "hub_billing_period", "hub_billing_period_literal")):
        store = TableStore(spark, f"{work}/{form}")
        run_year(spark, DWL, {"payment": ods_source(spark, SF0001, "payment")}, store, 1996, work_dir=f"{work}/t{form}", hub_form=form)
        assert store.read(there).count() > 0 and store.read(absent) is None
    assert {h.name for h in FP.hubs} - {t.name for t in FP.targets("literal")} == {"hub_billing_period", "hub_service"}


def test_a_failing_target_is_reported(spark, work):
    class Full(TableStore):
        def append(self, rows, name):
            if name == "link_user_account":
                raise OSError("no space")
            super().append(rows, name)

    store = Full(spark, f"{work}/s")
    with pytest.raises(OSError, match="no space"):
        run_year(spark, DWL, {"payment": ods_source(spark, SF0001, "payment")}, store, 1996, work_dir=f"{work}/t")
    run_year(spark, DWL, {"payment": ods_source(spark, SF0001, "payment")}, TableStore(spark, f"{work}/s"), 1996, work_dir=f"{work}/u")
    keys = [r[0] for r in store.read("hub_user").select("user_pk").collect()]
    assert store.read("link_user_account").count() > 0 and len(keys) == len(set(keys))


def test_keys_of_one_load_are_all_inserted(spark, work):
    """Pay documents occur in one load each: all their distinct keys are inserted, at that load."""
    from vaultweave.plans.yearly import fold_satellite_keys

    staged = stage(ods_source(spark, SF0001, "payment"), DWL.stages["payment"]).withColumn("load_year", F.year("load_date"))
    t = DWL.target("sat_pay_doc_details")
    keys = fold_satellite_keys(spark, [(t, staged, None)], [1995, 1996], f"{work}/f")
    want = staged.where("load_year in (1995, 1996)").select(F.col(t.pk).alias("pk"), F.col(t.hashdiff).alias("hd"), "load_date").distinct()
    assert rows_of(keys.select("pk", "hd", "load_date")) == rows_of(want)
