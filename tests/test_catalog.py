"""Catalog tables and views: bucketed anti joins, static partition overwrite, views across sessions, clustered history."""

import contextlib
import datetime as dt
import io

import pytest
from conftest import SF0001
from helpers import rows_of
from pyspark.sql import functions as F

from vaultweave.operators.hub import hub_rows
from vaultweave.operators.link import link_rows
from vaultweave.operators.satellite import sat_rows
from vaultweave.operators.staging import stage
from vaultweave.plans import catalog
from vaultweave.plans.lake import run_lake_year
from vaultweave.plans.specs import DWL, FP
from vaultweave.plans.views import drop_year_views, publish, view_name
from vaultweave.plans.yearly import NEAR_KEYS, near_history, run_year
from vaultweave.sources.catalog_store import CatalogStore
from vaultweave.sources.fixtures import ods_source, stg_source
from vaultweave.sources.store import TableStore


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture()
def store(spark, work):
    s = catalog.vault_store(spark, FP, work)
    yield s
    s.drop()


def payment(spark):
    return {"payment": ods_source(spark, SF0001, "payment")}


def test_the_target_of_an_anti_join_is_not_shuffled(spark, work, store):
    only = ["hub_user", "hub_billing_period_literal", "link_user_account"]
    for y in (1995, 1996):
        run_year(spark, FP, payment(spark), store, y, only=only, work_dir=f"{work}/{y}")
    stg = stage(payment(spark)["payment"], FP.stages["payment"], 1997)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in only:
            t, tgt = FP.target(name), store.read(name)
            rows = link_rows(stg, tgt, t, single_load=True) if name.startswith("link") else hub_rows(stg, tgt, t)
            tree = plan(rows).splitlines()
            join = next(i for i, ln in enumerate(tree) if "LeftAnti" in ln)
            depth = len(tree[join]) - len(tree[join].lstrip(" :+-"))
            # the second child of the join is the target's side
            side = next(i for i in range(len(tree) - 1, join, -1) if tree[i].startswith(" " * depth + "+- "))
            assert any("Bucketed: true" in ln for ln in tree[side:]) and not any("Exchange" in ln for ln in tree[side:]), "\n".join(tree)
            assert any("Exchange" in ln for ln in tree[join:side])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_new_catalog_finds_the_tables_again(spark, work, store):
    run_year(spark, FP, payment(spark), store, 1995, only=["hub_user", "sat_user_details"], work_dir=f"{work}/a")
    before = {n: rows_of(store.read_public(n)) for n in ("hub_user", "sat_user_details")}
    store.drop()                                                # what the end of a session does to Spark's own catalog
    assert not spark.catalog.databaseExists(store.database)
    again = catalog.vault_store(spark, FP, work)
    t = FP.target("hub_user")
    schema = stage(payment(spark)["payment"], FP.stages["payment"]).select(t.pk, *t.keys, "load_date", "record_source").schema
    assert rows_of(again.read_public("hub_user", schema)) == before["hub_user"]
    run_year(spark, FP, payment(spark), again, 1996, only=["hub_user", "sat_user_details"], work_dir=f"{work}/b")
    plain = TableStore(spark, f"{work}/plain")
    for y in (1995, 1996):
        run_year(spark, FP, payment(spark), plain, y, only=["hub_user", "sat_user_details"], work_dir=f"{work}/p{y}")
    for n in before:
        assert rows_of(again.read_public(n)) == rows_of(plain.read_public(n))
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {again.name('hub_user')}").collect()] == ["load_year=1995", "load_year=1996"]


def test_static_overwrite_registers_and_clears_a_partition(spark, work):
    store = CatalogStore(spark, f"{work}/lake", catalog.database_of(work))
    stg = {"payment": stg_source(spark, SF0001, "payment")}
    for y in (1996, 1997):
        run_lake_year(spark, stg, store, y)
    name = store.name("ods_payment")
    parts = lambda: sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    assert parts() == ["year=1996", "year=1997"]
    n96, n97 = (spark.table(name).where(f"year = {y}").count() for y in (1996, 1997))
    assert n96 and n97
    run_lake_year(spark, {"payment": stg["payment"].where("pay_date < '1997'")}, store, 1997)      # the year has no rows any more
    assert spark.table(name).where("year = 1997").count() == 0 and spark.table(name).count() == n96
    assert spark.sql(f"SELECT count(*) FROM {name} WHERE year = 1996").first()[0] == n96
    store.drop()


def test_permanent_views_are_dropped_by_a_run_of_its_own(spark, work):
    db = catalog.database_of(work)
    store = TableStore(spark, f"{work}/s")
    other = spark.newSession()                                  # the cleanup run: same catalog, no session views in common
    assert drop_year_views(other, DWL, 1996, db) == []          # idle: not even the database is there
    run_year(spark, DWL, payment(spark), store, 1996, only=["hub_user", "sat_user_details"], work_dir=f"{work}/a", view_database=db, keep_views=True)
    name = view_name(DWL, "payment", 1996)
    assert not [v.name for v in spark.catalog.listTables() if v.isTemporary and v.name == name]
    assert other.table(f"`{db}`.`{name}`").count() == other.sql(f"SELECT * FROM `{db}`.`{name}` WHERE load_date = TIMESTAMP_NTZ'1996-01-01'").count() > 0
    assert drop_year_views(other, DWL, 1996, db) == [name]
    assert not spark.catalog.tableExists(f"`{db}`.`{name}`")
    assert drop_year_views(other, DWL, 1996, db) == []          # idle again
    plain = TableStore(spark, f"{work}/p")
    run_year(spark, DWL, payment(spark), plain, 1996, only=["hub_user", "sat_user_details"], work_dir=f"{work}/b")
    for n in ("hub_user", "sat_user_details"):
        assert rows_of(store.read_public(n)) == rows_of(plain.read_public(n))
    run_year(spark, DWL, payment(spark), store, 1997, only=["hub_user"], work_dir=f"{work}/c", view_database=db)
    assert not spark.catalog.tableExists(f"`{db}`.`{view_name(DWL, 'payment', 1997)}`")      # dropped at the end of the run
    spark.sql(f"DROP DATABASE `{db}` CASCADE")


def test_a_view_is_replaced(spark, work):
    db = catalog.database_of(work)
    for i, n in enumerate((3, 5)):
        spark.range(n).write.parquet(f"{work}/v{i}")
        assert publish(spark, DWL, "payment", 2001, f"{work}/v{i}", db).count() == n
    assert drop_year_views(spark, DWL, 2001, db) == ["dwl_view_payment_2001"]
    spark.sql(f"DROP DATABASE `{db}` CASCADE")


def scanned(df):
    """Rows that the scans of ``df`` hand on, from the metrics of its executed plan."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            todo.append(p.plan())
        if kind == "FileSourceScanExec":
            rows += p.metrics().apply("numOutputRows").value()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return rows


def test_a_small_batch_reads_little_of_a_clustered_history(spark, work, store):
    src = ods_source(spark, SF0001, "payment")
    t = FP.target("sat_user_details")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for y in (1995, 1996, 1997):
            run_year(spark, FP, {"payment": src}, store, y, only=[t.name], work_dir=f"{work}/{y}")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    tgt = store.read(t.name)
    stg = stage(src, FP.stages["payment"], 1998, dt.datetime(1998, 1, 1))
    one = stg.where(F.col("user_pk") == stg.select(F.min("user_pk")).first()[0])
    near = near_history(one, tgt, t)
    assert scanned(near.select(t.pk, t.hashdiff)) <= tgt.count() / 2
    assert rows_of(sat_rows(one, near, t, dt.datetime(1998, 1, 1))) == rows_of(sat_rows(one, tgt, t, dt.datetime(1998, 1, 1)))
    assert "parquet.bloom.filter.enabled#user_pk" in str(spark.sql(f"DESCRIBE FORMATTED {store.name(t.name)}").collect())
    assert stg.select(t.pk).distinct().count() > NEAR_KEYS and near_history(stg, tgt, t) is tgt
    assert near_history(stg, None, t) is None
    assert near_history(one.withColumn("user_pk", F.lit(None).cast("string")), tgt, t).count() == 0


def test_the_mart_lies_in_order_of_its_files(spark, work):
    store = CatalogStore(spark, f"{work}/lake", catalog.database_of(work))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run_lake_year(spark, {"traffic": stg_source(spark, SF0001, "traffic")}, store, 2024)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    mart = store.read("dm_traffic").where("year = 2024")
    bounds = (mart.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("avg_traf").alias("a"), F.max("avg_traf").alias("b")).orderBy("f").collect())
    assert len(bounds) > 1 and all(x.b <= y.a for x, y in zip(bounds, bounds[1:]))
    cut = mart.where(F.col("avg_traf") > bounds[-2].b)
    assert "PushedFilters: [IsNotNull(avg_traf), GreaterThan(avg_traf" in plan(cut)
    assert scanned(cut) < mart.count()
    store.drop()


def test_null_keys_of_dirty_payments_come_back_at_every_load(spark):
    hub = catalog.queries()["dirty_hub_user"](spark, SF0001)
    per_load = {r.load_date.year: r["count"] for r in hub.where("user_pk is null").groupBy("load_date").count().collect()}
    assert len(per_load) >= 6 and set(per_load.values()) == {1}
    keys = [r.user_pk for r in hub.where("user_pk is not null").select("user_pk").collect()]
    assert len(keys) == len(set(keys))
    forms = {r.user_key for r in hub.collect()}                 # keys keep the text they came with, tabs count
    assert any(f and f.startswith("  ") for f in forms) and any(f and f.startswith("\t") for f in forms) and any(f and f.islower() for f in forms)
