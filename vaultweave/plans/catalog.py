"""Registered queries: one per lake statement, staging view and vault target.

Every query reads the driver tables (via the fixture mapping) in full and returns a DataFrame:
  ods_<entity>       lake load of every year in the raw table (with ``year``)
  dm_traffic         traffic mart of every year
  stage_<source>     staging view of every year (each row carries its year's run date)
  <target>           full vault target after loading every year in the data, oldest first
  dwl_<target>       the same for the payment-only vault
  inc_<target>       the same target after one scheduled run per year, each against the table so far
  inc_ods_<entity>   lake table after one scheduled run per year, and one for a year without rows
  inc_dm_traffic     the mart after the same runs
  catalog_ods_<entity>, catalog_dm_traffic   the same runs into partitioned catalog tables
  state_dm_traffic   the mart merged from monthly states that are loaded one by one
  view_stage_<source>  staging read through one permanent view per year
  one_scan_<source>  keys of all hubs and links of a source, from one reading of it
  rerun_<target>     runs of 1996, 1998, 1997 and 1997 again: out of order, and a rerun
  dirty_<target>     payments with NULL, blank, padded and differently cased keys, every year
  years_<target>     traffic targets over four years
The incremental, rerun and dirty runs keep their targets in catalog tables: hubs and links bucketed by key, satellites in
ranges of their key.
Vault queries write their target under ``spark.checkpoint.dir`` and return the written table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultweave.operators.mart import traffic_mart
from vaultweave.operators.ods import ods_load
from vaultweave.operators.staging import stage
from vaultweave.plans.lake import reload_slice, run_lake_year
from vaultweave.plans.specs import DWL, FP, VaultSpec
from vaultweave.plans.yearly import backfill, in_years, run_year, target_columns
from vaultweave.plans.views import publish
from vaultweave.session import materialize, new_work_dir
from vaultweave.sources.catalog_store import CatalogStore
from vaultweave.sources.fixtures import dirty_payment, ods_source, stg_source, traffic_of_years
from vaultweave.sources.store import CODEC, LOAD_YEAR, TableStore

Query = Callable[[SparkSession, str], DataFrame]

ENTITIES = ("payment", "billing", "issue", "traffic")


def _ods(entity: str) -> Query:
    return lambda spark, sf_dir: ods_load(stg_source(spark, sf_dir, entity), entity)


def _dm_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic_mart(ods_load(stg_source(spark, sf_dir, "traffic"), "traffic"))


def _stage(vault: VaultSpec, source: str) -> Query:
    return lambda spark, sf_dir: stage(ods_source(spark, sf_dir, source), vault.stages[source])


def vault_target(vault: VaultSpec, name: str, source: Callable | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = vault.target(name)
        src = source(spark, sf_dir) if source else ods_source(spark, sf_dir, t.source)
        work = new_work_dir(spark, f"{vault.name}-{name}")
        store = TableStore(spark, f"{work}/vault")
        backfill(spark, vault, {t.source: src}, store, only=[name], work_dir=f"{work}/tmp")
        schema = stage(src, vault.stages[t.source]).select(*target_columns(t)).schema
        return store.read_public(name, schema)
    return run


def database_of(work: str) -> str:
    """A database name of its own for each work folder."""
    return f"vw_{work.rsplit('-', 1)[1]}"


def vault_store(spark: SparkSession, vault: VaultSpec, work: str) -> CatalogStore:
    """Catalog tables of a vault: hubs and links bucketed by their key, satellites in ranges of it."""
    return CatalogStore(spark, f"{work}/vault", database_of(work), {t.name: t.pk for t in (*vault.hubs, *vault.links)},
                        {t.name: t.pk for t in vault.sats})


#: targets also built by one scheduled run per year against the table so far; in-order runs give the backfill's rows
INCREMENTAL = tuple(t.name for t in FP.targets())


#: sources that join tables: queries of several loads write them once
JOINED = ("billing", "issue")


def source_by_year(src: DataFrame, source: str, time_col: str, path: str, loads: tuple[int, ...] = ()) -> tuple[DataFrame, list[int]]:
    """A source for one load after the other, and the years to load: ``loads`` or all. A joined one is written once, by year,
    so that a load reads its own year and joins nothing again."""
    if source not in JOINED:
        return src, list(loads) or sorted(r[0] for r in src.select(F.year(time_col)).distinct().collect() if r[0] is not None)
    kept = src.where(in_years(time_col, list(loads)) if loads else F.col(time_col).isNotNull())
    rows = materialize(kept.withColumn(LOAD_YEAR, F.year(time_col)), path, LOAD_YEAR, codec=CODEC)
    return rows, list(loads) or TableStore(src.sparkSession, path).years(path)


def of_year(src: DataFrame, year: int) -> DataFrame:
    return src.where(F.col(LOAD_YEAR) == year).drop(LOAD_YEAR) if LOAD_YEAR in src.columns else src


def incremental_target(vault: VaultSpec, name: str, source: Callable | None = None, loads: tuple[int, ...] = ()) -> Query:
    """One scheduled run per load: ``loads`` in the order given, or every year in the data."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = vault.target(name)
        src = source(spark, sf_dir) if source else ods_source(spark, sf_dir, t.source)
        work = new_work_dir(spark, f"inc-{name}")
        store = vault_store(spark, vault, work)
        rows, years = source_by_year(src, t.source, vault.stages[t.source].time_col, f"{work}/source", loads)
        for i, y in enumerate(years):
            run_year(spark, vault, {t.source: of_year(rows, y)}, store, y, only=[name], work_dir=f"{work}/{i}-{y}")
        schema = stage(src, vault.stages[t.source]).select(*target_columns(t)).schema
        return store.read_public(name, schema)
    return run


#: loads of the rerun queries: 1997 comes after 1998, and twice
RERUN = (1996, 1998, 1997, 1997)
RERUN_TARGETS = ("hub_user", "hub_pay_doc", "hub_service_literal", "link_user_account", "link_user_service_billing_period",
                 "sat_service_details", "sat_issue_details", "sat_tariff_details", "sat_user_details", "sat_pay_doc_details")
DIRTY_TARGETS = ("hub_user", "hub_pay_doc", "hub_billing_period_literal", "link_user_account", "link_account_billing_pay",
                 "sat_user_details", "sat_pay_doc_details")
YEARS_TARGETS = ("hub_device", "link_user_device", "sat_device_details")


def one_scan_target(vault: VaultSpec, source: str) -> Query:
    """All hubs and links of a source from one reading of its staged years: ``target, pk, load_date, record_source``."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        targets = [t for t in (*vault.hubs, *vault.links) if t.source == source]
        work = new_work_dir(spark, f"one-{source}")
        store = TableStore(spark, f"{work}/vault")
        src = ods_source(spark, sf_dir, source)
        backfill(spark, vault, {source: src}, store, only=[t.name for t in targets], work_dir=f"{work}/tmp", one_scan=True)
        out = None
        for t in targets:
            schema = stage(src, vault.stages[source]).select(*target_columns(t)).schema
            rows = store.read_public(t.name, schema).select(F.lit(t.name).alias("target"), F.col(t.pk).alias("pk"), "load_date", "record_source")
            out = rows if out is None else out.unionByName(rows)
        return out
    return run


def view_stage(vault: VaultSpec, source: str) -> Query:
    """Every year's batch written, published as a permanent view and read through it."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src, spec = ods_source(spark, sf_dir, source), vault.stages[source]
        work = new_work_dir(spark, f"view-{source}")
        rows, years = source_by_year(src, source, spec.time_col, f"{work}/source")
        out = stage(src, spec).limit(0)
        for y in years:
            stage(of_year(rows, y), spec, y).write.option("compression", CODEC).parquet(f"{work}/{y}")
            out = out.unionByName(publish(spark, vault, source, y, f"{work}/{y}", database_of(work)))
        return out
    return run


def yearly_lake(entity: str, table: str, by_name: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stg = stg_source(spark, sf_dir, entity)
        work = new_work_dir(spark, f"inc-{table}")
        store = CatalogStore(spark, f"{work}/lake", database_of(work)) if by_name else TableStore(spark, f"{work}/lake")
        loaded = ods_load(stg, entity)
        years = sorted(r[0] for r in loaded.select("year").distinct().collect())
        for y in [*years, max(years, default=2000) + 1]:                 # the last one is empty
            run_lake_year(spark, {entity: stg}, store, y)
        if by_name:
            return spark.table(store.name(table))
        shape = traffic_mart(loaded) if table == "dm_traffic" else loaded
        return spark.read.schema(shape.schema).parquet(store.path(table))
    return run


def state_dm_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart merged from its monthly state, every month loaded on its own, and the first one of each year once more."""
    stg = stg_source(spark, sf_dir, "traffic")
    store = TableStore(spark, f"{new_work_dir(spark, 'state')}/lake")
    loaded = ods_load(stg, "traffic")
    months = sorted(tuple(r) for r in loaded.select("year", F.month("timestamp")).distinct().collect())
    again = [m for i, m in enumerate(months) if i == 0 or months[i - 1][0] != m[0]]
    for y, m in [*months, *again]:
        reload_slice(spark, stg, store, y, m)
    return spark.read.schema(traffic_mart(loaded).schema).parquet(store.path("dm_traffic"))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for e in ENTITIES:
        q[f"ods_{e}"] = _ods(e)
    q["dm_traffic"] = _dm_traffic
    for s in FP.stages:
        q[f"stage_{s}"] = _stage(FP, s)
    q["stage_payment_dwl"] = _stage(DWL, "payment")
    for t in FP.targets():
        q[t.name] = vault_target(FP, t.name)
    for t in DWL.targets():
        q[f"dwl_{t.name}"] = vault_target(DWL, t.name)
    for name in INCREMENTAL:
        q[f"inc_{name}"] = incremental_target(FP, name)
    for e in ENTITIES:
        q[f"inc_ods_{e}"] = yearly_lake(e, f"ods_{e}")
        q[f"catalog_ods_{e}"] = yearly_lake(e, f"ods_{e}", by_name=True)
    q["inc_dm_traffic"] = yearly_lake("traffic", "dm_traffic")
    q["catalog_dm_traffic"] = yearly_lake("traffic", "dm_traffic", by_name=True)
    q["state_dm_traffic"] = state_dm_traffic
    for s in FP.stages:
        q[f"view_stage_{s}"] = view_stage(FP, s)
        q[f"one_scan_{s}"] = one_scan_target(FP, s)
    for name in RERUN_TARGETS:
        q[f"rerun_{name}"] = incremental_target(FP, name, loads=RERUN)
    for name in DIRTY_TARGETS:
        q[f"dirty_{name}"] = incremental_target(FP, name, dirty_payment)
    for name in YEARS_TARGETS:
        q[f"years_{name}"] = vault_target(FP, name, traffic_of_years)
    return q
