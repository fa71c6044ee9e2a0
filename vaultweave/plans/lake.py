"""Lake runs: raw tables -> year-partitioned ODS tables -> traffic mart.

``run_lake_year`` is one yearly run: each ODS table gets exactly its ``year=Y`` partition
replaced (emptied when the raw table has no rows of that year), then the mart's ``year=Y``
partition is rebuilt from the ODS traffic partition, in order of ``avg_traf``: a range sort, so the files of a year
are ranges of it, in file order, and a filter on it reads few of them. ``backfill_lake`` does the same for many
years with one dynamic partition overwrite per table, and empties the requested years that get no
rows (which that overwrite would leave, unlike the yearly one).
"""

from __future__ import annotations

import calendar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultweave.operators.mart import traffic_mart, traffic_mart_of_state, traffic_state
from vaultweave.operators.ods import ods_load
from vaultweave.sources.store import TableStore

ENTITIES = ("traffic", "billing", "issue", "payment")


def run_lake_year(spark: SparkSession, stg: dict[str, DataFrame], store: TableStore, year: int) -> None:
    """One yearly run over the raw tables in ``stg``; the mart is rebuilt when traffic is among them."""
    for e in (e for e in ENTITIES if e in stg):
        store.overwrite_year(ods_load(stg[e], e, year), f"ods_{e}", year)
    if "traffic" not in stg:
        return
    mart = traffic_mart(store.read("ods_traffic"), year).orderBy("avg_traf", "user_id")
    store.overwrite_year(mart, "dm_traffic", year)


def _overwrite_years(spark: SparkSession, df: DataFrame, store: TableStore, name: str, years: list[int]) -> None:
    """Replace partitions ``year in years`` with the rows of ``df``: those that get rows in one
    dynamic overwrite, so a failed run leaves the old rows; only years without rows are emptied
    (a zero-row write, Catalyst folds ``limit(0)`` away)."""
    rows = df.where(F.col("year").isin(years))
    filled = {r[0] for r in rows.select("year").distinct().collect()}      # at most len(years)
    if filled:
        store.overwrite_years(rows, name)
    for y in sorted(set(years) - filled):
        store.overwrite_year(df.limit(0), name, y)


def backfill_lake(spark: SparkSession, stg: dict[str, DataFrame], store: TableStore, years: list[int]) -> None:
    for e in ENTITIES:
        _overwrite_years(spark, ods_load(stg[e], e), store, f"ods_{e}", years)
    ods_traffic = store.read("ods_traffic").where(F.col("year").isin(years))
    _overwrite_years(spark, traffic_mart(ods_traffic).orderBy("year", "avg_traf", "user_id"), store, "dm_traffic", years)


STATE = "dm_traffic_state"


def reload_slice(spark: SparkSession, stg_traffic: DataFrame, store: TableStore, year: int, month: int) -> None:
    """Rebuild one month of the mart's state from the raw rows of that month, then the mart's year from its twelve months.

    The raw rows read are those of the month (a range on the raw time reaches the scan); the mart's year is merged from the state,
    one row per user and month. A month whose raw rows are gone is emptied. Other months stay as they are."""
    lo = calendar.timegm((year, month, 1, 0, 0, 0)) * 1000
    hi = calendar.timegm((year + month // 12, month % 12 + 1, 1, 0, 0, 0)) * 1000
    ms = F.col("timestamp")
    rows = ods_load(stg_traffic.where((ms >= lo) & (ms < hi)), "traffic", year)
    state = traffic_state(rows).drop("year", "month")
    state.write.mode("overwrite").parquet(f"{store.path(STATE)}/year={year}/month={month}")
    whole = spark.read.schema(f"{state_schema(state)}, year int, month int").parquet(store.path(STATE)).where(F.col("year") == year)
    store.overwrite_year(traffic_mart_of_state(whole).orderBy("avg_traf", "user_id"), "dm_traffic", year)


def state_schema(state: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema.fields)
