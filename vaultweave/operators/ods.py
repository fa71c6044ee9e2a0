"""Lake ODS load: cast a raw (STG) table and keep one year, written as partition ``year=Y``.

Raw tables hold text; bad text becomes NULL (``try_cast``), as Hive's cast does, and a NULL
time falls out of the year filter. ``ods_load(stg, entity)`` without a year loads every year at
once and adds the ``year`` column, for a single partitioned write of a backfill.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultweave.functions.time import epoch_ms_to_ts, in_year


@dataclass(frozen=True)
class OdsSpec:
    columns: tuple[str, ...]
    casts: dict[str, str]
    time_col: str


ODS = {
    "payment": OdsSpec(("user_id", "pay_doc_type", "pay_doc_num", "account", "phone", "billing_period",
                        "pay_date", "sum"),
                       {"pay_date": "timestamp_ntz", "sum": "decimal(10,2)"}, "pay_date"),
    "billing": OdsSpec(("user_id", "billing_period", "service", "tariff", "sum", "created_at"),
                       {"sum": "decimal(10,2)", "created_at": "timestamp_ntz"}, "created_at"),
    "issue": OdsSpec(("user_id", "start_time", "end_time", "title", "description", "service"),
                     {"user_id": "int", "start_time": "timestamp_ntz", "end_time": "timestamp_ntz"},
                     "start_time"),
    # ``timestamp`` is epoch milliseconds in the raw table
    "traffic": OdsSpec(("user_id", "timestamp", "device_id", "device_ip_addr", "bytes_sent", "bytes_received"),
                       {}, "timestamp"),
}


def _epoch_seconds(year: int) -> int:
    return calendar.timegm((year, 1, 1, 0, 0, 0))


def _traffic(stg: DataFrame, year: int | None) -> DataFrame:
    ms = F.col("timestamp")
    secs = (ms.cast("long") / F.lit(1000)).cast("long")  # truncates toward zero, like the raw filter
    df = stg
    if year is not None:
        lo, hi = _epoch_seconds(year), _epoch_seconds(year + 1)
        # a slightly wider range on the raw column reaches the parquet scan; the exact test follows
        df = df.where((ms > F.lit((lo - 1) * 1000)) & (ms < F.lit((hi + 1) * 1000)))
        df = df.where((secs >= F.lit(lo)) & (secs < F.lit(hi)))
        year_col = F.lit(year)
    else:
        df = df.where(ms.isNotNull())
        year_col = F.year(epoch_ms_to_ts(secs * F.lit(1000)))
    return df.select("user_id", epoch_ms_to_ts(ms).alias("timestamp"), "device_id", "device_ip_addr",
                     "bytes_sent", "bytes_received", year_col.cast("int").alias("year"))


def ods_load(stg: DataFrame, entity: str, year: int | None = None) -> DataFrame:
    if entity == "traffic":
        return _traffic(stg, year)
    spec = ODS[entity]
    cols = [F.col(c).try_cast(spec.casts[c]).alias(c) if c in spec.casts else F.col(c) for c in spec.columns]
    df = stg.select(*cols)
    if year is not None:
        df = df.where(in_year(spec.time_col, year)).withColumn("year", F.lit(year))
    else:
        df = df.where(F.col(spec.time_col).isNotNull()).withColumn("year", F.year(spec.time_col))
    return df
