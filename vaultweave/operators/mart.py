"""Traffic mart: per user and year, max / min / rounded mean of bytes received.

Reads the ODS traffic table; with ``year`` the filter is on the partition column, so only that
partition is listed and scanned. One hash aggregate with a partial step: a user holding a third
of all rows is reduced map-side. The lake runs sort a year by ``avg_traf`` over all its files when they write it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def traffic_mart(ods_traffic: DataFrame, year: int | None = None) -> DataFrame:
    df = ods_traffic if year is None else ods_traffic.where(F.col("year") == F.lit(year))
    return (df.groupBy("year", "user_id")
            .agg(F.max("bytes_received").alias("max_bytes_received"),
                 F.min("bytes_received").alias("min_bytes_received"),
                 F.round(F.avg("bytes_received")).alias("avg_traf"))
            .select("user_id", "max_bytes_received", "min_bytes_received", "avg_traf", "year"))


def traffic_state(ods_traffic: DataFrame) -> DataFrame:
    """Mergeable aggregates of the mart per year, month and user: sum, count, max and min of bytes received. Months add up to a
    year without the raw rows; rows whose bytes are NULL count for the user only."""
    b = F.col("bytes_received")
    return (ods_traffic.groupBy("year", F.month("timestamp").alias("month"), "user_id")
            .agg(F.sum(b.cast("long")).alias("bytes"), F.count(b).alias("n"), F.max(b).alias("max_bytes_received"), F.min(b).alias("min_bytes_received"))
            .select("user_id", "bytes", "n", "max_bytes_received", "min_bytes_received", "year", "month"))


def traffic_mart_of_state(state: DataFrame) -> DataFrame:
    """The mart's rows of every year in ``state``, equal to ``traffic_mart`` over the raw rows."""
    mean = F.when(F.sum("n") > 0, F.sum("bytes").cast("double") / F.sum("n"))
    return (state.groupBy("year", "user_id")
            .agg(F.max("max_bytes_received").alias("max_bytes_received"), F.min("min_bytes_received").alias("min_bytes_received"), F.round(mean).alias("avg_traf"))
            .select("user_id", "max_bytes_received", "min_bytes_received", "avg_traf", "year"))
