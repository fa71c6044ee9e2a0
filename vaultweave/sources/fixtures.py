"""Source entities derived from the driver's TPC-H-like tables.

The reference ships no data, so each entity is mapped onto the given tables (same mapping in
the oracle SQL). ODS form = typed; STG form = the raw text the lake load casts from.
Fixed fixture values: accounts are customer key modulo 750 with prefix 'FL-', each customer has
two phones ('+' customer*10 + order parity), device ip is '10.0.0.' + event id modulo 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultweave.functions.time import ts_to_epoch_ms


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("pay_doc_type"),
        F.col("o_orderkey").alias("pay_doc_num"),
        F.concat(F.lit("FL-"), (F.col("o_custkey") % 750).cast("string")).alias("account"),
        F.concat(F.lit("+"), (F.col("o_custkey") * 10 + F.col("o_orderkey") % 2).cast("string")).alias("phone"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 7).alias("billing_period"),
        F.col("o_orderdate").alias("pay_date"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("sum"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return (li.join(o, li["l_orderkey"] == o["o_orderkey"])
              .join(p, li["l_partkey"] == p["p_partkey"]))


def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        F.col("o_custkey").alias("user_id"),
        F.substring(F.col("l_shipdate").cast("string"), 1, 7).alias("billing_period"),
        F.col("p_type").alias("service"),
        F.col("p_brand").alias("tariff"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("sum"),
        F.col("l_shipdate").alias("created_at"),
    )


def issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_shipdate").alias("start_time"),
        (F.col("l_shipdate") + F.expr("INTERVAL 2 DAYS")).alias("end_time"),
        F.concat(F.lit("return "), F.col("p_type")).alias("title"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string"), F.lit(" status "),
                 F.col("l_linestatus")).alias("description"),
        F.col("p_brand").alias("service"),
    )


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id"),
        F.col("ts").alias("timerequest"),
        F.regexp_extract(F.col("props"), "([0-9]+)", 1).alias("device_id"),
        F.concat(F.lit("10.0.0."), (F.col("event_id") % 4).cast("string")).alias("device_ip_addr"),
        F.floor(F.col("value") * 10).cast("int").alias("bytes_sent"),
        F.floor(F.col("value") * 100).cast("int").alias("bytes_received"),
    )


def dirty_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments with NULL, blank, padded and differently cased keys, picked by order key; 50 pay documents, so that a
    document recurs in every year with other dates and sums."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")

    def spoiled(base, step: int):
        kind = k % step
        return (F.when(kind == 0, F.lit(None).cast("string")).when(kind == 1, "").when(kind == 2, "   ")
                .when(kind == 3, F.concat(F.lit("  "), base, F.lit(" "))).when(kind == 4, F.lower(base)).when(kind == 5, F.upper(base))
                .when(kind == 6, F.concat(F.lit("\t"), base)).otherwise(base))

    return o.select(
        spoiled(F.concat(F.lit("Cust-"), F.col("o_custkey").cast("string")), 11).alias("user_id"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).when(k % 13 == 1, " ").otherwise(F.col("o_orderpriority")).alias("pay_doc_type"),
        F.when(k % 13 < 2, F.lit(None).cast("long")).otherwise(k % 50).alias("pay_doc_num"),
        spoiled(F.concat(F.lit("Fl-"), (F.col("o_custkey") % 750).cast("string")), 17).alias("account"),
        spoiled(F.concat(F.lit("ext "), (k % 3).cast("string")), 19).alias("phone"),
        F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(F.substring(F.col("o_orderdate").cast("string"), 1, 7)).alias("billing_period"),
        F.col("o_orderdate").alias("pay_date"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("sum"),
    )


def traffic_of_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic over four years: requests moved back by 0 to 3 times 366 days, by event."""
    days = F.pmod(F.floor(F.col("event_id") / 4), F.lit(4)).cast("int") * 366
    return table(spark, sf_dir, "events").select(
        "user_id", (F.col("ts") - F.make_dt_interval(days)).alias("timerequest"), F.regexp_extract(F.col("props"), "([0-9]+)", 1).alias("device_id"),
        F.concat(F.lit("10.0.0."), (F.col("event_id") % 4).cast("string")).alias("device_ip_addr"),
        F.floor(F.col("value") * 10).cast("int").alias("bytes_sent"), F.floor(F.col("value") * 100).cast("int").alias("bytes_received"))


ODS_SOURCES = {"payment": payment, "billing": billing, "issue": issue, "traffic": traffic}


def ods_source(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return ODS_SOURCES[entity](spark, sf_dir)


def stg_source(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Raw (STG) text form of an entity, as the lake load receives it."""
    df = ods_source(spark, sf_dir, entity)
    if entity == "payment":
        return df.withColumn("pay_date", F.col("pay_date").cast("string")).withColumn("sum", F.col("sum").cast("string"))
    if entity == "billing":
        return df.withColumn("sum", F.col("sum").cast("string")).withColumn("created_at", F.col("created_at").cast("string"))
    if entity == "issue":
        return df.select(F.col("user_id").cast("string").alias("user_id"),
                         F.col("start_time").cast("string").alias("start_time"),
                         F.col("end_time").cast("string").alias("end_time"), "title", "description", "service")
    if entity == "traffic":
        return df.select("user_id", ts_to_epoch_ms("timerequest").alias("timestamp"), "device_id",
                         "device_ip_addr", "bytes_sent", "bytes_received")
    raise KeyError(entity)
