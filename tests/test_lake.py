import datetime as dt

from pyspark.sql import functions as F

from vaultweave.operators.mart import traffic_mart
from vaultweave.operators.ods import ods_load
from vaultweave.sources.store import TableStore


def test_bad_text_becomes_null_and_null_dates_drop(spark):
    stg = spark.createDataFrame(
        [("abc", "2001-03-04 05:06:07", "2001-03-05 00:00:00", "t", "d", "s"),
         ("12", "x", None, "t", "d", "s"),
         ("13", "2002-01-01 00:00:00", None, "t", "d", "s")],
        "user_id string, start_time string, end_time string, title string, description string, service string")
    out = ods_load(stg, "issue", 2001).collect()
    assert len(out) == 1 and out[0].user_id is None and out[0].year == 2001
    assert out[0].start_time == dt.datetime(2001, 3, 4, 5, 6, 7)
    assert sorted(r.year for r in ods_load(stg, "issue").collect()) == [2001, 2002]


def test_decimal_cast_and_year_filter_payment(spark):
    stg = spark.createDataFrame([(1, "t", 5, "a", "p", "2001-01", "2001-12-31 23:59:59", "10.005"),
                                 (1, "t", 6, "a", "p", "2002-01", "2002-01-01 00:00:00", "1e20")],
                                "user_id bigint, pay_doc_type string, pay_doc_num bigint, account string, phone string, "
                                "billing_period string, pay_date string, sum string")
    r = ods_load(stg, "payment", 2001).collect()
    assert len(r) == 1 and str(r[0]["sum"]) == "10.01"
    assert ods_load(stg, "payment", 2002).collect()[0]["sum"] is None      # overflow -> NULL


def test_traffic_epoch_ms_exact(spark):
    ms_2024 = 1704067207179          # 2024-01-01 00:00:07.179 UTC
    stg = spark.createDataFrame([(1, ms_2024, "d", "ip", 1, 10), (1, 1704067199999, "d", "ip", 1, 30)],
                                "user_id bigint, timestamp bigint, device_id string, device_ip_addr string, "
                                "bytes_sent int, bytes_received int")
    r = ods_load(stg, "traffic", 2024).collect()
    assert len(r) == 1 and r[0]["timestamp"] == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)
    assert ods_load(stg, "traffic", 2023).count() == 1
    mart = traffic_mart(ods_load(stg, "traffic")).orderBy("year").collect()
    assert [(m.year, m.avg_traf) for m in mart] == [(2023, 30.0), (2024, 10.0)]


def test_round_half_up_in_mart(spark):
    df = spark.createDataFrame([(1, 1, 2024), (1, 2, 2024)], "user_id bigint, bytes_received int, year int")
    assert traffic_mart(df, 2024).first().avg_traf == 2.0     # 1.5 rounds up


def test_overwrite_year_replaces_only_that_year_even_when_empty(spark, work):
    store = TableStore(spark, work)
    df = spark.createDataFrame([(1, 2001), (2, 2002)], "v int, year int")
    for y in (2001, 2002):
        store.overwrite_year(df.where(F.col("year") == y), "t", y)
    store.overwrite_year(spark.createDataFrame([(9, 2001)], "v int, year int"), "t", 2001)
    got = sorted(tuple(r) for r in spark.read.parquet(store.path("t")).collect())
    assert got == [(2, 2002), (9, 2001)]
    store.overwrite_year(df.limit(0), "t", 2001)
    got = sorted(tuple(r) for r in spark.read.schema("v int, year int").parquet(store.path("t")).collect())
    assert got == [(2, 2002)]


def test_lake_backfill_equals_yearly_runs_and_empties_missing_years(spark, work):
    from conftest import SF0001

    from vaultweave.plans.lake import ENTITIES, backfill_lake, run_lake_year
    from vaultweave.sources.fixtures import stg_source

    stg = {e: stg_source(spark, SF0001, e) for e in ENTITIES}
    years = [1996, 1997, 2024, 2030]
    a, b = TableStore(spark, f"{work}/a"), TableStore(spark, f"{work}/b")
    for y in years:
        run_lake_year(spark, stg, a, y)
    # b starts with stale rows in 2030, which the backfill must clear
    store_stale = spark.createDataFrame([(1, 2030)], "user_id bigint, year int")
    b.overwrite_year(store_stale, "dm_traffic", 2030)
    backfill_lake(spark, stg, b, years)
    for t in [f"ods_{e}" for e in ENTITIES] + ["dm_traffic"]:
        ra = sorted(map(str, spark.read.parquet(a.path(t)).collect()))
        rb = sorted(map(str, spark.read.parquet(b.path(t)).collect()))
        assert ra == rb and len(ra) > 0, t


def test_mart_state_is_merged_and_one_month_reloaded(spark, work):
    import calendar

    from vaultweave.plans.lake import reload_slice

    ms = lambda y, m, d: calendar.timegm((y, m, d, 12, 0, 0)) * 1000
    schema = "user_id bigint, timestamp bigint, device_id string, device_ip_addr string, bytes_sent int, bytes_received int"
    rows = [(u, ms(2023 + (m > 6), m, d), "d", "ip", 1, None if (u, d) == (3, 1) else u * 100 + m * d) for u in (1, 2, 3) for m in range(1, 13) for d in (1, 2, 28)]
    rows += [(4, ms(2024, 12, 31), "d", "ip", 1, None)]
    store = TableStore(spark, work)
    stg = spark.createDataFrame(rows, schema)
    for y, m in [(2023, m) for m in range(1, 7)] + [(2024, m) for m in range(7, 13)]:
        reload_slice(spark, stg, store, y, m)
    mart = lambda raw: sorted(map(str, traffic_mart(ods_load(spark.createDataFrame(raw, schema), "traffic")).collect()))
    got = lambda: sorted(map(str, spark.read.parquet(store.path("dm_traffic")).select("user_id", "max_bytes_received", "min_bytes_received", "avg_traf", "year").collect()))
    assert got() == mart(rows)
    # one month is replaced: only its raw rows are handed in, the other months come from the state
    december = [(1, ms(2024, 12, 5), "d", "ip", 1, 7), (5, ms(2024, 12, 6), "d", "ip", 1, 9)]
    reload_slice(spark, spark.createDataFrame(december, schema), store, 2024, 12)
    assert got() == mart([r for r in rows if r[1] < ms(2024, 12, 1) - 43_200_000] + december)
    reload_slice(spark, stg.limit(0), store, 2024, 12)          # a month without rows any more
    assert got() == mart([r for r in rows if r[1] < ms(2024, 12, 1) - 43_200_000])
