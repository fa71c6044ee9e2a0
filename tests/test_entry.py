import duckdb
import pytest
from conftest import SF0001

import __spark_entry__ as E
from vaultweave.plans import catalog, oracle
from vaultweave.plans.specs import DWL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["user_pk", "user_hashdiff", "phone", "effective_from", "load_date", "record_source"]
    assert df.count() > 0


def test_every_query_has_oracle_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_some_queries_against_duckdb_at_sf0001(spark):
    con = duckdb.connect()
    for t in ("orders", "lineitem", "part", "events"):
        con.execute(f"create view {t} as select * from read_parquet('{SF0001}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    for name in ("hub_service_literal", "link_user_service_billing_period", "sat_issue_details",
                 "sat_device_details", "dm_traffic", "ods_traffic", "inc_hub_tariff", "inc_sat_user_details"):
        df = qs[name](spark, SF0001)
        cols = sorted(df.columns)
        got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
        res = con.execute(f"select {', '.join(chr(34) + c + chr(34) for c in cols)} from ({sqls[name]})")
        want = sorted(tuple(str(v) for v in r) for r in res.fetchall())
        assert got == want, name


def test_satellite_sql_refuses_more_loads_than_it_unrolls(monkeypatch):
    monkeypatch.setattr(oracle, "ORACLE_LOADS", 3)
    con = duckdb.connect()
    con.execute(f"create view orders as select * from read_parquet('{SF0001}/orders.parquet')")
    with pytest.raises(duckdb.Error, match="more loads"):
        con.execute(oracle.target_sql(DWL, "sat_user_details")).fetchall()
