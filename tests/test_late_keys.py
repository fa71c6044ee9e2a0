"""Keys travel as their texts and are hashed on the way to the target; joined sources are read once for all loads."""

import contextlib
import io

from conftest import SF0001
from helpers import rows_of
from pyspark.sql import functions as F

from vaultweave.functions.hashing import hash_composite, late_columns, mark, seal
from vaultweave.operators.satellite import candidates
from vaultweave.operators.staging import stage
from vaultweave.plans import catalog
from vaultweave.plans.specs import FP
from vaultweave.plans.yearly import _inserted_rows, _rows_without, fold_both_keys, key_rows
from vaultweave.sources.fixtures import dirty_payment, ods_source
from vaultweave.sources.store import TableStore


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_sealed_texts_are_the_hashes(spark):
    rows = [("a", "b"), (None, None), ("", " "), ("\u0001x", "y"), ("\u0001" + "0" * 32, ""), ("long" * 40, "é" * 70), ("^^", "^^")]
    df = spark.createDataFrame(rows, "a string, b string")
    for parts in (2, 4):
        late = df.select(mark(hash_composite(["a", "b"], parts, text=True), "k"), hash_composite(["a", "b"], parts).alias("want"))
        assert late_columns(late) == ["k"] and late_columns(seal(late)) == []
        assert seal(late).where(~F.col("k").eqNullSafe(F.col("want"))).count() == 0
        assert late.select(F.max(F.octet_length("k"))).first()[0] <= 64
    assert late_columns(seal(late, ["other"])) == ["k"]
    src = dirty_payment(spark, SF0001)
    assert rows_of(seal(stage(src, FP.stages["payment"], texts=True))) == rows_of(stage(src, FP.stages["payment"]))


def test_no_hash_before_the_last_shuffle(spark, work):
    """The md5 of a link's keys is taken above its last exchange, and not below."""
    stg = stage(ods_source(spark, SF0001, "issue"), FP.stages["issue"], texts=True)
    t = FP.target("link_user_issue")
    rows = key_rows(stg, t)
    assert set(late_columns(rows)) == {"user_issue_pk", "user_pk", "issue_pk"} and "md5(user" not in plan(rows)
    store = TableStore(spark, work)
    store.append(rows, t.name)
    want = key_rows(stage(ods_source(spark, SF0001, "issue"), FP.stages["issue"]), t)
    assert rows_of(store.read_public(t.name)) == rows_of(want)


def test_skipped_keys_leave_the_inserted_rows(spark, work):
    staged = stage(dirty_payment(spark, SF0001), FP.stages["payment"], texts=True).withColumn("load_year", F.year("load_date"))
    years = sorted(r[0] for r in staged.select("load_year").distinct().collect())
    for name in ("sat_user_details", "sat_pay_doc_details"):
        t = FP.target(name)
        inserted, skipped = fold_both_keys(spark, [(t, staged, None)], years, f"{work}/{name}")
        stg = staged.drop("load_year")
        rows = _inserted_rows(stg, t, inserted)
        assert set(late_columns(rows)) == set(late_columns(candidates(stg, t))) and late_columns(rows)
        if name in skipped:
            assert rows_of(_rows_without(stg, t, skipped[name])) == rows_of(rows)
    assert skipped


def test_joined_source_is_joined_once(spark, work):
    src = ods_source(spark, SF0001, "issue")
    rows, years = catalog.source_by_year(src, "issue", "start_time", f"{work}/s")
    assert years == sorted(r[0] for r in src.select(F.year("start_time")).distinct().collect() if r[0] is not None)
    for y in years[:2]:
        one = catalog.of_year(rows, y)
        assert "Join" not in plan(one)
        assert rows_of(stage(one, FP.stages["issue"], y)) == rows_of(stage(src, FP.stages["issue"], y))
    some, loads = catalog.source_by_year(src, "issue", "start_time", f"{work}/t", (1996, 1998, 1997, 1997))
    assert loads == [1996, 1998, 1997, 1997] and {r[0] for r in some.select("load_year").distinct().collect()} == {1996, 1997, 1998}
