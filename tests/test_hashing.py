import hashlib

from pyspark.sql import functions as F

from vaultweave.functions.hashing import hash_composite, hash_diff, hash_key, norm_text


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_single_key_null_blank_case_space(spark):
    got = one(spark, hash_key("a"), [(None,), ("  ",), (" ab ",), ("AB",), ("\tx",)], "a string")
    assert got[0] is None and got[1] is None
    assert got[2] == got[3] == md5("AB")
    assert got[4] == md5("\tX")            # only spaces are trimmed, a tab stays


def test_norm_keeps_text_of_numbers_and_timestamps(spark):
    df = spark.createDataFrame([(7, "2024-01-01 00:00:07.179575")], "n bigint, t string")
    r = df.select(norm_text("n"), norm_text(F.col("t").cast("timestamp_ntz"))).first()
    assert r[0] == "7" and r[1] == "2024-01-01 00:00:07.179575"


def test_composite_sentinels(spark):
    schema = "a string, b string, c string"
    rows = [(None, None, None), (None, "7", None), ("a||b", "c", None), ("a", "b||c", None)]
    pay_doc = one(spark, hash_composite(["a", "b"], 2), rows, schema)
    assert pay_doc[0] is None                             # all parts NULL, sentinel matches
    assert pay_doc[1] == md5("^^||7")
    assert pay_doc[2] == pay_doc[3] == md5("A||B||C")     # separator inside a value collides
    three_vs_two = one(spark, hash_composite(["a", "b", "c"], 2), rows, schema)
    assert three_vs_two[0] == md5("^^||^^||^^")          # sentinel can't match: never NULL
    three_vs_four = one(spark, hash_composite(["a", "b", "c"], 4), rows, schema)
    assert three_vs_four[0] == md5("^^||^^||^^")


def test_hash_diff_never_null(spark):
    got = one(spark, hash_diff(["a"]), [(None,), ("x",)], "a string")
    assert got == [md5("^^"), md5("X")]


# Golden values: the hashed text of each recipe, written out by hand for one row per source, and its md5 as a literal;
# nothing here comes from plans.specs.
GOLDEN_ROWS = {
    "payment": """select 7L as user_id, ' 1-Urgent' as pay_doc_type, 42L as pay_doc_num, 'fl-7 ' as account, '+70' as phone,
        '2001-02' as billing_period, timestamp_ntz'2001-02-03 04:05:06' as pay_date, cast(10.5 as decimal(10,2)) as sum""",
    "billing": """select 7L as user_id, '2001-02' as billing_period, 'Promo tin ' as service, 'Brand#1' as tariff,
        cast(1 as decimal(10,2)) as sum, timestamp_ntz'2001-02-03 04:05:06' as created_at""",
    "issue": """select 7 as user_id, timestamp_ntz'2001-02-03 04:05:06' as start_time, timestamp_ntz'2001-02-04 00:00:00' as end_time,
        ' no Signal' as title, 'd' as description, 'promo TIN' as service""",
    "traffic": """select 7L as user_id, timestamp_ntz'2001-02-03 04:05:06' as timerequest, 'd9' as device_id,
        '10.0.0.1' as device_ip_addr, 1 as bytes_sent, 2 as bytes_received""",
}
GOLDEN = {
    "payment": {
        "user_pk": "8f14e45fceea167a5a36dedd4bea2543",  # 7
        "account_pk": "13571d311843ca7a54fe4e16ebb0d275",  # FL-7
        "billing_period_pk": "bbcc3f1046fa8c05607dc4ffa3f2ec52",  # 2001-02
        "pay_doc_pk": "ee16be8a7ce32ea38d7521bdf431ae78",  # 1-URGENT||42
        "user_account_pk": "7ee8ed35b0e5edc1a3abc5996a4c85cb",  # 7||FL-7
        "account_billing_pay_pk": "d3aeaa932709e102c51e61a7435e9bb6",  # FL-7||1-URGENT||42||2001-02
        "user_hashdiff": "8fda0f185c7c53251c8fc6c7161e85d2",  # +70
        "pay_doc_hashdiff": "1385ef12a88d7709f2483ef86ea6726d",  # 2001-02-03 04:05:06||10.50
    },
    "billing": {
        "service_pk": "bf4c83b7aa0dcd6659daf6e10d02797f",  # PROMO TIN
        "tariff_pk": "46f171a5cea77d0bc56933a2006f59e3",  # BRAND#1
        "user_service_pk": "f1d43f39bf631c1a8b776a79726c5cb7",  # 7||PROMO TIN
        "user_service_billing_period_pk": "ee5ff89d152c822daa419f52e93bc33b",  # 7||PROMO TIN||2001-02
        "service_tariff_pk": "4b896348565dc7cc6f4f4ce81d561020",  # PROMO TIN||BRAND#1
        "service_hashdiff": "f1d43f39bf631c1a8b776a79726c5cb7",  # 7||PROMO TIN
        "tariff_hashdiff": "533a9ff5b24ebd5dfc91269dcd73dc71",  # BRAND#1||PROMO TIN
    },
    "issue": {
        "start_time_pk": "60f6b9732ea47275702ed3a5a377aa46",  # 2001-02-03 04:05:06
        "issue_pk": "df76d7d20a9229a4fc156a6966d03db4",  # NO SIGNAL||2001-02-03 04:05:06
        "user_issue_pk": "7d8bdfedfea9c1005281ff140f7f0829",  # 7||NO SIGNAL||2001-02-03 04:05:06
        "issue_service_pk": "a3819e39af2592f49831d6a661b18961",  # NO SIGNAL||2001-02-03 04:05:06||PROMO TIN
        "issue_hashdiff": "0cdff0e2f352484b9140bac65f0c5d24",  # 7||2001-02-03 04:05:06||PROMO TIN
    },
    "traffic": {
        "timerequest_pk": "60f6b9732ea47275702ed3a5a377aa46",  # 2001-02-03 04:05:06
        "device_pk": "adb7bf1cff0c81595de38f51cd60c62c",  # D9
        "user_device_pk": "ba8d7f2e6d56550b12a5926cfed6e844",  # 7||D9
        "device_hashdiff": "f7a8866bf4ae5254f483e7fa8090a9ae",  # 7||D9||10.0.0.1
    },
}


def test_recipes_against_golden_literals(spark):
    from vaultweave.operators.staging import stage
    from vaultweave.plans.specs import FP

    for source, want in GOLDEN.items():
        row = stage(spark.sql(GOLDEN_ROWS[source]), FP.stages[source]).first().asDict()
        assert {k: row[k] for k in want} == want, source
        hashed = {k for k in row if k.endswith(("_pk", "_hashdiff"))}
        assert hashed - set(want) <= {"user_pk", "billing_period_pk", "service_pk"}, source  # checked with another source


def test_recipes_of_missing_parts(spark):
    """All parts NULL: NULL only where the sentinel has as many parts as there are inputs."""
    from vaultweave.operators.staging import stage
    from vaultweave.plans.specs import FP

    null = {"payment": {"user_pk", "account_pk", "billing_period_pk", "pay_doc_pk", "user_account_pk", "account_billing_pay_pk"},
            "billing": {"user_pk", "billing_period_pk", "service_pk", "tariff_pk", "user_service_pk", "service_tariff_pk"},
            "issue": {"user_pk", "service_pk"}, "traffic": {"user_pk", "device_pk", "user_device_pk"}}
    time = {"payment": "pay_date", "billing": "created_at", "issue": "start_time", "traffic": "timerequest"}
    for source, want in null.items():
        row = spark.sql(GOLDEN_ROWS[source])
        row = row.select(*[F.col(c) if c == time[source] else F.lit(None).cast(t).alias(c) for c, t in row.dtypes])
        got = stage(row, FP.stages[source]).first().asDict()
        assert {k for k in got if k.endswith(("_pk", "_hashdiff")) and got[k] is None} == want, source
