import datetime as dt

from pyspark.sql import functions as F

HUB_SCHEMA = "pk string, k string, dk string, load_date timestamp_ntz, record_source string"
SAT_SCHEMA = ("pk string, hd string, v string, effective_from timestamp_ntz, load_date timestamp_ntz, "
              "record_source string")


def ld(year):
    return dt.datetime(year, 1, 1)


def rows_of(df, cols=None):
    cols = cols or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda r: tuple((v is None, str(v)) for v in r))


def sat_batch(spark, year, items):
    """items: (pk, hd) pairs; payload v = hd, effective_from = load date."""
    return spark.createDataFrame([(pk, hd, hd, ld(year), ld(year), "src") for pk, hd in items], SAT_SCHEMA)


def apply_loads(spark, loads, step, schema):
    """Fold ``step(batch, target_or_None, load)`` over loads; returns (target, inserted counts)."""
    tgt, counts = None, []
    for year, batch in loads:
        ins = step(batch, tgt, year).collect()
        counts.append(len(ins))
        new = spark.createDataFrame(ins, schema)
        tgt = new if tgt is None else spark.createDataFrame(tgt.collect() + ins, schema)
    return tgt, counts


def ts(s):
    return F.lit(s).cast("timestamp_ntz")
