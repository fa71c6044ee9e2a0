"""Staging: one batch of a source with business keys, hash keys, hash diffs and batch columns.

``stage(src, spec, year=Y, load_date=D)`` is the yearly view: rows whose time column falls in
year Y, ``load_date`` = D. ``stage(src, spec, load_date=D)`` takes the whole input as one load (a
micro-batch). ``stage(src, spec)`` stages every year at once: each row gets the run
date of its own yearly batch (1 January of its year), which is what a year-by-year backfill
would have given it. Either way this is one projection over a scan; the year filter is a range on
the raw column, so parquet skips row groups and the rest of the plan stays in one codegen stage.
``texts=True`` leaves keys and hash diffs as the texts to be hashed (``functions.hashing.seal`` hashes them).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultweave.functions.hashing import hash_composite, hash_diff, hash_key, mark
from vaultweave.functions.time import in_year, load_date_of, ts_literal
from vaultweave.plans.specs import StageSpec


def stage(src: DataFrame, spec: StageSpec, year: int | None = None,
          load_date: dt.datetime | str | None = None, texts: bool = False) -> DataFrame:
    df = src
    for old, new in spec.renames.items():
        if old in df.columns:
            df = df.withColumnRenamed(old, new)
    if year is not None:
        df = df.where(in_year(spec.time_col, year))
        ld = ts_literal(load_date if load_date is not None else dt.datetime(year, 1, 1))
    else:
        # no year filter: the whole input is one load (``load_date`` given, e.g. a micro-batch)
        # or every row gets its own year's run date
        df = df.where(F.col(spec.time_col).isNotNull())
        ld = ts_literal(load_date) if load_date is not None else load_date_of(spec.time_col)

    cols = [F.col(c) for c in spec.columns]
    cols += [F.col(src_col).cast("string").alias(key) for key, src_col in spec.keys.items()]
    cols.append(F.lit(spec.record_source).alias("record_source"))
    named = mark if texts else Column.alias
    cols += [named(hash_key(c, texts), pk) for pk, c in spec.single.items()]
    cols += [named(hash_composite(list(ins), parts, texts), pk) for pk, (ins, parts) in spec.composite.items()]
    for hd, (ins, parts) in spec.hashdiffs.items():
        expr = hash_diff(list(ins), texts) if parts is None else hash_composite(list(ins), parts, texts)
        cols.append(named(expr, hd))
    cols += [ld.alias("load_date"), F.col(spec.time_col).alias("effective_from")]
    return df.select(*cols)
