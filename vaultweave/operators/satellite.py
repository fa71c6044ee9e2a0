"""Satellite load: change-detected history.

Rule (reference semantics): for a batch with run date D, look at the satellite rows with
``load_date <= D``; per pk keep the rows of its most recent load date ("latest", ties kept, so
it is a set of hash diffs). Insert every distinct batch row whose (pk, hashdiff) is not in that
set. NULL pks never match, so they are inserted on every load.

The reference joins the whole satellite history row by row to the batch before ranking; that
fan-out grows with (rows per pk)^2. Here "latest" is two aggregates and one join:
  a = max(load_date) per (pk, hashdiff);  m = max over a per pk;  latest = a where a.last = m.
A hash diff is in the latest set exactly when its own last load equals its pk's last load.
Both aggregates combine map-side, keys spread over (pk, hashdiff), and the final anti join is on
(pk, hashdiff), so a pk holding a third of all rows does not land in one task.

For a backfill of loads in increasing order after everything in the target, the same rule is
folded over all loads at once, on keys only (``plans.satfold``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultweave.functions.hashing import seal
from vaultweave.functions.time import ts_literal
from vaultweave.plans.specs import SatSpec


def sat_columns(spec: SatSpec) -> list[str]:
    return [spec.pk, spec.hashdiff, *spec.payload, "effective_from", "load_date", "record_source"]


def candidates(stg: DataFrame, spec: SatSpec) -> DataFrame:
    """Distinct batch rows in satellite shape (the reference inserts ``select distinct``)."""
    return stg.select(*sat_columns(spec)).distinct()


def latest_hashdiffs(tgt: DataFrame, spec: SatSpec, as_of: dt.datetime | str | None = None,
                     batch: DataFrame | None = None) -> DataFrame:
    """(pk, hashdiff) of each pk's most recent load with load_date <= as_of (NULL pks excluded);
    with ``batch``, of the pks that it holds."""
    pk, hd = spec.pk, spec.hashdiff
    t = tgt.where(F.col(pk).isNotNull())
    if as_of is not None:
        t = t.where(F.col("load_date") <= ts_literal(as_of))
        if "load_year" in tgt.columns:   # partition column of the store: prune later years
            year = as_of.year if isinstance(as_of, dt.datetime) else int(str(as_of)[:4])
            t = t.where(F.col("load_year") <= F.lit(year))
    # A NULL hash diff never matches a batch row but still marks its pk's last load, so it is
    # kept, as '' (an md5 hex is never empty). The column is then non-nullable and both uses of
    # ``a`` stay identical plans, so Spark reuses one exchange instead of scanning twice.
    if batch is not None:                # only keys that the batch can change
        t = t.join(batch.where(F.col(pk).isNotNull()).select(pk).distinct(), pk, "left_semi")
    a = (t.groupBy(pk, F.coalesce(F.col(hd), F.lit("")).alias(hd))
         .agg(F.max("load_date").alias("_last")))
    m = a.groupBy(F.col(pk).alias("_m_pk")).agg(F.max("_last").alias("_pk_last"))
    # equi join on (pk, last load): a hot pk's hash diffs still spread over their own last loads
    return (a.join(m, (F.col(pk) == F.col("_m_pk")) & (F.col("_last") == F.col("_pk_last")))
            .select(pk, hd))


def sat_rows(stg: DataFrame, tgt: DataFrame | None, spec: SatSpec, load_date: dt.datetime | str,
             pks: DataFrame | None = None) -> DataFrame:
    """Rows one batch (single ``load_date``) appends to the satellite. ``pks``: the batch's pks, where they are at hand."""
    cand = candidates(stg, spec)
    if tgt is None:
        return cand
    latest = latest_hashdiffs(tgt, spec, load_date, seal(stg) if pks is None else pks)
    return seal(cand, [spec.pk, spec.hashdiff]).join(latest, [spec.pk, spec.hashdiff], "left_anti")
