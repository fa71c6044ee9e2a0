"""Hub load: first-seen business keys.

Per load, one row per ``dedup_by`` value survives (the reference orders by LOAD_DATE only, which
is constant in a batch, so its pick is arbitrary; we break ties by pk, then the keys, then the
record source, NULLs first). Rows whose pk is already in the hub are dropped; the rest are
appended. Rows are never updated.

``hub_rows`` takes a staged frame that may hold several loads (distinct ``load_date`` values)
and returns what loading them one after another, oldest first, would append: per non-NULL pk,
the rows picked at its first load; NULL pks never match the hub, so each load adds its NULL row
again. With one load this is exactly the yearly statement.

Plan shape: the first step groups by pk, keys and source and takes the least load date, a hash
aggregate with a map-side step, so a key holding a third of all rows is reduced before any shuffle and
the staged rows are never sorted. The pick (a minimum of structs, which Spark sorts for) then sees one
row per distinct key text. The anti join shuffles one row per pk. AQE turns the
join into a broadcast at run time when the measured side is small, and splits skewed partitions
(``dedup_by`` different from pk can give many rows per pk).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultweave.plans.specs import HubSpec

_PICK = "_pick"


def hub_columns(spec: HubSpec) -> list[str]:
    return [spec.pk, *spec.keys, "load_date", "record_source"]


def hub_group(spec: HubSpec) -> list[str]:
    """Columns whose distinct rows a hub starts from."""
    return list(dict.fromkeys([*([spec.dedup_by] if spec.dedup_by else []), spec.pk, *spec.keys, "record_source"]))


def hub_rows(stg: DataFrame, tgt: DataFrame | None, spec: HubSpec, firsts: DataFrame | None = None) -> DataFrame:
    """``firsts``: the distinct rows of ``hub_group`` with ``_null_load`` and ``load_date``, where they are at hand
    (``plans.one_scan``); otherwise they are taken from ``stg``."""
    pk, keys = spec.pk, list(spec.keys)
    dedup = spec.dedup_by or pk
    if dedup == pk:
        # distinct (pk, keys, source) with their first load; then, per pk, the least (load_date, keys,
        # source) = first load and tie-break. NULL pks are grouped per load (one NULL row per load).
        if firsts is None:
            null_load = F.when(F.col(pk).isNull(), F.col("load_date")).alias("_null_load")
            firsts = stg.groupBy(pk, *keys, "record_source", null_load).agg(F.min("load_date").alias("load_date"))
        picked = (firsts.groupBy(pk, "_null_load")
                  .agg(F.min(F.struct("load_date", *keys, "record_source")).alias(_PICK))
                  .select(pk, *[F.col(f"{_PICK}.{c}").alias(c) for c in ["load_date", *keys, "record_source"]]))
    else:
        # the load date is carried as an aggregate: Catalyst drops a plain distinct under min()
        rows = firsts if firsts is not None else (
            stg.groupBy(*hub_group(spec), F.col("load_date").alias("_load")).agg(F.max("load_date").alias("load_date")))
        per_load = (rows.groupBy("load_date", dedup)
                    .agg(F.min(F.struct(pk, *keys, "record_source")).alias(_PICK))
                    .select("load_date", *[F.col(f"{_PICK}.{c}").alias(c) for c in [pk, *keys, "record_source"]]))
        # keep each pk's rows of its first load only (all of them: the reference inserts them all)
        first = (per_load.where(F.col(pk).isNotNull())
                 .groupBy(pk).agg(F.min("load_date").alias("_first_load")))
        picked = (per_load.join(first, pk, "left")
                  .where(F.col(pk).isNull() | (F.col("load_date") == F.col("_first_load"))))
    out = picked.select(*hub_columns(spec))
    if tgt is not None:
        out = out.join(tgt.select(pk), pk, "left_anti")
    return out
