"""Link load: distinct key relations not yet in the link.

``link_rows`` accepts one or several loads like ``hub_rows``: distinct rows of each load (the
distinct also covers ``also_distinct_on`` columns, which are then dropped, as the reference
does), keep a non-NULL link pk only at its first load, drop pks already in the link.
The distinct keeps each relation's first load date, a hash aggregate with a map-side step: hot
relations are reduced before any shuffle, and one row per relation, not per relation and load, goes
on to the first-load window and the anti join. NULL pks are kept per load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from vaultweave.plans.specs import LinkSpec


def link_columns(spec: LinkSpec) -> list[str]:
    return [spec.pk, *spec.parents, "load_date", "record_source"]


def link_group(spec: LinkSpec) -> list[str]:
    """Columns whose distinct rows a link starts from."""
    return [spec.pk, *spec.parents, *spec.also_distinct_on, "record_source"]


def link_rows(stg: DataFrame, tgt: DataFrame | None, spec: LinkSpec, single_load: bool = False, firsts: DataFrame | None = None) -> DataFrame:
    """``firsts``: the distinct rows of ``link_group`` with ``_null_load`` and ``load_date``, where they are at hand
    (``plans.one_scan``); otherwise they are taken from ``stg``."""
    pk = spec.pk
    d = firsts
    if d is None:
        null_load = F.when(F.col(pk).isNull(), F.col("load_date")).alias("_null_load")
        d = stg.groupBy(*link_group(spec), null_load).agg(F.min("load_date").alias("load_date"))
    if not single_load:
        # a pk's relations are few (parents are hashes of the pk's own parts), so this window is
        # bounded; a relation enters at its first load when that is also its pk's first load
        first = F.min("load_date").over(Window.partitionBy(pk, "_null_load"))
        d = d.withColumn("_first_load", first).where(F.col("load_date") == F.col("_first_load"))
    out = d.select(*link_columns(spec))
    if tgt is not None:
        out = out.join(tgt.select(pk), pk, "left_anti")
    return out
