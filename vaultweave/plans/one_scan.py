"""Distinct keys of all hubs and links of a source in one scan and one shuffle.

Every hub and link starts from the distinct rows of its own columns in the staged batch, with their first load. Instead of one
aggregate, and so one scan, per target, a single ``GROUP BY GROUPING SETS`` holds a set per target over one reading of
the batch: a row enters it once per target, is merged map-side with its like, and is shuffled as one distinct key. The
result is written once, in a folder per target, and each target goes on from its folder (pick of one row, anti join).

Rows in: staged rows times targets, before the map-side step; rows shuffled: distinct keys per task, the same as with an
aggregate per target. So it saves scans and stages, not shuffle, and pays off where reading the batch is the cost (wide or
computed batches, many targets); a batch already written with few columns can as well be read per target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultweave.functions.hashing import late_columns, mark
from vaultweave.operators.hub import hub_group
from vaultweave.operators.link import link_group
from vaultweave.plans.specs import HubSpec, LinkSpec
from vaultweave.session import new_work_dir

#: what a target's distinct rows hold for its pk's NULL rows: the load they belong to
NULL_LOAD = "_null_load"


def _group(t: HubSpec | LinkSpec) -> list[str]:
    return hub_group(t) if isinstance(t, HubSpec) else link_group(t)


def distinct_keys(staged: DataFrame, targets: list[HubSpec | LinkSpec]) -> DataFrame:
    """``_target`` (name), the grouping columns of all targets (NULL where a target has no such column), ``_null_load`` and the
    first ``load_date``, for hubs deduped by another key the load date itself."""
    cols = list(dict.fromkeys(c for t in targets for c in _group(t)))
    sets, names = [], {}
    for i, t in enumerate(targets):
        own = f"_null_{i}"
        per_load = isinstance(t, HubSpec) and t.dedup_by and t.dedup_by != t.pk
        staged = staged.withColumn(own, F.col("load_date") if per_load else F.when(F.col(t.pk).isNull(), F.col("load_date")))
        sets.append([*_group(t), own])
    every = [*cols, *[f"_null_{i}" for i in range(len(targets))]]
    for i, s in enumerate(sets):                                # grouping_id has a bit, from the left, per column left out
        names[sum(1 << (len(every) - 1 - k) for k, c in enumerate(every) if c not in s)] = i
    listed = ", ".join("(" + ", ".join(f"`{c}`" for c in s) + ")" for s in sets)
    grouped = staged.sparkSession.sql(
        f"""SELECT {', '.join(f'`{c}`' for c in every)}, grouping_id() AS _set, min(load_date) AS load_date
        FROM {{staged}} GROUP BY {', '.join(f'`{c}`' for c in every)} GROUPING SETS ({listed})""", staged=staged.select(*[c for c in every if c != "load_date"], "load_date"))
    target = F.element_at(F.create_map(*[F.lit(x) for k, i in names.items() for x in (k, targets[i].name)]), F.col("_set"))
    null_load = F.coalesce(*[F.when(target == t.name, F.col(f"_null_{i}")) for i, t in enumerate(targets)])
    late = late_columns(staged)
    kept = [mark(F.col(c), c) if c in late else c for c in cols]
    return grouped.select(target.alias("_target"), *kept, null_load.alias(NULL_LOAD), "load_date")


def split_keys(staged: DataFrame, targets: list[HubSpec | LinkSpec], work: str | None = None) -> dict[str, DataFrame]:
    """The distinct rows of each target, from one written table with a folder per target."""
    path = f"{work or new_work_dir(staged.sparkSession, 'keys')}/keys"
    rows = distinct_keys(staged, targets)
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy("_target").parquet(path)
    kept = staged.sparkSession.read.schema(rows.schema).parquet(path)
    return {t.name: kept.where(F.col("_target") == t.name).select(*_group(t), NULL_LOAD, "load_date") for t in targets}
