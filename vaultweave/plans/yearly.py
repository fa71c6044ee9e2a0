"""Yearly batch runner and backfill.

``run_year`` is one scheduled run (stage -> hubs -> links -> satellites -> drop staging) for a
year and run date, against whatever the targets hold: it applies the reference rules in full,
including out-of-order and repeated runs. Hubs, links and satellites only read the staged batch
and their own table, so the phase order is kept for readability, not because of dependencies.

``backfill`` loads a list of years as if ``run_year`` ran once per year, oldest first, with
fewer jobs: hubs and links load every year in one pass (their result is each key's first load),
satellites fold all loads in one pass over the load pattern of each key (``plans.satfold``). When the target already holds
a load at or after the first year, satellites fall back to ``run_year``'s rule per year.

The staged batch is written once to the work folder (partitioned by load year) instead of being
recomputed per target: each target then scans only its own columns, and a lost executor costs a
re-read, not a recomputation of the join behind it. It holds the texts of keys and hash diffs, as do all shuffles of
a load; they are hashed on the way to the target (``functions.hashing.seal``), or before a join with a target.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultweave.functions.hashing import seal
from vaultweave.operators.hub import hub_columns, hub_rows
from vaultweave.operators.link import link_columns, link_rows
from vaultweave.operators.satellite import candidates, latest_hashdiffs, sat_columns, sat_rows
from vaultweave.operators.staging import stage
from vaultweave.plans import satfold
from vaultweave.plans.one_scan import split_keys
from vaultweave.plans.specs import HubSpec, LinkSpec, SatSpec, VaultSpec
from vaultweave.plans.views import drop_year_views, publish, view_name
from vaultweave.session import materialize, new_work_dir
from vaultweave.sources.store import CODEC, LOAD_YEAR, TableStore


def target_columns(t) -> list[str]:
    if isinstance(t, HubSpec):
        return hub_columns(t)
    if isinstance(t, LinkSpec):
        return link_columns(t)
    return sat_columns(t)


#: targets written at the same time: each is its own chain of Spark jobs, and the tail of one leaves room for the next
SIDE_BY_SIDE = 4


def side_by_side(step, items) -> None:
    """``step`` on every item, ``SIDE_BY_SIDE`` at a time; the first error is raised once all have ended."""
    items = list(items)
    if len(items) == 1:
        step(items[0])
        return
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        for done in [pool.submit(step, i) for i in items]:
            done.result()


def _selected(vault: VaultSpec, only, hub_form: str) -> list:
    """The targets named in ``only``; without it all, with the hubs of ``hub_form``."""
    targets = list(vault.targets("both" if only is not None else hub_form))
    if only is not None:
        wanted = set(only)
        targets = [t for t in targets if t.name in wanted]
        missing = wanted - {t.name for t in targets}
        if missing:
            raise KeyError(f"unknown targets: {sorted(missing)}")
    return targets


def in_years(col: str, years: list[int]):
    """OR of year ranges, merged into contiguous spans (stays pushable to parquet)."""
    ys = sorted(set(years))
    spans, start, prev = [], ys[0], ys[0]
    for y in ys[1:]:
        if y != prev + 1:
            spans.append((start, prev))
            start = y
        prev = y
    spans.append((start, prev))
    cond = None
    for a, b in spans:
        c = (F.col(col) >= F.lit(f"{a}-01-01 00:00:00").cast("timestamp_ntz")) & \
            (F.col(col) < F.lit(f"{b + 1}-01-01 00:00:00").cast("timestamp_ntz"))
        cond = c if cond is None else (cond | c)
    return cond


def read_columns(t) -> list[str]:
    """Staged columns a target reads (its stored columns plus dedup / distinct-only columns)."""
    extra = []
    if isinstance(t, HubSpec) and t.dedup_by:
        extra = [t.dedup_by]
    elif isinstance(t, LinkSpec):
        extra = list(t.also_distinct_on)
    return target_columns(t) + [c for c in extra if c not in target_columns(t)]


def _needed_columns(targets, source: str) -> list[str]:
    cols: list[str] = []
    for t in targets:
        if t.source == source:
            cols += [c for c in read_columns(t) if c not in cols]
    return cols


def _prepare(staged: DataFrame, targets, source: str, path: str, partition_by: str | None = None) -> DataFrame:
    """Keep the columns the targets read; write them once when several targets (or a satellite, which
    reads its keys and then its rows, or a literal hub) consume the batch, else leave the
    plan lazy."""
    users = [t for t in targets if t.source == source]
    cols = _needed_columns(targets, source) + ([partition_by] if partition_by else [])
    staged = staged.select(*cols)
    # a hub deduped by another key reads its per-load picks twice (join with each pk's first
    # load); Catalyst plans the two branches differently, so without a written batch the
    # whole source would be computed twice
    reads_twice = any(isinstance(t, SatSpec) or (isinstance(t, HubSpec) and t.dedup_by) for t in users)
    if len(users) > 1 or reads_twice:
        return materialize(staged, path, partition_by, codec=CODEC)
    return staged


def _split(staged: dict[str, DataFrame], targets, one_scan: bool, work: str) -> dict[str, DataFrame]:
    """With ``one_scan``, the distinct keys of all hubs and links, from one reading of each source's batch."""
    out: dict[str, DataFrame] = {}
    for source, stg in staged.items() if one_scan else ():
        mine = [t for t in targets if t.source == source and not isinstance(t, SatSpec)]
        if mine:
            out |= split_keys(stg, mine, f"{work}/split_{source}")
    return out


def key_rows(stg: DataFrame, t: HubSpec | LinkSpec, firsts: DataFrame | None = None, single_load: bool = False) -> DataFrame:
    """Rows of a hub or link that the batch holds, known to the target or not. A hub deduped by another key picks the least
    pk, which is that of the md5."""
    if isinstance(t, LinkSpec):
        return link_rows(stg, None, t, single_load=single_load, firsts=firsts)
    if t.dedup_by:
        stg, firsts = seal(stg, [t.pk]), None if firsts is None else seal(firsts, [t.pk])
    return hub_rows(stg, None, t, firsts)


def run_load(spark: SparkSession, vault: VaultSpec, staged: dict[str, DataFrame], store: TableStore,
             load_date: dt.datetime, targets, work: str, firsts: dict[str, DataFrame] | None = None) -> None:
    """Apply one load (staged batches with a single run date) to every target. Targets read only the
    staged batch (or their distinct keys in ``firsts``) and their own table, so they are loaded side by side."""
    firsts = firsts or {}

    def load(t) -> None:
        stg = staged[t.source]
        tgt = store.read(t.name, seal(stg).select(*target_columns(t)).schema)
        if isinstance(t, SatSpec):
            pks = None
            if tgt is not None:
                # written, so that their size is known: few pks are broadcast, and the history is not shuffled to find theirs
                pks = materialize(seal(stg.where(F.col(t.pk).isNotNull()).select(t.pk).distinct()), f"{work}/keys_{t.name}", codec=CODEC)
            store.append(sat_rows(stg, near_history(pks, tgt, t) if t.name in store.clustered else tgt, t, load_date, pks), t.name)
        else:
            store.append_new(key_rows(stg, t, firsts.get(t.name), single_load=True), t.name, tgt, t.pk)

    side_by_side(load, targets)


#: keys of a batch up to which a satellite's history is read by key
NEAR_KEYS = 32


def near_history(stg: DataFrame, tgt: DataFrame | None, t: SatSpec) -> DataFrame | None:
    """The history that a batch of at most ``NEAR_KEYS`` keys can change, as a filter that reaches the files: their ranges and
    Bloom filters (``CatalogStore``'s ``clustered``) then spare most row groups. For more keys the whole history is scanned
    once; the rows a batch inserts are the same either way."""
    if tgt is None:
        return None
    keys = [r[0] for r in stg.where(F.col(t.pk).isNotNull()).select(t.pk).distinct().limit(NEAR_KEYS + 1).collect()]
    if len(keys) > NEAR_KEYS:
        return tgt
    wanted = F.lit(False)
    for k in sorted(keys):
        wanted = wanted | (F.col(t.pk) == F.lit(k))
    return tgt.where(wanted)


def stage_load(spark: SparkSession, vault: VaultSpec, sources: dict[str, DataFrame], targets, work: str,
               year: int | None, load_date: dt.datetime) -> dict[str, DataFrame]:
    staged = {}
    for name in sorted({t.source for t in targets}):
        s = stage(sources[name], vault.stages[name], year, load_date, texts=True)
        staged[name] = _prepare(s, targets, name, f"{work}/stage_{name}")
    return staged


def run_year(spark: SparkSession, vault: VaultSpec, sources: dict[str, DataFrame], store: TableStore,
             year: int, load_date: dt.datetime | None = None, only=None, work_dir: str | None = None,
             hub_form: str = "literal", view_database: str | None = None, keep_views: bool = False, one_scan: bool = False) -> None:
    """One scheduled yearly run: rows of ``year``, run date ``load_date`` (default 1 January).

    The staged batches are visible as session views while the run lasts (for SQL users and
    inspection) and dropped at the end, also when a load fails. With ``view_database`` they are permanent views there,
    which the loads read; ``keep_views`` leaves those to the separate cleanup run (``views.drop_year_views``), and a
    driver that dies leaves them too. Without ``only`` every target is loaded, the two hubs with two forms in the
    one of ``hub_form``. ``one_scan``: hubs and links take their distinct keys from one reading of the batch."""
    ld = load_date or dt.datetime(year, 1, 1)
    targets = _selected(vault, only, hub_form)
    work = work_dir or new_work_dir(spark, f"year{year}")
    try:
        if view_database:
            staged = {}
            for name in sorted({t.source for t in targets}):
                path = f"{work}/stage_{name}"
                stage(sources[name], vault.stages[name], year, ld).write.mode("overwrite").option("compression", CODEC).parquet(path)
                staged[name] = publish(spark, vault, name, year, path, view_database)
        else:
            staged = stage_load(spark, vault, sources, targets, work, year, ld)
            for name, df in staged.items():
                seal(df).createOrReplaceTempView(view_name(vault, name, year))
        run_load(spark, vault, staged, store, ld, targets, work, _split(staged, targets, one_scan, work))
    finally:
        if not (view_database and keep_views):
            drop_year_views(spark, vault, year, view_database)


def _last_load(store: TableStore, t, tgt: DataFrame | None):
    """Latest load_date of a target: newest load-year folder, then one aggregate over that
    partition only (not a scan of the whole history)."""
    years = store.years(store.path(t.name))
    if tgt is None or not years:
        return None
    return tgt.where(F.col(LOAD_YEAR) == max(years)).agg(F.max("load_date")).first()[0]


def backfill(spark: SparkSession, vault: VaultSpec, sources: dict[str, DataFrame], store: TableStore,
             years: list[int] | None = None, only=None, work_dir: str | None = None,
             hub_form: str = "literal", one_scan: bool = False) -> list[int]:
    """Load ``years`` (all years in the data when None) in increasing order. Returns the years
    the satellites were folded over (empty when only hubs and links were selected, or the
    satellites' sources hold no rows). ``hub_form`` and ``one_scan`` as in ``run_year``."""
    targets = _selected(vault, only, hub_form)
    work = work_dir or new_work_dir(spark, "backfill")
    staged: dict[str, DataFrame] = {}
    for name in sorted({t.source for t in targets}):
        spec = vault.stages[name]
        src = sources[name]
        if years is not None:
            src = src.where(in_years(spec.time_col, years))
        s = stage(src, spec, texts=True).withColumn(LOAD_YEAR, F.year("load_date"))
        staged[name] = _prepare(s, targets, name, f"{work}/stage_{name}", partition_by=LOAD_YEAR)
    if years is None:
        sat_sources = {t.source for t in targets if isinstance(t, SatSpec)}
        years = sorted(set().union(*[store.years(f"{work}/stage_{n}") for n in sat_sources])) if sat_sources else []
    years = sorted(set(years))

    def schema_of(t):
        return seal(staged[t.source]).select(*target_columns(t)).schema

    def load_keys(t) -> None:
        stg, tgt = staged[t.source].drop(LOAD_YEAR), store.read(t.name, schema_of(t))
        store.append_new(key_rows(stg, t, firsts.get(t.name)), t.name, tgt, t.pk)

    firsts = _split({s: d.drop(LOAD_YEAR) for s, d in staged.items()}, targets, one_scan, work)
    side_by_side(load_keys, [t for t in targets if not isinstance(t, SatSpec)])
    sats = [(t, store.read(t.name, schema_of(t)), schema_of(t)) for t in targets if isinstance(t, SatSpec)] if years else []

    first_load = dt.datetime(years[0], 1, 1) if years else None
    folded = []
    for t, tgt, schema in sats:
        last = _last_load(store, t, tgt)
        if last is not None and last >= first_load:
            # the target already holds a load at/after this backfill: general rule, load by load
            for y in years:
                cur = store.read(t.name, schema)
                rows = sat_rows(staged[t.source].where(F.col(LOAD_YEAR) == y).drop(LOAD_YEAR), cur, t,
                                dt.datetime(y, 1, 1))
                store.append(rows, t.name)
        else:
            # a target's rows hold the md5, so the batch that is folded with them does
            folded.append((t, staged[t.source] if tgt is None else seal(staged[t.source]), tgt))
    if folded:
        inserted, skipped = fold_both_keys(spark, folded, years, f"{work}/sat_state")

        def load_sat(f) -> None:
            t, stg = f[0], f[1].drop(LOAD_YEAR)
            left = materialize(skipped[t.name], f"{work}/sat_state/skipped_{t.name}", codec=CODEC) if t.name in skipped else None
            store.append(_inserted_rows(stg, t, inserted) if left is None else _rows_without(stg, t, left), t.name)

        side_by_side(load_sat, folded)
    return years


def fold_satellite_keys(spark: SparkSession, sats, years: list[int], work: str) -> DataFrame:
    """Fold the satellite rule over ``years`` for several satellites at once, on keys only and in one pass
    (``plans.satfold``). Returns the inserted keys of all loads, (sat, pk, hd, load_date).

    NULL pks never take part in "latest". A NULL hash diff never matches, so it is always inserted, and it
    still makes its load its pk's latest: it enters as ''."""
    return fold_both_keys(spark, sats, years, work)[0]


def fold_both_keys(spark: SparkSession, sats, years: list[int], work: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The inserted keys as ``fold_satellite_keys``, and by satellite the skipped ones where they are fewer."""
    latest = keys = None
    number = F.element_at(F.create_map(*[F.lit(x) for i, y in enumerate(years) for x in (y, i)]), F.col(LOAD_YEAR))
    for t, staged, tgt in sats:
        if tgt is not None:
            part = latest_hashdiffs(tgt, t).select(F.lit(t.name).alias("sat"), F.col(t.pk).alias("pk"), F.col(t.hashdiff).alias("hd"))
            latest = part if latest is None else latest.unionByName(part)
        k = (staged.where(F.col(t.pk).isNotNull() & F.col(LOAD_YEAR).isin(years))
             .select(F.lit(t.name).alias("sat"), F.col(t.pk).alias("pk"), F.coalesce(F.col(t.hashdiff), F.lit("")).alias("hd"), number.alias("load")))
        keys = k if keys is None else keys.unionByName(k)
    if latest is not None:
        latest = materialize(latest, f"{work}/init")
    out, left = satfold.fold_both(keys, len(years), latest, work)
    year = F.element_at(F.array(*[F.lit(y) for y in years]), F.col("load") + 1)
    dated = lambda d: d.select("sat", "pk", "hd", F.make_timestamp_ntz(year, *[F.lit(x) for x in (1, 1, 0, 0, 0)]).alias("load_date"))
    return dated(out), {s: dated(d) for s, d in left.items()}


def _rows_without(staged: DataFrame, t: SatSpec, skipped: DataFrame) -> DataFrame:
    """Distinct batch rows but those of the skipped (pk, hashdiff, load) keys: the rows of ``_inserted_rows``. Few skipped keys
    are broadcast (their written size is known), and the batch is not shuffled for the join."""
    keys = skipped.select(F.col("pk").alias(t.pk), F.col("hd").alias(t.hashdiff), "load_date")
    return candidates(staged, t).join(keys, [t.pk, t.hashdiff, "load_date"], "left_anti").select(*sat_columns(t))


def _inserted_rows(staged: DataFrame, t: SatSpec, inserted: DataFrame) -> DataFrame:
    """Distinct batch rows of the inserted (pk, hashdiff, load) keys; rows with a NULL pk or
    hashdiff never match the satellite, so every load inserts them."""
    cand = candidates(staged, t)
    keys = inserted.where(F.col("sat") == t.name).select(F.col("pk").alias(t.pk), F.col("hd").alias(t.hashdiff),
                                                          "load_date")
    matched = cand.join(keys, [t.pk, t.hashdiff, "load_date"], "left_semi").select(*sat_columns(t))
    never_match = cand.where(F.col(t.pk).isNull() | F.col(t.hashdiff).isNull())
    return matched.unionByName(never_match)
