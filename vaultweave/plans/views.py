"""Staging views of yearly batches.

A *session view* lives as long as the run that makes it. A *permanent view* is registered in a database, over the batch
written to the work folder: any session of that catalog reads it by name, a run that dies leaves it for inspection, and the
separate cleanup run drops it later from a session of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaultweave.plans.specs import VaultSpec


def view_name(vault: VaultSpec, source: str, year: int) -> str:
    """Name of a yearly staging batch, e.g. ``fp_view_billing_1997``."""
    return f"{vault.name}_view_{source}_{year}"


def publish(spark: SparkSession, vault: VaultSpec, source: str, year: int, path: str, database: str) -> DataFrame:
    """Create or replace the permanent view over the batch written at ``path``; returns the view's rows."""
    name = f"`{database}`.`{view_name(vault, source, year)}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    return spark.table(name)


def drop_year_views(spark: SparkSession, vault: VaultSpec, year: int, database: str | None = None) -> list[str]:
    """Drop the staging views of one year, all sources, if they exist (the separate cleanup run): session views, or the
    permanent ones of ``database``. Returns the names of those that existed; a missing database holds none."""
    names = [view_name(vault, s, year) for s in vault.stages]
    if database is None:
        return [v for v in names if spark.catalog.dropTempView(v)]
    if not spark.catalog.databaseExists(database):
        return []
    there = [v for v in names if spark.catalog.tableExists(f"`{database}`.`{v}`")]
    for v in names:
        spark.sql(f"DROP VIEW IF EXISTS `{database}`.`{v}`")
    return there
