"""vaultweave: yearly lake loads and an incremental Data Vault, written as PySpark DataFrame jobs.

Layers:
  functions/  column expressions (hash keys, year ranges, epoch conversions)
  sources/    entity frames derived from the driver tables, parquet table store
  operators/  stage, hub, link, satellite, ODS load, traffic mart
  plans/      specs of every target (data), the yearly runner, query catalogue, oracle SQL
"""

__version__ = "0.1.0"
