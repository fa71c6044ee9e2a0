"""Tables by name: the store of the lake and the vault in Spark's session catalog.

``CatalogStore`` keeps the layout of ``TableStore`` (Parquet under one root, vault tables by ``load_year``, lake tables
by ``year``) and registers every table in a database, so SQL users see them by name:

* a vault table with a key is **bucketed and sorted by that key**: the anti join of a yearly run reads the target
  bucket by bucket, without a shuffle of the target; only the batch is dealt by key;
* a lake year is replaced by ``INSERT OVERWRITE TABLE ... PARTITION (year = Y)``, which also clears a year
  without rows and registers its partition;
* **satellites** lie by ranges of their key with a Parquet Bloom filter on it, so that a small batch reads few
  row groups of the history (``plans.yearly.near_history``).

A catalog that does not outlive its session (Spark's own) is filled again from the files: the first use of a table
in a new session registers it and recovers its partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from vaultweave.functions.hashing import seal
from vaultweave.sources.store import CODEC, LOAD_YEAR, TableStore


class CatalogStore(TableStore):
    """``keys``: table to the column it is bucketed by. ``clustered``: table to the column its files are ranges of.
    ``buckets``: files a load adds per table; size it so that a bucket's whole history sorts in one task."""

    def __init__(self, spark: SparkSession, root: str, database: str, keys: dict[str, str] | None = None,
                 clustered: dict[str, str] | None = None, buckets: int = 8):
        super().__init__(spark, root)
        self.database, self.keys, self.clustered, self.buckets = database, keys or {}, clustered or {}, buckets
        # a dropped database takes its own folder along, so tables lie beside it, not in it
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/_database'")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def _there(self, table: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def create(self, table: str, schema: StructType, part: str) -> None:
        """Register ``table`` (``schema`` without its partition column ``part``) over its folder, with the partitions found there."""
        if self.spark.catalog.tableExists(self.name(table)):
            return
        found = self._there(table)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != part)
        key, near = self.keys.get(table), self.clustered.get(table)
        bucketed = f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {self.buckets} BUCKETS" if key else ""
        bloom = f", 'parquet.bloom.filter.enabled#{near}' = 'true'" if near else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({cols}, `{part}` INT) USING parquet OPTIONS ('compression' = '{CODEC}'{bloom}) "
                       f"PARTITIONED BY (`{part}`) {bucketed} LOCATION '{self.path(table)}'")
        if found:
            self.spark.sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")

    def read(self, name: str, schema: StructType | None = None) -> DataFrame | None:
        if not self.spark.catalog.tableExists(self.name(name)):
            if schema is None or not self._there(name):
                return None
            self.create(name, StructType([*schema.fields, StructField(LOAD_YEAR, IntegerType())]), LOAD_YEAR)
        return self.spark.table(self.name(name))

    def _dealt(self, rows: DataFrame, key: str) -> DataFrame:
        return seal(rows, [key]).repartition(self.buckets, key)

    def append(self, rows: DataFrame, name: str, dealt: bool = False) -> None:
        """``dealt``: a bucketed table's rows already lie by bucket."""
        rows = rows.withColumn(LOAD_YEAR, F.year("load_date"))
        self.create(name, rows.schema, LOAD_YEAR)
        key, near = self.keys.get(name), self.clustered.get(name)
        if key:                                                 # a task writes one bucket: one file per bucket and year
            rows = rows if dealt else self._dealt(rows, key)
        elif near:
            rows = seal(rows, [near]).repartitionByRange(LOAD_YEAR, near).sortWithinPartitions(LOAD_YEAR, near)
        else:
            rows = rows.hint("rebalance", LOAD_YEAR)
        seal(rows).select(*self.spark.table(self.name(name)).columns).write.insertInto(self.name(name))

    def append_new(self, rows: DataFrame, name: str, tgt: DataFrame | None, key: str) -> None:
        """The batch is dealt by bucket once, for the anti join and for the files."""
        if self.keys.get(name) != key:
            super().append_new(rows, name, tgt, key)
            return
        rows = self._dealt(rows, key)
        if tgt is not None:
            rows = rows.join(tgt.select(key), key, "left_anti")
        self.append(rows, name, dealt=True)

    def overwrite_year(self, rows: DataFrame, name: str, year: int, col: str = "year") -> None:
        rows = rows.drop(col)
        self.create(name, rows.schema, col)
        cols = ", ".join(f"`{c}`" for c in self.spark.table(self.name(name)).columns if c != col)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name(name)} PARTITION (`{col}` = {int(year)}) SELECT {cols} FROM {{rows}}", rows=rows)

    def overwrite_years(self, rows: DataFrame, name: str, col: str = "year") -> None:
        """Replace the partitions that ``rows`` holds; others stay."""
        self.create(name, rows.schema, col)
        out = rows.select(*self.spark.table(self.name(name)).columns)
        out.write.option("partitionOverwriteMode", "dynamic").insertInto(self.name(name), overwrite=True)

    def drop(self) -> None:
        """Forget the database and its tables; the files stay."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")
