"""Parquet table store for the lake and the vault.

Vault tables are append-only and partitioned by ``load_year`` (year of ``load_date``): a
satellite's ``load_date <= D`` filter then also prunes later partitions, and a year can be
inspected or reloaded on its own. Lake tables are partitioned by ``year`` and a load overwrites
exactly one ``year=Y`` directory (also when the new slice is empty), as a static-partition
``INSERT OVERWRITE`` does. Paths can be any Hadoop file system URI.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from vaultweave.functions.hashing import seal

LOAD_YEAR = "load_year"
#: keys and hash diffs are hex digits, half of which an entropy coder saves
CODEC = "zstd"


class TableStore:
    #: tables whose files are ranges of a column (none here)
    clustered: dict[str, str] = {}

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, schema: StructType | None = None) -> DataFrame | None:
        """The table, or None when nothing was written yet. ``schema`` excludes ``load_year``."""
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(StructType([*schema.fields, StructField(LOAD_YEAR, IntegerType())]))
        try:
            return reader.parquet(self.path(name))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
                return None
            raise

    def years(self, path: str) -> list[int]:
        """Load years of a partitioned table, from its folder names (one listing, no file is opened)."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{LOAD_YEAR}=") and n.split("=")[1].isdigit())

    def read_public(self, name: str, schema: StructType | None = None) -> DataFrame | None:
        """The table without its partition column; with a schema, a table never written is empty."""
        df = self.read(name, schema)
        if df is None:
            return None if schema is None else self.spark.createDataFrame([], schema)
        return df.drop(LOAD_YEAR)

    def append(self, rows: DataFrame, name: str) -> None:
        """One commit; rows are gathered by load year first, so a year gets few files (a large year is split). Texts of
        keys are hashed on the way to the file, after the rows were gathered."""
        (seal(rows.withColumn(LOAD_YEAR, F.year("load_date")).hint("rebalance", LOAD_YEAR))
         .write.mode("append").option("compression", CODEC).partitionBy(LOAD_YEAR).parquet(self.path(name)))

    def append_new(self, rows: DataFrame, name: str, tgt: DataFrame | None, key: str) -> None:
        """Append the rows whose ``key`` is not in ``tgt``, the table so far."""
        if tgt is not None:
            rows = seal(rows, [key]).join(tgt.select(key), key, "left_anti")
        self.append(rows, name)

    def overwrite_years(self, rows: DataFrame, name: str, col: str = "year") -> None:
        """Replace the partitions that ``rows`` holds, in one commit; others stay."""
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(self.path(name)))

    def overwrite_year(self, rows: DataFrame, name: str, year: int, col: str = "year") -> None:
        """Replace partition ``col=year`` with ``rows`` (which carry no partition column)."""
        rows.drop(col).write.mode("overwrite").parquet(f"{self.path(name)}/{col}={year}")
