"""Session and work-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "vaultweave",
                  extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset (tests, local runs) a private temporary folder is set; on a cluster
    that would be machine-local, so it is refused there.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="vaultweave-ckpt-"))
    return sc.getCheckpointDir()


def new_work_dir(spark: SparkSession, label: str = "run") -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/vaultweave/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, path: str, partition_by: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` to ``path`` and read it back: cuts lineage, survives executor loss."""
    w = df.write.mode("overwrite")
    if codec:
        w = w.option("compression", codec)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(_with_partition(df, partition_by)).parquet(path)


def _with_partition(df: DataFrame, partition_by: str | None):
    if not partition_by:
        return df.schema
    from pyspark.sql.types import StructType
    fields = [f for f in df.schema.fields if f.name != partition_by]
    fields += [f for f in df.schema.fields if f.name == partition_by]
    return StructType(fields)
