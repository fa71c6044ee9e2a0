"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultweave.session import materialize, new_work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back (cuts lineage)."""
    return materialize(df, f"{new_work_dir(df.sparkSession, label)}/t")


#: Spark's switch that drops a statement's shuffle files when it has ended
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved_alone(df: DataFrame, label: str) -> DataFrame:
    """``saved``, with the shuffle files of this write gone when it has ended: otherwise they stay on the executors'
    disks until the driver happens to collect its garbage, those of all steps so far together."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, None)
    conf.set(CLEAN_UP, "true")
    try:
        return saved(df, label)
    finally:
        conf.unset(CLEAN_UP) if before is None else conf.set(CLEAN_UP, before)


def fresh(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores in front as keep it apart from ``columns`` (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        out.append(n)
    return out


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def held_out(doc_id: Column) -> Column:
    """True for the evaluation fold: crc32 of the id as text, modulo 5, is 0 (a null id is held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


#: cells summed up at a time by ``sums_before``
CELLS = 1024


def sums_before(rows: DataFrame, group: list[str], cell: str, values: list[str]) -> DataFrame:
    """``rows`` (one per ``group`` and whole-numbered ``cell``) with ``<value>_before``, the sum over the group's smaller
    cells, and ``<value>_total``, the sum over the group. ``CELLS`` cells at a time are summed, then those sums: a
    window holds at most ``CELLS`` cells, or one row per ``CELLS`` cells, of one group."""
    of = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    begin = lambda v, w: F.coalesce(F.sum(v).over(ahead(w)), F.lit(0))
    rows = rows.withColumn("__block", F.floor(F.col(cell) / CELLS))
    sums = rows.groupBy(*group, "__block").agg(*[F.sum(v).alias(v) for v in values])
    sums = sums.select(*group, "__block", *[begin(v, of.orderBy("__block")).alias(f"__{v}") for v in values],
                       *[F.sum(v).over(of).alias(f"{v}_total") for v in values])
    inside = Window.partitionBy(*group, "__block").orderBy(cell)
    near = rows.select("*", *[begin(v, inside).alias(f"{v}_before") for v in values]).join(sums, [*group, "__block"])
    for v in values:
        near = near.withColumn(f"{v}_before", F.col(f"{v}_before") + F.col(f"__{v}"))
    return near.drop("__block", *[f"__{v}" for v in values])


#: DuckDB SQL of the unsigned CRC-32 of a text's UTF-8 bytes (that engine has no such function): the table of byte
#: values as a one-row CTE, and an expression that folds the bytes, to be used where the CTE ``crc`` is joined
CRC_TABLE_SQL = """crc AS (SELECT list(list_reduce(list_prepend(i::BIGINT, range(8)::BIGINT[]),
  lambda x, j: xor(x >> 1, (x & 1) * 3988292384)) ORDER BY i) AS t FROM range(256) r(i))"""


def crc_sql(text: str) -> str:
    bytes_of = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {bytes_of}), lambda x, y: xor(x >> 8, crc.t[(xor(x, y) & 255) + 1])))"
