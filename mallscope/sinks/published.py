"""K4-K6: results of batches in ordinary Parquet tables.

A batch writes its rows to a partition of its own, ``batch=N``, with one
write: a replay overwrites that and nothing else, and nothing that a reader
may hold open is touched. What a reader sees is decided by the rows:

* running totals only grow, so of one key the largest is the current one
  (``latest_totals``); a total that is written twice changes nothing;
* a small result (a top list, a trend, a block set) is written whole, and the
  newest batch is current (``read_newest``);
* anything else carries the batch as its version: ``upsert`` rewrites the
  touched partitions of a table (dynamic partition overwrite) with, of one
  key, the row of the highest version.

One writer at a time. ``retire`` drops partitions that are long superseded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallscope.sources.files import delete, list_dirs, publish_folder

BATCH = "batch"
VERSION = "version"
#: Batches for which a superseded partition stays, for readers that hold it.
KEEP_BATCHES = 64


def publish(df: DataFrame, path: str, batch_id: int) -> None:
    """Write ``df`` as batch ``batch_id`` of the table at ``path``."""
    df.write.mode("overwrite").parquet(batch_path(path, batch_id))


def batch_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{BATCH}={batch_id}"


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_published(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All batches' rows and their ``batch``; no rows if nothing was written."""
    s = T.StructType([*_schema(schema).fields, T.StructField(BATCH, T.LongType())])
    if not list_dirs(spark, path):
        return spark.createDataFrame([], s)
    return spark.read.schema(s).parquet(path).select(*s.names)


def batches_of(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches in a folder of ``batch=N`` folders, ascending."""
    return sorted(int(d.split("=", 1)[1]) for d in list_dirs(spark, path) if d.startswith(BATCH + "="))


def read_newest(spark: SparkSession, path: str, schema: T.StructType | str, before: int | None = None) -> DataFrame:
    """The rows of the newest batch (before batch ``before``)."""
    s = _schema(schema)
    have = [b for b in batches_of(spark, path) if before is None or b < before]
    if not have:
        return spark.createDataFrame([], s)
    return spark.read.schema(s).parquet(batch_path(path, have[-1]))


def retire(spark: SparkSession, path: str, batch_id: int, keep: int = KEEP_BATCHES) -> None:
    """Drop the batches older than the newest one that is ``keep`` behind."""
    old = [b for b in batches_of(spark, path) if b <= batch_id - keep]
    for b in old[:-1]:
        delete(spark, batch_path(path, b))


def latest_totals(rows: DataFrame, keys: list[str], total: str = "n") -> DataFrame:
    """The current total of each key of a log of growing totals."""
    return rows.groupBy(*keys).agg(F.max(total).alias(total))


def compact_totals(spark: SparkSession, path: str, schema: T.StructType | str, keys: list[str], through: int,
                   total: str = "n") -> None:
    """Write the current totals of the batches up to ``through`` as that one
    batch and drop the older ones.

    Totals read the same before and after. The new batch is written beside
    the old one and takes its place by a rename; for batches that nobody
    replays or holds open any more.
    """
    old = [b for b in batches_of(spark, path) if b <= through]
    rows = read_published(spark, path, schema).filter(F.col(BATCH) <= through)
    staging = f"{path.rstrip('/')}_compact/{through}"
    latest_totals(rows, keys, total).select(*_schema(schema).names).write.mode("overwrite").parquet(staging)
    if through in old:
        delete(spark, batch_path(path, through))
    publish_folder(spark, staging, batch_path(path, through))
    for b in old:
        if b < through:
            delete(spark, batch_path(path, b))


def upsert(df: DataFrame, path: str, batch_id: int, keys: list[str], partition_by: list[str]) -> None:
    """K4/K5: rows of ``df`` (one per key) replace those of equal key.

    ``partition_by`` are some of the keys; only the partitions that the batch
    touches are read and rewritten, their names reach the driver. A row keeps
    the batch that wrote it as ``version``, and the highest one wins: a replay
    changes nothing, an older batch cannot undo a newer one. Null keys are a
    key like any other.
    """
    spark = df.sparkSession
    new = df.withColumn(VERSION, F.lit(batch_id).cast("bigint"))
    rest = [c for c in new.columns if c not in keys]
    if list_dirs(spark, path):
        touched = df.select(*partition_by).distinct().collect()
        hit = F.lit(False)
        for row in touched:
            one = F.lit(True)
            for c in partition_by:
                one = one & (F.col(c).isNull() if row[c] is None else F.col(c) == F.lit(row[c]))
            hit = hit | one
        old = spark.read.schema(new.schema).parquet(path).filter(hit).select(*new.columns)
        both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
        new = (both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(VERSION, "__new")).alias("__r"))
               .select(*keys, *[F.col("__r")[c].alias(c) for c in rest]))
    (new.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path))


def read_upserted(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The current rows of an upserted table, without their versions."""
    s = _schema(schema)
    return spark.read.schema(s).parquet(path).select(*s.names) if list_dirs(spark, path) \
        else spark.createDataFrame([], s)
