"""Rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair has a hash of its own; a record lies in the shard of
the highest score ``weight / -ln(u)``, u the hash as a number in (0, 1). A
shard's share follows its weight. A shard that is added takes records only to
itself, one that goes gives up only its own, and a weight that rises only
draws records in, because no other score changes.

DataFrame functions only. Texts are read once, for their digests; only
(key, size, checksum, shard) is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mallscope.llm.common import scratch, written

#: Bytes that a record takes besides its text.
RECORD_BYTES = 16
#: Rows of one written file that are numbered together.
SLOT_ROWS = 1 << 18


def shard_weights(shards: int | Sequence[float]) -> list[float]:
    """A number of equal shards, or their weights; a weight of 0 is an empty shard."""
    weights = [1.0] * shards if isinstance(shards, int) else [float(w) for w in shards]
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative and one must be positive")
    return weights


def rendezvous(key: Column, *layouts: int | Sequence[float]) -> list[Column]:
    """The shard (int) of ``key`` under each of the layouts.

    A layout is what ``shard_weights`` takes. The pair's hash depends on the
    key's text and the shard's number alone, so layouts share their scores. A
    null key is one key like any other. Equal scores go to the larger number.
    """
    plans = [shard_weights(x) for x in layouts]
    h = F.xxhash64(key.cast("string"))

    def best(weights: list[float]) -> Column:
        def scored(weight: Column, number: Column) -> Column:
            # 53 bits of the pair's hash, in (0, 1)
            u = (F.shiftrightunsigned(F.xxhash64(h, number), 11).cast("double") + 0.5) / float(1 << 53)
            return F.struct((weight / -F.ln(u)).alias("score"), number.alias("shard"))

        positive = [k for k, w in enumerate(weights) if w > 0]
        numbers, shares = F.array(*map(F.lit, positive)), F.array(*[F.lit(weights[k]) for k in positive])
        return F.array_max(F.zip_with(shares, numbers, scored))["shard"]

    return [best(w) for w in plans]


def assign_shards(docs: DataFrame, shards: int | Sequence[float], grown: int | Sequence[float] | None = None,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, grown_shard) of every row of ``docs``.

    ``size`` is the text's UTF-8 bytes and ``RECORD_BYTES`` (a null text: 0
    bytes); ``grown_shard`` is the shard under the layout ``grown`` (default:
    one more shard of the first one's weight). Key and layout alone decide, so
    rows of one key - repeated rows, null keys - lie in one shard, ties or not.
    """
    weights = shard_weights(shards)
    now, then = rendezvous(F.col(key), weights, [*weights, weights[0]] if grown is None else grown)
    content = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(key),
                       (F.octet_length(content) + RECORD_BYTES).cast("bigint").alias("size"),
                       F.crc32(content).alias("text_crc32"), now.alias("shard"), then.alias("grown_shard"))


def with_slots(rows: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """``rows`` with ``slot``, a number within the shard, gapless from 0.

    The rows are written once; a row's place in its file tells equal rows
    apart and stays the same when a task is run again. Rows are numbered
    within (file, stretch of ``slot_rows`` rows, shard), and each such group
    starts where the earlier ones of its shard end, so no task gets a whole
    shard however much of the table one key holds.
    """
    spark, names = rows.sparkSession, rows.columns
    path = scratch(spark, "shard-rows")
    rows.write.parquet(path)
    kept = spark.read.schema(rows.schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    kept = kept.withColumn("__stretch", F.floor(F.col("__row") / slot_rows))
    group = ["shard", "__file", "__stretch"]
    before = Window.partitionBy("shard").orderBy("__file", "__stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    starts = written(starts.select(*group, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")), "shard-starts")
    place = F.row_number().over(Window.partitionBy(*group).orderBy("__row")) - 1
    return (kept.withColumn("__place", place).join(starts, group)
            .select(*names, (F.col("__start") + F.col("__place")).cast("bigint").alias("slot")))


def moved(assigned: DataFrame) -> DataFrame:
    """What a change of layout moves: (shard, grown_shard, n_rows, n_bytes),
    rows that stay included."""
    return assigned.groupBy("shard", "grown_shard").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("size").cast("bigint").alias("n_bytes"))


def write_shards(docs: DataFrame, path: str, shards: int | Sequence[float], key: str = "doc_id") -> None:
    """Write ``docs``, all columns as they are, to one folder ``__shard=N`` a
    shard. Spark balances the rows over tasks; a large shard is several files."""
    placed = docs.withColumn("__shard", rendezvous(F.col(key), shards)[0])
    placed.hint("rebalance", "__shard").write.partitionBy("__shard").parquet(path)


def shard_documents(docs: DataFrame, shards: int | Sequence[float] = 40) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    ``law`` is ``key``: doc_id and shard count decide. Null ids and texts, empty
    texts, repeated rows and further columns of any name are as
    ``assign_shards`` says; an empty table gives no rows.
    """
    rows = with_slots(assign_shards(docs.select("doc_id", "text"), shards))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
