"""The ad-click stream source and Kafka offset bookkeeping.

Kafka is read with Structured Streaming's ``kafka`` source (it needs the
``spark-sql-kafka`` package on the cluster's classpath). The receiver-based
and the two direct APIs of older Spark all map onto this one source: it is
direct (executors read their partitions), spreads partitions evenly over
executors, and is recoverable through the query checkpoint. Offline and in
tests the same lines come from files.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE_SCHEMA = T.StructType([T.StructField("line", T.StringType()),
                            T.StructField("event_id", T.LongType())])


# event_id of a Kafka record: offset * KAFKA_PARTITION_SLOTS + partition.
KAFKA_PARTITION_SLOTS = 10_000

# Largest micro-batch read from Kafka: it bounds every per-key step of a
# batch (e.g. one user's clicks in the blacklist state function).
DEFAULT_MAX_OFFSETS_PER_TRIGGER = 5_000_000


# Files a micro-batch of a file source takes at most.
DEFAULT_MAX_FILES_PER_TRIGGER = 256


def kafka_event_id(partition: str, offset: str):
    """A unique number per record of one topic; fails on a partition number
    that has no slot rather than giving two records one id."""
    p = F.col(partition)
    slot = F.when(p < KAFKA_PARTITION_SLOTS, p).otherwise(
        F.raise_error(F.concat(F.lit("no event id slot for partition "), p.cast("string"))).cast("int"))
    return F.col(offset) * KAFKA_PARTITION_SLOTS + slot


def kafka_options(bootstrap_servers: str, topic: str, group_id: str | None = None,
                  starting_offsets: dict | str | None = None,
                  max_offsets_per_trigger: int | None = DEFAULT_MAX_OFFSETS_PER_TRIGGER,
                  min_partitions: int | None = None) -> dict:
    """The reader options for a Kafka topic.

    ``starting_offsets`` is ``"earliest"``, ``"latest"`` or a map
    ``{topic: {partition: offset}}`` (S6: start from given offsets).
    ``min_partitions`` above the topic's partition count makes Spark split
    the offset range of a large (hot) topic partition over several tasks.
    """
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic}
    if group_id:
        opts["kafka.group.id"] = group_id
    if starting_offsets is not None:
        opts["startingOffsets"] = (starting_offsets if isinstance(starting_offsets, str)
                                   else json.dumps({t: {str(p): o for p, o in parts.items()}
                                                    for t, parts in starting_offsets.items()}))
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def read_ad_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                   options: dict | None = None,
                   max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER
                   ) -> DataFrame:
    """S3: a streaming DataFrame with a text ``line`` column (+ source columns).

    ``fmt="kafka"``: key/value are cast to text, topic/partition/offset kept
    for offset capture, and ``event_id`` = offset x ``KAFKA_PARTITION_SLOTS`` +
    partition. That is unique within one topic of fewer partitions than that,
    so anything else is refused: several topics here, a larger partition
    number when it is read. ``fmt="parquet"``: files with ``line`` (and
    ``event_id``) columns, e.g. written by ``render_ad_log``; a micro-batch
    takes at most ``max_files_per_trigger`` of them.
    """
    r = spark.readStream
    if fmt == "kafka":
        if "subscribePattern" in (options or {}) or "," in (options or {}).get("subscribe", ""):
            raise ValueError("read one topic a stream: offsets of several topics give equal event ids")
        df = r.format("kafka").options(**(options or {})).load()
        # a unique tie-break per click: offsets are unique per topic partition
        eid = kafka_event_id("partition", "offset")
        return df.select(F.col("value").cast("string").alias("line"), eid.alias("event_id"),
                         F.col("key").cast("string").alias("key"),
                         "topic", "partition", "offset")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.format(fmt).schema(LINE_SCHEMA).options(**(options or {})).load(path)


def offset_ranges(rows: DataFrame) -> DataFrame:
    """Per (topic, partition) the offset range a batch covered.

    ``until_offset`` is exclusive, like Kafka's offset ranges.
    """
    return rows.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
        F.count(F.lit(1)).alias("n"))


def record_offsets(root: str):
    """S7 on a stream: a ``foreachBatch`` function that stores each batch's
    offset ranges (topic, partition, from, until) in a folder of its own
    under ``root``; replaying a batch rewrites the same folder.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        offset_ranges(batch).write.mode("overwrite").parquet(f"{root.rstrip('/')}/batch_id={batch_id}")
    return on_batch


def read_offsets(spark: SparkSession, root: str) -> DataFrame:
    """All recorded batches' offset ranges (``batch_id`` from the folder names)."""
    return spark.read.parquet(root)


KAFKA_ROW_SCHEMA = T.StructType([T.StructField("topic", T.StringType()),
                                 T.StructField("partition", T.IntegerType()),
                                 T.StructField("offset", T.LongType()),
                                 T.StructField("value", T.StringType())])
