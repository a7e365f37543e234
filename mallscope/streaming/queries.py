"""Starting a streaming query with a checkpoint and trigger."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from mallscope.constants import BATCH_INTERVAL

DEFAULT_TRIGGER = {"processingTime": BATCH_INTERVAL}

# State in RocksDB on the executors, its changes logged to the checkpoint: a
# batch uploads what it changed, not the state. An idle query runs no batch of
# its own; state that a watermark closed leaves with the next data.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def conf_of(spark: SparkSession, conf: dict[str, str]):
    """Session settings for what is started inside; put back afterwards. A
    streaming query keeps the settings it was started with."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_query(df: DataFrame, checkpoint: str, sink: str = "parquet", path: str | None = None,
                output_mode: str = "append", trigger: dict | None = None,
                on_batch: Callable[[DataFrame, int], None] | None = None,
                query_name: str | None = None, options: dict | None = None,
                partition_by: list[str] | None = None) -> StreamingQuery:
    """Start ``df`` into a sink; restartable from ``checkpoint``.

    ``trigger``: ``{"processingTime": "3 seconds"}`` (default), ``{"availableNow": True}``
    or ``{"once": True}``; ``None`` runs micro-batches as fast as data comes.
    ``on_batch(batch_df, batch_id)`` turns the query into ``foreachBatch``
    (C6): arbitrary per-batch DataFrame writes, which must be idempotent by
    ``batch_id`` because a batch is replayed after a failure.
    ``sink="console"`` prints the first rows of each batch (K9).
    Restarting with the same ``checkpoint`` resumes from the last committed
    offsets and state (S5).
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger is not None:
        w = w.trigger(**trigger)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if on_batch is not None:
        w = w.foreachBatch(on_batch)
    else:
        w = w.format(sink)
        if path:
            w = w.option("path", path)
    if options:
        w = w.options(**options)
    return w.start()


def start_stateful(df: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None],
                   trigger: dict | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Start a streaming aggregation in update mode on RocksDB state.

    ``on_batch`` gets the groups that the batch changed. ``state_partitions``
    is how many parts the state has (default: the session's shuffle
    partitions); the first start fixes it for the life of the checkpoint.
    """
    conf = dict(STATE_CONF)
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    with conf_of(df.sparkSession, conf):
        return start_query(df, checkpoint, output_mode="update", trigger=trigger, on_batch=on_batch)


def read_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The rows of a query's state, one column a key and a value field.

    Of the last committed batch, or of ``batch_id``; Spark's ``statestore``
    reader, so a query need not run.
    """
    r = spark.read.format("statestore")
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    state = r.load(checkpoint)
    return state.select("key.*", *[state["value"][f].alias(f) for f in state.schema["value"].dataType.names])


def state_info(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint, their parts and batches
    (Spark's ``state-metadata`` reader)."""
    return spark.read.format("state-metadata").load(checkpoint)
