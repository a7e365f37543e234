"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. The time zone is pinned so that any
# timestamp text agrees with the SQL oracle; AQE re-plans joins and
# coalesces/splits shuffle partitions at run time from real sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # size shuffle partitions by bytes, not by the core count: on a cluster
    # set a generous spark.sql.shuffle.partitions and let AQE merge them
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "mallscope",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster, leave ``master`` unset and let spark-submit decide; size
    ``shuffle_partitions`` so one shuffle partition stays near 128-256 MB.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a folder every executor and the driver
    can reach, e.g. on HDFS or an object store); unset, this raises. Only in
    local mode with it unset (tests) a scratch folder is made and recorded.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and "
                           "all executors (e.g. on HDFS or an object store)")
    root = tempfile.mkdtemp(prefix="mallscope-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    return os.path.join(checkpoint_root(spark), *parts)
