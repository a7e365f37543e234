"""File-system helpers on Hadoop's FileSystem API (any Spark-supported store).

Used for the driver-side metadata steps only: which batches a published
table has, moving a written folder into place, dropping superseded ones.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_dirs(spark: SparkSession, path: str, marker: str | None = None) -> list[str]:
    """Names of the sub-folders of ``path`` (holding ``marker`` if given); [] if absent."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        if st.isDirectory() and (marker is None or fs.exists(st.getPath().suffix("/" + marker))):
            out.append(st.getPath().getName())
    return out


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def publish_folder(spark: SparkSession, staging: str, target: str) -> None:
    """Move a fully written folder into place with one rename (atomic on HDFS
    and local disks), so a file-stream reader sees all of it or none."""
    src, fs = _fs(spark, staging)
    dst, _ = _fs(spark, target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {staging} to {target}")


def make_dir(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.mkdirs(p)
