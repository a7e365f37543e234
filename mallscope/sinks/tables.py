"""JDBC append, catalog table replace, publishing ad lines to Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batchsize: int = 1000,
                 isolation_level: str = "READ_COMMITTED", num_partitions: int | None = None) -> dict:
    """K1/K2: writer options. Rows are sent from the executors in batches of
    ``batchsize`` per statement, one transaction per task; ``num_partitions``
    caps concurrent connections (the writer coalesces to it)."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize),
            "isolationLevel": isolation_level}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kw) -> None:
    """K1/K2: append a result to a JDBC table. Errors fail the job (not swallowed)."""
    df.write.format("jdbc").options(**jdbc_options(url, table, **kw)).mode(mode).save()


def replace_table(df: DataFrame, name: str, path: str | None = None,
                  partition_by: list[str] | None = None) -> None:
    """K3: replace a catalog table with ``df`` (overwrite), optionally at ``path``.

    Partitioning a fact by ``date`` makes the date bounds of P1 prune whole
    folders at read time.
    """
    if partition_by:
        # AQE rebalance: rows of a folder go together (few files per folder),
        # a hot folder is split over several tasks, small ones are merged
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def kafka_records(ads: DataFrame, key: str | None = "userid") -> DataFrame:
    """Typed clicks -> Kafka records (``key``, ``value`` = the text line)."""
    from mallscope.functions.adlog import render_ad_log
    lines = render_ad_log(ads, keep=[key] if key else [])
    cols = [lines["line"].alias("value")]
    if key:
        cols.insert(0, lines[key].cast("string").alias("key"))
    return lines.select(*cols)


def publish_ad_log(ads: DataFrame, bootstrap_servers: str, topic: str,
                   key: str | None = "userid") -> None:
    """Send the clicks as text lines to a Kafka topic (from the executors).

    Needs the ``spark-sql-kafka`` package on the cluster's classpath.
    """
    (kafka_records(ads, key).write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())
