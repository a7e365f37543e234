"""C3 live: the trailing per-minute trend (R8) from event-time windows.

Clicks are counted per (minute, ad) in one-minute windows behind a watermark
of the trend's span, so the state holds the span's minutes and no more; a
click of an older minute is dropped by it, and Spark's state metrics count
it. A batch merges the minutes that it changed into the last published trend,
which is as small as the span.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.functions.scalars import epoch_ms_to_minute, epoch_ms_to_timestamp
from mallscope.operators.ads import DEFAULT_SPAN_MINUTES, ad_minute_json, check_span, trailing_minutes
from mallscope.sinks.published import latest_totals, publish, read_newest, retire

MINUTES_SCHEMA = "adid string, minute bigint, n bigint"


def minute_windows(kept: DataFrame, span_minutes: int = DEFAULT_SPAN_MINUTES) -> DataFrame:
    """Running (adid, minute, n) of a stream of kept clicks."""
    check_span(span_minutes)
    timed = kept.withColumn("__at", epoch_ms_to_timestamp("timestamp")).withWatermark("__at", f"{span_minutes} minutes")
    counts = timed.groupBy(F.window("__at", "1 minute").alias("__w"), "adid").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("adid", epoch_ms_to_minute(F.unix_millis(F.col("__w.start"))).alias("minute"), "n")


def publish_trend(path: str, span_minutes: int = DEFAULT_SPAN_MINUTES):
    """A ``foreachBatch`` function: the span's minutes, written whole (K6)."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old = read_newest(spark, path, MINUTES_SCHEMA, before=batch_id)
        minutes = latest_totals(old.unionByName(batch.select("adid", "minute", "n")), ["adid", "minute"]).persist()
        try:
            now = trailing_minutes(minutes, span_minutes).select("adid", "minute", "n")
            publish(now.coalesce(1), path, batch_id)
            retire(spark, path, batch_id)
        finally:
            minutes.unpersist()
    return on_batch


def read_minutes(spark, path: str) -> DataFrame:
    """The trailing (adid, minute, n)."""
    return read_newest(spark, path, MINUTES_SCHEMA)


def read_trend(spark, path: str, span_minutes: int = DEFAULT_SPAN_MINUTES) -> DataFrame:
    """(adid, minutes_json)."""
    return ad_minute_json(trailing_minutes(read_minutes(spark, path), span_minutes))
