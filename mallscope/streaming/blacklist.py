"""C5 K7 K8 on a stream: counters in Spark's state, block points per batch.

The counters per (date, user, ad) are a streaming aggregation: clicks are
counted on the way into the shuffle, so a bot is a few rows, and the state
holds one number a counter. With ``keep_days`` they are counted per one-day
window behind a watermark, and closed days leave the state.

A batch gets the totals that it changed. Clicks are ranked only in groups
whose total reached the threshold, and there each map task ships at most
``threshold`` of a group, however many clicks a bot sends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mallscope.functions.scalars import epoch_ms_to_date, epoch_ms_to_timestamp
from mallscope.operators.ads import DEFAULT_THRESHOLD, ORDER_KEY, user_ad_daily_counts, with_date

COUNTER_KEYS = ["date", "userid", "adid"]
BLOCKED_SCHEMA = "userid string, blocked_ts bigint, blocked_event_id bigint"
COUNTERS_SCHEMA = "date string, userid string, adid string, n bigint"


def day_groups(clicks: DataFrame, keep_days: int | None) -> tuple[DataFrame, Column, Column]:
    """(clicks, grouping column, date text from it) for totals by day.

    Without ``keep_days`` the day is a text and its totals stay for ever. With
    it the day is a one-day window that leaves the state once the newest click
    is ``keep_days`` days past its end.
    """
    if keep_days is None:
        return with_date(clicks), F.col("date"), F.col("date")
    timed = clicks.withColumn("__at", epoch_ms_to_timestamp("timestamp")).withWatermark("__at", f"{keep_days} days")
    return timed, F.window("__at", "1 day").alias("__day"), epoch_ms_to_date(F.unix_millis(F.col("__day.start")))


def counter_totals(clicks: DataFrame, keep_days: int | None = None) -> DataFrame:
    """Running (date, userid, adid, n) of a stream of clicks, with the
    newest source batch that a counter has seen (``last``)."""
    timed, day, date = day_groups(clicks, keep_days)
    totals = timed.groupBy(day, "userid", "adid").agg(F.count(F.lit(1)).alias("n"), F.max("batch").alias("last"))
    return totals.select(date.alias("date"), "userid", "adid", "n", "last")


def unblocked(clicks: DataFrame, blocked: DataFrame) -> DataFrame:
    """Clicks of users not in the block set (userid); a null user is never blocked."""
    return clicks.join(blocked.select(F.col("userid").alias("__b")), F.col("userid") == F.col("__b"), "left_anti")


def batch_block_points(fresh: DataFrame, totals: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Users whose click count on some ad and day reaches ``threshold`` with
    this batch, and the click that does it: (userid, blocked_ts, blocked_event_id).

    ``fresh`` are the batch's clicks of users not blocked before, ``totals``
    the (date, userid, adid, n) after the batch.
    """
    reached = totals.select(*COUNTER_KEYS, F.col("n").alias("__n")).filter(
        (F.col("__n") >= threshold) & F.col("userid").isNotNull())
    new = user_ad_daily_counts(fresh).withColumnRenamed("n", "__new")
    # how many clicks of the batch it takes; at least one, whatever the state says
    reach = (new.join(reached, COUNTER_KEYS)
             .select(*COUNTER_KEYS, F.greatest(threshold - (F.col("__n") - F.col("__new")), F.lit(1)).alias("__need")))
    rows = with_date(fresh.select("userid", "adid", *ORDER_KEY)).join(reach, COUNTER_KEYS)
    w = Window.partitionBy(*COUNTER_KEYS).orderBy(*ORDER_KEY)
    # the constant limit is what each map task can apply
    hit = (rows.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= threshold)
           .filter(F.col("__rn") == F.col("__need")))
    return (hit.groupBy("userid").agg(F.min(F.struct(*ORDER_KEY)).alias("__p"))
            .select("userid", F.col("__p.timestamp").alias("blocked_ts"),
                    F.col("__p.event_id").alias("blocked_event_id")))


def passes(fresh: DataFrame, points: DataFrame, micro_batch: bool = False) -> DataFrame:
    """``fresh`` with ``passes``: whether the blacklist lets the click through.

    ``micro_batch``: the set is read when the batch starts, so the whole batch
    passes and the users in ``points`` are dropped from the next batch on.
    Else a user's clicks pass up to the blocking one.
    """
    if micro_batch:
        return fresh.withColumn("passes", F.lit(True))
    p = points.select(F.col("userid").alias("__u"), "blocked_ts", "blocked_event_id")
    at = F.struct(F.col("blocked_ts").alias("timestamp"), F.col("blocked_event_id").alias("event_id"))
    j = fresh.join(p, F.col("userid") == F.col("__u"), "left")
    return j.select(*fresh.columns, (F.col("__u").isNull() | (F.struct(*ORDER_KEY) <= at)).alias("passes"))
