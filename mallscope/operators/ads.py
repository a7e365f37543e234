"""Ad-click operators: A10 A11 C2 C3 C7 X2 X3 X5 and the C5 blacklist.

All are written for a DataFrame of clicks
``(timestamp ms, area, city, userid, adid[, event_id])``; the streaming
module feeds them micro-batches or uses their aggregations directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mallscope.constants import BLACKLIST_THRESHOLD, TOP_ADS, TREND_SPAN_MINUTES
from mallscope.functions.scalars import (MS_PER_MINUTE, epoch_ms_to_date, epoch_ms_to_minute,
                                         minute_to_hhmm, pairs_to_json)
from mallscope.operators.ranking import top_ranked

DEFAULT_THRESHOLD = BLACKLIST_THRESHOLD
DEFAULT_SPAN_MINUTES = TREND_SPAN_MINUTES
ORDER_KEY = ("timestamp", "event_id")


def with_date(ads: DataFrame, name: str = "date") -> DataFrame:
    """Add the UTC day ``yyyy-MM-dd`` of the click."""
    return ads.withColumn(name, epoch_ms_to_date("timestamp"))


def user_ad_daily_counts(ads: DataFrame) -> DataFrame:
    """A10/K7: clicks per (date, userid, adid)."""
    return (with_date(ads).groupBy("date", "userid", "adid")
                          .agg(F.count(F.lit(1)).alias("n")))


def blacklist_points(ads: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                     batch_col: str | None = None) -> DataFrame:
    """Blocked users and the click that blocked them.

    A user is blocked at the earliest click (by ``timestamp``, ``event_id``)
    that brings some (date, user, ad) count to ``threshold``. Returns
    (userid, blocked_ts, blocked_event_id). With ``batch_col`` (micro-batch
    semantics) clicks are ordered by batch first and the batch of that click
    is returned as ``blocked_batch`` as well.

    The ``row_number() <= threshold`` filter becomes a WindowGroupLimit: each
    map task keeps at most ``threshold`` rows per (date, user, ad), so even a
    bot with a third of all clicks ships a few rows.
    """
    order = ORDER_KEY if batch_col is None else (batch_col, *ORDER_KEY)
    r = with_date(ads.select("userid", "adid", *order))
    w = Window.partitionBy("date", "userid", "adid").orderBy(*order)
    hit = r.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == threshold)
    out = [F.col("__bp.timestamp").alias("blocked_ts"),
           F.col("__bp.event_id").alias("blocked_event_id")]
    if batch_col is not None:
        out.append(F.col(f"__bp.{batch_col}").alias("blocked_batch"))
    return (hit.groupBy("userid").agg(F.min(F.struct(*order)).alias("__bp"))
               .select("userid", *out))


def blacklist_filter(ads: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                     points: DataFrame | None = None, batch_col: str | None = None) -> DataFrame:
    """The clicks the blacklist lets through.

    Record-exact (default): a blocked user's clicks are kept up to and
    including the blocking click and dropped after it, on every ad - the
    stream with one click per batch. Micro-batch (``batch_col``): the
    blacklist is read when a batch starts and counters are raised after it,
    so the whole batch in which the user reached the threshold passes and
    later batches are dropped.

    ``points`` are the block points if they are known already (e.g. written
    once for several results). AQE broadcasts them if they turn out small;
    otherwise this is a shuffle join, split where one user is hot.
    """
    bp = blacklist_points(ads, threshold, batch_col) if points is None else points
    bp = bp.withColumnRenamed("userid", "__u")
    j = ads.join(bp, ads["userid"] == bp["__u"], "left")
    if batch_col is not None:
        keep = F.col("__u").isNull() | (F.col(batch_col) <= F.col("blocked_batch"))
    else:
        keep = (F.col("__u").isNull() |
                (F.struct(*ORDER_KEY) <= F.struct(F.col("blocked_ts").alias("timestamp"),
                                                   F.col("blocked_event_id").alias("event_id"))))
    return j.filter(keep).select(*ads.columns)


def date_area_city_ad_count(ads: DataFrame) -> DataFrame:
    """C2/R6 (batch form): clicks per (date, area, city, adid)."""
    return (with_date(ads).groupBy("date", "area", "city", "adid")
                          .agg(F.count(F.lit(1)).alias("n")))


def date_area_ad_rollup(counts: DataFrame) -> DataFrame:
    """City totals rolled up to (date, area, adid)."""
    return counts.groupBy("date", "area", "adid").agg(F.sum("n").cast("bigint").alias("n"))


def top3_ads_by_area(rollup: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """Exactly ``n`` ads per (date, area), most clicks first, ties by adid."""
    return top_ranked(rollup, ["date", "area"], [F.desc("n"), F.asc("adid")], n,
                      ties="row_number", rank_col="rn")


def top3_ads_json(ranked: DataFrame) -> DataFrame:
    """Ranked ads -> (date, area, top3_json) like ``[{"1":16},{"6":14}]``.

    The collected list is at most ``n`` entries per group (already ranked).
    """
    agg = ranked.groupBy("date", "area").agg(
        F.array_sort(F.collect_list(F.struct("rn", "adid", "n"))).alias("__l"))
    return agg.select("date", "area", pairs_to_json("__l", "adid", "n").alias("top3_json"))


def minute_counts(ads: DataFrame) -> DataFrame:
    """Clicks per (adid, minute since the epoch)."""
    return (ads.select("adid", epoch_ms_to_minute("timestamp").alias("minute"))
               .groupBy("adid", "minute").agg(F.count(F.lit(1)).alias("n")))


def ad_minute_counts(ads: DataFrame, span_minutes: int = DEFAULT_SPAN_MINUTES,
                     as_of_minute: int | None = None) -> DataFrame:
    """Clicks per (adid, minute) for the trailing ``span_minutes``.

    ``as_of_minute`` (minutes since the epoch) defaults to the newest minute
    in the data, one scalar subquery over the click times: where ``ads`` is
    costly to make, write what it rests on first. Either way the span becomes
    a bound on the raw ``timestamp`` column, which reaches the scan, and only
    the clicks in the span are counted. Whole minute buckets with
    ``minute > as_of - span`` are kept. Spans of a day or more are rejected
    because ``HH:mm`` labels would collide.
    """
    check_span(span_minutes)
    if as_of_minute is None:
        # no click is newer, so the lower bound alone leaves the span
        newest = ads.select(F.max("timestamp").alias("newest")).scalar()
        first = (epoch_ms_to_minute(newest) - F.lit(span_minutes - 1)) * F.lit(MS_PER_MINUTE)
    else:
        first = F.lit((as_of_minute - span_minutes + 1) * MS_PER_MINUTE)
    return minute_counts(ads.filter(F.col("timestamp") >= first)).withColumn("hhmm", minute_to_hhmm("minute"))


def check_span(span_minutes: int) -> None:
    if not 0 < span_minutes < 24 * 60:
        raise ValueError("span_minutes must be in 1..1439 (HH:mm labels repeat daily)")


def trailing_minutes(minute_counts: DataFrame, span_minutes: int = DEFAULT_SPAN_MINUTES,
                     as_of_minute=None) -> DataFrame:
    """C3 on stored buckets: keep (adid, minute, n) rows of the trailing span, add ``hhmm``."""
    check_span(span_minutes)
    m = minute_counts.select("adid", "minute", "n")
    as_of = F.lit(as_of_minute) if as_of_minute is not None else m.select(F.max("minute")).scalar()
    return (m.filter(F.col("minute") > as_of - F.lit(span_minutes))
             .withColumn("hhmm", minute_to_hhmm("minute")))


def ad_minute_json(minute_counts: DataFrame) -> DataFrame:
    """Per ad, the minute counts as ``[{"HH:mm":n},...]`` in time order.

    Each list holds at most ``span_minutes`` entries (bounded by the span).
    """
    agg = minute_counts.groupBy("adid").agg(
        F.array_sort(F.collect_list(F.struct("minute", "hhmm", "n"))).alias("__l"))
    return agg.select("adid", pairs_to_json("__l", "hhmm", "n").alias("minutes_json"))
