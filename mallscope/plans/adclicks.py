"""Ad-click results in batch form: R5 R6 R7 R8.

The streaming module runs the same functions on each micro-batch (or on
its running aggregates) so a stream and a batch over the same clicks give
the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.constants import TOP3_KEY_PREFIX, TOP_ADS, TREND_KEY
from mallscope.functions.scalars import kv_key
from mallscope.operators.joins import materialize
from mallscope.operators.ads import (DEFAULT_SPAN_MINUTES, DEFAULT_THRESHOLD, ad_minute_counts,
                                     ad_minute_json, blacklist_filter, blacklist_points,
                                     date_area_ad_rollup, date_area_city_ad_count,
                                     top3_ads_by_area, top3_ads_json)


def blacklist_users(ads: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """R5 (blocked set): (userid, blocked_ts, blocked_event_id).

    The results below take it as ``points``; write it once (``materialize``)
    and pass it on where several of them are wanted.
    """
    return blacklist_points(ads, threshold)


def kept_clicks(ads: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                points: DataFrame | None = None) -> DataFrame:
    """R5 (filter): clicks that pass the blacklist."""
    return blacklist_filter(ads, threshold, points)


def daily_city_counts(ads: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                      points: DataFrame | None = None) -> DataFrame:
    """Running clicks per (date, area, city, adid) over kept clicks."""
    return date_area_city_ad_count(kept_clicks(ads, threshold, points))


def daily_top3_ads(ads: DataFrame, threshold: int = DEFAULT_THRESHOLD, n: int = TOP_ADS,
                   points: DataFrame | None = None) -> DataFrame:
    """Per (date, area) the top ``n`` ads as JSON."""
    return top3_ads_json(top3_ads_by_area(date_area_ad_rollup(daily_city_counts(ads, threshold, points)), n))


def minute_trend(ads: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                 span_minutes: int = DEFAULT_SPAN_MINUTES, points: DataFrame | None = None,
                 as_of_minute: int | None = None) -> DataFrame:
    """Per ad the trailing per-minute counts as JSON.

    The block points are written once unless they are given: the newest minute
    and the counts then take a filter by them each, not the blacklist.
    """
    points = materialize(blacklist_points(ads, threshold)) if points is None else points
    kept = kept_clicks(ads, threshold, points)
    return ad_minute_json(ad_minute_counts(kept, span_minutes, as_of_minute))


def daily_top3_kv(top3: DataFrame) -> DataFrame:
    """R7 in the published layout: one hash per date, a field per area."""
    return top3.select(F.concat(F.lit(TOP3_KEY_PREFIX), F.col("date")).alias("hash_key"),
                       F.col("area").alias("field"), F.col("top3_json").alias("value"))


def minute_trend_kv(trend: DataFrame) -> DataFrame:
    """R8 in the published layout: one hash, a field per ad."""
    return trend.select(F.lit(TREND_KEY).alias("hash_key"),
                        F.col("adid").alias("field"), F.col("minutes_json").alias("value"))


def daily_city_kv(counts: DataFrame) -> DataFrame:
    """P8 + K4 layout: R6 rows as (hash_key, field, value) for a keyed store."""
    return counts.select(F.concat(F.lit("date_area_city_ad_"), F.col("date")).alias("hash_key"),
                         kv_key("area", "city", "adid").alias("field"),
                         F.col("n").cast("string").alias("value"))
