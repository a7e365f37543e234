"""C2 C7 live: running totals (R6) and top ads (R7) from Spark's state.

Each kept click counts on two levels, (date, area, city, ad) and (date, area,
ad), in one streaming aggregation. A batch gets the totals that it changed and
reads no older ones. Totals only grow, so an ad that the batch did not touch
cannot rise: a group's new top list is that of its old one and the touched
ads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.constants import TOP_ADS
from mallscope.operators.ads import top3_ads_by_area, top3_ads_json
from mallscope.sinks.published import latest_totals, publish, read_newest, read_published
from mallscope.streaming.blacklist import day_groups

R6_KEYS = ["date", "area", "city", "adid"]
TOP_SCHEMA = "date string, area string, adid string, n bigint"
#: One table for both results.
RESULT_SCHEMA = "result string, date string, area string, city string, adid string, n bigint"


def running_totals(kept: DataFrame, keep_days: int | None = None) -> DataFrame:
    """(date, level, area, city, adid, n) of a stream of kept clicks.

    ``level`` is ``city``, or ``area`` with no city. ``keep_days`` as for
    the counters: closed days leave the state, their results stay published.
    """
    timed, day, date = day_groups(kept, keep_days)
    levels = F.explode(F.array(F.struct(F.lit("city").alias("level"), F.col("city").alias("__c")),
                               F.struct(F.lit("area").alias("level"), F.lit(None).cast("string").alias("__c"))))
    # the watermark's column is passed on as it is
    named = [c for c in timed.columns if c not in ("city", "level")]
    leveled = timed.select(*named, levels.alias("__l")).select(*named, "__l.level", F.col("__l.__c").alias("city"))
    totals = leveled.groupBy(day, "level", "area", "city", "adid").agg(F.count(F.lit(1)).alias("n"))
    return totals.select(date.alias("date"), "level", "area", "city", "adid", "n")


def new_top(old: DataFrame, touched: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """The top ``n`` ads per (date, area) of totals that only grow, from
    the old top lists and the totals that changed: (date, area, adid, n, rn).

    ``old`` may hold totals that have grown since; of one ad the larger counts.
    """
    keys = ["date", "area", "adid"]
    both = old.select(*keys, "n").unionByName(touched.select(*keys, "n"))
    return top3_ads_by_area(latest_totals(both, keys), n)


def publish_totals(path: str, keep_days: int | None = None, n: int = TOP_ADS):
    """A ``foreachBatch`` function: R6 and R7 of a batch in one write.

    R6 gets the totals that changed. R7 gets the top lists of the open days
    (``keep_days``; all days without it), the batch's own and those of the
    batch before, which is all that the next batch needs of them. Both are
    logs of growing totals: a replay changes nothing.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        totals = batch.persist()
        try:
            area = totals.filter("level = 'area'").select("date", "area", "adid", "n")
            old = read_newest(spark, path, RESULT_SCHEMA, before=batch_id).filter("result = 'r7'")
            if keep_days is not None:
                newest = totals.agg(F.max("date")).first()[0]
                if newest:
                    old = old.filter(F.col("date") >= F.date_sub(F.lit(newest).cast("date"), keep_days).cast("string"))
            columns = ["date", "area", "city", "adid", "n"]
            rows = (totals.filter("level = 'city'").select(F.lit("r6").alias("result"), *columns)
                    .unionByName(new_top(old, area, n).select(F.lit("r7").alias("result"), "date", "area",
                                                              F.lit(None).cast("string").alias("city"), "adid", "n")))
            publish(rows.coalesce(1), path, batch_id)
        finally:
            totals.unpersist()
    return on_batch


def read_totals(spark, path: str) -> DataFrame:
    """(date, area, city, adid, n)."""
    rows = read_published(spark, path, RESULT_SCHEMA).filter("result = 'r6'")
    return latest_totals(rows, R6_KEYS)


def read_top(spark, path: str, n: int = TOP_ADS) -> DataFrame:
    """(date, area, top3_json)."""
    rows = read_published(spark, path, RESULT_SCHEMA).filter("result = 'r7'")
    return top3_ads_json(new_top(rows, rows.limit(0), n))
