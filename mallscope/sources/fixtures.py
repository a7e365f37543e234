"""The logical tables of the retail model, derived from the driver tables.

``events``, ``customer``, ``part``, ``nation`` and ``region`` are reshaped
into ``user_visit_action`` (fact), ``user_info``, ``product_info``,
``city_info`` and the ``ads_log`` click stream. Everything stays lazy; each
builder reads only the columns it needs, so the Parquet scans are pruned.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mallscope.functions.scalars import ntz_epoch_ms

# Parameters of the test model: the job conditions used by the batch
# results and the blacklist threshold used at sf0.01 (the default threshold
# of 50 clicks never fires on these tables).
CONDITIONS_TEXT = ('{startDate:"2024-01-05", endDate:"2024-01-25", startAge:"20", '
                   'endAge:"50", professionals:"", city:"", gender:"", keywords:"", '
                   'categoryIds:"", targetPageFlow:"1,2,3,4,5,6,7"}')
CONDITIONS = {"startDate": "2024-01-05", "endDate": "2024-01-25",
              "startAge": "20", "endAge": "50", "targetPageFlow": "1,2,3,4,5,6,7"}
TEST_THRESHOLD = 3
CITY_MODULUS = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a lazy relation."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """city_info: one city per nation, its area is the nation's region."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    # both sides are dimensions; Spark's size estimate picks the join
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (n.join(r, n["n_regionkey"] == r["r_regionkey"])
             .select(F.col("n_nationkey").cast("bigint").alias("city_id"),
                     F.col("n_name").alias("city_name"),
                     F.regexp_replace("r_name", " ", "_").alias("area")))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_info from customer."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    k = F.col("c_custkey")
    return c.select(
        k.alias("user_id"),
        F.concat(F.lit("user_"), k.cast("string")).alias("username"),
        F.col("c_name").alias("name"),
        (F.lit(10) + k % 50).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.when(k % 2 == 0, "M").otherwise("F").alias("gender"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_info from part (many ids share one name)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("extend_info"))


def _day_bounds(date_from: str | None, date_to: str | None):
    """Inclusive ``yyyy-MM-dd`` bounds -> half-open timestamp bounds."""
    lo = hi = None
    if date_from:
        lo = _dt.datetime.strptime(date_from, "%Y-%m-%d")
    if date_to:
        hi = _dt.datetime.strptime(date_to, "%Y-%m-%d") + _dt.timedelta(days=1)
    return lo, hi


def actions(spark: SparkSession, sf_dir: str, date_from: str | None = None,
            date_to: str | None = None) -> DataFrame:
    """user_visit_action from events.

    ``date_from`` / ``date_to`` (inclusive days) become timestamp bounds on
    the raw ``ts`` column so they reach the Parquet reader as pushed filters
    (the role date-partition pruning plays for a partitioned fact table).
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    lo, hi = _day_bounds(date_from, date_to)
    if lo is not None:
        e = e.filter(F.col("ts") >= F.lit(lo.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"))
    if hi is not None:
        e = e.filter(F.col("ts") < F.lit(hi.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"))
    k = F.get_json_object("props", "$.k").cast("bigint")
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    e = e.select("event_id", "user_id", "event_type", k.alias("k"), at.alias("at"))
    e = e.withColumn("d", F.substring("at", 1, 10))     # the day is a prefix of the time text
    et, k, eid = F.col("event_type"), F.col("k"), F.col("event_id")
    is_click = et.isin("click", "view")
    s = lambda c: c.cast("string")
    return e.select(
        F.col("d").alias("date"),
        F.col("user_id"),
        F.concat(s(F.col("user_id")), F.lit("_"), F.col("d")).alias("session_id"),
        (k % 10 + 1).alias("page_id"),
        F.col("at").alias("action_time"),
        F.when(et == "error", F.concat(F.lit("kw"), s(k % 6))).alias("search_keyword"),
        F.when(is_click, k % 20 + 1).otherwise(F.lit(-1)).cast("bigint").alias("click_category_id"),
        F.when(is_click, eid % 40).otherwise(F.lit(-1)).cast("bigint").alias("click_product_id"),
        F.when(et == "purchase", F.concat_ws(",", s(k % 20 + 1),
               F.when(eid % 2 == 0, s((k + 7) % 20 + 1)))).alias("order_category_ids"),
        F.when(et == "purchase", F.concat_ws(",", s(k % 40), s((k + 1) % 40))).alias("order_product_ids"),
        F.when(et == "signup", F.concat_ws(",", s(k % 20 + 1),
               F.when(eid % 3 == 0, s((k + 3) % 20 + 1)))).alias("pay_category_ids"),
        F.when(et == "signup", F.concat_ws(",", s(k % 40), s((k + 2) % 40))).alias("pay_product_ids"),
        (F.col("user_id") % CITY_MODULUS).alias("city_id"),
        eid.alias("event_id"))


def condition_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job conditions as texts, one of each supplier; some bounds are empty or left out."""
    k = F.col("s_suppkey")
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    day = lambda n: F.concat(F.lit("2024-01-"), F.lpad(n.cast("string"), 2, "0"))
    parts = [F.concat(F.lit("startDate:"), text(F.when(k % 7 == 0, "").otherwise(day(1 + k % 20)))),
             F.when(k % 5 != 0, F.concat(F.lit("endDate:"), text(day(5 + k % 25)))),
             F.concat(F.lit("startAge:"), text(F.when(k % 3 == 0, "").otherwise((10 + k % 30).cast("string")))),
             F.when(k % 4 != 0, F.concat(F.lit("endAge:"), text((20 + k % 40).cast("string"))))]
    return table(spark, sf_dir, "supplier").select(
        k.alias("set_id"), F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")).alias("params"))


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ads_log click stream: (timestamp ms, area, city, userid, adid, event_id)."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    c = cities(spark, sf_dir)
    return (e.join(c, (e["user_id"] % CITY_MODULUS) == c["city_id"])
             .select(ntz_epoch_ms("ts").alias("timestamp"),
                     F.col("area"), F.col("city_name").alias("city"),
                     F.col("user_id").cast("string").alias("userid"),
                     (F.get_json_object("props", "$.k").cast("bigint") % 6 + 1)
                     .cast("string").alias("adid"),
                     F.col("event_id")))


def ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click stream as the space-separated text lines a producer sends."""
    from mallscope.functions.adlog import render_ad_log
    return render_ad_log(ads(spark, sf_dir), keep=["event_id"])


def ad_lines_with_rejects(ads_: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The lines of clicks with some spoilt: event ids divisible by 97 lose
    what follows the city, those divisible by 101 their time."""
    from mallscope.functions.adlog import render_ad_log
    lines = render_ad_log(ads_, keep=["event_id"])
    eid, line = F.col("event_id"), F.col("line")
    spoilt = (F.when(eid % 97 == 0, F.concat_ws(" ", F.slice(F.split(line, " "), 1, 3)))
              .when(eid % 101 == 0, F.concat(F.lit("time"), line)).otherwise(line))
    return lines.select(spoilt.alias("line"), "event_id")


def kafka_rows(spark: SparkSession, sf_dir: str, topic: str = "ads_log",
               partitions: int = 3) -> DataFrame:
    """The lines as Kafka source rows (topic, partition, offset, value)."""
    lines = ad_lines(spark, sf_dir)
    return lines.select(F.lit(topic).alias("topic"),
                        (F.col("event_id") % partitions).cast("int").alias("partition"),
                        F.floor(F.col("event_id") / partitions).cast("bigint").alias("offset"),
                        F.col("line").alias("value"))
