"""

``entry(spark)`` runs the flagship result (R4, top products per area with
the city share text) on sf0.001. ``queries()`` registers every implemented
operator and result over the driver tables; ``oracle_sql()`` holds the
matching DuckDB SQL (same column names) for the correctness check.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

# importable however this file is loaded (by path or as a module)
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from mallscope.functions.adlog import parse_ad_log, render_ad_log  # noqa: E402
from mallscope.functions.scalars import with_task_id  # noqa: E402
from mallscope.functions.sql import register_sql  # noqa: E402
from mallscope.operators import actions as act  # noqa: E402
from mallscope.operators.ads import (ad_minute_counts, blacklist_filter,  # noqa: E402
                                     blacklist_points, date_area_ad_rollup,
                                     date_area_city_ad_count, top3_ads_by_area, top3_ads_json,
                                     trailing_minutes, user_ad_daily_counts)
from mallscope.operators.condition_sets import condition_set_counts, condition_set_top  # noqa: E402
from mallscope.operators.joins import click_star_join, drop_in, keep_in, materialize  # noqa: E402
from mallscope.operators.ranking import top_ranked  # noqa: E402
from mallscope.operators.sequences import (jump_ratio, page_flow_pairs, page_jump_counts,  # noqa: E402
                                           page_view_counts, session_chunks, session_transitions)
from mallscope.plans import adclicks, retail  # noqa: E402
from mallscope.plans.oracle_sql import BATCH_MS, SPAN, TASK  # noqa: E402
from mallscope.plans.oracle_sql import oracle_sql as _oracle_sql  # noqa: E402
from mallscope.plans.sql_text import area_product_top3_sql  # noqa: E402
from mallscope.session import checkpoint_root  # noqa: E402
from mallscope.sinks.published import publish, read_newest, read_upserted, upsert  # noqa: E402
from mallscope.sinks.tables import replace_table  # noqa: E402
from mallscope.sources import fixtures as fx  # noqa: E402
from mallscope.sources.streams import offset_ranges  # noqa: E402
from mallscope.sources.tables import conform, load_table  # noqa: E402
from mallscope.streaming import dashboard  # noqa: E402
from mallscope.streaming.queries import read_state  # noqa: E402

# the training-data operators are optional: without their folder (and the
# pipeline built on them) everything else here still works
try:
    from mallscope.llm.queries import llm_oracle_sql, llm_queries  # noqa: E402

    import corpus_pipeline  # noqa: E402
except ImportError:
    _LLM_QUERIES, _LLM_SQL = {}, {}
else:
    _LLM_QUERIES, _LLM_SQL = dict(llm_queries()), dict(llm_oracle_sql())
    _LLM_QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        _LLM_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

SF_SMOKE = "/root/testdata/sf0.001"
COND = fx.CONDITIONS
THRESHOLD = fx.TEST_THRESHOLD


def _ensure_utc(spark: SparkSession) -> None:
    # timestamp text must be UTC to agree with the oracle
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _filtered(spark, d):
    a = fx.actions(spark, d, COND["startDate"], COND["endDate"])
    return act.filter_actions(a, fx.users(spark, d), COND)


def _pivot(spark, d):
    return act.category_pivot(act.category_events(_filtered(spark, d)))


def _kept(spark, d):
    return blacklist_filter(fx.ads(spark, d), THRESHOLD)


def _r6(spark, d):
    return date_area_city_ad_count(_kept(spark, d))


def _area_counts(spark, d):
    return retail.area_click_counts(fx.actions(spark, d), fx.cities(spark, d), fx.products(spark, d))


def q_area_product_top3(spark, d):
    return retail.area_product_top3(fx.actions(spark, d), fx.cities(spark, d), fx.products(spark, d),
                                     task_id=TASK)


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    # sources
    q["load_table"] = lambda s, d: load_table(
        s, f"{d}/customer.parquet",
        T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                      T.StructField("c_nationkey", T.LongType())]))
    q["conform"] = lambda s, d: conform(
        fx.table(s, d, "events"),
        T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.IntegerType()),
                      T.StructField("event_type", T.StringType()), T.StructField("note", T.StringType())]),
        strict=False)
    # R1 / R2 building blocks
    q["filter_actions"] = _filtered
    q["classify_action"] = lambda s, d: act.classify_action(fx.actions(s, d)).select(
        "event_id", "kind", F.array_join("category_ids", ",").alias("category_list"))
    q["explode_ids"] = lambda s, d: act.explode_ids(fx.actions(s, d), "order_category_ids").select("event_id", "id")
    q["category_action_counts"] = lambda s, d: act.category_action_counts(_filtered(s, d))
    q["category_pivot"] = _pivot
    q["with_task_id"] = lambda s, d: with_task_id(_pivot(s, d), TASK)
    q["hot_category_top10"] = lambda s, d: retail.hot_category_top10(
        fx.actions(s, d, COND["startDate"], COND["endDate"]), fx.users(s, d), COND, task_id=TASK)
    q["category_session_counts"] = lambda s, d: act.category_session_counts(_filtered(s, d))
    q["hot_category_top_sessions"] = lambda s, d: retail.hot_category_top_sessions(
        fx.actions(s, d, COND["startDate"], COND["endDate"]), fx.users(s, d), COND, task_id=TASK)
    # the behaviour log as a date-partitioned table: P1's date bounds prune folders
    q["hot_category_top10_partitioned"] = lambda s, d: retail.hot_category_top10(
        _partitioned_actions(s, d), fx.users(s, d), COND, task_id=TASK)
    # R1 and R2 from one pass over the actions
    q["category_levels"] = lambda s, d: act.category_levels(
        fx.actions(s, d, COND["startDate"], COND["endDate"]), fx.users(s, d), COND)
    q["hot_category_top10_one_pass"] = lambda s, d: _hot_category_reports(s, d)[0]
    q["hot_category_top_sessions_one_pass"] = lambda s, d: _hot_category_reports(s, d)[1]
    # many conditions at once, one set for each supplier
    q["condition_set_counts"] = _condition_set_counts
    q["condition_set_top10"] = lambda s, d: condition_set_top(_condition_set_counts(s, d))
    q["keep_in"] = lambda s, d: keep_in(fx.actions(s, d), "page_id", [1, 2, 3]).select("event_id", "page_id")
    # R3
    # a low hot-session bound so the driver tables exercise both the plain and
    # the chunked path (sessions here hold a handful of actions)
    q["session_transitions"] = lambda s, d: session_transitions(
        fx.actions(s, d), chunk=session_chunks(burst_rows=1000), hot_rows=3)
    q["page_view_counts"] = lambda s, d: page_view_counts(
        fx.actions(s, d), sorted({a for a, _ in page_flow_pairs(COND["targetPageFlow"])}))
    q["page_jump_counts"] = lambda s, d: page_jump_counts(
        session_transitions(fx.actions(s, d), chunk=session_chunks()),
        page_flow_pairs(COND["targetPageFlow"]))
    q["jump_ratio"] = lambda s, d: jump_ratio(
        page_jump_counts(session_transitions(fx.actions(s, d)), page_flow_pairs(COND["targetPageFlow"])),
        page_view_counts(fx.actions(s, d), sorted({a for a, _ in page_flow_pairs(COND["targetPageFlow"])})))
    q["page_jump_ratio"] = lambda s, d: retail.page_jump_ratio(
        fx.actions(s, d), COND["targetPageFlow"], task_id=TASK)
    # R4
    q["click_star_join"] = lambda s, d: click_star_join(fx.actions(s, d), fx.cities(s, d), fx.products(s, d))
    q["area_product_counts"] = lambda s, d: _area_counts(s, d).groupBy("area", "product_name").agg(
        F.sum("n").cast("bigint").alias("product_count"))
    q["top_share_text"] = lambda s, d: retail.area_product_shares(
        fx.actions(s, d), fx.cities(s, d), fx.products(s, d))
    q["area_product_rank"] = lambda s, d: top_ranked(
        _area_counts(s, d).groupBy("area", "product_name").agg(F.sum("n").cast("bigint").alias("product_count")),
        ["area"], [F.desc("product_count")], 3, ties="rank")
    q["area_product_top3"] = q_area_product_top3
    # the same as SQL text, with the library's SQL functions
    q["area_product_top3_sql"] = _area_product_top3_sql
    q["sql_functions"] = _sql_functions
    # ad stream, batch forms
    q["render_ad_log"] = lambda s, d: render_ad_log(fx.ads(s, d), keep=["event_id"])
    q["parse_ad_log"] = lambda s, d: parse_ad_log(fx.ad_lines(s, d), keep=["event_id"])
    q["offset_ranges"] = lambda s, d: offset_ranges(fx.kafka_rows(s, d))
    q["user_ad_daily_counts"] = lambda s, d: user_ad_daily_counts(fx.ads(s, d))
    q["blacklist_users"] = lambda s, d: adclicks.blacklist_users(fx.ads(s, d), THRESHOLD)
    q["blacklist_filter"] = _kept
    # micro-batch semantics: clicks grouped into the stream's 3-second batches
    q["blacklist_filter_micro_batch"] = lambda s, d: blacklist_filter(
        fx.ads(s, d).withColumn("batch", F.floor(F.col("timestamp") / 3000)), THRESHOLD,
        batch_col="batch").drop("batch")
    q["drop_in"] = lambda s, d: drop_in(fx.ads(s, d), "userid", blacklist_points(fx.ads(s, d), THRESHOLD))
    q["date_area_city_ad_count"] = _r6
    q["kv_key"] = lambda s, d: adclicks.daily_city_kv(_r6(s, d))
    q["date_area_ad_rollup"] = lambda s, d: date_area_ad_rollup(_r6(s, d))
    q["top3_ads_by_area"] = lambda s, d: top3_ads_by_area(date_area_ad_rollup(_r6(s, d)))
    q["top3_ads_json"] = lambda s, d: adclicks.daily_top3_ads(fx.ads(s, d), THRESHOLD)
    q["ad_minute_counts"] = lambda s, d: ad_minute_counts(blacklist_filter(
        fx.ads(s, d), THRESHOLD, materialize(blacklist_points(fx.ads(s, d), THRESHOLD))), SPAN)
    q["ad_minute_json"] = lambda s, d: adclicks.minute_trend(fx.ads(s, d), THRESHOLD, SPAN)
    # published layouts of the live results
    q["top3_ads_kv"] = lambda s, d: adclicks.daily_top3_kv(adclicks.daily_top3_ads(fx.ads(s, d), THRESHOLD))
    q["ad_minute_kv"] = lambda s, d: adclicks.minute_trend_kv(adclicks.minute_trend(fx.ads(s, d), THRESHOLD, SPAN))
    # streaming twins: the dashboard fed with time slices of the clicks,
    # results read back as published (same oracle as the batch forms)
    q["stream_blacklist_filter"] = lambda s, d: _shared_stream(s, d)["kept"]
    q["stream_blacklist_users"] = lambda s, d: _shared_stream(s, d)["blocked"]
    q["stream_date_area_city_ad_count"] = lambda s, d: _shared_stream(s, d)["r6"]
    q["stream_top3_ads_json"] = lambda s, d: _shared_stream(s, d)["r7"]
    q["stream_ad_minute_counts"] = lambda s, d: trailing_minutes(_shared_stream(s, d)["minutes"], SPAN)
    q["stream_ad_minute_json"] = lambda s, d: _shared_stream(s, d)["r8"]
    q["stream_user_ad_daily_counts"] = lambda s, d: _shared_stream(s, d)["counters"]
    q["checkpoint_restart"] = lambda s, d: _shared_stream(s, d, restart_after=1, keep_days=1)["kept"]
    # bounded state: closed days leave the state, not the results
    q["stream_bounded_state"] = lambda s, d: _shared_stream(s, d, restart_after=1, keep_days=1)["r6"]
    # the running totals as Spark's state holds them after a stop and a restart
    q["stream_state_totals"] = _state_totals
    # lines that are no clicks get an output of their own
    q["stream_rejects"] = lambda s, d: _stream(s, d, render=fx.ad_lines_with_rejects)["rejects"]
    # the block set is read at batch start; batches are spans of eight days
    q["stream_blacklist_micro_batch"] = lambda s, d: _stream(
        s, d, micro_batch=True, bounds=_span_bounds(s, d))["kept"]
    q["stream_offset_ranges"] = _stream_offsets
    # sinks: write, read back
    q["upsert_kv"] = _sink_upsert
    q["replace_kv"] = _sink_replace
    q["replace_table"] = _sink_table
    return q


def _hot_category_reports(spark, d):
    return retail.hot_category_reports(fx.actions(spark, d, COND["startDate"], COND["endDate"]),
                                       fx.users(spark, d), COND, task_id=TASK)


def _condition_set_counts(spark, d):
    return condition_set_counts(fx.actions(spark, d), fx.users(spark, d), fx.condition_sets(spark, d))


def _area_product_top3_sql(spark, d):
    for name, df in (("user_visit_action", fx.actions(spark, d)), ("city_info", fx.cities(spark, d)),
                     ("product_info", fx.products(spark, d))):
        df.createOrReplaceTempView(name)
    return area_product_top3_sql(spark, TASK)


def _sql_functions(spark, d):
    register_sql(spark)
    return spark.sql("""
        SELECT epoch_ms_to_date(timestamp) AS date, minute_to_hhmm(timestamp div 60000) AS hhmm, adid, event_id,
               percent_tenth(event_id, event_id + 7) AS share, half_up_tenth(event_id / 7D) AS tenth,
               size(split_ids(concat_ws(',', adid, '', userid))) AS n_ids
        FROM {ads}""", ads=fx.ads(spark, d))


def _stream(spark, d, restart_after=None, **options):
    root = dashboard.replay(spark, fx.ads(spark, d), THRESHOLD, SPAN, restart_after=restart_after,
                            state_partitions=_state_parts(spark), **options)
    return dashboard.read_results(spark, root, SPAN)


def _state_parts(spark):
    # the state has a part for each core, so that all of them work on a batch
    return max(4, spark.sparkContext.defaultParallelism)


def _span_bounds(spark, d):
    first, last = fx.ads(spark, d).agg(F.min("timestamp"), F.max("timestamp")).first()
    return [k * BATCH_MS for k in range(first // BATCH_MS + 1, last // BATCH_MS + 1)]


def _shared_root(spark, d, **options):
    # the twins read different results of one replay; kept per session, input and options
    key = (spark.sparkContext.applicationId, d, *sorted(options.items()))
    if key not in _REPLAYS:
        _REPLAYS[key] = dashboard.replay(spark, fx.ads(spark, d), THRESHOLD, SPAN,
                                         state_partitions=_state_parts(spark), **options)
    return _REPLAYS[key]


def _shared_stream(spark, d, **options):
    return dashboard.read_results(spark, _shared_root(spark, d, **options), SPAN)


def _state_totals(spark, d):
    # R6 as the state of the totals query holds it, after a restart
    root = _shared_root(spark, d, restart_after=1, keep_days=None)
    state = read_state(spark, dashboard.paths(root)["ck_totals"])
    return state.filter("level = 'city'").select("date", "area", "city", "adid", F.col("count").alias("n"))


_REPLAYS: dict = {}


def _stream_offsets(spark, d):
    # Kafka-shaped rows arrive in three offset slices; each micro-batch's
    # ranges are recorded by foreachBatch, then folded per partition
    from mallscope.sources.streams import KAFKA_ROW_SCHEMA, read_offsets, record_offsets
    from mallscope.streaming.queries import start_query
    root = _scratch(spark, "offsets")
    rows = fx.kafka_rows(spark, d)
    bounds = rows.approxQuantile("offset", [1 / 3, 2 / 3], 0.001)
    edges = [None, *bounds, None]
    for i in range(3):
        part = rows
        if edges[i] is not None:
            part = part.filter(F.col("offset") >= int(edges[i]))
        if edges[i + 1] is not None:
            part = part.filter(F.col("offset") < int(edges[i + 1]))
        part.write.mode("append").parquet(root + "/src")
        src = spark.readStream.schema(KAFKA_ROW_SCHEMA).parquet(root + "/src")
        qy = start_query(src, root + "/ck", on_batch=record_offsets(root + "/ranges"),
                         trigger={"availableNow": True})
        qy.awaitTermination()
    return (read_offsets(spark, root + "/ranges").groupBy("topic", "partition")
            .agg(F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset"),
                 F.sum("n").alias("n")))


def _scratch(spark, name):
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def _sink_upsert(spark, d):
    # two overlapping upserts: batch 0 writes every key with value 0, batch 1
    # the real totals; the store must hold the latest value per key
    root = _scratch(spark, "kv")
    kv = materialize(adclicks.daily_city_kv(_r6(spark, d)))
    at = {"keys": ["hash_key", "field"], "partition_by": ["hash_key"]}
    upsert(kv.withColumn("value", F.lit("0")), root, 0, **at)
    upsert(kv, root, 1, **at)
    upsert(kv, root, 1, **at)                                 # a replayed batch changes nothing
    upsert(kv.withColumn("value", F.lit("-1")), root, 0, **at)   # nor does an older one
    return read_upserted(spark, root, kv.schema)


def _sink_replace(spark, d):
    root = _scratch(spark, "replace")
    r7 = top3_ads_json(top3_ads_by_area(date_area_ad_rollup(_r6(spark, d))))
    publish(r7.limit(1), root, 0)             # an older version, fully replaced
    publish(r7, root, 1)
    return read_newest(spark, root, r7.schema)


def _partitioned_actions(spark, d):
    name = "mallscope_uva_" + uuid.uuid4().hex[:8]
    replace_table(fx.actions(spark, d), name, path=_scratch(spark, "uva"), partition_by=["date"])
    return spark.table(name)


def _sink_table(spark, d):
    name = "mallscope_r6_" + uuid.uuid4().hex[:8]
    replace_table(_r6(spark, d), name, path=_scratch(spark, "table"), partition_by=["date"])
    return spark.table(name).select("date", "area", "city", "adid", "n")


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _ensure_utc(spark)
        return fn(spark, sf_dir)
    return run


def entry(spark: SparkSession) -> DataFrame:
    _ensure_utc(spark)
    return q_area_product_top3(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _wrap(v) for k, v in (_queries() | _LLM_QUERIES).items()}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per key of ``queries()`` (same column names)."""
    return _oracle_sql() | _LLM_SQL
