"""Plan-shape checks: the properties that matter at scale stay in the plans."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL


def plan_of(spark, key):
    import __spark_entry__ as E
    df = E.queries()[key](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()      # final AQE plan
    return df._jdf.queryExecution().executedPlan().toString()


def events_read_schema(plan):
    return re.findall(r"events\.parquet.*?ReadSchema: (struct<[^>]*>)", plan)


def test_r1_pushes_date_bounds_and_prunes_columns(spark):
    p = plan_of(spark, "hot_category_top10")
    assert "GreaterThanOrEqual(ts,2024-01-05" in p and "LessThan(ts,2024-01-26" in p
    assert "TakeOrderedAndProject" in p and "partial_count" in p
    assert all("value" not in s for s in events_read_schema(p))


def test_r2_partial_group_limit_and_broadcast_top_list(spark):
    p = plan_of(spark, "hot_category_top_sessions")
    assert re.search(r"WindowGroupLimit .*row_number\(\), 10, Partial", p)
    assert "LeftSemi" in p


def test_r4_pre_aggregates_before_dimension_joins(spark):
    p = plan_of(spark, "area_product_top3")
    # the fact aggregate sits below (printed after) both broadcast joins
    join_at = p.index("BroadcastHashJoin")
    assert p.index("keys=[city_id", join_at) > join_at
    assert re.search(r"WindowGroupLimit .*rank\(.*\), 3, Partial", p)


def test_r5_joins_the_block_table_with_what_is_small_enough(spark):
    p = plan_of(spark, "blacklist_filter")
    assert "LeftOuter" in p and "ResolvedHint" not in p


LARGE = ["hot_category_top10", "hot_category_top_sessions", "blacklist_filter", "ad_minute_json",
         "session_transitions", "area_product_top3"]


def test_results_stay_right_when_nothing_may_be_broadcast(spark):
    # the plan of a large cluster: every join shuffles
    import oracle_compare
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        assert "BroadcastHashJoin" not in plan_of(spark, "hot_category_top10")
        res = oracle_compare.compare(spark, SF_SMALL, LARGE, verbose=False)
        assert set(res.values()) == {"OK"}, res
    finally:
        spark.conf.set(keys[0], old)
        spark.conf.unset(keys[1])


def test_a_tiny_file_of_many_rows_is_not_hinted(spark, tmp_path):
    # compressed bytes prove nothing about rows: no plan carries a broadcast hint
    from mallscope.operators.joins import click_star_join, drop_in, keep_in
    path = str(tmp_path / "many")
    spark.range(20_000_000).selectExpr("0L as city_id", "'c' city_name", "'a' area").coalesce(1).write.parquet(path)
    many = spark.read.parquet(path)
    facts = spark.createDataFrame([(0, 1)], "city_id long, click_product_id long")
    products = spark.createDataFrame([(1, "p")], "product_id long, product_name string")
    for df in (click_star_join(facts, many, products), keep_in(facts, "city_id", many), drop_in(facts, "city_id", many)):
        assert "Hint" not in df._jdf.queryExecution().analyzed().toString()
        assert "Aggregate" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_r3_runs_one_window(spark):
    from mallscope.plans import retail
    from mallscope.sources import fixtures as fx
    df = retail.page_jump_ratio(fx.actions(spark, SF_SMALL), "1,2,3", split_hot=False)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Window ") == 1


def test_r8_span_and_a4_pages_reach_the_scan(spark, tmp_path):
    from mallscope.operators.ads import ad_minute_counts
    from mallscope.operators.sequences import page_view_counts
    from mallscope.sources import fixtures as fx
    ads, acts = str(tmp_path / "ads"), str(tmp_path / "acts")
    fx.ads(spark, SF_SMALL).write.parquet(ads)
    fx.actions(spark, SF_SMALL).write.parquet(acts)
    df = ad_minute_counts(spark.read.parquet(ads), 3, as_of_minute=28_400_000)
    assert f"GreaterThanOrEqual(timestamp,{(28_400_000 - 2) * 60_000})" in \
        df._jdf.queryExecution().executedPlan().toString()
    newest = ad_minute_counts(spark.read.parquet(ads), 600)
    assert newest.count() > 0
    plan = page_view_counts(spark.read.parquet(acts), ["1", "07", "x", "3"])._jdf.queryExecution().executedPlan().toString()
    assert "In(page_id, [1,3])" in plan


def test_r4_builds_the_text_above_the_rank_limit(spark):
    p = plan_of(spark, "area_product_top3")
    # printed from the top: the share list is collected above the product ranking
    assert p.index("collect_list") < p.index("rank(")


def test_null_sessions_are_split_like_any_hot_one(spark):
    from mallscope.operators.sequences import session_chunks, session_transitions
    rows = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'named', null) session_id", "date_format(timestamp_seconds(id div 50), 'yyyy-MM-dd HH:mm:ss') action_time",
        "id event_id", "id % 7 page_id").cache()
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        split = session_transitions(rows, chunk=session_chunks(burst_rows=40), hot_rows=3)
        plain = session_transitions(rows)
        assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
        sizes = [r["count"] for r in split.filter("session_id is null").groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 1000, sizes           # of 2,000 rows without a session
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_reports_scan_the_fact_twice_for_r1_and_r2(spark):
    import os
    import uuid

    from mallscope.plans.reports import run_reports
    from mallscope.session import checkpoint_root
    from mallscope.sources import fixtures as fx
    path = os.path.join(checkpoint_root(spark), "fact-" + uuid.uuid4().hex[:8])
    fx.actions(spark, SF_SMALL).write.parquet(path)
    plans = []

    def writer(df, table):
        df.write.format("noop").mode("overwrite").save()
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    run_reports(spark.read.parquet(path), fx.users(spark, SF_SMALL), fx.cities(spark, SF_SMALL),
                fx.products(spark, SF_SMALL), fx.CONDITIONS, writer, which=("r1", "r2"))
    name = os.path.basename(path)
    # both read the counts that one pass over the fact has written
    assert name not in plans[0] and name not in plans[1]
    from mallscope.operators.actions import category_levels
    levels = category_levels(spark.read.parquet(path), fx.users(spark, SF_SMALL), fx.CONDITIONS)
    plan = levels._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2 and plan.count("Generate explode") == 1      # the fact and the users
    assert plan.index("Expand") < plan.index("Join")                               # doubles only what is left


def test_strict_schema_binding_fails_on_lossy_values(spark):
    import pytest
    from pyspark.sql import types as T

    from mallscope.sources.tables import conform
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    big = spark.createDataFrame([(1,), (2**40,), (None,)], "a long")
    with pytest.raises(Exception, match="column a"):
        conform(big, schema).collect()
    assert [r.a for r in conform(big, schema, on_misfit="null").collect()] == [1, None, None]
    with pytest.raises(Exception, match="column a"):
        conform(spark.createDataFrame([(1.5,)], "a double"), schema).collect()
    with pytest.raises(Exception, match="column a"):
        conform(spark.createDataFrame([("x",)], "a string"), schema).collect()
    assert [r.a for r in conform(spark.createDataFrame([("7",), (None,)], "a string"), schema).collect()] == [7, None]


def test_r3_normal_sessions_skip_the_chunked_path(spark):
    # registered with a low hot-session bound: both paths are planned
    p = plan_of(spark, "session_transitions")
    assert "LeftAnti" in p and "LeftSemi" in p
    # default bound, no hot session at this size: only the plain window
    p = plan_of(spark, "page_jump_ratio")
    assert "LeftAnti" not in p


def test_r1_on_a_date_partitioned_log_prunes_folders(spark):
    p = plan_of(spark, "hot_category_top10_partitioned")
    assert re.search(r"PartitionFilters: \[[^\]]*date[^\]]*2024-01-05", p)
