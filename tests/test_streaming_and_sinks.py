import os
import uuid

import pytest
from pyspark.sql import functions as F

from mallscope.functions.adlog import render_ad_log
from mallscope.operators import ads as A
from mallscope.session import checkpoint_root
from mallscope.sinks.published import (batches_of, compact_totals, latest_totals, publish, read_newest,
                                       read_published, read_upserted, retire, upsert)
from mallscope.sinks.tables import jdbc_options
from mallscope.sources import fixtures as fx
from mallscope.sources.files import list_dirs, publish_folder
from mallscope.sources.streams import read_ad_stream
from mallscope.streaming import dashboard as D
from mallscope.streaming import totals as TT
from mallscope.streaming.queries import read_state, state_info

from conftest import SF_SMALL


def same(a, b):
    cols = sorted(b.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def new_root(spark, name):
    return os.path.join(checkpoint_root(spark), f"t-{name}-" + uuid.uuid4().hex[:8])


def test_stream_equals_batch_with_restart(spark):
    ads = fx.ads(spark, SF_SMALL)
    root = D.replay(spark, ads, threshold=2, span_minutes=600, slices=3, restart_after=0)
    res = D.read_results(spark, root, 600)
    kept = A.blacklist_filter(ads, 2)
    r6 = A.date_area_city_ad_count(kept)
    assert same(res["kept"], kept)
    assert same(res["r6"], r6)
    assert same(res["r7"], A.top3_ads_json(A.top3_ads_by_area(A.date_area_ad_rollup(r6))))
    assert same(res["r8"], A.ad_minute_json(A.ad_minute_counts(kept, 600)))
    assert same(res["blocked"], A.blacklist_points(ads, 2))
    assert same(res["counters"], A.user_ad_daily_counts(kept))
    a = res["audit"].collect()
    assert sum(r.lines for r in a) == ads.count() == sum(r.kept + r.blocked + r.rejected + r.late for r in a)
    # what Spark's state holds after the restart is the batch result
    p = D.paths(root)
    state = read_state(spark, p["ck_totals"]).filter("level = 'city'")
    assert same(state.select("date", "area", "city", "adid", F.col("count").alias("n")), r6)
    state = read_state(spark, p["ck_blacklist"])
    assert same(state.select("date", "userid", "adid", F.col("count").alias("n")), A.user_ad_daily_counts(ads))
    info = state_info(spark, p["ck_trend"]).first()
    assert info.operatorName == "stateStoreSave" and info.numPartitions == 4


def test_state_mid_stream_equals_the_batch_so_far(spark):
    ads = fx.ads(spark, SF_SMALL)
    cut = ads.approxQuantile("timestamp", [0.5], 0.0)[0]
    first = ads.filter(F.col("timestamp") < int(cut))
    root = D.replay(spark, first, threshold=50, span_minutes=60, slices=1)
    p = D.paths(root)
    held = lambda: read_state(spark, p["ck_blacklist"]).select("date", "userid", "adid", F.col("count").alias("n"))
    assert same(held(), A.user_ad_daily_counts(first))
    # the rest arrives after a stop; state and results go on from there
    src = p["src"]
    rest = ads.filter(F.col("timestamp") >= int(cut))
    render_ad_log(rest, keep=["event_id"]).write.parquet(root + "/more")
    publish_folder(spark, root + "/more", src + "/slice=1")
    lines = read_ad_stream(spark, "parquet", path=src, options={"basePath": src})
    D.run_ad_dashboard(spark, root, lines, 50, 60, {"availableNow": True}, state_partitions=4).await_termination(300)
    assert same(held(), A.user_ad_daily_counts(ads))
    assert same(D.read_results(spark, root)["r6"], A.date_area_city_ad_count(ads))


def frame(spark, *rows, schema="d string, k string, n long"):
    return spark.createDataFrame(list(rows), schema)


def test_totals_survive_replays_and_compaction(spark):
    root, schema = new_root(spark, "log"), "d string, k string, n long"
    batches = [[("x", "a", 1), ("y", "b", 2)], [("x", "a", 3)], [("x", "c", 1), ("y", "b", 5)]]
    for i in (0, 1, 1, 2, 0):                     # batches that come again change nothing
        publish(frame(spark, *batches[i]), root, i)
    now = lambda: sorted(tuple(r) for r in latest_totals(read_published(spark, root, schema), ["d", "k"]).collect())
    want = [("x", "a", 3), ("x", "c", 1), ("y", "b", 5)]
    assert now() == want and batches_of(spark, root) == [0, 1, 2]
    compact_totals(spark, root, schema, ["d", "k"], 1)
    assert now() == want and batches_of(spark, root) == [1, 2]
    publish(frame(spark, ("x", "a", 9)), root, 3)
    assert now() == [("x", "a", 9), *want[1:]]


def test_upsert_keeps_the_newest_row_of_a_key(spark):
    root, schema = new_root(spark, "up"), "d string, k string, n long"
    at = {"keys": ["d", "k"], "partition_by": ["d"]}
    assert read_upserted(spark, root, schema).count() == 0
    upsert(frame(spark, ("x", "a", 1), ("x", "b", 1), ("y", "a", 1), (None, "a", 1)), root, 0, **at)
    files = lambda d: sorted(f.path for f in spark.read.format("binaryFile").load(f"{root}/{d}").select("path").collect())
    untouched = files("d=y")
    for batch, rows in ((2, [("x", "b", 7), (None, "a", 8)]), (2, [("x", "b", 7), (None, "a", 8)]), (1, [("x", "b", 99), ("x", "c", 4)])):
        upsert(frame(spark, *rows), root, batch, **at)
    got = sorted((tuple(r) for r in read_upserted(spark, root, schema).collect()), key=str)
    assert got == sorted([("x", "a", 1), ("x", "b", 7), ("x", "c", 4), ("y", "a", 1), (None, "a", 8)], key=str)
    assert files("d=y") == untouched                # only touched partitions are rewritten


def test_newest_batch_is_current_and_readers_survive(spark):
    root, schema = new_root(spark, "new"), "k string, n long"
    assert read_newest(spark, root, schema).count() == 0
    publish(frame(spark, ("old", 1), schema=schema), root, 0)
    reader = read_newest(spark, root, schema)
    for b in range(1, 4):
        publish(frame(spark, ("new", b), schema=schema), root, b)
    assert [tuple(r) for r in reader.collect()] == [("old", 1)]
    assert [tuple(r) for r in read_newest(spark, root, schema).collect()] == [("new", 3)]
    assert [tuple(r) for r in read_newest(spark, root, schema, before=3).collect()] == [("new", 2)]
    retire(spark, root, 3, keep=1)
    assert batches_of(spark, root) == [2, 3]


def test_a_new_checkpoint_on_old_results_is_refused(spark):
    root = new_root(spark, "run")
    publish(spark.range(1).selectExpr("id as lines"), D.paths(root)["gate"], 0)
    with pytest.raises(ValueError, match="new root"):
        D.run_ad_dashboard(spark, root, spark.range(1))


def test_jdbc_options_mapping():
    o = jdbc_options("jdbc:mysql://h/db", "area_count_info", user="u", password="p", batchsize=500)
    assert o["dbtable"] == "area_count_info" and o["batchsize"] == "500"
    assert o["isolationLevel"] == "READ_COMMITTED"


def test_minute_span_rejects_a_day(spark):
    with pytest.raises(ValueError):
        A.ad_minute_counts(fx.ads(spark, SF_SMALL), 24 * 60)


SCHEMA = "timestamp long, area string, city string, userid string, adid string, event_id long"


def feed(spark, root, batches, raw=False, before=None, **options):
    """Batches of clicks (``raw``: lines), one by one through the dashboard."""
    src, live = D.paths(root)["src"], None
    try:
        for i, rows in enumerate(batches):
            df = (spark.createDataFrame(rows, "line string, event_id long") if raw
                  else render_ad_log(spark.createDataFrame(rows, SCHEMA), keep=["event_id"]))
            df.coalesce(1).write.parquet(f"{root}/in{i}")
            publish_folder(spark, f"{root}/in{i}", f"{src}/slice={i}")
            if before:
                before(i)
            if live is None:
                lines = read_ad_stream(spark, "parquet", path=src, options={"basePath": src})
                live = D.run_ad_dashboard(spark, root, lines, trigger={"processingTime": "0 seconds"},
                                          state_partitions=2, **options)
            live.drain()
        assert live.active and live.exception() is None
        progress = {n: q.recentProgress for n, q in live.queries.items()}
    finally:
        if live is not None:
            live.stop()
    return D.read_results(spark, root, options.get("span_minutes", 60)), progress


def test_late_clicks_count_in_their_minute_and_day(spark):
    m = 60_000
    t0 = 1_704_067_200_000 + 100 * m
    res, _ = feed(spark, new_root(spark, "late"),
                  [[(t0, "A", "c", "u1", "1", 1), (t0 + 30 * m, "A", "c", "u2", "1", 2)],
                   [(t0 + 25 * m, "A", "c", "u3", "1", 3)],
                   [(t0 + 1 * m, "A", "c", "u4", "1", 4)]], threshold=50, span_minutes=120)
    assert {(r.minute - t0 // m, r.n) for r in res["minutes"].collect()} == {(0, 1), (30, 1), (25, 1), (1, 1)}
    assert res["kept"].count() == 4 and [r.n for r in res["r6"].collect()] == [4]


def test_minutes_out_of_the_span_leave_the_state_and_late_ones_are_counted(spark):
    m = 60_000
    t0 = 1_704_067_200_000
    root = new_root(spark, "span")
    batches = [[(t0 + i * m, "A", "c", f"u{i}", str(i % 2), i)] for i in (0, 6, 12, 24)]
    batches += [[(t0 + 1 * m, "A", "c", "late", "1", 900)], [(t0 + 27 * m, "A", "c", "z", "1", 901)]]
    res, progress = feed(spark, root, batches, threshold=50, span_minutes=10)
    assert {r.minute - t0 // m for r in res["minutes"].collect()} == {24, 27}
    states = [p["stateOperators"][0] for p in progress["trend"] if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in states) == 1          # the late click, in the metrics
    assert sum(s["numRowsRemoved"] for s in states) == 3                     # minutes 0, 6 and 12 have left
    assert read_state(spark, D.paths(root)["ck_trend"]).count() == 2
    assert res["r6"].agg(F.sum("n")).first()[0] == len(batches)              # it still counts in its day


def test_clicks_of_closed_days_are_kept_apart_and_leave_the_state(spark):
    h, d0 = 3_600_000, 1_704_067_200_000               # 2024-01-01 00:00 UTC
    root = new_root(spark, "closed")
    res, _ = feed(spark, root,
                  [[(d0 + 10 * h, "A", "c", "q", "1", 1), (d0 + 11 * h, "A", "c", "p", "1", 2)],
                   [(d0 + 50 * h, "A", "c", "p", "1", 3)],          # day 3: day 1 closes
                   [(d0 + 12 * h, "A", "c", "q", "1", 4), (d0 + 26 * h, "A", "c", "q", "1", 5)]],
                  threshold=3, span_minutes=60, keep_days=1)
    assert sorted(r.event_id for r in res["kept"].collect()) == [1, 2, 3, 5]
    assert [r.event_id for r in res["late"].collect()] == [4]
    assert {(r.date, r.n) for r in res["r6"].collect()} == {("2024-01-01", 2), ("2024-01-03", 1), ("2024-01-02", 1)}
    assert sum(r.lines - r.kept - r.blocked - r.rejected - r.late for r in res["audit"].collect()) == 0
    assert sum(r.late for r in res["audit"].collect()) == 1
    for name in ("ck_blacklist", "ck_totals"):
        days = read_state(spark, D.paths(root)[name]).select(F.to_date(F.col("window.start")).cast("string").alias("day"))
        assert {r.day for r in days.collect()} == {"2024-01-02", "2024-01-03"}, name


def test_bad_lines_go_to_the_rejects(spark):
    rows = [("1704067200000 A c u 1", 1), ("x A c u 1", 2), ("1704067200000 A", 3), ("", 4), (None, 5)]
    res, _ = feed(spark, new_root(spark, "bad"), [rows], raw=True, threshold=2)
    assert sorted((r.event_id, r.line) for r in res["rejects"].collect() if r.line is not None) == [
        (2, "x A c u 1"), (3, "1704067200000 A"), (4, "")]
    assert sorted(r.event_id for r in res["rejects"].collect()) == [2, 3, 4, 5]
    a = res["audit"].collect()[0]
    assert (a.lines, a.kept, a.rejected, a.late, a.blocked) == (5, 1, 4, 0, 0)


def test_a_replayed_batch_changes_nothing(spark):
    # the steps of a batch run twice, as after a crash between them and the commit
    m, t0 = 60_000, 1_704_067_200_000
    batches = [[(t0 + i * m, "A", "c", "u" if i % 2 else f"v{i}", "1", i) for i in range(k, k + 4)] for k in (0, 4)]
    plain, _ = feed(spark, new_root(spark, "once"), batches, threshold=3, span_minutes=30, micro_batch=False)
    twice = lambda f: lambda batch, i: (f(batch, i), f(batch, i))
    real = (D.blacklist_batch, D.tt.publish_totals, D.tr.publish_trend)
    try:
        D.blacklist_batch = lambda *a, **k: twice(real[0](*a, **k))
        D.tt.publish_totals = lambda *a, **k: twice(real[1](*a, **k))
        D.tr.publish_trend = lambda *a, **k: twice(real[2](*a, **k))
        again, _ = feed(spark, new_root(spark, "twice"), batches, threshold=3, span_minutes=30, micro_batch=False)
    finally:
        D.blacklist_batch, D.tt.publish_totals, D.tr.publish_trend = real
    for name in ("kept", "blocked", "counters", "r6", "r7", "minutes", "r8"):
        assert same(plain[name], again[name]), name
    counts = ["lines", "kept", "blocked", "rejected", "late"]
    assert same(plain["audit"].select(*counts), again["audit"].select(*counts))
    assert plain["blocked"].count() == 1


def test_a_user_denied_between_batches_is_dropped_from_the_next_one_on(spark):
    m, t0 = 60_000, 1_704_067_200_000
    root = new_root(spark, "deny")
    denied = root + "/denied"
    batches = [[(t0 + i * m, "A", "c", u, "1", 10 * i + j) for j, u in enumerate(("u", "v"))] for i in range(3)]
    snapshots = {0: [("nobody",)], 1: [("nobody",), ("v",)], 2: [("u",)]}

    def before(i):
        if i in snapshots:
            publish(spark.createDataFrame(snapshots[i], "userid string"), denied, i)
    res, _ = feed(spark, root, batches, before=before, threshold=50, denied=denied)
    assert sorted(r.event_id for r in res["kept"].collect()) == [0, 1, 10, 21]
    assert sum(r.blocked for r in res["audit"].collect()) == 2


def test_new_top_of_growing_totals_equals_the_ranking_over_all(spark):
    import random
    rnd = random.Random(3)
    totals, top = {}, spark.createDataFrame([], TT.TOP_SCHEMA)
    for _ in range(6):
        touched = {}
        for _ in range(40):
            k = (f"d{rnd.randint(0, 1)}", rnd.choice("AB"), str(rnd.randint(0, 9)))
            totals[k] = touched[k] = totals.get(k, 0) + rnd.randint(1, 3)
        rows = lambda m: spark.createDataFrame([(*k, n) for k, n in m.items()], TT.TOP_SCHEMA)
        top = TT.new_top(top, rows(touched))
        assert same(top, A.top3_ads_by_area(rows(totals)))
        top = spark.createDataFrame(top.collect(), top.schema)


def test_a_batch_of_the_totals_reads_no_older_total_and_is_one_write(spark):
    import inspect
    m, t0 = 60_000, 1_704_067_200_000
    root = new_root(spark, "one")
    batches = [[(t0 + i * m, "A", "c", f"u{i}", str(i % 5), i)] for i in range(2)]
    res, _ = feed(spark, root, batches, threshold=50, span_minutes=60)
    written = read_published(spark, D.paths(root)["results"], TT.RESULT_SCHEMA)
    # The changed total of each batch and nothing else
    assert [r["count"] for r in written.filter("result = 'r6'").groupBy("batch").count().collect()] == [1] * 2
    assert inspect.getsource(TT.publish_totals).count("publish(") == 1 and res["r6"].count() == 2


def test_dashboard_advances_on_a_live_source(spark):
    import time
    root, t0 = new_root(spark, "live"), 1_704_067_200_000
    src = root + "/in"

    def publish(i):
        df = spark.createDataFrame([(t0 + i * 60_000, "A", "c", f"u{i}", "1", i)], SCHEMA)
        render_ad_log(df, keep=["event_id"]).coalesce(1).write.parquet(f"{root}/staging{i}")
        publish_folder(spark, f"{root}/staging{i}", f"{src}/slice={i}")

    publish(0)
    lines = read_ad_stream(spark, "parquet", path=src, options={"basePath": src})
    q = D.run_ad_dashboard(spark, root, lines, threshold=50, span_minutes=60, state_partitions=2)       # 3 s trigger
    try:
        seen, i, end = [], 0, time.time() + 150
        while time.time() < end and len(set(seen)) < 4:
            i += 1
            publish(i)                              # data keeps arriving
            time.sleep(2)
            if row := D.read_results(spark, root)["r6"].agg(F.sum("n")).first()[0]:
                seen.append(row)
        assert len(set(seen)) >= 3 and seen == sorted(seen), seen
        assert q.exception() is None, q.exception()
        assert q.active
    finally:
        q.stop()
    res = D.read_results(spark, root)
    assert res["r7"].count() == 1 and res["r8"].count() == 1


def test_conditions_from_properties_file(spark, tmp_path):
    from mallscope.sources.conditions import load_conditions
    f = tmp_path / "conditions.properties"
    f.write_text('condition.params.json={startDate:"2024-01-05", \\\n  endDate:"2024-01-25", \\\n'
                 '  startAge: "20", \\\n  targetPageFlow:"1,2,3"}\n', encoding="utf-8")
    c = load_conditions(spark, str(f))
    assert (c["startDate"], c["endDate"], c["startAge"], c["targetPageFlow"]) == \
        ("2024-01-05", "2024-01-25", "20", "1,2,3")


def test_start_query_memory_sink_available_now(spark):
    from mallscope.streaming.queries import start_query
    root = os.path.join(checkpoint_root(spark), "t-q-" + uuid.uuid4().hex[:8])
    spark.range(5).write.parquet(root + "/in")
    src = spark.readStream.schema("id long").parquet(root + "/in")
    q = start_query(src.withColumn("twice", F.col("id") * 2), root + "/ck", sink="memory",
                    query_name="t_mem_" + uuid.uuid4().hex[:6], trigger={"availableNow": True})
    q.awaitTermination(120)
    assert sorted(r.twice for r in spark.table(q.name).collect()) == [0, 2, 4, 6, 8]


def test_run_reports_writes_every_batch_result(spark):
    import __spark_entry__ as E
    from mallscope.plans.oracle_sql import TASK
    from mallscope.plans.reports import run_reports, table_writer
    prefix = "t_" + uuid.uuid4().hex[:6] + "_"
    root = os.path.join(checkpoint_root(spark), "reports-" + uuid.uuid4().hex[:8])
    d = SF_SMALL
    tables = run_reports(fx.actions(spark, d), fx.users(spark, d), fx.cities(spark, d),
                         fx.products(spark, d), fx.CONDITIONS, table_writer(prefix, root),
                         task_id=TASK)
    q = E.queries()
    want = {"r1": "hot_category_top10", "r2": "hot_category_top_sessions",
            "r3": "page_jump_ratio", "r4": "area_product_top3"}
    for key, table in tables.items():
        assert same(spark.table(prefix + table), q[want[key]](spark, d)), key


def test_kafka_records_shape(spark):
    from mallscope.sinks.tables import kafka_records
    ads = spark.createDataFrame([(1704067207179, "EUROPE", "FRANCE", "7", "3", 1)],
                                "timestamp long, area string, city string, userid string, adid string, event_id long")
    r = kafka_records(ads).collect()[0]
    assert (r.key, r.value) == ("7", "1704067207179 EUROPE FRANCE 7 3")


def test_kafka_options_mapping():
    from mallscope.sources.streams import kafka_options
    o = kafka_options("h:9092", "ads_log", starting_offsets={"ads_log": {0: 10, 1: 5}},
                      min_partitions=64)
    assert o["subscribe"] == "ads_log" and o["minPartitions"] == "64"
    assert o["startingOffsets"] == '{"ads_log": {"0": 10, "1": 5}}'
    assert o["maxOffsetsPerTrigger"] == "5000000"


def test_dashboard_on_kafka_shaped_rows(spark):
    # what read_ad_stream("kafka") returns, fed from files: value text + partition/offset
    from mallscope.sources.streams import KAFKA_ROW_SCHEMA, kafka_event_id
    root = new_root(spark, "kafka")
    fx.kafka_rows(spark, SF_SMALL).write.parquet(root + "/in")
    rows = spark.readStream.schema(KAFKA_ROW_SCHEMA).parquet(root + "/in")
    lines = rows.select(F.col("value").alias("line"), kafka_event_id("partition", "offset").alias("event_id"))
    D.run_ad_dashboard(spark, root, lines, threshold=2, span_minutes=600, trigger={"availableNow": True},
                       micro_batch=False, state_partitions=4).await_termination(300)
    kept = A.blacklist_filter(fx.ads(spark, SF_SMALL), 2)
    assert same(D.read_results(spark, root)["r6"], A.date_area_city_ad_count(kept))


def test_kafka_event_ids_never_collide_silently(spark):

    from mallscope.sources.streams import kafka_event_id, read_ad_stream
    rows = spark.createDataFrame([(10_000, 0)], "partition int, offset long")
    with pytest.raises(Exception, match="no event id slot"):
        rows.select(kafka_event_id("partition", "offset")).collect()
    with pytest.raises(ValueError):
        read_ad_stream(spark, "kafka", options={"subscribe": "a,b"})


def test_streams_list_no_folder_that_the_blacklist_deletes(spark):
    import glob

    rows = [(1704067200000 + 1000 * i, "a", "c", str(i // 2), "1", i) for i in range(10)]
    ads = spark.createDataFrame(rows, D.KEPT_SCHEMA)
    # each slice blocks another user, so that older block sets are deleted
    root = D.replay(spark, ads, threshold=2, span_minutes=60, bounds=[1704067200000 + 2000 * i for i in range(1, 5)])
    gate = D.paths(root)["gate"]
    sets = [b for b in batches_of(spark, gate) if "result=blocked" in list_dirs(spark, f"{gate}/batch={b}")]
    assert len(batches_of(spark, gate)) == 5 and sets == [3, 4]
    for name in ("totals", "trend"):
        logs = [open(f).read() for f in glob.glob(f"{root}/_checkpoint/{name}/sources/0/[0-9]*")]
        assert logs and sum(x.count("result=kept/") for x in logs) >= 5
        assert not any(r in x for x in logs for r in ("result=blocked", "result=audit", "result=counters"))
    assert D.read_results(spark, root, 60)["kept"].count() == 10


def test_a_batch_is_written_in_as_many_tasks_as_it_needs(spark):
    parts = {"kept": spark.range(10).withColumn("passes", F.lit(True)), "counters": spark.range(5).selectExpr("id n")}
    out = D._together(parts)
    # no result is squeezed through one task: the write may split a large one
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan and "Repartition 1" not in plan
    assert {r.result: r["count"] for r in out.groupBy("result").count().collect()} == {"kept": 10, "counters": 5}
