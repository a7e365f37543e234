"""C2-C9 + K4-K8: the live ad dashboard as a chain of restartable queries.

==========  ==================================================================
query       does
==========  ==================================================================
ingest      lines -> ``clicks``: parsed once, spoilt lines kept apart; Spark's
            own file sink, so a reader sees whole batches
blacklist   counters per (date, user, ad) in state; a batch's clicks through
            the block set -> ``gate``: kept and late clicks, counters, block
            set and audit of a batch in one write, put in place by one rename
totals      kept clicks -> running totals in state -> R6 and R7 in one write
trend       kept clicks -> one-minute windows behind a watermark -> R8
==========  ==================================================================

What a query must remember is in Spark's state and checkpoints; what it
publishes is ordinary Parquet, a folder per batch (``sinks.published``), so
a replayed batch writes the same again. ``clicks`` and ``gate`` are the only
streams between queries: every result reads a kept click once.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallscope.functions.adlog import parse_ad_log, render_ad_log
from mallscope.operators.ads import DEFAULT_SPAN_MINUTES, DEFAULT_THRESHOLD, with_date
from mallscope.session import checkpoint_root
from mallscope.sinks.published import BATCH, batch_path, batches_of, latest_totals, read_newest
from mallscope.sources.files import delete, list_dirs, make_dir, publish_folder
from mallscope.sources.streams import read_ad_stream
from mallscope.streaming import totals as tt
from mallscope.streaming import trend as tr
from mallscope.streaming.blacklist import (BLOCKED_SCHEMA, COUNTER_KEYS, COUNTERS_SCHEMA, batch_block_points,
                                           counter_totals, passes, unblocked)
from mallscope.streaming.queries import DEFAULT_TRIGGER, conf_of, start_query, start_stateful

KEPT_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType()), T.StructField("area", T.StringType()),
    T.StructField("city", T.StringType()), T.StructField("userid", T.StringType()),
    T.StructField("adid", T.StringType()), T.StructField("event_id", T.LongType())])
BATCH_FIELD = T.StructField(BATCH, T.LongType())
#: ``line`` is kept of spoilt lines only.
CLICKS_SCHEMA = T.StructType([*KEPT_SCHEMA.fields, T.StructField("line", T.StringType()),
                              T.StructField("ok", T.BooleanType()), BATCH_FIELD])
AUDIT_SCHEMA = "lines bigint, kept bigint, blocked bigint, rejected bigint, late bigint"
#: How far the blacklist has come: the newest source batch and day seen, and
#: the batches that hold the block set and the one before it.
PROGRESS_SCHEMA = AUDIT_SCHEMA + ", through bigint, newest_day string, set_batch bigint, set_before bigint"
DENIED_SCHEMA = "userid string"
RESULT = "result"
QUERIES = ["ingest", "blacklist", "totals", "trend"]
#: A stateful query runs without AQE; what its batches do apart from the state need not.
BATCH_CONF = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def paths(root: str) -> dict:
    names = ["src", "clicks", "gate", "staging", "results", "trend"]
    return ({n: os.path.join(root, n) for n in names} |
            {f"ck_{n}": os.path.join(root, "_checkpoint", n) for n in QUERIES})


def ingest(lines: DataFrame) -> DataFrame:
    """P2 on a stream: parsed lines with ``ok`` and the micro-batch's time as
    ``batch``, the same again when the batch is replayed."""
    parsed = parse_ad_log(lines, keep=["event_id", "line"], with_rejects=True)
    return parsed.select(*KEPT_SCHEMA.names, F.when(~F.col("ok"), F.col("line")).alias("line"), "ok",
                         F.unix_millis(F.current_timestamp()).alias(BATCH))


def blacklist_batch(root: str, threshold: int = DEFAULT_THRESHOLD, micro_batch: bool = False,
                    keep_days: int | None = None, denied: str | None = None, partitions: str | None = None):
    """A ``foreachBatch`` function: a batch's changed counters and its clicks
    through the blacklist.

    The batch's clicks are the source batches after the last one worked on, up
    to the newest that a counter has seen. With ``keep_days`` the days older
    than the newest day seen before, less ``keep_days``, are closed: their
    counters have left the state, and valid clicks that still come for them go
    to ``late``. ``denied`` (C4) names a published table of users (``publish``)
    whose newest batch is read whenever a batch starts; they are dropped as
    blocked users are. ``partitions`` are the shuffle partitions of the batch's
    joins (default: those of the state), which AQE merges by size.
    """
    p = paths(root)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # the batch's own joins are ordinary ones: planned by their real sizes,
        # not in the fixed parts of the state
        with conf_of(batch.sparkSession, BATCH_CONF | ({"spark.sql.shuffle.partitions": partitions} if partitions else {})):
            gate_batch(batch, batch_id)

    def gate_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counted = batch.persist()
        held = [counted]
        try:
            last = counted.agg(F.max("last")).first()[0]
            if last is None:
                return
            if batch_id in batches_of(spark, p["gate"]):
                return            # a replay: the batch is out as a whole and may have been read
            before = read_gate(spark, root, "audit", PROGRESS_SCHEMA, newest_before=batch_id).first()
            closed = None
            if keep_days is not None and before is not None and before["newest_day"]:
                closed = (dt.date.fromisoformat(before["newest_day"]) - dt.timedelta(days=keep_days)).isoformat()
            clicks = with_date(spark.read.schema(CLICKS_SCHEMA).parquet(p["clicks"])
                               .filter((F.col(BATCH) > (before["through"] if before else -1)) & (F.col(BATCH) <= last)))
            clicks = clicks.withColumn("__late", F.col("ok") & (F.col("date") < closed if closed else F.lit(False))).persist()
            held.append(clicks)
            seen = clicks.agg(F.count(F.lit(1)), F.count_if(~F.col("ok")), F.count_if("__late"),
                              F.max(F.when(F.col("ok"), F.col("date")))).first()

            set_batch = before["set_batch"] if before else None
            blocked = (spark.createDataFrame([], BLOCKED_SCHEMA) if set_batch is None else
                       spark.read.schema(BLOCKED_SCHEMA).parquet(f"{batch_path(p['gate'], set_batch)}/{RESULT}=blocked"))
            out = blocked.select("userid")
            if denied:
                out = out.unionByName(read_newest(spark, denied, DENIED_SCHEMA))
            fresh = unblocked(clicks.filter(F.col("ok") & ~F.col("__late")).select(*KEPT_SCHEMA.names), out).persist()
            held.append(fresh)
            totals = counted.select(*COUNTER_KEYS, "n")
            points = batch_block_points(fresh, totals, threshold).persist()
            held.append(points)
            judged = passes(fresh, points, micro_batch).persist()
            held.append(judged)
            n_kept = judged.agg(F.count_if("passes")).first()[0]

            # a counter counts what passed: the total less the clicks cut off
            cut = with_date(judged).groupBy(*COUNTER_KEYS).agg(F.count_if(~F.col("passes")).alias("__cut"),
                                                               F.count_if("passes").alias("__kept"))
            counters = (cut.filter("__kept > 0").join(totals, COUNTER_KEYS)
                        .select(*COUNTER_KEYS, (F.col("n") - F.col("__cut")).alias("n")))
            parts = {"kept": judged.filter("passes"), "counters": counters}
            if seen[2]:
                parts["late"] = clicks.filter("__late").select(*KEPT_SCHEMA.names)
            grown = bool(points.take(1))
            if grown:
                parts["blocked"] = blocked.unionByName(points)
            newest = max(filter(None, [seen[3], before["newest_day"] if before else None]), default=None)
            row = (seen[0], n_kept, seen[0] - n_kept - seen[1] - seen[2], seen[1], seen[2], last, newest,
                   batch_id if grown else set_batch, set_batch if grown else before and before["set_before"])
            parts["audit"] = spark.range(1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(
                row, T.StructType.fromDDL(PROGRESS_SCHEMA), strict=True)])
            staging = f"{p['staging']}/{uuid.uuid4().hex}"
            _together(parts).write.partitionBy(RESULT).parquet(staging)
            publish_folder(spark, staging, batch_path(p["gate"], batch_id))
            if grown and before and before["set_before"] is not None:
                # the last two block sets stay, for readers and replays
                delete(spark, f"{batch_path(p['gate'], before['set_before'])}/{RESULT}=blocked")
        finally:
            for df in held:
                df.unpersist()
    return on_batch


def _together(parts: dict[str, DataFrame]) -> DataFrame:
    """Rows of several results as one DataFrame, each in as many tasks as its
    size asks for (AQE splits a large one)."""
    rows = None
    for name, df in parts.items():
        one = df.drop("passes").withColumn(RESULT, F.lit(name))
        rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
    return rows.hint("rebalance", RESULT)


def read_gate(spark: SparkSession, root: str, result: str, schema: T.StructType | str,
              newest_before: int | None = None) -> DataFrame:
    """The rows of one result of the blacklist, with their ``batch``: of all
    batches, or of the newest one before a batch."""
    s = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    s = T.StructType([*s.fields, BATCH_FIELD])
    path = paths(root)["gate"]
    have = [b for b in batches_of(spark, path) if newest_before is None or b < newest_before]
    if newest_before is not None:
        have = have[-1:]
    folders = [f"{batch_path(path, b)}/{RESULT}={result}" for b in have]
    if not folders:
        return spark.createDataFrame([], s)
    if newest_before is not None:
        return spark.read.schema(s).option("basePath", path).parquet(*folders)
    whole = T.StructType([*s.fields, T.StructField(RESULT, T.StringType())])
    return spark.read.schema(whole).parquet(path).filter(F.col(RESULT) == result).select(*s.names)


class Dashboard:
    """The running queries of a dashboard."""

    def __init__(self, queries: dict) -> None:
        self.queries = queries

    def drain(self, *names: str) -> None:
        """Wait until all that has arrived is worked off, query by query."""
        for name in names or QUERIES:
            self.queries[name].processAllAvailable()

    def stop(self) -> None:
        for q in reversed(self.queries.values()):
            q.stop()

    def await_termination(self, seconds: float | None = None) -> None:
        """Until a query ends (``availableNow``: all of them, in turn)."""
        for q in self.queries.values():
            q.awaitTermination(seconds)

    @property
    def active(self) -> bool:
        return all(q.isActive for q in self.queries.values())

    def exception(self):
        return next((e for q in self.queries.values() if (e := q.exception()) is not None), None)


def run_ad_dashboard(spark: SparkSession, root: str, lines: DataFrame,
                     threshold: int = DEFAULT_THRESHOLD, span_minutes: int = DEFAULT_SPAN_MINUTES,
                     trigger: dict | None = None, micro_batch: bool = True,
                     keep_days: int | None = None, denied: str | None = None,
                     state_partitions: int | None = None) -> Dashboard:
    """Start the dashboard on a live ``lines`` stream.

    ``lines`` has ``line`` and ``event_id`` columns, e.g. from
    ``read_ad_stream``, whose sources bound a batch. Nothing waits here: the
    queries run at ``trigger`` (3 s) and resume from their checkpoints under
    ``root`` when started again. ``micro_batch`` (as the application being
    rebuilt does) reads the block set when a batch starts and raises the
    counters after it; without it a user is cut off at the very click.
    ``keep_days`` bounds the state (see ``blacklist_batch``), ``denied`` names a
    further block set. ``state_partitions`` is fixed at the first start.
    """
    p = paths(root)
    if list_dirs(spark, p["gate"]) and not list_dirs(spark, p["ck_blacklist"]):
        raise ValueError(f"{root} holds results but no checkpoint: start under a new root")
    trigger = trigger or DEFAULT_TRIGGER
    for n in ("clicks", "gate"):
        make_dir(spark, p[n])

    def stream(name: str, schema: T.StructType, folders: str = "") -> DataFrame:
        return spark.readStream.schema(schema).option("basePath", p[name]).parquet(os.path.join(p[name], folders))

    queries = {"ingest": start_query(ingest(lines), p["ck_ingest"], path=p["clicks"], trigger=trigger,
                                     partition_by=[BATCH])}
    if "availableNow" in trigger:
        queries["ingest"].awaitTermination()
    counters = counter_totals(stream("clicks", CLICKS_SCHEMA).filter("ok"), keep_days)
    queries["blacklist"] = start_stateful(counters, p["ck_blacklist"], blacklist_batch(root, threshold, micro_batch, keep_days, denied,
                                                                                         spark.conf.get("spark.sql.shuffle.partitions")),
                                          trigger, state_partitions)
    if "availableNow" in trigger:
        queries["blacklist"].awaitTermination()

    def kept() -> DataFrame:
        # only the folders of kept clicks: a block set may be deleted while a query lists them
        whole = T.StructType([*KEPT_SCHEMA.fields, BATCH_FIELD, T.StructField(RESULT, T.StringType())])
        return stream("gate", whole, f"{BATCH}=*/{RESULT}=kept").select(*KEPT_SCHEMA.names)

    queries["totals"] = start_stateful(tt.running_totals(kept(), keep_days), p["ck_totals"],
                                       tt.publish_totals(p["results"], keep_days), trigger, state_partitions)
    queries["trend"] = start_stateful(tr.minute_windows(kept(), span_minutes), p["ck_trend"],
                                      tr.publish_trend(p["trend"], span_minutes), trigger, state_partitions)
    return Dashboard(queries)


def write_slices(ads: DataFrame, src: str, slices: int, bounds: list[int] | None = None, render=render_ad_log):
    """Yield after publishing each time slice of ``ads`` as lines under ``src``.

    Slice bounds are approximate quantiles of the click time, or ``bounds``.
    Each slice is written by one job into a staging folder (it may hold many
    files) and then moved to ``src/slice=N`` with one rename, so a running
    file stream sees a slice whole or not at all.
    """
    if bounds is None:
        probs = [i / slices for i in range(1, slices)]
        bounds = ads.approxQuantile("timestamp", probs, 0.001) if slices > 1 else []
    edges = [None, *bounds, None]
    for i in range(len(edges) - 1):
        part = ads
        if edges[i] is not None:
            part = part.filter(F.col("timestamp") >= F.lit(int(edges[i])))
        if edges[i + 1] is not None:
            part = part.filter(F.col("timestamp") < F.lit(int(edges[i + 1])))
        staging = f"{src.rstrip('/')}_staging/slice={i}"
        render(part, keep=["event_id"]).write.mode("overwrite").parquet(staging)
        publish_folder(ads.sparkSession, staging, f"{src.rstrip('/')}/slice={i}")
        yield i


def replay(spark: SparkSession, ads: DataFrame, threshold: int = DEFAULT_THRESHOLD,
           span_minutes: int = DEFAULT_SPAN_MINUTES, slices: int = 4, restart_after: int | None = None,
           root: str | None = None, micro_batch: bool = False, keep_days: int | None = None,
           bounds: list[int] | None = None, render=render_ad_log, state_partitions: int = 4) -> str:
    """Feed ``ads`` through the dashboard slice by slice; return the output root.

    For finished data: each slice is published whole (one folder rename) and
    goes through the blacklist before the next; totals and trend follow at
    their own pace. With ``restart_after=i`` everything is stopped after slice
    ``i`` and started again from the checkpoints (recovery test).
    """
    root = root or os.path.join(checkpoint_root(spark), "dashboard-" + uuid.uuid4().hex[:12])
    src = paths(root)["src"]
    live = None
    try:
        for i in write_slices(ads, src, slices, bounds, render):
            if live is None:
                lines = read_ad_stream(spark, "parquet", path=src, options={"basePath": src})
                live = run_ad_dashboard(spark, root, lines, threshold, span_minutes, {"processingTime": "400 milliseconds"},
                                        micro_batch, keep_days, state_partitions=state_partitions)
            live.drain("ingest", "blacklist")
            if restart_after is not None and i == restart_after:
                live.stop()
                live = None
        if live is not None:
            live.drain()
    finally:
        if live is not None:
            live.stop()
    return root


def read_results(spark: SparkSession, root: str, span_minutes: int = DEFAULT_SPAN_MINUTES) -> dict[str, DataFrame]:
    """What the dashboard has published, as DataFrames."""
    p = paths(root)
    names = KEPT_SCHEMA.names
    clicks = (spark.read.schema(CLICKS_SCHEMA).parquet(p["clicks"]) if list_dirs(spark, p["clicks"])
              else spark.createDataFrame([], CLICKS_SCHEMA))
    last = read_gate(spark, root, "audit", PROGRESS_SCHEMA, newest_before=1 << 62).first()
    held = last["set_batch"] if last else None
    return {
        "kept": read_gate(spark, root, "kept", KEPT_SCHEMA).select(*names),
        "late": read_gate(spark, root, "late", KEPT_SCHEMA).select(*names),
        "rejects": clicks.filter("not ok").select("line", "event_id"),
        "blocked": spark.createDataFrame([], BLOCKED_SCHEMA) if held is None else
        spark.read.schema(BLOCKED_SCHEMA).parquet(f"{batch_path(p['gate'], held)}/{RESULT}=blocked"),
        "counters": latest_totals(read_gate(spark, root, "counters", COUNTERS_SCHEMA), COUNTER_KEYS),
        "r6": tt.read_totals(spark, p["results"]),
        "r7": tt.read_top(spark, p["results"]),
        "minutes": tr.read_minutes(spark, p["trend"]),
        "r8": tr.read_trend(spark, p["trend"], span_minutes),
        "audit": read_gate(spark, root, "audit", AUDIT_SCHEMA),
    }
