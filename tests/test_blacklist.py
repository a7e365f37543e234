import datetime as dt
import random

from mallscope.operators.ads import blacklist_filter, blacklist_points, user_ad_daily_counts

SCHEMA = "timestamp long, area string, city string, userid string, adid string, event_id long"
DAY = 86_400_000


def replay_reference(rows, threshold, batch_size):
    """The procedure being rebuilt: per batch, drop blocked users (set read at
    batch start), then add the batch's kept clicks to per-(date, user, ad)
    counters and block users whose counter reached the threshold."""
    rows = sorted(rows, key=lambda r: (r[0], r[5]))
    blocked, counters, kept = set(), {}, []
    for i in range(0, len(rows), batch_size):
        batch = [r for r in rows[i:i + batch_size] if r[3] not in blocked]
        kept += batch
        for r in batch:
            d = dt.datetime.fromtimestamp(r[0] / 1000, dt.UTC).strftime("%Y-%m-%d")
            k = (d, r[3], r[4])
            counters[k] = counters.get(k, 0) + 1
            if counters[k] >= threshold:
                blocked.add(r[3])
    return sorted(r[5] for r in kept)


def random_clicks(seed, n=300):
    rnd = random.Random(seed)
    return [(1_704_067_200_000 + rnd.randint(0, 2 * DAY), "A", "c", str(rnd.randint(0, 5)),
             str(rnd.randint(1, 3)), i) for i in range(n)]


def test_closed_form_equals_replay_with_single_click_batches(spark):
    for seed in (1, 2, 3):
        rows = random_clicks(seed)
        df = spark.createDataFrame(rows, SCHEMA)
        for t in (3, 6):
            got = sorted(r.event_id for r in blacklist_filter(df, t).collect())
            assert got == replay_reference(rows, t, 1), (seed, t)


def test_block_hits_last_and_other_ads_and_dates(spark):
    t0 = 1_704_067_200_000
    rows = [(t0 + 1, "A", "c", "u", "1", 1), (t0 + 2, "A", "c", "u", "1", 2),
            (t0 + 3, "A", "c", "u", "2", 3),                 # other ad after the block: dropped
            (t0 + 4, "A", "c", "v", "1", 4), (t0 + DAY, "A", "c", "v", "1", 5)]  # two days: no block
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.event_id for r in blacklist_filter(df, 2).collect()) == [1, 2, 4, 5]
    pts = {r.userid: (r.blocked_ts, r.blocked_event_id) for r in blacklist_points(df, 2).collect()}
    assert pts == {"u": (t0 + 2, 2)}


def test_micro_batch_form_equals_replay_with_larger_batches(spark):
    for seed in (4, 5):
        rows = sorted(random_clicks(seed), key=lambda r: (r[0], r[5]))
        for size in (7, 50):
            with_batch = [r + (i // size,) for i, r in enumerate(rows)]
            df = spark.createDataFrame(with_batch, SCHEMA + ", batch long")
            got = sorted(r.event_id for r in blacklist_filter(df, 3, batch_col="batch").collect())
            assert got == replay_reference(rows, 3, size), (seed, size)


def test_stream_steps_equal_replay_for_both_cut_offs(spark):
    from mallscope.streaming.blacklist import BLOCKED_SCHEMA, batch_block_points, passes, unblocked
    rows = sorted(random_clicks(11), key=lambda r: (r[0], r[5]))
    size = 60
    for micro in (False, True):
        blocked = spark.createDataFrame([], BLOCKED_SCHEMA)
        got = []
        for i in range(0, len(rows), size):
            fresh = unblocked(spark.createDataFrame(rows[i:i + size], SCHEMA), blocked)
            # the totals after the batch, blocked users' clicks included, as the state has them
            totals = user_ad_daily_counts(spark.createDataFrame(rows[:i + size], SCHEMA))
            points = batch_block_points(fresh, totals, 6)
            got += [r.event_id for r in passes(fresh, points, micro).filter("passes").collect()]
            blocked = spark.createDataFrame(blocked.unionByName(points).collect(), BLOCKED_SCHEMA)
        assert sorted(got) == replay_reference(rows, 6, size if micro else 1), micro


def test_a_blocked_bot_goes_before_anything_is_grouped_or_ranked(spark):
    from mallscope.streaming.blacklist import BLOCKED_SCHEMA, batch_block_points, unblocked
    clicks = spark.range(20_000).selectExpr(
        "id as timestamp", "'A' area", "'c' city", "'bot' userid", "'1' adid", "id event_id")
    blocked = spark.createDataFrame([("bot", 0, 0)], BLOCKED_SCHEMA)
    fresh = unblocked(clicks, blocked)
    assert fresh.count() == 0
    points = batch_block_points(fresh, user_ad_daily_counts(clicks), 50)
    assert points.count() == 0
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "LeftAnti" in plan
    # a bot that is not blocked yet: each map task ships at most `threshold` of its clicks
    fresh = unblocked(clicks, spark.createDataFrame([], BLOCKED_SCHEMA))
    points = batch_block_points(fresh, user_ad_daily_counts(clicks), 50)
    assert [tuple(r) for r in points.collect()] == [("bot", 49, 49)]
    assert "WindowGroupLimit" in points._jdf.queryExecution().executedPlan().toString()
