import random

from pyspark.sql import functions as F

from mallscope.operators.sequences import (jump_ratio, page_flow_pairs, page_jump_counts, page_view_counts,
                                           session_chunks, session_transitions)

SCHEMA = "session_id string, action_time string, event_id long, page_id long"


def brute(rows):
    by = {}
    for s, t, e, p in rows:
        by.setdefault(s, []).append((t, e, p))
    out = {}
    for s, items in by.items():
        items.sort()
        for (t, e, p), nxt in zip(items, items[1:] + [None]):
            out[e] = nxt[2] if nxt else None
    return out


def as_map(df):
    return {r.event_id: r.next_page_id for r in df.collect()}


def test_flow_pairs():
    assert page_flow_pairs("1,2,3") == [("1", "2"), ("2", "3")]
    assert page_flow_pairs("1,2,1,2,") == [("1", "2"), ("2", "1")]
    assert page_flow_pairs("5") == []


def test_ties_in_one_second_use_event_id(spark):
    rows = [("s", "2024-01-01 00:00:01", 2, 7), ("s", "2024-01-01 00:00:01", 1, 5),
            ("s", "2024-01-01 00:00:00", 9, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert as_map(session_transitions(df)) == {9: 5, 1: 7, 2: None}


def test_chunked_hot_session_equals_plain_and_brute_force(spark):
    rnd = random.Random(7)
    rows, eid = [], 0
    for s in ["hot", "a", "b", "c"]:
        n = 400 if s == "hot" else rnd.randint(1, 6)
        for _ in range(n):
            minute = rnd.randint(0, 30)
            sec = rnd.randint(0, 2)
            rows.append((s, f"2024-01-01 00:{minute:02d}:{sec:02d}", eid, rnd.randint(1, 7)))
            eid += 1
    for _ in range(60):                        # a burst: many actions in one second
        rows.append(("hot", "2024-01-01 00:07:01", eid, rnd.randint(1, 7)))
        eid += 1
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert as_map(session_transitions(df)) == want
    assert as_map(session_transitions(df, chunk=F.substring("action_time", 1, 16), hot_rows=None)) == want
    # only the hot session takes the chunked path
    assert as_map(session_transitions(df, chunk=F.substring("action_time", 1, 16), hot_rows=50)) == want
    # three levels; bursts split into chunks of at most 7 actions
    assert as_map(session_transitions(df, chunk=session_chunks(burst_rows=7), hot_rows=50)) == want
    assert as_map(session_transitions(df, chunk=session_chunks(burst_rows=7), hot_rows=None)) == want


def test_jumps_and_ratio(spark):
    rows = [("s1", "t1", 1, 1), ("s1", "t2", 2, 2), ("s1", "t3", 3, 3), ("s1", "t4", 4, 1),
            ("s2", "t1", 5, 2), ("s3", "t1", 6, 3), ("s2", "t2", 7, 9)]   # 2 -> 3 split over sessions: no jump
    df = spark.createDataFrame(rows, SCHEMA)
    pairs = page_flow_pairs("1,2,3")
    jumps = page_jump_counts(session_transitions(df), pairs)
    views = page_view_counts(df, ["1", "2"])
    got = {r.jump: r.ratio for r in jump_ratio(jumps, views).collect()}
    assert got == {"1-2": 1 / 2, "2-3": 1 / 2}


def test_hot_keys_sampled_and_exact(spark):
    from pyspark.sql import functions as F

    from mallscope.operators import sequences as S
    rows = spark.range(300_000).select(
        F.when(F.col("id") < 200_000, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string"))
        .alias("s"))
    old = S.HOT_SAMPLE_ROWS
    try:
        S.HOT_SAMPLE_ROWS = 2_000          # fraction 0.02 for hot_rows=100_000
        assert [r.s for r in S.hot_keys(rows, "s", 100_000).collect()] == ["hot"]
    finally:
        S.HOT_SAMPLE_ROWS = old
    assert sorted(r.s for r in S.hot_keys(rows, "s", 1_000).collect()) == ["hot"]   # exact count
