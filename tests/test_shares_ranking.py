from pyspark.sql import functions as F

from mallscope.operators.ranking import top_ranked
from mallscope.operators.shares import OTHER_LABEL, top_share_text

SCHEMA = "g string, item string, n long"


def share(spark, rows, k=2):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.g: (r.total, r.share_text) for r in top_share_text(df, ["g"], "item", "n", k=k).collect()}


def test_one_item_still_lists_other(spark):
    assert share(spark, [("a", "A", 5)]) == {"a": (5, f"A:100.0%,{OTHER_LABEL}:0.0%")}


def test_rounded_shares_can_make_other_negative(spark):
    assert share(spark, [("a", "X", 49), ("a", "Y", 351)]) == {"a": (400, f"Y:87.8%,X:12.3%,{OTHER_LABEL}:-0.1%")}


def test_top_items_tie_break_by_name(spark):
    got = share(spark, [("a", "C", 1), ("a", "B", 1), ("a", "A", 1)])
    assert got == {"a": (3, f"A:33.3%,B:33.3%,{OTHER_LABEL}:33.4%")}


def test_null_item_is_its_own_item(spark):
    got = share(spark, [("a", None, 3), ("a", "B", 1)])
    assert got == {"a": (4, f"null:75.0%,B:25.0%,{OTHER_LABEL}:0.0%")}


def test_rank_keeps_ties_row_number_cuts(spark):
    df = spark.createDataFrame([("x", "p1", 9), ("x", "p2", 8), ("x", "p3", 7), ("x", "p4", 7)], SCHEMA)
    assert top_ranked(df, ["g"], [F.desc("n")], 3, ties="rank").count() == 4
    kept = top_ranked(df, ["g"], [F.desc("n"), F.asc("item")], 3, ties="row_number")
    assert sorted(r.item for r in kept.collect()) == ["p1", "p2", "p3"]


def test_top_ranked_plans_a_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("n"))
    plan = top_ranked(df, ["g"], [F.desc("n")], 2, ties="row_number")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def _expected_share_text(counts: dict, k: int = 2) -> str:
    """The share rule, written directly: top k by count (ties by name), each
    share rounded half-up to one decimal, the remainder rounded the same way."""
    import math
    total = sum(counts.values())
    top = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:k]
    rest = 100.0
    parts = []
    for item, n in top:
        pct = math.floor(n * 1000.0 / total + 0.5) / 10.0
        rest -= pct
        parts.append(f"{item}:{pct}%")
    parts.append(f"{OTHER_LABEL}:{math.floor(rest * 10 + 0.5) / 10.0}%")
    return ",".join(parts)


def test_share_text_matches_the_rule_on_random_groups(spark):
    import random
    rnd = random.Random(11)
    rows, want = [], {}
    for g in range(300):
        items = {f"c{j:02d}": rnd.randint(1, 500) for j in rnd.sample(range(30), rnd.randint(1, 6))}
        want[f"g{g}"] = (sum(items.values()), _expected_share_text(items))
        rows += [(f"g{g}", i, n) for i, n in items.items()]
    assert share(spark, rows) == want
