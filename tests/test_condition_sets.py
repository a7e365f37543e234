"""Many job conditions at once, and results as SQL text."""

import pytest

from mallscope.operators.actions import category_counts_for_users, category_levels, filter_actions
from mallscope.operators.condition_sets import condition_bounds, condition_set_counts, condition_set_top
from mallscope.sources.conditions import parse_conditions
from test_actions import UVA, row

TEXTS = {
    1: '{startDate:"2024-01-05", endDate:"2024-02-10", startAge:"20", endAge:"50"}',
    2: None,                                                    # no bounds at all
    3: '{startDate:"", endAge:"30"}',
    4: '{startDate:"2024-02-01", endDate:"2024-01-01"}',        # nothing lies between
    5: "{startDate:'2024'}",                                    # compared as text
    6: '{startDate:"0001-01-01", endDate:"9999-12-31"}',
    7: '{"startDate":"2024-01-31", "endDate":"2024-01-31"}',
    8: "{}",
    9: '{endDate:"2023-12-31"}',
    10: '{startDate:" 2024-02-01 ", startAge:"51"}',
}


@pytest.fixture(scope="module")
def model(spark):
    dates = ["2024-01-05", "2024-01-31", "2024-02-01", "2024-02-10", "2023-12-31", "2025-07-01", "soon", "2024-13-01", None]
    rows = [row(10 * i + u, d, u, click=u if i % 2 else -1, order=None if i % 2 else "3,,4", pay="9")
            for i, d in enumerate(dates) for u in (1, 2, 3, 4, 5)]
    rows += [row(900, "2024-01-31", 1, pay="9"), row(900, "2024-01-31", 1, pay="9"), row(901, "2024-01-31", 1)]
    users = spark.createDataFrame([(1, 20), (2, 50), (3, 51), (4, None), (4, 25)], "user_id long, age int")
    return spark.createDataFrame(rows, UVA), users


def tuples(df):
    return sorted(map(tuple, df.collect()))


def test_each_set_counts_what_its_conditions_alone_count(spark, model):
    actions, users = model
    sets = spark.createDataFrame(list(TEXTS.items()), "set_id long, params string")
    got = condition_set_counts(actions, users, sets).cache()
    for k, text in TEXTS.items():
        cond = parse_conditions(spark, text) if text else {}
        want = category_counts_for_users(actions, users, cond)
        cols = ["category_id", "click_count", "order_count", "pay_count"]
        assert tuples(got.filter(f"set_id = {k}").select(cols)) == tuples(want.select(cols)), (k, text)
    assert {r.set_id for r in got.select("set_id").distinct().collect()} == set(TEXTS) - {4}
    top = condition_set_top(got, 2)
    assert {r.place for r in top.collect()} == {1, 2}


def test_sets_and_actions_meet_by_month_and_not_in_a_nested_loop(spark, model):
    actions, users = model
    sets = spark.createDataFrame(list(TEXTS.items()), "set_id long, params string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (old, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            plan = condition_set_counts(actions, users, sets)._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan
            assert "[month" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_sets_no_actions_and_sets_of_one_id(spark, model):
    actions, users = model
    schema = "set_id long, params string"
    assert condition_set_counts(actions, users, spark.createDataFrame([], schema)).count() == 0
    assert condition_set_counts(actions.limit(0), users, spark.createDataFrame([(1, None)], schema)).count() == 0
    once = condition_set_counts(actions, users, spark.createDataFrame([(1, TEXTS[1])], schema))
    twice = condition_set_counts(actions, users, spark.createDataFrame([(1, TEXTS[1])] * 2, schema))
    assert tuples(twice) == [(s, c, 2 * a, 2 * b, 2 * d) for s, c, a, b, d in tuples(once)]
    named = spark.createDataFrame([("x", TEXTS[1], 5)], "job string, cond string, month int")
    assert len(tuples(condition_set_counts(actions, users, named, "job", "cond"))) == len(tuples(once))


def test_a_broken_text_fails_rather_than_match_everything(spark):
    broken = spark.createDataFrame([(1, "{startDate:")], "set_id long, params string")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        condition_bounds(broken).collect()


def test_levels_equal_the_separate_counts(spark, model):
    actions, users = model
    cond = {"startDate": "2024-01-05"}
    levels = category_levels(actions, users, cond)
    cols = ["category_id", "click_count", "order_count", "pay_count"]
    assert tuples(levels.filter("level = 'category'").select(cols)) == \
        tuples(category_counts_for_users(actions, users, cond).select(cols))
    from mallscope.operators.actions import category_session_counts
    got = levels.filter("level = 'session' and click_count > 0").select("category_id", "session_id", "click_count")
    assert tuples(got) == tuples(category_session_counts(filter_actions(actions, users, cond)))


def test_sql_functions_give_what_the_column_functions_give(spark):
    from mallscope.functions import scalars as sc
    from mallscope.functions.sql import register_sql
    register_sql(spark)
    df = spark.createDataFrame([(1704067200123, 0.05, 1, 3, "3,,5,"), (-1, -0.05, 2, 3, ""), (0, 99.95, 0, 7, ","),
                                (None, None, None, 1, None)],
                               "ms long, x double, n long, total long, ids string")
    want = df.select(sc.epoch_ms_to_date("ms"), sc.minute_to_hhmm(sc.epoch_ms_to_minute("ms")), sc.half_up_tenth("x"),
                     sc.percent_tenth("n", "total"), sc.split_ids("ids"))
    got = df.selectExpr("epoch_ms_to_date(ms)", "minute_to_hhmm(cast(floor(ms / 60000D) as bigint))",
                        "half_up_tenth(x)", "percent_tenth(n, total)", "split_ids(ids)")
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_share_line_of_ties_nulls_and_the_rest(spark):
    from mallscope.functions.sql import register_sql
    register_sql(spark)
    line = lambda e: spark.sql(f"select share_line({e}, 'rest') t").first().t
    assert line("array(struct('a' as item, 66.7D as pct), struct('b' as item, 33.4D as pct))") == "a:66.7%,b:33.4%,rest:-0.1%"
    assert line("array(struct(cast(null as string) as item, 100D as pct))") == "null:100.0%,rest:0.0%"


def test_a_set_takes_four_sums_of_a_month_however_wide_its_bounds(spark):
    import random
    import re

    r = random.Random(3)
    dates = [f"2024-{m:02d}-{d:02d}" for m in (1, 2, 4) for d in range(1, 29, 3)] + ["2024-02-99", "soon", None]
    rows = [row(i, r.choice(dates), r.randrange(40), click=r.choice([-1, 1, 2, 3]), pay="9") for i in range(400)]
    ages = [(u, r.choice([None, 18, 25, 31, 40, 62])) for u in range(38)] + [(5, 25)]
    actions, users = spark.createDataFrame(rows, UVA), spark.createDataFrame(ages, "user_id long, age int")
    starts, ends = ["", "2024-01-04", "2024-01-05", "2024-02", "2024-03-15", "2025-01-01", "a"], ["", "2024-01-04", "2024-02-12", "2024-04-30", "2023", "z"]
    texts = {10 * i + j: f'{{startDate:"{s}", endDate:"{e}", startAge:"{r.choice(["", 17, 25, 26, 63])}", endAge:"{r.choice(["", 10, 25, 61, 99])}"}}'
             for i, s in enumerate(starts) for j, e in enumerate(ends)}
    df = condition_set_counts(actions, users, spark.createDataFrame(list(texts.items()), "set_id long, params string"))
    # facts are met at corners of date and age, not date by date
    assert re.search(r"\[month#\d+L?, d#\d+L?, a#\d+L?\]", df._jdf.queryExecution().executedPlan().toString())
    bounds = {b.set_id: b for b in condition_bounds(spark.createDataFrame(list(texts.items()), "set_id long, params string")).collect()}
    by_user = {}
    for u, a in ages:
        by_user.setdefault(u, []).append(a)
    want = {}
    for x in (dict(zip(actions.columns, t, strict=True)) for t in rows):
        kind, ids = ("click", [str(x["click_category_id"])]) if x["click_category_id"] != -1 else ("pay", ["9"])
        for a in by_user.get(x["user_id"], []):
            for k, b in bounds.items():
                d = x["date"]
                if all([b.start_date is None or (d is not None and d >= b.start_date), b.end_date is None or (d is not None and d <= b.end_date),
                        b.start_age is None or (a is not None and a >= b.start_age), b.end_age is None or (a is not None and a <= b.end_age)]):
                    for c in ids:
                        n = want.setdefault((k, c), [0, 0, 0])
                        n[0 if kind == "click" else 2] += 1
    assert tuples(df) == sorted((*k, *v) for k, v in want.items())
