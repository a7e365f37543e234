from mallscope.operators.actions import (category_events, category_pivot, classify_action,
                                         filter_actions, hot_categories)

UVA = ("date string, user_id long, session_id string, page_id long, action_time string, "
       "search_keyword string, click_category_id long, click_product_id long, "
       "order_category_ids string, order_product_ids string, pay_category_ids string, "
       "pay_product_ids string, city_id long, event_id long")


def row(eid, date="2024-01-10", user=1, click=-1, order=None, pay=None):
    return (date, user, f"{user}_{date}", 1, f"{date} 00:00:00", None, click, -1 if click == -1 else 5,
            order, None, pay, None, 1, eid)


def test_action_kind_is_exclusive_and_ordered(spark):
    df = spark.createDataFrame([row(1, click=4, order="1,2"), row(2, order="1,2", pay="3"),
                                row(3, pay="3,"), row(4)], UVA)
    got = {r.event_id: (r.kind, r.category_ids) for r in classify_action(df).collect()}
    assert got == {1: ("click", ["4"]), 2: ("order", ["1", "2"]), 3: ("pay", ["3"]), 4: (None, None)}


def test_list_entries_counted_and_pay_only_category_kept(spark):
    df = spark.createDataFrame([row(1, click=4), row(2, order="4,5"), row(3, pay="9")], UVA)
    got = {r.category_id: (r.click_count, r.order_count, r.pay_count)
           for r in category_pivot(category_events(df)).collect()}
    assert got == {"4": (1, 1, 0), "5": (0, 1, 0), "9": (0, 0, 1)}


def test_hot_categories_order_and_tie_break(spark):
    counts = spark.createDataFrame([("10", 5, 1, 1), ("2", 9, 1, 1), ("3", 0, 0, 2), ("11", 5, 1, 1)],
                                   "category_id string, click_count long, order_count long, pay_count long")
    assert [r.category_id for r in hot_categories(counts, 3).collect()] == ["3", "2", "10"]


def test_condition_bounds_inclusive_optional_and_empty(spark):
    acts = spark.createDataFrame([row(1, "2024-01-05", 1), row(2, "2024-01-25", 2),
                                  row(3, "2024-01-26", 1), row(4, "2024-01-04", 3)], UVA)
    users = spark.createDataFrame([(1, 20), (2, 50), (3, 51)], "user_id long, age int")
    ids = lambda c: sorted(r.event_id for r in filter_actions(acts, users, c).collect())
    full = {"startDate": "2024-01-05", "endDate": "2024-01-25", "startAge": "20", "endAge": "50"}
    assert ids(full) == [1, 2]
    assert ids({**full, "endDate": None}) == [1, 2, 3]
    assert ids({**full, "startDate": ""}) == [1, 2]          # user 3 is 51, outside the ages
    assert ids({**full, "startDate": None, "endAge": "  "}) == [1, 2, 4]
    assert ids({}) == [1, 2, 3, 4]


def test_counts_are_pre_aggregated_per_user_before_the_join(spark):
    import re

    from mallscope.operators.actions import category_counts_for_users
    from mallscope.sources import fixtures as fx
    d = "/root/testdata/sf0.001"
    df = category_counts_for_users(fx.actions(spark, d), fx.users(spark, d), fx.CONDITIONS)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[user_id#\d+L?, category_id", plan)
