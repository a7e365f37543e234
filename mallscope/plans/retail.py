"""Batch results over the behaviour log: R1 R2 R3 R4.

Each takes DataFrames (fact + dimensions) and returns a lazy DataFrame; the
caller writes it with a sink from ``mallscope.sinks``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.constants import TOP_CATEGORIES, TOP_CITIES, TOP_PRODUCTS, TOP_SESSIONS
from mallscope.functions.scalars import with_task_id
from mallscope.operators.actions import (category_counts_for_users, category_levels, hot_categories,
                                         session_counts_for_users)
from mallscope.operators.joins import materialize
from mallscope.operators.ranking import top_ranked
from mallscope.operators.sequences import page_flow_pairs, session_chunks, session_transitions
from mallscope.operators.shares import OTHER_LABEL, top_share_text

DEFAULT_TASK_ID = "mallscope-task"


def hot_category_top10(actions: DataFrame, users: DataFrame, cond: dict, n: int = TOP_CATEGORIES,
                       task_id: str = DEFAULT_TASK_ID) -> DataFrame:
    """Top categories by pay, order, click counts among filtered actions.

    Plan: scan (pruned, date bounds pushed) -> explode category lists -> one
    partial aggregate per (user, category) -> join the users in the age range
    -> aggregate on the category id -> TakeOrderedAndProject(n).
    """
    top = hot_categories(category_counts_for_users(actions, users, cond), n)
    return with_task_id(top.select("category_id", "click_count", "order_count", "pay_count"), task_id)


def hot_category_top_sessions(actions: DataFrame, users: DataFrame, cond: dict,
                              n_categories: int = TOP_CATEGORIES,
                              n_sessions: int = TOP_SESSIONS,
                              task_id: str = DEFAULT_TASK_ID,
                              categories: DataFrame | None = None) -> DataFrame:
    """R2: the ``n_sessions`` sessions with most clicks in each hot category.

    ``categories`` (category_id) are the hot ones if they are known already,
    e.g. R1's written result; otherwise they are computed here. Per-category
    ranking uses row_number with a session tie-break and a partial
    WindowGroupLimit, so a huge category ships only its top rows out of each
    map task.
    """
    top = categories if categories is not None else \
        hot_categories(category_counts_for_users(actions, users, cond), n_categories)
    top = top.select("category_id")
    counts = session_counts_for_users(actions, users, cond, top)
    ranked = top_ranked(counts, ["category_id"], [F.desc("click_count"), F.asc("session_id")],
                        n_sessions, ties="row_number", rank_col=None)
    return with_task_id(ranked.select("category_id", "session_id", "click_count"), task_id)


def hot_category_reports(actions: DataFrame, users: DataFrame, cond: dict, n_categories: int = TOP_CATEGORIES,
                         n_sessions: int = TOP_SESSIONS,
                         task_id: str = DEFAULT_TASK_ID) -> tuple[DataFrame, DataFrame]:
    """R1 and R2 from one scan and one explode of the actions.

    The counts per category and per (category, session) are computed together
    and written once to the shared checkpoint folder; R1 is the top of the
    former, R2 ranks the latter within R1's categories.
    """
    levels = materialize(category_levels(actions, users, cond))
    top = hot_categories(levels.filter("level = 'category'"), n_categories)
    sessions = levels.filter("level = 'session' and click_count > 0").select(
        "category_id", "session_id", "click_count")
    hot = sessions.join(top.select(F.col("category_id").alias("__k")), F.col("category_id") == F.col("__k"), "left_semi")
    ranked = top_ranked(hot, ["category_id"], [F.desc("click_count"), F.asc("session_id")], n_sessions,
                        ties="row_number", rank_col=None)
    return (with_task_id(top.select("category_id", "click_count", "order_count", "pay_count"), task_id),
            with_task_id(ranked, task_id))


def page_jump_ratio(actions: DataFrame, flow: str, task_id: str = DEFAULT_TASK_ID,
                    split_hot: bool = True) -> DataFrame:
    """Conversion rate of each adjacent pair of the target page flow.

    ratio = (times a session went straight from page a to page b)
            / (visits of page a, all sessions, 1 if never visited).
    Pairs never taken are not listed.
    """
    pairs = page_flow_pairs(flow)
    from_pages = sorted({a for a, _ in pairs})
    t = session_transitions(actions, chunk=session_chunks() if split_hot else None)
    # every action is one row of `t`: one aggregate per (page, next page),
    # then one row per page of the flow with its visits and its jumps to pages
    # of the flow (a list no longer than the flow), so the window runs once
    moves = t.groupBy("page_id", "next_page_id").agg(F.count(F.lit(1)).alias("n"))
    page = F.col("page_id").cast("string")
    to = F.col("next_page_id").cast("string")
    to_pages = sorted({b for _, b in pairs})
    by_page = (moves.filter(page.isin(from_pages)).groupBy(page.alias("from_page"))
               .agg(F.sum("n").alias("visits"),
                    F.collect_list(F.when(to.isin(to_pages), F.struct(to.alias("to_page"), F.col("n")))).alias("next")))
    jump = F.concat("from_page", F.lit("-"), F.col("j.to_page"))
    wanted = [f"{a}-{b}" for a, b in pairs]
    ratios = (by_page.select("from_page", "visits", F.explode("next").alias("j"))
              .select(jump.alias("jump"), (F.col("j.n").cast("double") / F.col("visits").cast("double")).alias("ratio"))
              .filter(F.col("jump").isin(wanted)))
    return with_task_id(ratios, task_id)


def area_click_counts(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """J2 + A6 pre-aggregated: clicks per (area, product_name, city_name).

    The fact is first reduced to one row per (city_id, product_id) with a
    partial aggregate, *then* joined to the dimensions: the joins see at
    most |cities| x |products| rows whatever the fact size, and a hot
    product is one row per map task instead of a skewed join key.
    """
    pre = actions.groupBy("city_id", "click_product_id").agg(F.count(F.lit(1)).alias("n"))
    c = cities.select("city_id", "city_name", "area")
    p = products.select("product_id", "product_name")
    j = pre.join(c, "city_id").join(p, pre["click_product_id"] == p["product_id"])
    return j.groupBy("area", "product_name", "city_name").agg(F.sum("n").cast("bigint").alias("n"))


def area_product_shares(actions: DataFrame, cities: DataFrame, products: DataFrame,
                        k_cities: int = TOP_CITIES, other: str = OTHER_LABEL) -> DataFrame:
    """A6 + A7: (area, product_name, product_count, city_click_ratio) for every product."""
    counts = area_click_counts(actions, cities, products)
    return top_share_text(counts, ["area", "product_name"], "city_name", "n", k=k_cities,
                          other=other, out="city_click_ratio", total="product_count")


def area_product_top3(actions: DataFrame, cities: DataFrame, products: DataFrame,
                      n: int = TOP_PRODUCTS, k_cities: int = TOP_CITIES,
                      other: str = OTHER_LABEL,
                      task_id: str = DEFAULT_TASK_ID) -> DataFrame:
    """Per area, the products with the ``n`` highest click counts.

    Ties share a rank (``rank``), so an area can list more than ``n``.
    Products are grouped by *name*: ids with equal names merge. The products
    are ranked on their totals first; the share text is built for those that
    stay.
    """
    counts = area_click_counts(actions, cities, products)
    totals = counts.groupBy("area", "product_name").agg(F.sum("n").cast("bigint").alias("__total"))
    top = top_ranked(totals, ["area"], [F.desc("__total")], n, ties="rank", rank_col=None)
    top = top.select(F.col("area").alias("__a"), F.col("product_name").alias("__p"))
    stays = F.col("area").eqNullSafe(F.col("__a")) & F.col("product_name").eqNullSafe(F.col("__p"))
    shares = top_share_text(counts.join(top, stays, "left_semi"), ["area", "product_name"], "city_name", "n",
                            k=k_cities, other=other, out="city_click_ratio", total="product_count")
    return with_task_id(shares.select("area", "product_name", "product_count", "city_click_ratio"), task_id)
