"""Action filtering, classification and counting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.constants import TOP_CATEGORIES
from mallscope.functions.scalars import split_ids

KINDS = ("click", "order", "pay")


def _bound(value):
    """A condition value is absent when null or empty text."""
    if value is None:
        return None
    value = str(value).strip()
    return value or None


def date_filter(actions: DataFrame, cond: dict) -> DataFrame:
    """The ``startDate`` / ``endDate`` part of P1 (inclusive text bounds)."""
    a = actions
    lo_d, hi_d = _bound(cond.get("startDate")), _bound(cond.get("endDate"))
    if lo_d is not None:
        a = a.filter(F.col("date") >= F.lit(lo_d))
    if hi_d is not None:
        a = a.filter(F.col("date") <= F.lit(hi_d))
    return a


def users_in_age(users: DataFrame, cond: dict) -> DataFrame:
    """The ``startAge`` / ``endAge`` part of P1, applied to the user dimension."""
    u = users.select("user_id", "age")
    lo_a, hi_a = _bound(cond.get("startAge")), _bound(cond.get("endAge"))
    if lo_a is not None:
        u = u.filter(F.col("age") >= F.lit(int(lo_a)))
    if hi_a is not None:
        u = u.filter(F.col("age") <= F.lit(int(hi_a)))
    return u.select("user_id")


def filter_actions(actions: DataFrame, users: DataFrame, cond: dict) -> DataFrame:
    """P1 + J1: actions of users inside the optional inclusive bounds.

    Bounds: ``startDate``/``endDate`` compare the ``date`` text, ``startAge``/
    ``endAge`` the user's age. Each is applied only when given; an empty
    value counts as absent. Only action columns are returned (``ac.*``).
    The age bounds are applied to the user dimension *before* the join, so
    the join's build side is as small as possible.
    """
    u = users_in_age(users, cond)
    return date_filter(actions, cond).join(u, "user_id").select(*actions.columns)


def classify_action(actions: DataFrame) -> DataFrame:
    """P5: exclusive action kind and its category ids.

    A click (``click_category_id != -1``) wins over an order list, which wins
    over a pay list; anything else (searches) has kind null and no ids.
    Adds ``kind`` and ``category_ids`` (array of text ids, empty entries
    dropped).
    """
    click = F.col("click_category_id") != -1
    order = F.col("order_category_ids").isNotNull()
    pay = F.col("pay_category_ids").isNotNull()
    kind = (F.when(click, "click").when(order, "order").when(pay, "pay"))
    ids = (F.when(click, F.array(F.col("click_category_id").cast("string")))
            .when(order, split_ids("order_category_ids"))
            .when(pay, split_ids("pay_category_ids")))
    return actions.withColumn("kind", kind).withColumn("category_ids", ids)


def explode_ids(df: DataFrame, column: str, alias: str = "id") -> DataFrame:
    """One row per entry of a comma-joined id list (empty entries dropped)."""
    return df.withColumn(alias, F.explode(split_ids(column)))


def category_events(actions: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """P5 + P11: one (category_id, kind) row per counted list entry (+ ``keep`` columns)."""
    c = classify_action(actions.select(*keep, "click_category_id", "order_category_ids",
                                       "pay_category_ids"))
    return c.select(*keep, F.explode("category_ids").alias("category_id"), "kind")


def category_action_counts(actions: DataFrame) -> DataFrame:
    """A1: count per (category_id, kind); partial + final hash aggregate."""
    return category_events(actions).groupBy("category_id", "kind").agg(F.count(F.lit(1)).alias("n"))


def category_pivot(events: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A2: (category_id, kind) rows -> one row per category, missing kinds = 0.

    One aggregation with conditional counts (no pivot pre-pass job);
    ``by`` adds grouping columns (e.g. ``user_id`` for a pre-aggregation).
    """
    return events.groupBy(*by, "category_id").agg(
        *[F.count_if(F.col("kind") == k).alias(f"{k}_count") for k in KINDS])


def category_counts_for_users(actions: DataFrame, users: DataFrame, cond: dict) -> DataFrame:
    """P1 + A1 + A2: category counts of the filtered actions.

    The actions are first reduced to counts per (user, category) by a partial
    aggregate, and only those join the users: the join shuffles user-category
    pairs instead of every action, and a hot user is a few rows. Counts add
    up (a user row that appears twice counts its actions twice, as a plain
    join does).
    """
    u = users_in_age(users, cond)
    acts = date_filter(actions, cond)
    per_user = category_pivot(category_events(acts, keep=("user_id",)), by=("user_id",))
    return (per_user.join(u, "user_id").groupBy("category_id")
                    .agg(*[F.sum(f"{k}_count").cast("bigint").alias(f"{k}_count") for k in KINDS]))


def category_levels(actions: DataFrame, users: DataFrame, cond: dict) -> DataFrame:
    """A1 + A2 + A3 over P1-filtered actions, from one pass over them.

    Rows of level ``category`` hold the counts of a category, rows of level
    ``session`` those of a category in one session (``session_id`` is null in
    the former, and in the latter for actions without a session). The actions
    are read and exploded once and reduced to counts per (user, category,
    session) by a partial aggregate; the grouping sets double only what is
    left after the join with the users. Sessions of all categories are
    counted, since the hot ones are not known yet.
    """
    u = users_in_age(users, cond)
    events = category_events(date_filter(actions, cond), keep=("user_id", "session_id"))
    counts = [f"{k}_count" for k in KINDS]
    per_user = category_pivot(events, by=("user_id", "session_id"))
    rows = per_user.join(u, "user_id").select("category_id", "session_id", *counts)
    levels = rows.groupingSets([["category_id"], ["category_id", "session_id"]], "category_id", "session_id")
    return (levels.agg(F.grouping("session_id").alias("__all"),
                       *[F.sum(c).cast("bigint").alias(c) for c in counts])
            .select(F.when(F.col("__all") == 1, "category").otherwise("session").alias("level"),
                    "category_id", "session_id", *counts))


def hot_categories(counts: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """Top ``n`` by pay, then order, then click count; ties by id text.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: a per-partition
    top-n, then a merge of at most ``n`` rows per partition.
    """
    return counts.orderBy(F.desc("pay_count"), F.desc("order_count"),
                          F.desc("click_count"), F.asc("category_id")).limit(n)


def category_session_counts(actions: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """A3 (+J4): clicks per (category_id, session_id), optionally only in ``categories``."""
    a = actions.filter(F.col("click_category_id") != -1).select(
        F.col("click_category_id").cast("string").alias("category_id"), "session_id")
    if categories is not None:
        k = categories.select(F.col("category_id").alias("__k"))
        a = a.join(k, a["category_id"] == k["__k"], "left_semi")
    return a.groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count"))


def session_counts_for_users(actions: DataFrame, users: DataFrame, cond: dict,
                             categories: DataFrame) -> DataFrame:
    """A3 + J4 over P1-filtered actions.

    Clicks are first kept only in ``categories``, then counted per (user,
    category, session) by a partial aggregate, and only the counts join the
    users.
    """
    u = users_in_age(users, cond)
    a = date_filter(actions, cond).filter(F.col("click_category_id") != -1).select(
        "user_id", F.col("click_category_id").cast("string").alias("category_id"), "session_id")
    k = categories.select(F.col("category_id").alias("__k"))
    per_user = (a.join(k, a["category_id"] == k["__k"], "left_semi")
                 .groupBy("user_id", "category_id", "session_id")
                 .agg(F.count(F.lit(1)).alias("click_count")))
    return (per_user.join(u, "user_id").groupBy("category_id", "session_id")
                    .agg(F.sum("click_count").cast("bigint").alias("click_count")))
