"""P1 + S9 for many job conditions at once.

Each row of a table of conditions (``set_id``, ``params``: the lenient JSON
text of a job) filters the same actions. The actions are read once for all
sets and reduced to counts per (age, date, category), which a calendar, an age
and a category list bound, however many actions there are. The counts of each
month are added up along dates and ages once; a set then takes four sums of a
month and category, however many dates and ages it spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mallscope.constants import TOP_CATEGORIES
from mallscope.operators.actions import KINDS, category_events, category_pivot
from mallscope.operators.joins import materialize
from mallscope.operators.ranking import top_ranked
from mallscope.sources.conditions import CONDITION_SCHEMA

# dates that are not of the form yyyy-MM-dd belong to this bin, which all sets visit
_NO_MONTH = -1


def condition_bounds(sets: DataFrame, set_id: str = "set_id", params: str = "params") -> DataFrame:
    """(set_id, start_date, end_date, start_age, end_age) from the JSON texts.

    An absent or empty value is null: no bound. A null text has no bounds at
    all; a text that is no JSON fails the job rather than match everything.
    """
    options = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true", "mode": "FAILFAST"}
    c = sets.select(F.col(set_id).alias("set_id"), F.from_json(params, CONDITION_SCHEMA, options).alias("c"))
    bound = lambda f: F.nullif(F.trim(F.col(f"c.{f}")), F.lit(""))
    return c.select("set_id", bound("startDate").alias("start_date"), bound("endDate").alias("end_date"),
                    bound("startAge").cast("int").alias("start_age"), bound("endAge").cast("int").alias("end_age"))


def _month(date: str) -> Column:
    """Months since year 0 of a ``yyyy-MM-dd`` text, null of any other text."""
    d = F.col(date)
    number = F.substring(d, 1, 4).cast("int") * 12 + F.substring(d, 6, 2).cast("int")
    return F.when(d.rlike(r"^\d{4}-(0[1-9]|1[0-2])-\d{2}$"), number)


def _in_some_span(actions: DataFrame, bounds: DataFrame) -> DataFrame:
    """Actions from the earliest start to the latest end, as far as all sets
    have one; as scalar subqueries they also prune date folders."""
    def outer(column, pick):
        return bounds.agg(F.when(F.count(column) == F.count(F.lit(1)), pick(column))).scalar()
    first, last = outer("start_date", F.min), outer("end_date", F.max)
    return actions.filter((first.isNull() | (F.col("date") >= first)) & (last.isNull() | (F.col("date") <= last)))


def _axes(known: DataFrame) -> DataFrame:
    """(month, dates, ages): the distinct dates and ages of each month, ascending;
    null ages are the place after the last one (``places`` counts it)."""
    return (known.groupBy("month").agg(F.array_sort(F.collect_set("date")).alias("dates"),
                                       F.array_sort(F.collect_set("age")).alias("ages"),
                                       F.max(F.col("age").isNull().cast("int")).alias("__null"))
            .select("month", "dates", "ages", (F.size("ages") + F.col("__null")).alias("places")))


def _grid(known: DataFrame, axes: DataFrame, counts: list[str]) -> DataFrame:
    """(month, category_id, d, a, counts): the month's counts added up over its
    first ``d`` dates and ``a`` ages, for every ``d`` and ``a``."""
    place = F.when(F.col("age").isNull(), F.col("places")).otherwise(F.array_position("ages", F.col("age")))
    cells = known.join(axes, "month").select(
        "month", "category_id", F.array_position("dates", F.col("date")).cast("int").alias("d"),
        place.cast("int").alias("a"), *counts)
    empty = (known.select("month", "category_id").distinct().join(axes, "month")
             .withColumn("d", F.explode(F.sequence(F.lit(1), F.size("dates"))))
             .select("month", "category_id", "d", F.explode(F.sequence(F.lit(1), F.col("places"))).alias("a"),
                     *[F.lit(0).cast("bigint").alias(c) for c in counts]))
    out = (cells.unionByName(empty).groupBy("month", "category_id", "d", "a")
           .agg(*[F.sum(c).alias(c) for c in counts]))
    for along, other in (("a", "d"), ("d", "a")):
        w = Window.partitionBy("month", "category_id", other).orderBy(along).rowsBetween(Window.unboundedPreceding, 0)
        out = out.select("month", "category_id", "d", "a", *[F.sum(c).over(w).alias(c) for c in counts])
    return out


def _corners(at: DataFrame, axes: DataFrame) -> DataFrame:
    """(set_id, month, d, a, sign): the four corners in the grid of the dates and
    ages that a set takes of a month. Bounds compare as P1 does (date texts, ages)."""
    def upto(values: str, inside) -> Column:
        return F.size(F.filter(values, inside))
    def below(values: str, bound: str) -> Column:
        return F.when(F.col(bound).isNull(), 0).otherwise(upto(values, lambda v: v < F.col(bound)))
    def through(values: str, bound: str) -> Column:
        return F.when(F.col(bound).isNull(), F.size(values)).otherwise(upto(values, lambda v: v <= F.col(bound)))
    # a null age is within no bound
    top = (F.when(F.col("start_age").isNull() & F.col("end_age").isNull(), F.col("places"))
           .otherwise(through("ages", "end_age")))
    box = (at.join(axes, "month")
           .select("set_id", "month", below("dates", "start_date").alias("d0"), through("dates", "end_date").alias("d1"),
                   below("ages", "start_age").alias("a0"), top.alias("a1"))
           .filter("d0 < d1 and a0 < a1"))
    corner = lambda d, a, sign: F.struct(F.col(d).alias("d"), F.col(a).alias("a"), F.lit(sign).alias("sign"))
    corners = F.array(corner("d1", "a1", 1), corner("d0", "a1", -1), corner("d1", "a0", -1), corner("d0", "a0", 1))
    return box.select("set_id", "month", F.inline(corners)).filter("d > 0 and a > 0")


def condition_set_counts(actions: DataFrame, users: DataFrame, sets: DataFrame,
                         set_id: str = "set_id", params: str = "params") -> DataFrame:
    """A1 + A2 for each set: (set_id, category_id, click_count, order_count, pay_count).

    Equal to ``category_counts_for_users`` with each row's conditions; rows of
    ``sets`` with the same id add up. Sets and reduced actions meet by month,
    an equi-join, at the corners of the dates and ages that the bounds span (an
    inclusion-exclusion of four sums). A set enters only the months from the
    first to the last that the actions have, so an open bound costs no more
    than a wide one.
    """
    bounds = condition_bounds(sets, set_id, params)
    counts = [f"{k}_count" for k in KINDS]
    per_user = category_pivot(category_events(_in_some_span(actions, bounds), keep=("user_id", "date")),
                              by=("user_id", "date"))
    facts = (per_user.join(users.select("user_id", "age"), "user_id").groupBy("age", "date", "category_id")
             .agg(*[F.sum(c).cast("bigint").alias(c) for c in counts]))
    facts = materialize(facts.withColumn("month", F.coalesce(_month("date"), F.lit(_NO_MONTH))))
    known = facts.filter(F.col("month") != _NO_MONTH)
    axes = materialize(_axes(known))
    grid = materialize(_grid(known, axes, counts))
    first, last = axes.agg(F.min("month")).scalar(), axes.agg(F.max("month")).scalar()
    at = bounds.select("*", F.greatest(_month("start_date"), first).alias("from"),
                       F.least(_month("end_date"), last).alias("to"))
    months = F.when(F.col("from") <= F.col("to"), F.sequence("from", "to"))
    by_month = _corners(at.withColumn("month", F.explode(months)).drop("from", "to"), axes)
    in_months = (by_month.join(grid, ["month", "d", "a"])
                 .select("set_id", "category_id", *[(F.col("sign") * F.col(c)).alias(c) for c in counts]))
    # odd dates have no calendar to add up along; they meet all sets as they are
    odd = facts.filter(F.col("month") == _NO_MONTH)
    inside = ((F.col("start_date").isNull() | (F.col("date") >= F.col("start_date")))
              & (F.col("end_date").isNull() | (F.col("date") <= F.col("end_date")))
              & (F.col("start_age").isNull() | (F.col("age") >= F.col("start_age")))
              & (F.col("end_age").isNull() | (F.col("age") <= F.col("end_age"))))
    in_odd = (odd.join(bounds.withColumn("month", F.explode(F.array(F.lit(_NO_MONTH)))), "month").filter(inside)
              .select("set_id", "category_id", *counts))
    found = in_months.unionByName(in_odd).groupBy("set_id", "category_id").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in counts])
    # corners may cancel out; a fact counts at least one event
    return found.filter(" or ".join(f"{c} > 0" for c in counts))


def condition_set_top(counts: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """R1 of each set: its ``n`` hot categories and their place, from ``condition_set_counts``."""
    order = [F.desc("pay_count"), F.desc("order_count"), F.desc("click_count"), F.asc("category_id")]
    return top_ranked(counts, ["set_id"], order, n, ties="row_number", rank_col="place")
