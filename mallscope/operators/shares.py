"""The "top items with their share, plus the rest" text.

For each group the ``k`` items with most rows are printed as
``item:pct%`` (one decimal, halves up), followed by the remainder label with
``100`` minus those rounded shares (itself rounded; it can be ``-0.1``). The
remainder entry is always present, even when the group has one item.

Built from built-ins only (no Python aggregate, which would lose partial
aggregation): counts per (group, item) -> group total and item rank in one
window over the already-aggregated rows -> the top ``k`` collected (at most
``k`` per group) -> text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mallscope.constants import OTHER_LABEL, TOP_CITIES
from mallscope.functions.scalars import double_text, half_up_tenth, percent_tenth


def item_counts(rows: DataFrame, group: list[str], item: str, n: str = "n") -> DataFrame:
    """Rows -> count per (group..., item); map-side partial aggregation."""
    return rows.groupBy(*group, item).agg(F.count(F.lit(1)).alias(n))


def top_share_text(counts: DataFrame, group: list[str], item: str, n: str = "n",
                   k: int = TOP_CITIES,
                   other: str = OTHER_LABEL, out: str = "share_text",
                   total: str = "total") -> DataFrame:
    """(group..., item, n) -> (group..., total, share_text).

    Ties for the top ``k`` go to the smaller item text. A null item prints
    as ``null``.
    """
    w_all = Window.partitionBy(*group)
    w_rank = Window.partitionBy(*group).orderBy(F.desc(n), F.asc_nulls_first(item))
    r = counts.select(*group, item, n,
                      F.sum(n).over(w_all).alias("__t"),
                      F.row_number().over(w_rank).alias("__rn"))
    top = (r.filter(F.col("__rn") <= k)
            .select(*group, "__t", "__rn",
                    F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("__item"),
                    percent_tenth(n, "__t").alias("__pct")))
    agg = top.groupBy(*group).agg(
        F.max("__t").alias(total),
        F.array_sort(F.collect_list(F.struct("__rn", "__item", "__pct"))).alias("__top"))
    parts = F.transform("__top", lambda x: F.concat(x["__item"], F.lit(":"),
                                                   double_text(x["__pct"]), F.lit("%")))
    rest = F.aggregate(F.col("__top"), F.lit(100.0), lambda acc, x: acc - x["__pct"])
    text = F.concat(F.array_join(parts, ","), F.lit("," + other + ":"),
                    double_text(half_up_tenth(rest)), F.lit("%"))
    return agg.select(*group, F.col(total).cast("bigint").alias(total), text.alias(out))
