"""X2-X5, P11 and U1 for users who write SQL text.

``register_sql`` adds temporary SQL functions to a session. Their bodies are
SQL, so Catalyst inlines them like any expression; no Python runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "half_up_tenth(x DOUBLE) RETURNS DOUBLE": "floor(x * 10D + 0.5D) / 10D",
    "percent_tenth(n BIGINT, total BIGINT) RETURNS DOUBLE": "floor(cast(n as double) * 1000D / total + 0.5D) / 10D",
    "split_ids(ids STRING) RETURNS ARRAY<STRING>": "array_remove(split(ids, ','), '')",
    "epoch_ms_to_date(ms BIGINT) RETURNS STRING":
        "cast(date_from_unix_date(cast(floor(ms / 86400000D) as int)) as string)",
    "minute_to_hhmm(minute BIGINT) RETURNS STRING":
        "format_string('%02d:%02d', pmod(floor(minute / 60D), 24L), pmod(minute, 60L))",
    # the top items in order, each with its rounded share, then the rest
    "share_line(top ARRAY<STRUCT<item: STRING, pct: DOUBLE>>, other STRING) RETURNS STRING":
        """concat(array_join(transform(top, x -> concat(coalesce(x.item, 'null'), ':', x.pct, '%')), ','),
                  ',', other, ':', half_up_tenth(aggregate(top, 100D, (rest, x) -> rest - x.pct)), '%')""",
}

# The shares of every product, over the user's own tables or views.
SHARES = """CREATE OR REPLACE TEMPORARY FUNCTION area_product_shares(k INT, other STRING)
RETURNS TABLE (area STRING, product_name STRING, product_count BIGINT, city_click_ratio STRING)
RETURN
  WITH clicks AS (
    SELECT city_id, click_product_id, count(*) AS n FROM user_visit_action GROUP BY city_id, click_product_id),
  counts AS (
    SELECT c.area, p.product_name, c.city_name, sum(a.n) AS n
    FROM clicks a JOIN city_info c ON a.city_id = c.city_id JOIN product_info p ON a.click_product_id = p.product_id
    GROUP BY c.area, p.product_name, c.city_name),
  ranked AS (
    SELECT area, product_name, city_name, n, sum(n) OVER (PARTITION BY area, product_name) AS total,
           row_number() OVER (PARTITION BY area, product_name ORDER BY n DESC, city_name) AS place
    FROM counts)
  SELECT area, product_name, max(total),
         share_line(transform(array_sort(collect_list(struct(place, city_name, percent_tenth(n, total) AS pct))),
                              x -> named_struct('item', x.city_name, 'pct', x.pct)), area_product_shares.other)
  FROM ranked WHERE place <= area_product_shares.k GROUP BY area, product_name"""


def register_sql(spark: SparkSession) -> None:
    """Register the scalar functions; ``register_shares`` adds the table function."""
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")


def register_shares(spark: SparkSession) -> None:
    """Register ``area_product_shares(k, other)``: A6 + A7 as a table function.

    It reads ``user_visit_action``, ``city_info`` and ``product_info``, which
    must exist as tables or views. Clicks are reduced per (city, product)
    before the joins, and only ``k`` cities of a product are collected.
    """
    register_sql(spark)
    spark.sql(SHARES)
