"""Results written as SQL text over tables or views of the usual names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mallscope.constants import OTHER_LABEL, TOP_CITIES, TOP_PRODUCTS
from mallscope.functions.sql import register_shares
from mallscope.plans.retail import DEFAULT_TASK_ID

AREA_PRODUCT_TOP = """
SELECT :task_id AS task_id, area, product_name, product_count, city_click_ratio
FROM (SELECT *, rank() OVER (PARTITION BY area ORDER BY product_count DESC) AS place
      FROM area_product_shares({k}, '{other}'))
WHERE place <= :n"""


def area_product_top3_sql(spark: SparkSession, task_id: str = DEFAULT_TASK_ID) -> DataFrame:
    """R4 as SQL text; ``user_visit_action``, ``city_info`` and ``product_info``
    must exist as tables or views."""
    register_shares(spark)
    text = AREA_PRODUCT_TOP.format(k=TOP_CITIES, other=OTHER_LABEL)
    return spark.sql(text, args={"task_id": task_id, "n": TOP_PRODUCTS})
