"""J1-J5 joins.

No broadcast is forced here: which side is broadcast is left to Spark, from
file sizes when planning and from the real shuffle sizes at run time (AQE),
both against ``spark.sql.autoBroadcastJoinThreshold``; beyond it a join
shuffles, and AQE splits a hot key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.session import scratch_path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    For a result that several plans use: computed once, its file sizes are
    real statistics for the planner, and the lineage is cut (a lost executor
    does not recompute upstream stages).
    """
    path = scratch_path(df.sparkSession, "materialized", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def click_star_join(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """Fact inner-join city and product dimensions -> (area, product_name, city_name).

    Rows whose click product has no product row (``-1`` = no click) drop out,
    as in an inner join.
    """
    c = cities.select("city_id", "city_name", "area")
    p = products.select("product_id", "product_name")
    a = actions.select("city_id", "click_product_id")
    return (a.join(c, "city_id")
             .join(p, a["click_product_id"] == p["product_id"])
             .select("area", "product_name", "city_name"))


def keep_in(df: DataFrame, column: str, keys, key_column: str | None = None) -> DataFrame:
    """Keep rows whose ``column`` is in ``keys``.

    ``keys`` is a Python list (becomes ``isin``, for short literal lists) or a
    DataFrame (becomes a left-semi join; repeated keys don't matter to it).
    """
    if isinstance(keys, DataFrame):
        k = keys.select(F.col(key_column or keys.columns[0]).alias("__k"))
        return df.join(k, df[column] == k["__k"], "left_semi")
    return df.filter(F.col(column).isin(list(keys)))


def drop_in(df: DataFrame, column: str, keys, key_column: str | None = None) -> DataFrame:
    """Drop rows whose ``column`` is in ``keys`` (left-anti join).

    Null keys in ``keys`` do not remove anything (anti-join, not NOT IN).
    """
    if isinstance(keys, DataFrame):
        k = keys.select(F.col(key_column or keys.columns[0]).alias("__k"))
        return df.join(k, df[column] == k["__k"], "left_anti")
    keys = [k for k in keys if k is not None]
    return df.filter(~F.col(column).isin(keys) | F.col(column).isNull()) if keys else df
