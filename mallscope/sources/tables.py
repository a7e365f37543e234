"""Logical table schemas, table loading and schema conforming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

USER_VISIT_ACTION = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
    # added: a unique tie-break for ordering actions inside one second
    T.StructField("event_id", T.LongType()),
])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("gender", T.StringType()),
])

PRODUCT_INFO = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

CITY_INFO = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("area", T.StringType()),
])

ADS_LOG = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("area", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("userid", T.StringType()),
    T.StructField("adid", T.StringType()),
    T.StructField("event_id", T.LongType()),
])

SCHEMAS = {
    "user_visit_action": USER_VISIT_ACTION,
    "user_info": USER_INFO,
    "product_info": PRODUCT_INFO,
    "city_info": CITY_INFO,
    "ads_log": ADS_LOG,
}


def conform(df: DataFrame, schema: T.StructType, strict: bool = True,
            on_misfit: str | None = None) -> DataFrame:
    """Bind a DataFrame to a declared schema by column name.

    Missing columns raise (``strict``) or become typed nulls; extra columns
    are dropped, so later stages read only the declared columns. A value that
    does not fit its declared type, or would change in it (``1.5`` as a whole
    number), fails the job with the column's name; with
    ``on_misfit="null"`` (the default of ``strict=False``) it becomes null.
    """
    if on_misfit is None:
        on_misfit = "raise" if strict else "null"
    if on_misfit not in ("raise", "null"):
        raise ValueError("on_misfit must be 'raise' or 'null'")
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f"`{f.name}`")
            if df.schema[f.name].dataType != f.dataType:
                c = _fitted(c, f, df.schema[f.name].dataType, on_misfit)
            cols.append(c.alias(f.name))
        elif strict:
            raise ValueError(f"column {f.name!r} missing; have {sorted(have)}")
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _fitted(c, field: T.StructField, have: T.DataType, on_misfit: str):
    """``c`` in the declared type; misfits are nulls or an error."""
    cast = c.try_cast(field.dataType)
    fits = cast.isNotNull()
    if isinstance(have, T.NumericType) and isinstance(field.dataType, T.IntegralType):
        fits = fits & cast.cast(have).eqNullSafe(c)
    if on_misfit == "null":
        return F.when(fits, cast)
    error = F.raise_error(F.concat(F.lit(f"column {field.name}: no {field.dataType.simpleString()}: "), c.cast("string")))
    return F.when(c.isNull(), F.lit(None)).when(fits, cast).otherwise(error).cast(field.dataType)


def load_table(spark: SparkSession, name_or_path: str,
               schema: T.StructType | None = None) -> DataFrame:
    """A catalog table by name, or a Parquet path; conformed if a schema is given.

    Reads stay lazy: filters and the column list of later stages reach the
    scan (partition pruning on partitioned tables, PushedFilters on Parquet).
    """
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        df = spark.read.parquet(name_or_path)
    else:
        df = spark.table(name_or_path)
    return conform(df, schema) if schema is not None else df
