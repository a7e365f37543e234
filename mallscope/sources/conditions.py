"""Job conditions written as lenient JSON (unquoted keys) in a properties file."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONDITION_FIELDS = ["startDate", "endDate", "startAge", "endAge", "professionals", "city",
                    "gender", "keywords", "categoryIds", "targetPageFlow"]
# every field is read as text; numbers are cast where they are used
CONDITION_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in CONDITION_FIELDS])
PROPERTY_KEY = "condition.params.json"


def _to_dict(row) -> dict:
    return {k: v for k, v in row.asDict().items()}


def parse_conditions(spark: SparkSession, text: str) -> dict:
    """Lenient JSON text -> dict of condition strings (absent fields -> None)."""
    df = spark.createDataFrame([(text,)], "t string").select(
        F.from_json("t", CONDITION_SCHEMA, {"allowUnquotedFieldNames": "true",
                                            "allowSingleQuotes": "true"}).alias("c"))
    row = df.select("c.*").first()
    return _to_dict(row)


def load_conditions(spark: SparkSession, path: str, key: str = PROPERTY_KEY) -> dict:
    """Read ``key=...`` (with ``\\`` line continuations) from a properties file."""
    text = spark.read.text(path, wholetext=True).first()[0]
    joined = text.replace("\\\r\n", " ").replace("\\\n", " ")
    for line in joined.splitlines():
        k, sep, v = line.partition("=")
        if sep and k.strip() == key:
            return parse_conditions(spark, v.strip())
    raise KeyError(key)
