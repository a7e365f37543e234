"""Documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns what the next one works on:
the columns of ``documents``, but for the last, which returns the pieces of the
packed sequences. A stage works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mallscope.llm.common import unused, written
from mallscope.llm.decontam import contamination
from mallscope.llm.host_rules import keep_good
from mallscope.llm.packing import pack_along_curve
from mallscope.llm.secrets import redact
from mallscope.llm.simhash_dedup import drop_near_duplicates


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` without the rows of ``rejected`` (doc_id, text_hash).

    The rejected rows are written first: a small table is then broadcast by
    Spark's own threshold.
    """
    d, h = unused(docs, "__d", "__h")
    gone = written(rejected.select(F.col("doc_id").alias(d), F.col("text_hash").alias(h)).distinct(), "rejected")
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.join(gone, F.col("doc_id").cast("bigint").eqNullSafe(F.col(d)) & (text_hash == F.col(h)),
                     "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or whose host's rate speaks against
    them, go; all others stay as they are."""
    return keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one of the
    smallest doc_id."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go."""
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found.filter("contaminated"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are masked and ``n_chars``
    follows."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids in sequences of 2048, along a space-filling curve."""
    return pack_along_curve(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("packing", packing),
]

# fingerprints, components and token ids are beyond SQL; the tests compare
# run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet to the
    shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
