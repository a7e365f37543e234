"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mallscope.llm.common import remainder, scratch
from mallscope.llm.decontam import contamination
from mallscope.llm.hard_negatives import hard_negatives
from mallscope.llm.host_rules import judge
from mallscope.llm.licenses import license_scan
from mallscope.llm.main_text import extract_main_text
from mallscope.llm.ngram_lm import score_documents
from mallscope.llm.oracle_sql import ORACLE_SQL
from mallscope.llm.packing import pack_along_curve
from mallscope.llm.secrets import secret_report
from mallscope.llm.sharding import shard_documents
from mallscope.llm.simhash_dedup import hex_digits, simhash_components
from mallscope.llm.token_orc import read_token_orc, token_digests, write_token_orc
from mallscope.llm.toxicity import toxicity
from mallscope.llm.vector_codes import vector_codes


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def op1_ngram_lm(spark: SparkSession, d: str) -> DataFrame:
    scored = score_documents(_documents(spark, d), lambda c: remainder(c, 10) != 0, order=3)
    return scored.withColumn("held_out", remainder("doc_id", 10) == 0)


def op2_simhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    found = simhash_components(_documents(spark, d))
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op3_toxicity(spark: SparkSession, d: str) -> DataFrame:
    labels = spark.read.parquet(f"{d}/labels.parquet")
    scored = toxicity(_documents(spark, d), labels, lambda c: remainder(c, 5) != 0)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op4_curve_packing(spark: SparkSession, d: str) -> DataFrame:
    return pack_along_curve(_documents(spark, d))


def op5_token_orc(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "token-orc")
    write_token_orc(_documents(spark, d), path)
    return token_digests(read_token_orc(spark, path))


def op6_secrets(spark: SparkSession, d: str) -> DataFrame:
    return secret_report(_documents(spark, d)).drop("text_hash")


def op7_host_rules(spark: SparkSession, d: str) -> DataFrame:
    return judge(_documents(spark, d)).drop("host_rate")


def op8_licenses(spark: SparkSession, d: str) -> DataFrame:
    return license_scan(_documents(spark, d))


def op9_main_text(spark: SparkSession, d: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{d}/pages.parquet"))


def op10_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return contamination(_documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet")).drop("text_hash")


def op11_sharding(spark: SparkSession, d: str) -> DataFrame:
    return shard_documents(_documents(spark, d), 40)


def op12_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives(spark.read.parquet(f"{d}/embeddings.parquet"), F.col("vec_id") % 100 == 0, label)


def op13_vector_codes(spark: SparkSession, d: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{d}/embeddings.parquet"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_ngram_lm, op2_simhash_dedup, op3_toxicity, op4_curve_packing, op5_token_orc, op6_secrets, op7_host_rules, op8_licenses, op9_main_text,
        op10_decontamination, op11_sharding, op12_hard_negatives, op13_vector_codes)}


def llm_oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
