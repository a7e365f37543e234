"""Token ids in ORC files.

Documents are range-sorted by id, encoded and written as ORC: integer
run-length encoded ids, stripes that tasks read in parallel, row indexes and a
Bloom filter on ``doc_id`` so that a look-up reads only matching stripes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mallscope.llm.common import in_arrow, sub_batches, text_bytes, written
from mallscope.llm.tokens import TOKENIZER, TextEncoder

# ``part`` numbers the ranges in doc_id order; file names say nothing about it
FILE_SCHEMA = "part int, doc_id bigint, n_tokens bigint, start_in_part bigint, ids array<int>"


def _encode_task(tokenizer: str, end_id: int):
    def run(batches):
        encoder, at, part = TextEncoder.of_worker(tokenizer), 0, TaskContext.get().partitionId()
        for batch in sub_batches(batches, "text"):
            flat, n = encoder.encode(batch.column("text").to_pylist(), end_id)
            ends = np.cumsum(n)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                           pa.array(flat.view("<i4")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, dtype=np.int32)), batch.column("doc_id"), pa.array(n),
                 pa.array(at + ends - n), ids],
                names=["part", "doc_id", "n_tokens", "start_in_part", "ids"])
            at += int(ends[-1])
    return run


def write_token_orc(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = 2,
                    stripe_bytes: int = 64 << 20, index_stride: int = 2_000,
                    bloom_fpp: float = 0.01) -> None:
    """Encode ``docs`` (doc_id, text) and write them in ascending doc_id order.

    ``part`` ascends with doc_id, and so do the rows of a part. A null text
    is empty (the end id alone); a null doc_id sorts first; rows that share a
    doc_id stay side by side in the order of a hash of their texts. An empty
    table gives files without rows. Only ``doc_id`` and ``text`` are read, so
    further columns of any name don't matter.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    # the texts are shuffled, not the ids, which take more room
    rows = (rows.repartitionByRange("doc_id", "tie")
            .sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))
    (in_arrow(rows, _encode_task(tokenizer, end_id), FILE_SCHEMA)
     .write.option("compression", "zstd").option("orc.stripe.size", str(stripe_bytes))
     .option("orc.create.index", "true").option("orc.row.index.stride", str(index_stride))
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", str(bloom_fpp))
     .orc(path))


def read_token_orc(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids from the files of ``write_token_orc``.

    ``doc_ids`` is pushed to the scan, where stripe statistics, row indexes
    and Bloom filters skip what can't match. ``start`` counts the ids of all
    documents before it over all files.
    """
    files = spark.read.schema(FILE_SCHEMA).orc(path)
    # one row per part: its size, then where it begins; written, so that the
    # planner knows how small it is and the ids need no shuffle to meet it
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    base = written(totals.select("part", F.expr(
        "coalesce(sum(size) over (order by part rows between unbounded preceding and 1 preceding), 0)"
    ).alias("base")), "orc-bases")
    if doc_ids is not None:
        files = files.filter(F.col("doc_id").isin([int(x) for x in doc_ids]))
    return files.join(base, "part").select(
        "doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")


def _digest_task(batches):
    for batch in batches:
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy()
        values = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(offsets).astype(np.int64)),
             pa.array(crc, type=pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids as read."""
    return in_arrow(
        tokens.select("doc_id", "start", "ids"), _digest_task, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
