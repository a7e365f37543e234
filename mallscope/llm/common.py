"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Iterator
from types import ModuleType
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallscope.session import scratch_path

# A-Z to a-z and every ASCII byte that is neither a letter nor a digit to a
# space; bytes of multi-byte characters stay, so the words are those of
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
_ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256))


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes."""
    return text.split()


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    # NUL and friends map to the space, so split() sees only the words
    return text.translate(_ALNUM).split()


def remainder(column: str | Column, k: int) -> Column:
    """crc32(value as text) mod k; a null value counts as the empty text."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % k


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as make it differ
    from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:16]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage: a lost executor costs a re-read, not the work before.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sub_batches(batches: Iterator[pa.RecordBatch], column: str,
                max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes`` in each
    (one longer text is a batch of its own); nothing is dropped."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = np.cumsum(pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
        start = 0
        while start < n:
            base = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, base + max_bytes, side="right")))
            yield batch.slice(start, end - start)
            start = end


def worker_cache(key: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, kept in this Python worker for later tasks.

    Functions travel by value, with globals of their own in each task, so what
    is kept lives in a module entry of the worker process.
    """
    kept = sys.modules.setdefault("_mallscope_worker", ModuleType("_mallscope_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of an odd base modulo 2^64, and of its inverse."""
    kept = worker_cache("powers", dict)
    if len(kept.get("up", ())) <= n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(n + 1, base, dtype=np.uint64)
            p[0] = 1
            kept[name] = np.multiply.accumulate(p)
    return kept["up"], kept["down"]


def piece_keys(b: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each piece b[start:stop] of a byte array."""
    up, down = _powers(len(b))
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:len(b)], out=sums[1:])
    return (sums[stop] - sums[start]) * down[start]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (one to one)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_keys(texts: list[bytes], alnum: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All words of ``texts`` in turn: (number of the text, 64-bit hash).

    Words as ``space_words`` or, with ``alnum``, ``alnum_words`` has them.
    """
    raw = b"\n".join(texts)
    b = np.frombuffer(raw.translate(_ALNUM) if alnum else raw, dtype=np.uint8)
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = ~_IS_SPACE[b]
    edge = np.diff(inside)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    of = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
    return of, mixed(piece_keys(b, start, stop))


def release() -> None:
    """Give memory that Python no longer uses back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``task``, giving the memory it used back to the system when it ends: a
    Python worker waits beside the JVM for its next task, perhaps a long time."""
    def run(batches):
        try:
            yield from task(batches)
        finally:
            release()
    return run


#: Bytes that Spark hands to a Python worker at once; a longer text is a batch
#: of its own. Spark's default of 64 MB costs several times that beside the heap.
BATCH_BYTES = 8 << 20


def in_arrow(df: DataFrame, task, schema: str | T.StructType) -> DataFrame:
    """``df.mapInArrow`` with bounded batches and a tidy end.

    The batch size is a session setting and stays lowered for later queries.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    return df.mapInArrow(tidy(task), schema)
