"""Integer vectors in binary blocks, shared by the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components beyond this (256 * x, either sign) are refused: sums of their
#: squares would leave 64 bits.
LARGEST = 1 << 26
#: Stands for a null id inside a block; sorts last.
NO_ID = (1 << 63) - 1


def is_vector(column: str) -> Column:
    """Neither null nor with a null or non-finite component."""
    ok = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(column).isNotNull() & F.coalesce(ok, F.lit(False))


def integers(column: str) -> Column:
    """floor(256 * x) of every component."""
    def whole(x):
        v = F.floor(x.cast("double") * 256)
        return F.when(F.abs(v) < LARGEST, v).otherwise(
            F.raise_error(F.lit("a vector component is too large"))).cast("int")
    return F.transform(column, whole)


def longest(df: DataFrame, column: str) -> int:
    """Components of the longest vector; 0 for an empty table."""
    return df.agg(F.max(F.size(column))).first()[0] or 0


def as_matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """The integer vectors of an Arrow list column as rows; shorter ones are
    filled up with zeros."""
    sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def longs(column: pa.Array, null: int = NO_ID) -> np.ndarray:
    return pa.compute.fill_null(column.cast(pa.int64()), null).to_numpy(zero_copy_only=False)


def in_blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches' rows, ``rows`` at a time (the last ones: fewer)."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            batch = batch.slice(part.num_rows)
            held.append(part)
            n += part.num_rows
            if n == rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
