"""Sequence packing along a space-filling curve.

Every document becomes a point: the mean of its words' hashed vectors in a few
dimensions. Documents are range-sorted by the point's Hilbert key, so that
neighbours on the curve are alike, and laid end to end along it, cut every
``seq_len`` ids. A task packs one range of the curve; its last ids go to
sequences whose lengths are powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.llm.common import in_arrow, mixed, sub_batches, text_bytes, word_keys
from mallscope.llm.tokens import TOKENIZER, TextEncoder, packed

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert indexes of integer points (n, dims) with ``bits`` bits a side.

    The transpose form of the index: undo the excess rotations from the top
    bit down, Gray-encode, then interleave the bits.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _key_task(dims: int, bits: int, spread: float):
    def run(batches):
        side = 1 << bits
        for batch in sub_batches(batches, "text"):
            of, key = word_keys(batch.column("text").to_pylist())
            n = np.maximum(np.bincount(of, minlength=batch.num_rows), 1)
            points = []
            for d in range(dims):       # 16 bits of the word's hash a dimension
                if d % 4 == 0:
                    key = mixed(key + np.uint64(d))
                lane = ((key >> np.uint64(16 * (d % 4))) & np.uint64(0xFFFF)).astype(np.float64) / 32767.5 - 1
                mean = np.bincount(of, weights=lane, minlength=batch.num_rows) / n
                points.append(np.clip(np.floor((np.tanh(mean / spread) + 1) * side / 2), 0, side - 1))
            curve = hilbert_key(np.stack(points, axis=1), bits)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(curve)],
                                             names=["doc_id", "text", "curve"])
    return run


def curve_keys(docs: DataFrame, dims: int = 4, bits: int = 12, spread: float = 0.1) -> DataFrame:
    """doc_id, text (UTF-8 bytes, null as empty) and ``curve``, the Hilbert key
    of the document's projected mean word vector (``dims`` times ``bits`` is at
    most 62)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    return in_arrow(rows, _key_task(dims, bits, spread), "doc_id bigint, text binary, curve bigint")


def _pack_task(tokenizer: str, end_id: int, seq_len: int):
    def run(batches):
        encoder = TextEncoder.of_worker(tokenizer)
        first = TaskContext.get().partitionId() << 32
        done = 0            # sequences that are full
        held: list[tuple] = []      # (doc_id, start, ids, doc_tokens) of the sequence being filled
        held_n = 0

        def out(pieces, cuts):
            # pieces: (doc_id, start, ids, doc_tokens) laid end to end from 0;
            # cuts: lengths of the sequences they fill
            nonlocal done
            rows = []
            edge, room, offset = 0, cuts[0], 0
            for doc_id, start, ids, doc_tokens in pieces:
                at, n = 0, len(ids) // 4
                while at < n:
                    if not room:
                        edge, offset = edge + 1, 0
                        room = cuts[edge]
                    take = min(room, n - at)
                    rows.append((doc_id, start + at, take, zlib.crc32(ids[4 * at:4 * (at + take)]),
                                 doc_tokens, first + done + edge, offset))
                    at, room, offset = at + take, room - take, offset + take
            done += len(cuts)
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in sub_batches(batches, "text"):
            ids_of = packed(*encoder.encode(batch.column("text").to_pylist(), end_id))
            pieces, n = held, held_n
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of, strict=True):
                pieces.append((doc_id, 0, ids, len(ids) // 4))
                n += len(ids) // 4
            full, rest = divmod(n, seq_len)
            held, held_n = [], rest
            # what lies beyond the last full sequence waits for the next batch
            while rest:
                doc_id, start, ids, doc_tokens = pieces.pop()
                size = len(ids) // 4
                if size > rest:
                    pieces.append((doc_id, start, ids[:4 * (size - rest)], doc_tokens))
                    start, ids, size = start + size - rest, ids[4 * (size - rest):], rest
                held.insert(0, (doc_id, start, ids, doc_tokens))
                rest -= size
            if full:
                yield out(pieces, [seq_len] * full)
        if held:
            yield out(held, [1 << b for b in range(held_n.bit_length() - 1, -1, -1) if held_n >> b & 1])
    return run


def pack_along_curve(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = 1,
                     seq_len: int = 2048, dims: int = 4, bits: int = 12) -> DataFrame:
    """Pieces of documents in sequences of ``seq_len`` ids.

    Each row of ``docs`` is one document, also where rows repeat. A null or
    empty text is the end id alone; a null doc_id is kept as null; an empty
    table gives no rows. Equal points are ordered by a hash of doc_id and
    text, so a large group of copies still spreads over many ranges. Only
    ``doc_id`` and ``text`` are read, whatever other columns there are.
    ``sequence_id`` is the range's number times 2^32 plus a running number.
    """
    keyed = curve_keys(docs, dims, bits).withColumn("tie", F.xxhash64("doc_id", "text"))
    ordered = (keyed.repartitionByRange("curve", "tie")
               .sortWithinPartitions("curve", "tie").select("doc_id", "text"))
    return in_arrow(ordered, _pack_task(tokenizer, end_id, seq_len), PIECES)
