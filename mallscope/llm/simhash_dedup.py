"""Near-duplicates by SimHash fingerprints and a segment-popcount grid.

A 64-bit fingerprint is cut into 16 segments of 4 bits; their bit counts are a
point in a 16-dimensional grid. The Manhattan distance of two points is at
most the Hamming distance of the fingerprints, so fingerprints within 2 bits
have points within 2, and then some grid point lies within 1 of both: each
point is entered in the cells within 1 of it, and fingerprints that share a
cell are compared exactly.

A cell that holds many fingerprints is cut finer, down to segments of one bit.
There the point is the fingerprint itself and the distances agree: all members
of a cell are within 2 bits of each other, so they are linked to the least of
them and no pairs are formed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mallscope.llm.common import in_arrow, sub_batches, text_bytes, unused, written
from mallscope.llm.components import connected_components

SEED = 42

# bit j of a byte as a count in lane j of eight byte-wide lanes
_LANES = np.array([sum((c >> j & 1) << (8 * j) for j in range(8)) for c in range(256)], dtype=np.uint64)


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of every run of ``size`` words (fewer words: of all of them)."""
    words = text.lower().split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(line, SEED)]
    stop = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    start = np.concatenate([[0], stop[:-size] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(start.tolist(), stop[size - 1:].tolist(), strict=True)]


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text (``counts`` hashes each, in turn) the bits set in over half of
    its hashes; without hashes zero."""
    out = np.zeros(len(counts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full]
    begin = np.cumsum(n) - n
    # sums of up to 255 rows fit into a byte-wide lane
    cuts = np.concatenate([np.arange(b, b + k, 255) for b, k in zip(begin.tolist(), n.tolist(), strict=True)])
    of = np.searchsorted(cuts, begin)
    for byte in range(8):
        lanes = _LANES[(hashes >> np.uint64(8 * byte)) & np.uint64(0xFF)]
        sums = np.add.reduceat(lanes, cuts)
        wide = sums.view(np.uint8).reshape(-1, 8).astype(np.int64)
        total = np.add.reduceat(wide, of, axis=0)
        bits = (2 * total > n[:, None]).astype(np.uint64) << np.arange(8, dtype=np.uint64)
        out[full] |= bits.sum(axis=1, dtype=np.uint64) << np.uint64(8 * byte)
    return out


def _fingerprint_task(size: int):
    def run(batches):
        for batch in sub_batches(batches, "text"):
            rows = [shingle_hashes(t, size) for t in batch.column("text").to_pylist()]
            counts = np.array([len(r) for r in rows], dtype=np.int64)
            flat = np.fromiter((h for r in rows for h in r), dtype=np.uint64, count=int(counts.sum()))
            prints = majority_bits(flat, counts).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(prints)],
                                             names=["doc_id", "text_hash", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, text_hash (XXH64 of the text) and fp, the 64-bit SimHash as a
    signed number, one row per row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text_bytes().alias("text"))
    return in_arrow(rows, _fingerprint_task(shingle), "doc_id bigint, text_hash bigint, fp bigint")


def popcount_point(fp: Column) -> Column:
    """Bit counts of the 16 segments of 4 bits, one in each hex digit."""
    odd = F.lit(0x5555555555555555)
    a, b = fp.bitwiseAND(odd), F.shiftrightunsigned(fp, 1).bitwiseAND(odd)
    # two-bit sums without a carry into the sign
    two = a.bitwiseXOR(b).bitwiseOR(F.shiftleft(a.bitwiseAND(b), 1))
    low = F.lit(0x3333333333333333)
    return two.bitwiseAND(low) + F.shiftrightunsigned(two, 2).bitwiseAND(low)


def _cells_within_one(point: Column) -> Column:
    """The grid point and those that differ by one in one coordinate (0 to 4)."""
    cells = [point]
    for k in range(16):
        digit = F.shiftrightunsigned(point, 4 * k).bitwiseAND(F.lit(15))
        one = F.lit(1 << (4 * k)).cast("bigint")
        cells.append(F.when(digit < 4, point + one))
        cells.append(F.when(digit > 0, point - one))
    return F.array_compact(F.array(*cells))


def near_links(prints: DataFrame, hot_cell: int = 64) -> DataFrame:
    """Links (a, b) between the distinct values of ``fp`` whose graph has the
    same components as the graph of all pairs within 2 differing bits.

    Every link is checked by its Hamming distance. Cells of at most
    ``hot_cell`` fingerprints are compared pairwise, larger ones cut finer.
    """
    entries = prints.select("fp").distinct().select("fp", popcount_point(F.col("fp")).alias("point")).select(
        "fp", F.explode(_cells_within_one(F.col("point"))).alias("cell"))
    # counting combines on the map side, so that a large cell is one row a task
    counts = entries.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(entries.join(counts, "cell"), "cells")
    small = shared.filter(F.col("n") <= hot_cell).select("cell", "fp")
    other = small.select("cell", F.col("fp").alias("other"))
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    pairs = (small.join(other, "cell").filter((F.col("fp") < F.col("other")) & (apart <= 2))
             .select(F.col("fp").alias("a"), F.col("other").alias("b")))
    fine = shared.filter(F.col("n") > hot_cell).select("fp").distinct()
    bits = F.array(F.lit(0).cast("bigint"), *(F.lit((1 << k) - ((1 << 64) if k == 63 else 0)).cast("bigint")
                                              for k in range(64)))
    balls = fine.select("fp", F.explode(bits).alias("bit")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("cell"))
    least = balls.groupBy("cell").agg(F.min("fp").alias("least"), F.count("*").alias("n")).filter("n > 1")
    stars = (balls.join(least, "cell").filter(F.col("fp") != F.col("least"))
             .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("least"))) <= 2)
             .select(F.col("least").alias("a"), F.col("fp").alias("b")))
    return pairs.union(stars).distinct()


def simhash_components(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fp and component_id.

    Fingerprints link at 2 or fewer differing bits (the grid's cells are made
    for that distance); ``component_id`` is the smallest doc_id reachable,
    itself included. Texts without words, null ones among them, have the
    fingerprint zero and link like any other; a null doc_id is no component's
    id unless the component has no other; repeated rows are in one component;
    an empty table gives no rows. Columns beside doc_id and text aren't read.
    """
    rows = written(fingerprints(docs, shingle), "fingerprints")
    # copies are one node: their number doesn't matter from here on
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = connected_components(near_links(prints))
    of = (prints.join(roots, F.col("fp") == F.col("node"), "left")
          .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    of = written(of, "print-roots")
    ids = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(of.select("fp", "root").join(ids, "root"), "print-components")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row of each component stays, that of the smallest doc_id; columns as before.

    Of several such rows the one with the least text hash stays, and of rows
    that agree in doc_id and text the one whose other columns are least as
    JSON text. A null doc_id comes after all others; null, empty and blank
    texts are near duplicates of each other; an empty table gives no rows.
    Further columns may have any name.
    """
    d, h, group, again_, row = unused(docs, "__d", "__h", "__root", "__again", "__row")
    found = simhash_components(docs, shingle)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("first")
    keep = found.groupBy("root").agg(first).select(
        F.col("first.doc_id").alias(d), F.col("first.text_hash").alias(h), F.col("root").alias(group))
    times = found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).filter("n > 1")
    keep = written(keep.join(times, F.col(d).eqNullSafe(F.col("doc_id")) & (F.col(h) == F.col("text_hash")), "left")
                   .select(d, h, group, F.col("n").isNotNull().alias(again_)), "kept")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.join(keep, F.col("doc_id").cast("bigint").eqNullSafe(F.col(d)) & (F.xxhash64(text) == F.col(h)))
    once = rows.filter(~F.col(again_))
    # rows that occur more than once word for word: few, so only they are shuffled again
    order = F.to_json(F.struct(*[c for c in docs.columns if c != "text"]), {"ignoreNullFields": "false"})
    least = F.min_by(F.struct(*docs.columns), order).alias(row)
    again = rows.filter(again_).groupBy(group).agg(least).select(f"{row}.*")
    return once.select(*docs.columns).unionAll(again)
