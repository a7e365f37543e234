"""Vector codes by Lloyd's rounds over two trees.

A vector is cut into parts; each part position has a codebook, and a vector's
code is the number of the nearest entry in each. Rounds run per block of rows:
a balanced tree over the block's parts (nodes split at the middle of their
widest component) meets a tree over the codebook's entries. For a pair of
nodes the least and the greatest distance between their boxes are exact
integers; an entry node whose least distance exceeds the smallest greatest one
of its part node is pruned. A part node left with one entry goes to it whole,
with the node's cached sum; leaves that stay uncertain compare their parts
with the entries left, in integers.

Blocks are written once, in tree order, and read by every round. A round sends
(part, entry, component) sums of a task, the driver sees the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.llm.common import in_arrow, written
from mallscope.llm.vectors import as_matrix, in_blocks, integers, is_vector, longest

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Components (4 bytes each) of a block of vectors.
BLOCK_COMPONENTS = 1 << 20
LEAF = 24


def middle_splits(points: np.ndarray, leaf: int) -> tuple[np.ndarray, int]:
    """(row numbers in tree order, depth) of a balanced tree over the rows.

    Level ``k`` cuts the order into 2**k runs of almost equal length
    (``runs``); the run of a node is that of its two children.
    """
    n = len(points)
    depth = max(0, int(np.ceil(np.log2(max(1, n / leaf)))))
    order = np.arange(n)
    for level in range(depth):
        start = runs(n, level)
        own = points[order]
        spread = np.maximum.reduceat(own, start[:-1]) - np.minimum.reduceat(own, start[:-1])
        node = np.repeat(np.arange(len(start) - 1), np.diff(start))
        value = own[np.arange(n), spread.argmax(axis=1)[node]]
        order = order[np.lexsort((value, node))]
    return order, depth


def runs(n: int, level: int) -> np.ndarray:
    """Bounds of the 2**level runs of n rows."""
    # doubling a bound's number keeps it: a parent's run is its children's
    return (np.arange((1 << level) + 1) * n) >> level


def boxes(points: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(least, greatest) components of the nodes of each level, leaves first made."""
    n = len(points)
    start = runs(n, depth)[:-1]
    out = [(np.minimum.reduceat(points, start), np.maximum.reduceat(points, start))]
    for _ in range(depth):
        low, high = out[-1]
        out.append((np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2])))
    return out[::-1]


def box_bounds(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance between boxes a[i] and b[j]."""
    (alow, ahigh), (blow, bhigh) = (a[0][i], a[1][i]), (b[0][j], b[1][j])
    gap = np.maximum(0, np.maximum(blow - ahigh, alow - bhigh))
    span = np.maximum(bhigh - alow, ahigh - blow)
    return (gap * gap).sum(axis=1), (span * span).sum(axis=1)


def beaten(box: tuple, entries: np.ndarray, p: np.ndarray, entry: np.ndarray, rank: np.ndarray,
           single: np.ndarray) -> np.ndarray:
    """Whether another entry is nearer to the whole of box p than ``entry``.

    The other one is the pair of the box with the smallest ``rank``. Two
    squared distances of a point differ by a linear function of it, whose
    least value over a box is exact.
    """
    by = np.lexsort((rank, ~single, p))
    first = by[np.r_[True, np.diff(p[by]) > 0]] if len(by) else by
    rival = np.zeros(len(box[0]), dtype=np.int64)
    rival[p[first]] = entry[first]
    b = entries[rival[p]]
    step = entries[entry] - b
    reach = np.where(step > 0, box[1][p], box[0][p])
    return ((entries[entry] ** 2).sum(axis=1) - (b ** 2).sum(axis=1) - 2 * (reach * step).sum(axis=1)) > 0


def assign(points: np.ndarray, depth: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The nearest entry of every point (in tree order), ties to the lower one.

    Returns (entry of each point, whether it was decided with a whole node,
    first rows of those nodes, their lengths).
    """
    n, number = len(points), len(entries)
    eorder, edepth = middle_splits(entries, 1)
    pboxes, eboxes = boxes(points, depth), boxes(entries[eorder], edepth)
    erun = runs(number, edepth)
    entry = np.zeros(n, dtype=np.int64)
    whole = np.zeros(n, dtype=bool)
    firsts, lengths = [], []
    # alive pairs of a part node and an entry node, and a bound of each part
    # node on the distance of its parts to their nearest entry
    p, e = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    bound = np.full(1, np.iinfo(np.int64).max)
    plevel = elevel = 0
    while True:
        low, high = box_bounds(pboxes[plevel], eboxes[elevel], p, e)
        np.minimum.at(bound, p, high)
        near = low <= bound[p]
        p, e = p[near], e[near]
        if elevel == edepth:
            single = np.diff(erun)[e] == 1
            near = ~(single & beaten(pboxes[plevel], entries, p, eorder[erun[e]], low[near] + high[near], single))
            p, e = p[near], e[near]
            # a part node with one entry left is decided
            left = np.bincount(p, minlength=len(bound))
            decided = (left[p] == 1) & (np.diff(erun)[e] == 1)
            start = runs(n, plevel)
            for node, to in zip(p[decided], eorder[erun[e[decided]]], strict=True):
                entry[start[node]:start[node + 1]] = to
                whole[start[node]:start[node + 1]] = True
                firsts.append(start[node])
                lengths.append(start[node + 1] - start[node])
            p, e = p[~decided], e[~decided]
            if plevel == depth or not len(p):
                break
        # the entries' tree is shallow: two levels of it to one of the parts'
        for _ in range(min(2, edepth - elevel)):
            p, e = np.repeat(p, 2), np.repeat(2 * e, 2)
            e[1::2] += 1
            elevel += 1
        if plevel < depth:
            p, e = np.repeat(2 * p, 2), np.repeat(e, 2)
            p[1::2] += 1
            bound = np.repeat(bound, 2)
            plevel += 1
    if len(p):
        # uncertain leaves: each part against each entry left, in integers
        start = runs(n, depth)
        by = np.lexsort((e, p))
        p, e = p[by], eorder[erun[e[by]]]
        size = np.diff(start)[p]
        row = np.repeat(start[p], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        to = np.repeat(e, size)
        d = points[row] - entries[to]
        d = (d * d).sum(axis=1)
        best = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(best, row, d)
        tied = d == best[row]
        choice = np.full(n, number)
        np.minimum.at(choice, row[tied], to[tied])
        entry[choice < number] = choice[choice < number]
    return entry, whole, np.array(firsts, dtype=np.int64), np.array(lengths, dtype=np.int64)


def block_sums(points: np.ndarray, depth: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(count, sum of components) of the parts of each entry."""
    entry, whole, first, length = assign(points, depth, entries)
    counts = np.bincount(entry, minlength=len(entries))
    sums = np.zeros_like(entries)
    np.add.at(sums, entry[~whole], points[~whole])
    if len(first):
        # a node's cached sum: the difference of two running sums
        running = np.zeros((len(points) + 1, points.shape[1]), dtype=np.int64)
        np.cumsum(points, axis=0, out=running[1:])
        np.add.at(sums, entry[first], running[first + length] - running[first])
    return counts, sums


def _build(dim: int, parts: int, rows: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in in_blocks(batches, rows):
            cut = as_matrix(block.column(1), dim).reshape(block.num_rows, parts, dim // parts)
            orders, points, depth = [], [], 0
            for k in range(parts):
                order, depth = middle_splits(cut[:, k], LEAF)
                orders.append(order)
                points.append(cut[order, k])
            yield pa.RecordBatch.from_pydict({
                "n": pa.array([block.num_rows], pa.int32()), "depth": pa.array([depth], pa.int32()),
                "keys": pa.array([_packed(block.select([0, 2]))], pa.binary()),
                "orders": pa.array([np.array(orders, dtype=np.int32).tobytes()], pa.binary()),
                "points": pa.array([np.array(points, dtype=np.int32).tobytes()], pa.binary())})
    return task


def _packed(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _blocks(batches: Iterator[pa.RecordBatch], parts: int, dim: int):
    for batch in batches:
        for n, depth, keys, orders, points in zip(*batch.columns, strict=True):
            n = n.as_py()
            yield (n, depth.as_py(), keys.as_py(), np.frombuffer(orders.as_py(), dtype=np.int32).reshape(parts, n),
                   np.frombuffer(points.as_py(), dtype=np.int32).reshape(parts, n, dim // parts).astype(np.int64))


def _round(books: np.ndarray, dim: int):
    parts, number, width = books.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, number), dtype=np.int64), np.zeros_like(books)
        for _, depth, _, _, points in _blocks(batches, parts, dim):
            for k in range(parts):
                c, s = block_sums(points[k], depth, books[k])
                counts[k] += c
                sums[k] += s
        at = np.flatnonzero(counts.ravel())
        yield pa.RecordBatch.from_pydict({
            "slot": np.repeat(at, width).astype(np.int32),
            "component": np.tile(np.arange(width, dtype=np.int32), len(at)),
            "n": np.repeat(counts.ravel()[at], width), "total": sums.reshape(-1, width)[at].ravel()})
    return task


def _final(books: np.ndarray, dim: int):
    parts = len(books)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, depth, keys, orders, points in _blocks(batches, parts, dim):
            codes, error = np.zeros((n, parts), dtype=np.uint8), np.zeros(n, dtype=np.int64)
            for k in range(parts):
                entry = assign(points[k], depth, books[k])[0]
                d = points[k] - books[k][entry]
                codes[orders[k], k] = entry
                error[orders[k]] += (d * d).sum(axis=1)
            own = pa.ipc.open_stream(keys).read_all().combine_chunks()
            text = codes.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [own.column(0).combine_chunks(), own.column(1).combine_chunks(),
                 pa.array([text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)], pa.string()),
                 pa.array(error)], names=["vec_id", "label", "code", "error"])
    return task


def codebooks_text(books: np.ndarray) -> str:
    """All components as decimal integers by part, entry, position."""
    return ",".join(map(str, books.ravel().tolist()))


def vector_codes(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector.

    Rows with a null vector or a null or non-finite component go. Components
    become floor(256 * x); a vector shorter than the longest counts as filled
    up with zeros, to a multiple of ``parts``. The codebooks start as the parts
    of the ``entries`` (at most 256) rows of the smallest vec_id, null ids
    last, rows of one id by their vector; with fewer rows they are shorter.
    Repeated rows count each. Equal distances go to the lower entry; an entry
    that no part goes to stays. ``label_error`` sums ``error`` over rows of one
    label, null being one. Further columns are ignored; an empty table gives no
    rows. A component of 2**18 or more is refused.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be in 1..256 (two hex digits)")
    spark = embeddings.sparkSession
    rows = (embeddings.select("vec_id", "embedding", "label").filter(is_vector("embedding"))
            .select("vec_id", integers("embedding").alias("v"), "label"))
    dim = max(parts, -(-longest(rows, "v") // parts) * parts)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    books = np.array([[*r[0], *[0] * (dim - len(r[0]))] for r in first], dtype=np.int64)
    books = books.reshape(len(first), parts, dim // parts).transpose(1, 0, 2).copy()
    blocks = written(in_arrow(rows, _build(dim, parts, max(64, BLOCK_COMPONENTS // dim)),
                              "n int, depth int, keys binary, orders binary, points binary"), "code-blocks")
    for _ in range(rounds if len(first) else 0):
        sums = in_arrow(blocks, _round(books, dim), "slot int, component int, n bigint, total bigint")
        # at most one number a codebook component comes back
        for r in sums.groupBy("slot", "component").agg(F.sum("n"), F.sum("total")).collect():
            books.reshape(-1, dim // parts)[r[0], r[1]] = r[3] // r[2]
    types = dict(rows.dtypes)
    coded = written(in_arrow(blocks, _final(books, dim),
                             f"vec_id {types['vec_id']}, label {types['label']}, code string, error bigint"), "codes")
    by_label = written(coded.groupBy(F.col("label").alias("__label")).agg(
        F.sum("error").cast("bigint").alias("label_error")), "label-errors")
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("__label")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
