"""Hard negatives by inner-product windows over cover trees.

A candidate x gets one more component, sqrt(M^2 - |x|^2) with M the block's
largest norm, so that all candidates of a block have norm M; a query gets a
zero there. Then |q - x|^2 = |q|^2 + M^2 - 2 q.x, and a ball around a tree
node bounds the inner products of everything below it from both sides.

Each block of rows is one cover tree, written once. Its levels are the
prefixes of one farthest-first traversal: a level's centres lie more than its
scale apart, every other centre lies within that scale of one, and each level
holds the one above it. A node's radius is the true distance to the farthest
row below it. An anchor descends level by level, drops nodes that miss all its
windows or cannot beat what it has, visits the leaves left in the order of
their upper bounds, and verifies them by exact integer products; what it has
is carried from tree to tree.

Anchors meet trees in units of (group of trees, slice of anchors): a group
bounds what a task holds, anchors are read as a stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mallscope.llm.common import in_arrow, shuffle_partitions, written
from mallscope.llm.vectors import NO_ID, as_matrix, in_blocks, integers, is_vector, longest, longs

#: Components of a tree's vectors; trees of a group; anchors of a slice.
TREE_COMPONENTS = 1 << 17
GROUP_TREES = 64
SLICE_ANCHORS = 1 << 15
#: Anchors that descend together.
ANCHOR_ROWS = 512
#: Rows of a leaf, about.
LEAF = 32
POSITIVES, NEGATIVES = 5, 10
_LOW, _HIGH = -(1 << 62), 1 << 62


class CoverTree:
    """A block's rows in leaf order, and its levels of (centre, radius, parent)."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> None:
        n = len(ids)
        norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
        self.square = float(norms.max())
        x = np.column_stack([vectors.astype(np.float64), np.sqrt(np.maximum(0, self.square - norms))])
        centres, gaps, nearest = farthest_first(x, max(1, -(-n // leaf)))
        # the prefix of centres inserted at a gap over a scale is a level
        sizes, scale = [], gaps[0] if len(gaps) else 0.0
        while scale > 0 and len(sizes) < 48:
            k = 1 + int((gaps > scale).sum())
            if not sizes or k > sizes[-1]:
                sizes.append(k)
            if k == len(centres):
                break
            scale /= 2
        if not sizes or sizes[-1] < len(centres):
            sizes.append(len(centres))
        order = np.argsort(nearest, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.leaves = np.searchsorted(nearest[order], np.arange(len(centres) + 1))
        x, at = x[order], nearest[order]
        point = x[np.argsort(order)[centres]]        # a centre keeps its number in all levels
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        up = np.arange(len(centres))                 # a leaf's ancestor in the level at hand
        for i in range(len(sizes) - 1, -1, -1):
            far = np.sqrt(((x - point[up[at]]) ** 2).sum(axis=1))
            radius = np.zeros(sizes[i])
            np.maximum.at(radius, up[at], far)
            if i:
                d = ((point[:sizes[i], None] - point[None, :sizes[i - 1]]) ** 2).sum(axis=2)
                parent = d.argmin(axis=1)
                parent[:sizes[i - 1]] = np.arange(sizes[i - 1])
            else:
                parent = np.zeros(sizes[0], dtype=np.int64)
            self.levels.insert(0, (point[:sizes[i]], radius, parent))
            up = parent[up]
        # a row's key orders rows of equal score: the smaller id first
        self.shift = max(1, int(n - 1).bit_length())
        rank = np.empty(n, dtype=np.int64)
        rank[np.lexsort((self.labels, self.ids))] = np.arange(n)
        self.late = (1 << self.shift) - 1 - rank

    def bounds(self, level: int, q: np.ndarray, q2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each query with each node."""
        point, radius, _ = self.levels[level]
        whole = q2[:, None] + self.square
        d2 = q2[:, None] + (point ** 2).sum(axis=1)[None] - 2 * (q @ point[:, :-1].T)
        d = np.sqrt(np.maximum(0, d2))
        # rounding of the bounds, far above that of doubles; scores are whole
        slack = 1 + 1e-9 * whole
        return (whole - (d + radius) ** 2) / 2 - slack, (whole - np.maximum(0, d - radius) ** 2) / 2 + slack

    def products(self, q: np.ndarray, leaf: int) -> np.ndarray:
        """Exact inner products with the rows of a leaf."""
        own = self.vectors[self.leaves[leaf]:self.leaves[leaf + 1]]
        largest = int(np.abs(q).max(initial=0)) * int(np.abs(own).max(initial=0)) * q.shape[1]
        if largest < 1 << 53:
            # sums below 2^53 are exact in doubles
            return (q.astype(np.float64) @ own.astype(np.float64).T).astype(np.int64)
        return q.astype(np.int64) @ own.astype(np.int64).T


def farthest_first(x: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(up to m centres, each one's distance to the earlier ones, nearest
    centre of every row); equal rows share a centre."""
    best = ((x - x[0]) ** 2).sum(axis=1)
    centres, gaps, nearest = [0], [], np.zeros(len(x), dtype=np.int64)
    squares = (x ** 2).sum(axis=1)
    while len(centres) < m:
        far = int(best.argmax())
        if best[far] <= 1e-6:
            break
        gaps.append(float(np.sqrt(best[far])))
        d = np.maximum(0, squares + squares[far] - 2 * (x @ x[far]))
        closer = d < best
        closer[far] = True
        best[closer] = d[closer]
        best[far] = 0
        nearest[closer] = len(centres)
        centres.append(far)
    return np.array(centres), np.array(gaps), nearest


class Search:
    """Anchors that look for the best rows of each of their windows.

    A window is (least, greatest score); a row belongs in it if its score does
    and its label is (``same``) or is not the anchor's; a row of the anchor's
    own id never does. ``found`` holds, per anchor and window, the best ``k``
    as (score, id, label).
    """

    def __init__(self, ids, labels, vectors, low, high, k: int, same: bool) -> None:
        self.ids, self.labels, self.q, self.low, self.high, self.k, self.same = ids, labels, vectors, low, high, k, same
        self.q2 = (vectors.astype(np.float64) ** 2).sum(axis=1)
        n = low.size
        self.score = np.full((n, k), _LOW)
        self.id = np.full((n, k), NO_ID)

    def visit(self, tree: CoverTree) -> None:
        q, windows = self.q.astype(np.float64), self.low.shape[1]
        alive = np.ones((len(q), len(tree.levels[0][1])), dtype=bool)
        for level in range(len(tree.levels)):
            if level:
                alive = alive[:, tree.levels[level][2]]
            least, most = tree.bounds(level, q, self.q2)
            alive &= self.wanted(least, most)
            if not alive.any():
                return
        # best first: the leaves of the highest upper bounds in the first
        # rounds, whose finds prune the later ones
        order = np.argsort(np.where(alive, -most, np.inf), axis=1, kind="stable")
        done, width = 0, 1
        while done < order.shape[1]:
            row = np.repeat(np.arange(len(q)), min(width, order.shape[1] - done))
            leaf = order[:, done:done + width].ravel()
            open_ = alive[row, leaf]
            row, leaf = row[open_], leaf[open_]
            if done and len(row):
                still = self.wanted(least[row, leaf], most[row, leaf], row)
                row, leaf = row[still], leaf[still]
            if not len(row) and not open_.any():
                return
            self.verify(tree, row, leaf, windows)
            done, width = done + width, 2 * width

    def wanted(self, least: np.ndarray, most: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
        """Whether some window could take a row of these bounds."""
        out = np.zeros(least.shape, dtype=bool)
        windows = self.low.shape[1]
        worst = self.score[:, -1].reshape(-1, windows)
        for w in range(windows):
            # a row that ties with the worst one found may win by its id
            low, high = np.maximum(self.low[:, w], worst[:, w]), self.high[:, w]
            if row is None:
                out |= (most >= low[:, None]) & (least <= high[:, None])
            else:
                out |= (most >= low[row]) & (least <= high[row])
        return out

    def verify(self, tree: CoverTree, row: np.ndarray, leaf: np.ndarray, windows: int) -> None:
        by = np.argsort(leaf, kind="stable")
        row, leaf = row[by], leaf[by]
        edges = np.r_[0, np.flatnonzero(np.diff(leaf)) + 1, len(leaf)]
        got = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a == b:
                continue
            rows, at = row[a:b], slice(tree.leaves[leaf[a]], tree.leaves[leaf[a] + 1])
            scores = tree.products(self.q[rows], leaf[a])
            fits = (tree.labels[at][None] == self.labels[rows][:, None]) == self.same
            fits &= tree.ids[at][None] != self.ids[rows][:, None]
            for w in range(windows):
                slot = rows * windows + w
                low = np.maximum(self.low[rows, w], self.score[slot, -1])
                i, j = np.nonzero(fits & (scores >= low[:, None]) & (scores <= self.high[rows, w][:, None]))
                if len(i):
                    got.append((slot[i], scores[i, j], tree.ids[at][j]))
        if got:
            self.keep(*(np.concatenate(c) for c in zip(*got, strict=True)))

    def keep(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        hit = np.unique(slot)
        slot = np.concatenate([slot, np.repeat(hit, self.k)])
        score = np.concatenate([score, self.score[hit].ravel()])
        ids = np.concatenate([ids, self.id[hit].ravel()])
        by = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[by], score[by], ids[by]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        top = place < self.k
        self.score[slot[top], place[top]] = score[top]
        self.id[slot[top], place[top]] = ids[top]


def _pack(tree: CoverTree) -> bytes:
    parts = [tree.ids, tree.labels, tree.vectors.astype(np.int32), tree.leaves.astype(np.int64)]
    for point, radius, parent in tree.levels:
        parts += [point, radius, parent.astype(np.int64)]
    out = pa.BufferOutputStream()
    head = np.array([tree.vectors.shape[1], len(tree.levels), *map(len, parts)], dtype=np.int64)
    out.write(np.array([len(head)], dtype=np.int64).tobytes() + head.tobytes() + np.float64(tree.square).tobytes())
    for p in parts:
        out.write(np.ascontiguousarray(p).tobytes())
    return out.getvalue().to_pybytes()


def _unpack(raw: bytes) -> CoverTree:
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, n, 8)
    dim, depth, at = int(head[0]), int(head[1]), 16 + 8 * n
    tree = CoverTree.__new__(CoverTree)
    tree.square = float(np.frombuffer(raw, np.float64, 1, at - 8)[0])

    def take(k: int, kind, width: int = 0) -> np.ndarray:
        nonlocal at
        number = int(head[2 + k]) * max(1, width)
        out = np.frombuffer(raw, kind, number, at)
        at += out.nbytes
        return out.reshape(-1, width) if width else out

    tree.ids, tree.labels = take(0, np.int64), take(1, np.int64)
    tree.vectors, tree.leaves = take(2, np.int32, dim), take(3, np.int64)
    tree.levels = [(take(4 + 3 * i, np.float64, dim + 1), take(5 + 3 * i, np.float64), take(6 + 3 * i, np.int64))
                   for i in range(depth)]
    return tree


def _plant(dim: int):
    rows = max(LEAF, TREE_COMPONENTS // max(1, dim))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in in_blocks(batches, rows):
            tree = CoverTree(longs(block.column(0)), longs(block.column(1)), as_matrix(block.column(2), dim))
            yield pa.RecordBatch.from_pydict({"n": pa.array([block.num_rows], pa.int32()),
                                              "tree": pa.array([_pack(tree)], pa.binary())})
    return task


def _match(dim: int, k: int, same: bool):
    """Rows of a unit: its trees (kind 0), then its anchors (kind 1)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, trees, held = None, [], []

        def answer():
            a = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            low, high = (as_matrix_64(a.column(c)) for c in ("low", "high"))
            search = Search(longs(a.column("anchor_id")), longs(a.column("label")), as_matrix(a.column("v"), dim),
                            low, high, k, same)
            for tree in trees:
                search.visit(tree)
            slot, place = np.nonzero(search.score > _LOW)
            keys = a.column("anchor").to_numpy(zero_copy_only=False)
            windows = low.shape[1]
            return pa.RecordBatch.from_pydict({
                "anchor": keys[slot // windows], "window": (slot % windows).astype(np.int32),
                "id": search.id[slot, place], "score": search.score[slot, place]})

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                now = (row.column("unit")[0].as_py(), row.column("kind")[0].as_py())
                if held and (now[0] != unit or now[1] == 0 or sum(map(len, held)) >= ANCHOR_ROWS):
                    yield answer()
                    held = []
                if now[0] != unit:
                    unit, trees = now[0], []
                if now[1] == 0:
                    trees.append(_unpack(row.column("tree")[0].as_py()))
                else:
                    held.append(row)
        if held:
            yield answer()
    return task


def as_matrix_64(lists: pa.Array) -> np.ndarray:
    """Rows of equally long bigint lists."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _spread(trees: DataFrame, anchors: DataFrame, groups: int, slices: int, dim: int, k: int, same: bool) -> DataFrame:
    """(anchor, window, id, score): the best ``k`` of each unit."""
    spark = trees.sparkSession
    unit = F.col("__group") * slices + F.col("__slice")
    kinds = ("unit", "kind", "tree", "anchor", "anchor_id", "label", "v", "low", "high")
    t = trees.withColumn("__slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    a = anchors.withColumn("__group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    t = t.select(unit.alias("unit"), F.lit(0).alias("kind"), "tree",
                 *[F.lit(None).cast(dict(anchors.dtypes)[c]).alias(c) for c in kinds[3:]])
    a = a.select(unit.alias("unit"), F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("tree"), *kinds[3:])
    n = max(1, min(groups * slices, max(shuffle_partitions(spark), groups * slices // 4)))
    units = t.unionByName(a).repartition(n, "unit").sortWithinPartitions("unit", "kind")
    return in_arrow(units, _match(dim, k, same), "anchor bigint, window int, id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, is_anchor: Column, label: Column | None = None,
                   positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int] = (30, 90)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are its best ``positives`` other rows of its label;
    for each of them, its best ``negatives`` rows of other labels whose score
    is ``window[0]`` to ``window[1]`` hundredths of the positive's. Scores are
    inner products of floor(256 * x); ties go to the smaller vec_id. All rows
    are candidates. ``label`` replaces the column of that name.

    Rows with a null label, a null vector or a null or non-finite component
    take no part. A null vec_id is no anchor and sorts last. Each repeated row
    counts; an anchor row that occurs twice is asked once; a row of the
    anchor's own vec_id is not another row. Shorter vectors count as filled up
    with zeros, a component of 2**18 or more is refused. Further columns are
    ignored; an empty table, or one without anchors, gives no rows.
    """
    spark = embeddings.sparkSession
    rows = (embeddings.withColumn("__label", (F.col("label") if label is None else label).cast("bigint"))
            .withColumn("__anchor", F.coalesce(is_anchor & F.col("vec_id").isNotNull(), F.lit(False)))
            .filter(F.col("__label").isNotNull() & is_vector("embedding"))
            .select(F.coalesce(F.col("vec_id").cast("bigint"), F.lit(NO_ID)).alias("id"), F.col("__label").alias("label"),
                    integers("embedding").alias("v"), "__anchor"))
    dim = max(1, longest(rows, "v"))
    trees = written(in_arrow(rows.drop("__anchor"), _plant(dim), "n int, tree binary"), "cover-trees")
    anchors = written(rows.filter("__anchor").select(F.col("id").alias("anchor_id"), "label", "v").distinct()
                      .withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    count, asked = trees.count(), anchors.count()
    # as many groups as tasks run beside each other, if there are trees enough
    groups = max(1, -(-count // GROUP_TREES), min(count, shuffle_partitions(spark)))
    slices = max(1, -(-asked // SLICE_ANCHORS))
    # trees are dealt by the row they are written in, anchors by their number
    trees = trees.select("tree", F.pmod(F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index")),
                                        F.lit(groups)).cast("int").alias("__group"))
    anchors = anchors.withColumn("__slice", F.pmod(F.xxhash64("anchor"), F.lit(slices)).cast("int"))

    every = anchors.withColumn("low", F.array(F.lit(_LOW))).withColumn("high", F.array(F.lit(_HIGH)))
    near = written(_best(_spread(trees, every, groups, slices, dim, positives, True), positives)
                   .select("anchor", F.col("id").alias("positive"), F.col("score").alias("positive_score"),
                           (F.col("rank") - 1).alias("window")), "positives")
    low, high = window
    low, high = F.col("positive_score") * low, F.col("positive_score") * high
    # rounded up and down to whole scores, in integers
    at_least = ((low + F.pmod(-low, F.lit(100))) / 100).cast("bigint")
    at_most = ((high - F.pmod(high, F.lit(100))) / 100).cast("bigint")
    bands = near.groupBy("anchor").agg(F.array_sort(F.collect_list(
        F.struct("window", at_least.alias("low"), at_most.alias("high")))).alias("__bands"))

    def bound(name: str, none: int) -> Column:
        # an anchor with fewer positives gets empty windows in their place
        return F.transform(F.sequence(F.lit(1), F.lit(positives)),
                           lambda i: F.coalesce(F.get("__bands", i - 1)[name], F.lit(none))).alias(name)

    banded = anchors.join(bands, "anchor").select(*anchors.columns, bound("low", _HIGH), bound("high", _LOW))
    found = _best(_spread(trees, banded, groups, slices, dim, negatives, False), negatives)
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return (found.join(near, ["anchor", "window"]).join(anchors.select("anchor", "anchor_id"), "anchor")
            .select("anchor_id", real("positive").alias("positive_id"), "rank", real("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
