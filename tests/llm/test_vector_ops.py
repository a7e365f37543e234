import hashlib
import zlib

import numpy as np
import pytest
from llm_fixture import docs, empty, rows
from pyspark.sql import functions as F

from mallscope.llm.hard_negatives import CoverTree, hard_negatives
from mallscope.llm.sharding import assign_shards, moved, shard_documents, with_slots, write_shards
from mallscope.llm.vector_codes import assign, block_sums, middle_splits, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, score double, __label int, id string"


def vectors(n=260, dim=16, seed=3):
    """(vec_id, vector, label): clustered rows, copies, ties, and the odd cases."""
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 0.3, (6, dim))
    out = [(k, (centres[k % 6] + rnd.normal(0, 0.05, dim)).astype(np.float32).tolist(), int(rnd.integers(0, 4)))
           for k in range(n)]
    out += [(1000 + k, out[5][1], k % 4) for k in range(12)]               # copies: equal scores
    out += [(2000, [0.0] * dim, 1), (2100, out[7][1], 1), (2100, out[7][1], 1), (None, out[9][1], 2), (-100, out[3][1], 0)]
    out += [(3000, None, 1), (3100, [float("nan")] * dim, 1), (3200, [None] * dim, 2), (3300, [float("inf")] + [0.1] * (dim - 1), 2),
            (3400, out[2][1], None), (3500, out[4][1][:dim - 3], 2)]
    return out


def frame(spark, data):
    return spark.createDataFrame([(i, v, lab, 1.0, 9, "x") for i, v, lab in data], SCHEMA)


def whole(data, dim, labelled):
    kept = [(i, v, lab) for i, v, lab in data
            if v is not None and all(x is not None and np.isfinite(x) for x in v) and not (labelled and lab is None)]
    x = np.zeros((len(kept), dim), dtype=np.int64)
    for r, (_, v, _) in enumerate(kept):
        x[r, :len(v)] = np.floor(256 * np.asarray(v, dtype=np.float32).astype(np.float64))
    return [k[0] for k in kept], x, [k[2] for k in kept]


def plain_negatives(data, dim, step):
    ids, x, labels = whole(data, dim, True)
    last = 1 << 62
    order = [last if i is None else i for i in ids]
    out, asked = [], set()
    for a, i in enumerate(ids):
        if i is None or i % step or (i, labels[a], x[a].tobytes()) in asked:
            continue
        asked.add((i, labels[a], x[a].tobytes()))
        s = x @ x[a]
        ranked = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-s[j], order[j]))
        for p in [j for j in ranked if labels[j] == labels[a]][:5]:
            fits = [j for j in ranked if labels[j] != labels[a] and 30 * s[p] <= 100 * s[j] <= 90 * s[p]]
            out += [(i, ids[p], r + 1, ids[j], int(s[p]), int(s[j])) for r, j in enumerate(fits[:10])]
    return sorted(out, key=str)


def test_hard_negatives_equal_brute_force(spark):
    data = vectors()
    want = plain_negatives(data, 16, 20)
    got = hard_negatives(frame(spark, data), F.col("vec_id") % 20 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want and len(want) > 100


def test_hard_negatives_over_many_trees_groups_and_slices(spark, monkeypatch):
    from mallscope.llm import hard_negatives as H
    data = vectors(400, seed=5)
    monkeypatch.setattr(H, "TREE_COMPONENTS", 64 * 16)
    monkeypatch.setattr(H, "GROUP_TREES", 2)
    monkeypatch.setattr(H, "SLICE_ANCHORS", 7)
    got = hard_negatives(frame(spark, data).repartition(3), F.col("vec_id") % 10 == 0)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_negatives(data, 16, 10)


def test_hard_negatives_without_rows_or_anchors(spark):
    assert hard_negatives(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert hard_negatives(frame(spark, vectors(30)), F.lit(False)).count() == 0


def test_cover_tree_covers_separates_nests_and_bounds():
    rnd = np.random.default_rng(1)
    v = np.floor(rnd.normal(0, 90, (700, 8)) + 300 * rnd.integers(0, 2, (700, 1))).astype(np.int64)
    tree = CoverTree(np.arange(700), np.zeros(700, dtype=np.int64), v, leaf=8)
    assert sorted(tree.ids) == list(range(700)) and len(tree.levels) > 3
    x = np.column_stack([tree.vectors, np.sqrt(tree.square - (tree.vectors ** 2).sum(axis=1))])
    assert np.allclose((x ** 2).sum(axis=1), tree.square)
    up = np.repeat(np.arange(len(tree.leaves) - 1), np.diff(tree.leaves))
    q = v[:20].astype(float)
    exact = v[:20] @ tree.vectors.T
    for level in range(len(tree.levels) - 1, -1, -1):
        point, radius, parent = tree.levels[level]
        assert (np.sqrt(((x - point[up]) ** 2).sum(axis=1)) <= radius[up] + 1e-9).all()       # covering
        low, high = tree.bounds(level, q, (q ** 2).sum(axis=1))
        assert (low[:, up] <= exact).all() and (exact <= high[:, up]).all()
        if level:
            above = tree.levels[level - 1][0]
            assert np.array_equal(point[:len(above)], above)                                   # nesting
            d = np.sqrt(((above[:, None] - above[None]) ** 2).sum(axis=2) + 1e18 * np.eye(len(above)))
            gap = np.sqrt(((point - above[parent]) ** 2).sum(axis=1))
            assert gap.max() <= d.min() + 1e-6                         # separated by more than what they cover
        up = parent[up]


def test_descent_skips_nodes_outside_the_windows(monkeypatch):
    from mallscope.llm.hard_negatives import Search
    rnd = np.random.default_rng(2)
    v = np.concatenate([rnd.integers(-3, 3, (300, 8)) + 200 * np.eye(8, dtype=np.int64)[k % 8] for k in range(6)])
    tree = CoverTree(np.arange(len(v)), np.repeat(np.arange(6), 300), v)
    seen = []
    monkeypatch.setattr(tree, "products", lambda q, leaf, f=tree.products: seen.append((len(q), leaf)) or f(q, leaf))
    one = np.array([[30_000]])
    s = Search(np.array([10 ** 6]), np.array([9]), v[:1], one, one + 20_000, 3, False)
    s.visit(tree)
    best = sorted((v @ v[0])[(v @ v[0] >= 30_000) & (v @ v[0] <= 50_000)])[::-1][:3]
    assert s.score[0].tolist() == best and 0 < len(seen) < (len(tree.leaves) - 1) / 4


def plain_codes(data, dim, entries=64, rounds=2, parts=16):
    ids, x, labels = whole(data, dim, False)
    order = sorted(range(len(ids)), key=lambda r: (ids[r] is None, ids[r] or 0, x[r].tolist()))
    books = x[order[:entries]].reshape(-1, parts, dim // parts).transpose(1, 0, 2).copy()
    cut = x.reshape(len(x), parts, dim // parts)

    def near():
        d = ((cut[:, :, None] - books[None]) ** 2).sum(axis=3)
        return d.argmin(axis=2), d.min(axis=2).sum(axis=1)
    for _ in range(rounds):
        code, _e = near()
        for p in range(parts):
            for e in range(books.shape[1]):
                own = cut[code[:, p] == e, p]
                if len(own):
                    books[p, e] = [int(c) // len(own) for c in own.sum(axis=0)]
    code, error = near()
    by = {}
    for lab, e in zip(labels, error, strict=True):
        by[lab] = by.get(lab, 0) + int(e)
    digest = hashlib.sha256(",".join(str(c) for c in books.ravel().tolist()).encode()).hexdigest()
    return sorted([(i, "".join(f"{c:02x}" for c in r), int(e), by[lab], digest)
                   for i, r, e, lab in zip(ids, code, error, labels, strict=True)], key=str)


@pytest.mark.parametrize("n", [40, 300])
def test_vector_codes_equal_plain_lloyd(spark, n):
    data = vectors(n, dim=32)
    got = vector_codes(frame(spark, data).repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_codes(data, 32)


def test_vector_codes_of_an_empty_table_and_of_one_row(spark):
    assert vector_codes(frame(spark, [])).count() == 0
    assert [r.code for r in vector_codes(frame(spark, [(5, [0.5] * 16, None)])).collect()] == ["00" * 16]


def test_trees_assign_like_brute_force_and_take_whole_nodes():
    rnd = np.random.default_rng(4)
    for n, width, m in ((3000, 2, 64), (900, 4, 7), (60, 3, 60), (1, 2, 1)):
        points = rnd.integers(-40, 40, (n, width)) + 400 * rnd.integers(0, 4, (n, 1))
        points[n // 2:] = points[:n - n // 2]                                  # ties
        entries = points[:m].copy()
        order, depth = middle_splits(points, 8)
        own = points[order]
        entry, whole_, first, length = assign(own, depth, entries)
        want = ((own[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert np.array_equal(entry, want) and whole_.sum() == length.sum()
        counts, sums = block_sums(own, depth, entries)
        assert np.array_equal(counts, np.bincount(want, minlength=m))
        assert np.array_equal(sums, np.array([own[want == e].sum(axis=0) for e in range(m)]))
    # entries far apart: all parts go with whole nodes, none is compared
    points = rnd.integers(-40, 40, (900, 4)) + 400 * rnd.integers(0, 4, (900, 1))
    order, depth = middle_splits(points, 8)
    entry, whole_, _, _ = assign(points[order], depth, 400 * np.arange(4)[:, None] * np.ones((1, 4), dtype=np.int64))
    assert whole_.mean() > 0.95 and np.array_equal(entry, np.round(points[order].mean(axis=1) / 400))


def test_shards_cover_every_row_and_grow_into_the_new_one(spark):
    data = rows() * 2 + [(207, "another text of one id", "src0")] * 40          # a hot key
    got = shard_documents(docs(spark, data), 5).collect()
    assert len(got) == len(data) and {r.law for r in got} == {"key"}
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in data)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == want
    place = {}
    for r in got:
        assert r.grown_shard in (r.shard, 5) and place.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    wider = {r.doc_id: r.shard for r in assign_shards(docs(spark, data), 6).collect()}
    assert all(wider[i] == g for i, (_, g) in place.items())                    # the grown layout is the wider one
    assert shard_documents(empty(spark), 5).count() == 0


def test_slots_are_gapless_over_small_stretches(spark):
    many = spark.range(5000).select((F.col("id") % 7).cast("int").alias("shard"), "id").repartition(3)
    got = with_slots(many, slot_rows=100)
    r = got.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"),
                                 F.min("slot").alias("lo"), F.max("slot").alias("hi")).collect()
    assert all(x.n == x.d == x.hi + 1 and x.lo == 0 for x in r) and got.select("id").distinct().count() == 5000


def test_weights_set_the_shares_and_a_change_moves_little(spark):
    many = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    n = {r.shard: r["count"] for r in assign_shards(many, [1, 3, 0, 1]).groupBy("shard").count().collect()}
    assert set(n) == {0, 1, 3} and abs(n[1] / 40_000 - 0.6) < 0.02
    change = {(r.shard, r.grown_shard): r.n_rows for r in moved(assign_shards(many, 40)).collect()}
    assert all(b in (a, 40) for a, b in change) and abs(sum(v for (a, b), v in change.items() if a != b) / 40_000 - 1 / 41) < 0.005
    heavier = moved(assign_shards(many, [1, 1, 1], [1, 2, 1])).collect()         # a rising weight only draws in
    assert all(r.grown_shard in (r.shard, 1) for r in heavier)


def test_sharding_runs_no_python_and_shuffles_no_text(spark):
    plan = shard_documents(docs(spark), 40)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "text#" not in plan


def test_written_shards_hold_all_columns(spark, tmp_path):
    d = docs(spark)
    write_shards(d, str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.drop("__shard").exceptAll(d).count() == 0 and back.count() == d.count()
