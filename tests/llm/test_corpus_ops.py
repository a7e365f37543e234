"""Operators 1, 2 and 10 and the pipeline against plain Python versions."""

import math
import random
import zlib
from collections import Counter

import llm_fixture as fx
import numpy as np
import pytest
from pyspark.sql import functions as F

from mallscope.llm import decontam, ngram_lm, simhash_dedup
from mallscope.llm.common import remainder, scratch
from mallscope.llm.components import connected_components
from mallscope.llm.elias_fano import PROBABILITY, EliasFano, NgramTrie, quantise

TRAIN = lambda c: remainder(c, 10) != 0


# --- 1: language model ----------------------------------------------------------

def test_elias_fano_access_and_successor():
    rng = np.random.default_rng(0)
    for n, top in ((1, 5), (1000, 10 ** 6), (5000, 2 ** 63), (3000, 3100), (64, 1), (129, 2 ** 50)):
        v = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        e = EliasFano(*EliasFano.arrays(v))
        i = rng.integers(0, n, 4000)
        assert (e.at(i) == v[i]).all()
        u = np.unique(v)
        e = EliasFano(*EliasFano.arrays(u))
        t = np.concatenate([rng.choice(u, 500), rng.integers(0, top, 500, dtype=np.uint64)])
        at, hit = e.successor(np.zeros(1000, dtype=np.int64), np.full(1000, len(u)), t)
        assert (at == np.searchsorted(u, t)).all() and (hit == np.isin(t, u)).all()


def test_codes_are_rounded_down_within_a_step():
    p = np.array([1.0, 0.5, 0.3, 1e-5, 3e-9, 0.0])
    got = PROBABILITY[quantise(p)]
    assert (got <= p + 1e-15).all() and got[-1] == 0
    assert (got[:4] > p[:4] * 0.91).all()


def test_trie_finds_what_it_holds_and_nothing_else():
    rng = np.random.default_rng(1)
    context = np.unique(rng.integers(0, 2 ** 63, 300, dtype=np.uint64))
    pairs = sorted({(int(rng.integers(len(context))), int(rng.integers(0, 2 ** 40))) for _ in range(2000)})
    triples = sorted({(int(rng.integers(len(pairs))), int(rng.integers(0, 2 ** 40))) for _ in range(3000)})
    col = lambda rows, i, t: np.array([r[i] for r in rows], dtype=t)
    trie = NgramTrie(context, np.full(len(context), 500), col(pairs, 0, np.int64), col(pairs, 1, np.uint64),
                     np.full(len(pairs), 7), col(triples, 0, np.int64), col(triples, 1, np.uint64),
                     np.full(len(triples), 2), 0.5)
    at, hit = trie.find_contexts(np.concatenate([context, context + np.uint64(1)]))
    assert hit[:len(context)].all() and not hit[len(context):].any() and (at[:len(context)] == np.arange(len(context))).all()
    for level, rows, n in (("2", pairs, len(context)), ("3", triples, len(pairs))):
        parent, word = col(rows, 0, np.int64), col(rows, 1, np.uint64)
        where, found = trie.find_words(level, np.arange(n), np.bincount(parent, minlength=n), word)
        assert found.all() and (where == np.arange(len(rows))).all()
        _, found = trie.find_words(level, parent, np.ones(len(rows), dtype=np.int64), word ^ np.uint64(1))
        held = set(rows)
        assert found.tolist() == [(p, w ^ 1) in held for p, w in rows]


def plain_scores(data, order, discount):
    """Base and model scores with exact probabilities; per row of ``data``."""
    tokens = [fx.lower(t).encode().split() + [None] for _, t, _ in data]
    c1, c2, c3 = Counter(), Counter(), Counter()
    for (i, _, _), w in zip(data, tokens, strict=True):
        if fx.crc(i, 10):
            s = [None] + w
            c1.update(w)
            c2.update(zip(s, s[1:], strict=False))
            c3.update(zip(s, s[1:], s[2:], strict=False))
    n, v = sum(c1.values()), len(c1)
    f1, f2 = Counter(a for a, _ in c2), Counter((a, b) for a, b, _ in c3)
    base = lambda w: (c1[w] + 0.1) / (n + 0.1 * (v + 1))
    out = []
    for w in tokens:
        s, total = [None] + w, 0.0
        for i in range(1, len(s)):
            a, x = s[i - 1], s[i]
            p = base(x)
            if c1[a]:
                p = max(c2[a, x] - discount, 0) / c1[a] + discount * f1[a] / c1[a] * p
            if order > 2 and i > 1 and c2[s[i - 2], a]:
                b = (s[i - 2], a)
                p = max(c3[*b, x] - discount, 0) / c2[b] + discount * max(f2[b], 1) / c2[b] * p
            total += math.log10(min(p, 1))
        out.append((len(w), sum(c1[x] > 0 for x in w), n, sum(math.log10(base(x)) for x in w), total))
    return out


@pytest.mark.parametrize(("order", "block", "shards"), [(2, 10 ** 6, "3"), (3, 700, "7"), (3, 2500, "1")])
def test_scores_equal_plain_version(spark, order, block, shards):
    data = [r for r in fx.rows() if r[0] != 205] + [(205, " ".join(fx._words(random.Random(2), 3000)), "s")]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", shards)
        got = ngram_lm.score_documents(fx.docs(spark, data).coalesce(1), TRAIN, order=order, block_tokens=block).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = plain_scores(data, order, 0.8)
    name = lambda i: -1 if i is None else i
    got = sorted((name(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    want = sorted((name(i), *w) for (i, _, _), w in zip(data, want, strict=True))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[4] == pytest.approx(w[4], rel=1e-12)
        # codes are rounded down by less than a step of 2^(1/8) each
        assert w[5] - 0.08 * w[1] <= g[5] <= w[5] + 1e-9, (g, w)


def test_shards_grow_with_the_tokens(spark, monkeypatch):
    data = [r for r in fx.rows() if r[0] is not None and r[0] < 200]
    tokens = sum(len(fx.lower(t).split()) + 1 for _, t, _ in data)
    shards, answer = [], ngram_lm._answer
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 500, raising=False)
    monkeypatch.setattr(ngram_lm, "_answer", lambda order, n, discount: shards.append(n) or answer(order, n, discount))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        got = {}
        for r in ngram_lm.score_documents(fx.docs(spark, data).coalesce(1), TRAIN, block_tokens=2500).collect():
            got[r.doc_id] = r.score
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert tokens / 500 <= shards[0] <= tokens / 500 + 2 and shards[0] > 4
    for (i, t, _), want in zip(data, plain_scores(data, 3, 0.8), strict=True):
        assert want[4] - 0.08 * want[0] <= got[i] <= want[4] + 1e-9


def test_query_scores_with_triples(spark):
    from mallscope.llm.queries import llm_queries
    # the word after b is one of nine for a pair, certain for a triple
    data = [(i, f"p{i % 9} b q{i % 9}", "s") for i in range(1, 400)]
    got = {r.doc_id: r.score for r in llm_queries()["op1_ngram_lm"](spark, write_tables(spark, data)).collect()}
    for (i, _, _), two, three in zip(data, plain_scores(data, 2, 0.8), plain_scores(data, 3, 0.8), strict=True):
        assert two[4] < three[4] - 0.08 * 4
        assert three[4] - 0.08 * 4 <= got[i] <= three[4] + 1e-9


def test_scores_of_an_empty_table_and_without_training_rows(spark):
    assert ngram_lm.score_documents(fx.empty(spark), TRAIN).collect() == []
    data = [(1, "a b a", "s"), (2, None, "s")]
    got = {r.doc_id: r for r in ngram_lm.score_documents(fx.docs(spark, data), lambda c: F.lit(False)).collect()}
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens, got[1].base_score) == (4, 0, 0, 0.0)
    assert got[2].n_tokens == 1


# --- 2: SimHash -------------------------------------------------------------------

def test_components_of_chains_stars_and_cycles(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(7, 8), (8, 9), (9, 7), (3, 3)]
    edges += [(rnd.randint(1000, 1100), rnd.randint(1000, 1100)) for _ in range(70)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_popcount_distance_is_a_lower_bound(spark):
    rnd = random.Random(9)
    prints = [rnd.getrandbits(64) for _ in range(50)] + [0, 2 ** 64 - 1]
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    points = [r[0] for r in spark.createDataFrame(signed, "fp long").select(
        simhash_dedup.popcount_point(F.col("fp"))).collect()]
    digits = [[p >> 4 * k & 15 for k in range(16)] for p in points]
    assert digits == [[(p >> 4 * k & 15).bit_count() for k in range(16)] for p in prints]
    for a, x in zip(prints, digits, strict=True):
        for b, y in zip(prints, digits, strict=True):
            assert sum(abs(i - j) for i, j in zip(x, y, strict=True)) <= (a ^ b).bit_count()


@pytest.mark.parametrize("hot_cell", [64, 1, 3])
def test_links_give_the_components_of_all_pairs(spark, hot_cell):
    rnd = random.Random(hot_cell)
    prints = set()
    for _ in range(12):                       # clusters around centres, and chains of two-bit steps
        p = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 25)):
            prints.add(p)
            p ^= (1 << rnd.randrange(64)) | (1 << rnd.randrange(64))
            if rnd.random() < 0.3:
                p ^= 1 << rnd.randrange(64)
    signed = {p - (1 << 64) if p >> 63 else p for p in prints} | {0, 1, 3, -1, -2}
    links = simhash_dedup.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), hot_cell).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 2 for r in links)
    names = {p: p & (1 << 64) - 1 for p in signed}
    _, want = fx.components([(None, u) for u in names.values()])
    group = {p: p for p in signed}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for r in links:
        group[find(r.a)] = find(r.b)
    for a in signed:
        for b in signed:
            assert (find(a) == find(b)) == (want[names[a]] == want[names[b]])


def test_fingerprints_and_components_equal_plain_version(spark):
    got = simhash_dedup.simhash_components(fx.docs(spark)).select(
        "doc_id", simhash_dedup.hex_digits(F.col("fp")).alias("fingerprint"), "component_id").collect()
    data = [(i, fx.fingerprint(t)) for i, t, _ in fx.rows()]
    least, _ = fx.components(data)
    name = lambda i: -1 if i is None else i
    want = sorted((name(i), f"{p:016x}", name(least[p])) for i, p in data)
    assert sorted((name(r.doc_id), r.fingerprint, name(r.component_id)) for r in got) == want
    assert simhash_dedup.simhash_components(fx.empty(spark)).collect() == []


def test_majority_over_many_shingles():
    rng = np.random.default_rng(3)
    counts = np.array([0, 1, 2, 255, 256, 700, 0, 5000])
    h = rng.integers(0, 2 ** 64, counts.sum(), dtype=np.uint64)
    got = simhash_dedup.majority_bits(h, counts)
    for g, part in zip(got.tolist(), np.split(h, np.cumsum(counts)[:-1]), strict=True):
        x = part.tolist()
        assert g == sum((2 * sum(v >> b & 1 for v in x) > len(x)) << b for b in range(64))


# --- 10: decontamination ------------------------------------------------------------

def test_contamination_equals_plain_version(spark):
    known = fx.windows(fx.BENCHMARK)
    got = decontam.contamination(fx.docs(spark).repartition(4), fx.benchmark(spark)).collect()
    name = lambda i: -1 if i is None else i
    want = sorted((name(i), *fx.contamination(t, known)) for i, t, _ in fx.rows())
    assert sorted((name(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == want
    assert sum(w[-1] for w in want) >= 3
    # words of an item without an id are hit, and nobody is named
    assert [w[2:4] + w[5:] for w in want if w[0] == 190] == [(4, 0, True)]


def test_contamination_of_empty_sides(spark):
    none = decontam.contamination(fx.docs(spark), fx.benchmark(spark).limit(0)).collect()
    assert len(none) == len(fx.rows()) and not any(r.contaminated for r in none)
    assert decontam.contamination(fx.empty(spark), fx.benchmark(spark)).collect() == []


def test_proximity_matches(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    texts = {1: words, 2: words[:4] + ["x"] + words[4:], 3: words[:4] + ["x", "y"] + words[4:7] + ["z"] + words[7:],
             4: words[::-1], 5: words[:9], 6: words[:5] + ["x"] * 9 + words[5:]}
    path = scratch(spark, "t-index")
    decontam.build_index(spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "doc_id long, text string"), path)
    index = decontam.read_index(spark, path)
    heads = {r.row: r.doc_id for r in index.filter("pos = -1").collect()}
    w = decontam.test_windows(spark.createDataFrame([(1, " ".join(words))], "item_id long, text string"))
    exact = {heads[r.row] for r in decontam.search(index, w).collect()}
    near = {(heads[r.row], r.exact) for r in decontam.search(index, w, slop=3).collect()}
    assert exact == {1} and near == {(1, True), (2, False), (3, False)}


# --- pipeline -------------------------------------------------------------------------

def write_tables(spark, data):
    d = scratch(spark, "t-tables")
    fx.docs(spark, data).write.parquet(f"{d}/documents.parquet")
    fx.benchmark(spark).write.parquet(f"{d}/benchmark.parquet")
    return d


def test_pipeline_equals_plain_version(spark):
    import corpus_pipeline as cp
    from mallscope.llm.common import written
    data = fx.rows()
    d = write_tables(spark, data)
    rows = [r for r, v in zip(data, fx.verdicts(data), strict=True) if v[1]]
    states = [rows]
    _, roots = fx.components([(i, fx.fingerprint(t)) for i, t, _ in rows])
    first = {}
    for r in rows:
        key = roots[fx.fingerprint(r[1])]
        rank = (r[0] is None, r[0] or 0)
        if key not in first or rank < first[key][0]:
            first[key] = (rank, r)
    rows = [r for _, r in first.values()]
    states.append(rows)
    known = fx.windows(fx.BENCHMARK)
    rows = [r for r in rows if not fx.contamination(r[1], known)[-1]]
    states.append(rows)
    rows = [(i, fx.redacted(t, [(a, b) for a, _, b, _ in fx.secrets(t)]), s) for i, t, s in rows]
    states.append(rows)

    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    name = lambda i: -1 if i is None else i
    for (title, stage), want in zip(cp.STAGES[:-1], states, strict=True):
        docs = written(stage(spark, docs, d), "t-stage")
        assert docs.columns == columns, title
        got = docs.collect()
        assert sorted((name(r.doc_id), r.text or "") for r in got) == sorted((name(i), t or "") for i, t, _ in want), title
        assert all(r.n_chars == len(r.text) for r in got if r.text is not None)
    from test_text_ops import ids_of
    packed = cp.run(spark, d).toPandas()
    assert packed.length.sum() == sum(len(ids_of(t, 1)) for _, t, _ in rows)
    for i, t, _ in rows:
        if i is not None:
            ids = ids_of(t, 1)
            for p in packed[packed.doc_id == i].itertuples():
                assert zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32


CLASHES = ["__d", "__h", "__root", "__again", "__row", "__host", "__rate", "__spans", "__clean", "__measures", "_x"]


def test_stages_leave_columns_of_any_name_alone(spark):
    import corpus_pipeline as cp
    from mallscope.llm.common import unused
    data = fx.rows()
    docs = fx.docs(spark, data).drop(*CLASHES)
    for c in CLASHES:
        docs = docs.withColumn(c, F.concat(F.lit(c + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    assert unused(docs, "__D", "free") == ["___D", "free"]
    d = scratch(spark, "t-tables")
    docs.write.parquet(f"{d}/documents.parquet")
    fx.benchmark(spark).write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        plain = stage(spark, docs.drop(*CLASHES), d).select("doc_id", "text").collect()
        got = stage(spark, docs, d)
        assert got.columns == docs.columns, name
        rows = got.collect()
        key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")
        assert sorted(map(key, rows)) == sorted(map(key, plain)), name
        assert all(r[c] == f"{c}:{'' if r.doc_id is None else r.doc_id}" for r in rows for c in CLASHES), name


def test_of_equal_rows_the_one_with_the_least_other_columns_stays(spark):
    rows = [(1, "one text of some words", s, n) for s, n in (("b", 1), ("a", 2), (None, 3), ("a", 1))]
    rows += [(2, "one text of some words", "0", 0), (5, None, "z", None), (5, None, "y", 4), (5, None, "y", None)]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        docs = spark.createDataFrame(order, "doc_id long, text string, source string, n int").repartition(3)
        got = sorted(map(tuple, simhash_dedup.drop_near_duplicates(docs).collect()))
        assert got == [(1, "one text of some words", "a", 1), (5, None, "y", 4)]


def test_pipeline_of_an_empty_table(spark):
    import corpus_pipeline as cp
    assert cp.run(spark, write_tables(spark, [])).collect() == []


def test_every_operator_is_registered():
    import __spark_entry__ as e
    names = [k for k in e.queries() if k.startswith("op") and k[2:].split("_")[0].isdigit()]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in e.queries()


def test_queries_with_sql_agree(spark):
    import __spark_entry__ as e
    import oracle_compare
    from conftest import SF_SMALL
    keys = [k for k in e.oracle_sql() if k.startswith("op")]
    assert len(keys) >= 2
    res = oracle_compare.compare(spark, SF_SMALL, keys, verbose=False)
    assert set(res.values()) == {"OK"}, res
