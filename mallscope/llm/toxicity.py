"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; any other text is unlabelled, some of
it toxic too. A linear classifier over hashed words and word beginnings is
trained in numpy on the class-prior-corrected risk
    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),
whose second part, an estimate of the risk on the true negatives, is kept from
going below zero (Kiryo et al., 2017). Scoring is one pass over all texts.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.llm.common import alnum_words, in_arrow, sub_batches, text_bytes, written


def word_features(word: bytes, buckets: int) -> list[int]:
    """Bucket numbers of a word and of its beginnings of four to six bytes."""
    out = [zlib.crc32(b"=" + word) % buckets]
    out += [zlib.crc32(b"^" + word[:k]) % buckets for k in (4, 5, 6) if len(word) >= k]
    return out


def text_features(text: bytes, buckets: int) -> np.ndarray:
    """Different buckets of a text, ascending."""
    found: set[int] = set()
    for w in set(alnum_words(text)):
        found.update(word_features(w, buckets))
    return np.array(sorted(found), dtype=np.int32)


def _feature_task(buckets: int):
    def run(batches):
        for batch in sub_batches(batches, "text"):
            rows = [text_features(t, buckets) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive"), batch.column("unlabelled"),
                 pa.array(rows, type=pa.list_(pa.int32()))], names=["positive", "unlabelled", "features"])
    return run


def choose_features(in_p: np.ndarray, in_u: np.ndarray, n_p: int, n_u: int, prior: float,
                    max_features: int = 20_000, enrichment: float = 3.0) -> np.ndarray:
    """Places of the counts that are most typical of the positives.

    ``in_p`` of ``n_p`` positive and ``in_u`` of ``n_u`` unlabelled rows hold
    a feature. Kept are at most ``max_features`` that are at least
    ``enrichment`` times as frequent in positives as the unlabelled rows'
    negatives would have them by chance.
    """
    rate_p = in_p / n_p
    # the unlabelled rows hold ``prior`` of positives: take their share out
    rate_n = np.maximum(in_u / n_u - prior * rate_p, 0) / (1 - prior)
    lift = (rate_p + 0.5 / n_p) / (rate_n + 0.5 / n_u)
    gain = (rate_p - rate_n) / np.sqrt(rate_p * (1 - rate_p) / n_p + (rate_n + 1 / n_u) / n_u)
    use = np.flatnonzero((lift >= enrichment) & (gain > 3))
    return use[np.argsort(-gain[use], kind="stable")[:max_features]]


def nnpu_risk(xp, xu, w: np.ndarray, b: float, prior: float):
    """The negative part of the risk, the whole risk and the step's gradient.

    ``xp`` and ``xu`` are (row numbers, feature numbers, rows) of the ones.
    The risk is prior E_p[l(s, 1)] + max(0, E_u[l(s, 0)] - prior E_p[l(s, 0)])
    with logistic losses l. Where the part in the maximum is negative the step
    climbs it: its gradient is that part's, turned round.
    """
    def score(x):
        return np.bincount(x[0], weights=w[x[1]], minlength=x[2]) + b

    def back(x, g):
        return np.append(np.bincount(x[1], weights=g[x[0]], minlength=len(w)), g.sum())

    sp, su = score(xp), score(xu)
    up_p, up_u = 1 / (1 + np.exp(-np.clip(sp, -30, 30))), 1 / (1 + np.exp(-np.clip(su, -30, 30)))
    # logistic losses: log(1+e^-s) for the label 1, log(1+e^s) for 0
    negative = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
    positive = prior * np.logaddexp(0, -sp).mean()
    g_neg = back(xu, up_u / len(su)) - back(xp, prior * up_p / len(sp))
    g = back(xp, prior * (up_p - 1) / len(sp)) + g_neg if negative >= 0 else -g_neg
    return negative, positive + max(0.0, negative), g


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, use: np.ndarray,
             buckets: int, steps: int = 300, rate: float = 0.05,
             ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights by bucket and the bias, from rows of places in ``use``, the chosen buckets."""
    weights = np.zeros(buckets, dtype=np.float32)
    if not len(use) or not positive or not unlabelled or not prior:
        return weights, -4.0

    def matrix(rows):
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows), len(rows)

    xp, xu = matrix(positive), matrix(unlabelled)
    w, b = np.zeros(len(use)), -1.0
    m, v = np.zeros(len(use) + 1), np.zeros(len(use) + 1)
    for step in range(1, steps + 1):
        _, _, g = nnpu_risk(xp, xu, w, b, prior)
        g[:-1] += ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        change = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - change[:-1], b - change[-1]
    weights[use] = w
    return weights, float(b)


def _chosen_task(use: np.ndarray, buckets: int):
    def run(batches):
        place = np.full(buckets, -1, dtype=np.int64)
        place[use] = np.arange(len(use))
        for batch in batches:
            lists = batch.column("features")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            held = []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                at = place[values[a:b]]
                bits = np.zeros(len(use), dtype=bool)
                bits[at[at >= 0]] = True
                held.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive"), batch.column("unlabelled"), pa.array(held, type=pa.binary())],
                names=["positive", "unlabelled", "held"])
    return run


def fit(docs: DataFrame, toxic_ids: DataFrame, unlabelled_ids: DataFrame, prior: float,
        max_positive: int = 4_000, max_unlabelled: int = 12_000, buckets: int = 1 << 20,
        min_positives: int = 3) -> tuple[np.ndarray, float]:
    """Train on bounded samples: at most ``max_positive`` of ``toxic_ids`` and
    ``max_unlabelled`` of ``unlabelled_ids`` (doc_id), lowest hash first. Of an
    id with several rows one is learnt from, the text of the lowest hash.

    Those ids are broadcast and their texts become bucket numbers in the tasks,
    written once. Rows by bucket are counted by Spark; the driver gets the
    counts of buckets that ``min_positives`` positives hold (at most
    ``buckets`` rows), chooses features, and then gets one bit a text and
    feature: 40 MB at most, however long the texts are.
    """
    def lowest(ids, n):
        return ids.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)

    ids = (lowest(toxic_ids, max_positive).select("doc_id", F.lit(1).alias("p"), F.lit(0).alias("u"))
           .unionAll(lowest(unlabelled_ids, max_unlabelled).select("doc_id", F.lit(0), F.lit(1)))
           .groupBy("doc_id").agg(F.max("p").alias("positive"), F.max("u").alias("unlabelled")))
    sample = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
              .join(F.broadcast(ids), "doc_id")          # at most max_positive + max_unlabelled ids
              .groupBy("doc_id", "positive", "unlabelled")
              .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least"))
              .select("positive", "unlabelled", "least.text"))
    rows = written(in_arrow(sample, _feature_task(buckets), "positive int, unlabelled int, features array<int>"),
                   "toxic-sample")
    n_p, n_u = (int(n or 0) for n in rows.agg(F.sum("positive"), F.sum("unlabelled")).first())
    use = np.zeros(0, dtype=np.int64)
    if n_p and n_u:
        counts = (rows.select("positive", "unlabelled", F.explode("features").alias("bucket")).groupBy("bucket")
                  .agg(F.sum("positive").alias("p"), F.sum("unlabelled").alias("u")).filter(F.col("p") >= min_positives)
                  .orderBy("bucket").toArrow())
        if counts.num_rows:
            bucket, in_p, in_u = (counts.column(c).to_numpy() for c in ("bucket", "p", "u"))
            use = bucket[choose_features(in_p, in_u, n_p, n_u, prior)].astype(np.int64)
    chosen = in_arrow(rows, _chosen_task(use, buckets), "positive int, unlabelled int, held binary").toArrow()
    pos, unl = chosen.column("positive").to_numpy(), chosen.column("unlabelled").to_numpy()
    held = chosen.column("held").to_pylist()
    places = [np.flatnonzero(np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=len(use))) for x in held]
    order = sorted(range(len(held)), key=held.__getitem__)
    return fit_nnpu([places[i] for i in order if pos[i]], [places[i] for i in order if unl[i]], prior, use, buckets)


def _score_task(weights, bias: float, max_words: int = 300_000):
    def run(batches):
        table = weights.value
        memo: dict[bytes, float] = {}
        buckets = len(table)
        for batch in sub_batches(batches, "text"):
            scores = np.empty(batch.num_rows)
            if len(memo) > max_words:
                memo.clear()
            for i, text in enumerate(batch.column("text").to_pylist()):
                total, words = bias, set(alnum_words(text))
                # a bucket counts once per text, as in training
                seen: set[int] = set()
                for w in words:
                    x = memo.get(w)
                    if x is None:
                        x = memo[w] = tuple(k for k in word_features(w, buckets) if table[k])
                    if x:
                        seen.update(x)
                for k in sorted(seen):
                    total += float(table[k])
                scores[i] = total
            p = 1 / (1 + np.exp(-np.clip(scores, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], names=["doc_id", "score"])
    return run


def score_texts(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """doc_id and score (0 to 1), one row per row of ``docs``."""
    table = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    return in_arrow(rows, _score_task(table, bias), "doc_id bigint, score double")


def toxicity(docs: DataFrame, labels: DataFrame, is_training, prior: float | None = None,
             max_positive: int = 4_000, max_unlabelled: int = 12_000, buckets: int = 1 << 20) -> DataFrame:
    """doc_id, score and predicted (score >= 0.5) for every row of ``docs``.

    ``is_training`` maps a doc_id column to a condition: only rows that meet
    it are learnt from. Positives are the documents with ``labels.toxic`` = 1;
    every training document may be drawn as unlabelled. ``prior`` (share of
    toxic documents) defaults to the share among the labelled training rows.
    Null and empty texts get the score of a text without words; without any
    positive label every score is low. Null labels and doc_ids are not learnt
    from; rows that repeat are scored each; an empty table gives no rows.
    Other columns of ``docs`` are not read.
    """
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & is_training("doc_id")))
    if prior is None:
        prior = float(known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0)
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).filter(
        F.col("doc_id").isNotNull() & is_training("doc_id"))
    weights, bias = fit(docs, known.filter("toxic = 1"), ids, min(prior, 0.95), max_positive, max_unlabelled, buckets)
    return score_texts(docs, weights, bias).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
