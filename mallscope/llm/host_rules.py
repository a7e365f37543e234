"""Quality rules judged by host.

Every document is measured and tested against rules. The failures are summed
by host, each host's failure rate is shrunk towards the rate of all hosts with
a beta prior fitted to the hosts themselves, and the host's verdict is joined
back to its documents: few rows of a host say little, many say much.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallscope.llm.common import in_arrow, sub_batches, text_bytes, unused, word_keys, written

WINDOW = 5      # words of a repeated passage

_SPACE = np.zeros(256, dtype=np.int64)
_SPACE[[9, 10, 11, 12, 13, 32]] = 1
# code points begin at every byte that does not continue one
_WORD_CHAR = np.array([(c & 0xC0) != 0x80 for c in range(256)], dtype=np.int64) * (1 - _SPACE)
_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1


def repeated_words(ids: np.ndarray, doc: np.ndarray, n_docs: int, window: int = WINDOW) -> np.ndarray:
    """Per document, the words that lie in a window found twice or more in it.

    ``ids``: word hashes (unsigned) of all documents in turn; ``doc``: the document of
    each. Windows are compared by a 64-bit hash; those of equal hash are then
    compared word by word.
    """
    out = np.zeros(n_docs, dtype=np.int64)
    starts = np.flatnonzero(doc[:len(doc) - window + 1] == doc[window - 1:]) if len(doc) >= window else doc[:0]
    if not len(starts):
        return out
    key = doc[starts].astype(np.uint64)
    for k in range(window):
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[starts + k]
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    a, b = starts[order[same]], starts[order[same + 1]]
    equal = doc[a] == doc[b]
    for k in range(window):
        equal &= ids[a + k] == ids[b + k]
    if not equal.all():     # two different windows share a hash: compare them all
        rows = np.column_stack([doc[starts].astype(np.uint64), *(ids[starts + k] for k in range(window))])
        _, where, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        hit = starts[times[where.ravel()] > 1]
    else:
        hit = np.concatenate([a, b])
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    edge[hit] = 1
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(window):
        covered[k:] |= edge[:len(ids) - k].astype(bool)
    return np.bincount(doc[covered], minlength=n_docs)


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def measured(texts: list[bytes]) -> list[np.ndarray]:
    """The counts of ``_COUNTS`` for each text."""
    n = len(texts)
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])

    def total(table):
        return np.diff(np.concatenate([[0], np.cumsum(table[raw])])[ends])

    of, ids = word_keys(texts)
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    return [np.bincount(of, minlength=n), total(_WORD_CHAR), total(_SYMBOL),
            np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64), repeated_words(ids, of, n),
            np.array([len(x) for x in lines], dtype=np.int64)]


def _measure_task(batches):
    for batch in sub_batches(batches, "text"):
        counts = measured(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("host"), *map(pa.array, counts)],
                                         names=["doc_id", "host", *_COUNTS])


def _measure_rows_task(name: str):
    def run(batches):
        for whole in batches:
            text = whole.column("text").cast(pa.binary()).fill_null(b"")
            parts = pa.RecordBatch.from_arrays([text, pa.array(np.arange(len(text)))], names=["text", "row"])
            for part in sub_batches([parts], "text"):
                counts = measured(part.column("text").to_pylist())
                rows = whole.slice(part.column("row")[0].as_py(), part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.StructArray.from_arrays(list(map(pa.array, counts)), _COUNTS)],
                    names=[*rows.schema.names, name])
    return run


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the counts that the rules use, one row per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col(host).cast("string").alias("host"), text_bytes().alias("text"))
    return in_arrow(rows, _measure_task, "doc_id bigint, host string, " + ", ".join(f"{c} bigint" for c in _COUNTS))


def host_rates(measured: DataFrame) -> DataFrame:
    """host, n_docs, n_failed and ``rate``: the posterior mean failure rate.

    The beta prior's mean is the rate over all documents; its strength comes
    from the spread of the hosts' raw rates beyond what binomial sampling
    alone would give (moments; one row reaches the driver). Hosts that spread
    no more than chance share one rate.
    """
    hosts = written(measured.groupBy("host").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("bigint")).alias("n_failed")), "hosts")
    s = hosts.agg(
        F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"), F.count("*").alias("k"),
        F.sum(F.col("n_docs").cast("double") ** 2).alias("n2"),
        F.sum(F.col("n_failed").cast("double") ** 2 / F.col("n_docs")).alias("f2")).first()
    n, f, k = s["n"] or 0, s["f"] or 0, s["k"] or 0
    mean = f / n if n else 0.0
    strength = float("inf")
    if k > 1 and 0 < mean < 1:
        between = (s["f2"] - n * mean * mean) - (k - 1) * mean * (1 - mean)
        variance = between / (n - s["n2"] / n) if n > s["n2"] / n else 0.0
        if variance > 0:
            strength = max(0.0, mean * (1 - mean) / variance - 1)
    if strength == float("inf"):
        rate = F.lit(float(mean))
    else:
        rate = (F.col("n_failed") + F.lit(float(mean * strength))) / (F.col("n_docs") + F.lit(float(strength)))
    return hosts.withColumn("rate", rate)


@dataclass(frozen=True)
class Rules:
    """A document fails a base rule with fewer than ``min_words`` words or more
    than ``max_repeat_percent`` of them in repeated windows; it fails a further
    rule with more than ``max_symbols`` symbols a word, more than the share
    ``max_dup_lines`` of its lines repeated, or a mean word length outside
    ``mean_word``. Of a host whose shrunk failure rate is over ``rejected``
    every document goes; up to ``trusted`` the further rules don't count."""
    min_words: int = 10
    max_repeat_percent: int = 20
    max_symbols: float = 0.1
    max_dup_lines: float = 0.5
    mean_word: tuple[float, float] = (2.0, 15.0)
    trusted: float = 0.02
    rejected: float = 0.5

    def base_failed(self, count) -> Column:
        return (count("n_words") < self.min_words) | (
            count("n_repeat_words") * 100 > count("n_words") * self.max_repeat_percent)

    def rule_failed(self, count) -> Column:
        words = F.greatest(count("n_words"), F.lit(1))
        return ((count("n_symbols") > words * self.max_symbols)
                | (count("n_dup_lines") > F.greatest(count("n_lines"), F.lit(1)) * self.max_dup_lines)
                | ~(count("word_chars") / words).between(*self.mean_word))

    def verdict(self, rate: Column) -> Column:
        return (F.when(rate > self.rejected, F.lit("rejected"))
                .when(rate <= self.trusted, F.lit("trusted")).otherwise(F.lit("watched")))

    def kept(self, base_failed: Column, rule_failed: Column, verdict: Column) -> Column:
        return ~base_failed & (verdict != "rejected") & ((verdict == "trusted") | ~rule_failed)


def _rates(measured_rows: DataFrame, rules: Rules, host: str = "__host", rate: str = "__rate") -> DataFrame:
    """``host`` and ``rate``, written so that their size is known: a small table is
    broadcast by Spark's own threshold, a large one is joined by a shuffle that
    AQE can split at a hot host."""
    failed = measured_rows.withColumn("failed", rules.base_failed(F.col) | rules.rule_failed(F.col))
    return written(host_rates(failed).select(F.col("host").alias(host), F.col("rate").alias(rate)), "rates")


def judge(docs: DataFrame, host: str = "source", rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """One row per row of ``docs``: its counts, its host's rate and ``kept``
    (see ``Rules``).

    A null text has no words and fails; a null host is a host of its own; rows
    that repeat are judged each; an empty table gives no rows. Other columns
    are not read.
    """
    m = written(measure(docs, host), "measured")
    j = m.join(_rates(m, rules), F.col("host").eqNullSafe(F.col("__host")), "left")
    j = (j.withColumn("base_failed", rules.base_failed(F.col)).withColumn("rule_failed", rules.rule_failed(F.col))
         .withColumn("host_verdict", rules.verdict(F.col("__rate"))))
    kept = rules.kept(F.col("base_failed"), F.col("rule_failed"), F.col("host_verdict"))
    return j.withColumn("kept", kept).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "rule_failed", "host", F.col("__rate").alias("host_rate"), "host_verdict")


def keep_good(docs: DataFrame, host: str = "source", rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """The rows of ``docs`` that ``judge`` keeps, with their columns.

    The counts are made twice, once for the hosts and once beside the rows
    themselves: the texts are then not shuffled to meet their verdicts, only
    the hosts' rates are joined to them. Nulls, repeated rows and empty tables
    as in ``judge``; further columns may have any name.
    """
    measures, its_host, rate = unused(docs, "__measures", "__host", "__rate")
    schema = T.StructType([*docs.schema.fields, T.StructField(measures, T.StructType(
        [T.StructField(c, T.LongType()) for c in _COUNTS]))])
    rates = _rates(measure(docs, host), rules, its_host, rate)
    rows = in_arrow(docs.withColumn("text", F.col("text").cast("string")), _measure_rows_task(measures), schema)
    j = rows.join(rates, F.col(host).cast("string").eqNullSafe(F.col(its_host)), "left")

    def count(name):
        return F.col(f"{measures}.{name}")

    kept = rules.kept(rules.base_failed(count), rules.rule_failed(count), rules.verdict(F.col(rate)))
    return j.filter(kept).select(*docs.columns)
