"""Language-model scores from a sharded Elias-Fano n-gram trie.

The documents become blocks of tokens, written once. Each block asks for the
different n-grams it holds and reports how often its training documents hold
them; questions travel to shards by their first word. A shard sums the counts,
builds its part of the trie and answers; the answers go back to the blocks,
which add up their documents' probabilities. Frequent first words are spread
over several shards by the word that follows.

The model interpolates absolutely discounted relative frequencies with the
next shorter context, down to add-0.1 word probabilities. The n-grams'
probabilities and weights are kept as 8-bit codes, rounded down.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.llm.common import in_arrow, release, shuffle_partitions, sub_batches, text_bytes, word_keys, written
from mallscope.llm.elias_fano import PROBABILITY, SUCCESSOR_BITS, NgramTrie, quantise

#: The end of a text, a token like the words and the first context of a text.
END = np.uint64(0xE27D9B1F6A5C4837)
_CUT = np.uint64(64 - SUCCESSOR_BITS)

#: Tokens for each shard, about; a shard is held whole by one Python task.
SHARD_TOKENS = 1 << 20

BLOCK_SCHEMA = "block bigint, tokens bigint, payload binary"


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays as bytes: the bytes of equal weight together, compressed."""
    out = [np.array([len(arrays)] + [x for a in arrays for x in (a.itemsize, len(a))], dtype="<i8").tobytes()]
    press = zstandard.ZstdCompressor(level=1)
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
        part = press.compress(np.ascontiguousarray(planes).tobytes())
        out += [len(part).to_bytes(8, "little"), part]
    return b"".join(out)


def _unpack(raw: bytes, kinds: str) -> list[np.ndarray]:
    """``kinds``: a NumPy type character for each array ('5' for 40-bit
    numbers)."""
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(n, 2)
    at, out = 8 + 16 * n, []
    expand = zstandard.ZstdDecompressor()
    for (size, length), kind in zip(head.tolist(), kinds, strict=True):
        part = int.from_bytes(raw[at:at + 8], "little")
        planes = np.frombuffer(expand.decompress(raw[at + 8:at + 8 + part]), np.uint8).reshape(size, length)
        wide = 8 if kind == "5" else size
        bytes_ = np.zeros((length, wide), dtype=np.uint8)
        bytes_[:, :size] = planes.T
        out.append(bytes_.reshape(-1).view("<u8" if kind == "5" else f"<{kind}"))
        at += 8 + part
    return out


def _five(x: np.ndarray) -> np.ndarray:
    """40-bit numbers as five bytes each."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].copy().view("V5").ravel()


def _block_task(block_tokens: int):
    def run(batches):
        seq = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        held_n = 0

        def block():
            nonlocal seq, held, held_n
            keys, which = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
            counts = np.concatenate([h[1] for h in held])
            ids, known, train = [], [], []
            for doc_ids, _, _, flags in held:
                ids += doc_ids
                train += flags
            known = np.array([i is not None for i in ids], dtype="u1")
            payload = _pack([keys, which.astype("<u4"), counts.astype("<u4"),
                             np.array([i or 0 for i in ids], dtype="<i8"), known, np.array(train, dtype="u1")])
            row = (seq, held_n + len(ids), payload)
            seq, held, held_n = seq + 1, [], 0
            return pa.RecordBatch.from_pydict(
                {"block": pa.array([row[0]], pa.int64()), "tokens": pa.array([row[1]], pa.int64()),
                 "payload": pa.array([row[2]], pa.binary())})

        for batch in sub_batches(batches, "text"):
            texts = [t.lower() for t in batch.column("text").to_pylist()]
            of, keys = word_keys(texts)
            held.append((batch.column("doc_id").to_pylist(), np.bincount(of, minlength=len(texts)), keys,
                         batch.column("train").to_pylist()))
            held_n += len(keys)
            if held_n >= block_tokens:
                yield block()
        if held:
            yield block()
    return run


def make_blocks(docs: DataFrame, is_training, block_tokens: int = 1_500_000) -> DataFrame:
    """Blocks of about ``block_tokens`` words (a longer text lies in one)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(is_training("doc_id"), F.lit(False)).alias("train"), text_bytes().alias("text"))
    return written(in_arrow(rows, _block_task(block_tokens), BLOCK_SCHEMA), "lm-blocks")


def _cuts(shards: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where each shard of ``asked`` begins and ends in ascending ``shards``."""
    return np.stack([np.searchsorted(shards, asked), np.searchsorted(shards, asked, side="right")], axis=1)


class _Block:
    """One block's documents and n-grams, numbered in a fixed order."""

    def __init__(self, payload: bytes, order: int):
        words, which, counts, self.doc_ids, self.named, self.train = _unpack(payload, "QIIqBB")
        self.counts = counts.astype(np.int64)
        n_docs = len(counts)
        # words and, last, the end; every text is END words END
        self.keys = np.append(words, END)
        end = len(words)
        size = self.counts + 2
        first = np.cumsum(size) - size
        seq = np.full(int(size.sum()), end, dtype=np.int32)
        inside = np.ones(len(seq), dtype=bool)
        inside[first] = inside[first + size - 1] = False
        seq[inside] = which
        opening = np.zeros(len(seq), dtype=bool)
        opening[first] = True
        at = np.flatnonzero(~opening)       # all tokens: without the opening END
        self.token = seq[at]
        self.doc = np.repeat(np.arange(n_docs, dtype=np.int32), size)[at]
        train = self.train.astype(bool)[self.doc]
        n = len(self.keys)
        self.count1 = np.bincount(self.token[train], minlength=n)
        code = seq[at - 1].astype(np.int64) * n + self.token
        code, pair = np.unique(code, return_inverse=True)
        self.pair = pair.astype(np.int32)
        del pair
        self.count2 = np.bincount(self.pair[train], minlength=len(code)).astype("<u4")
        self.parent2, self.word2 = (code // n).astype(np.int32), (code % n).astype(np.int32)
        self.deep = np.zeros(0, dtype=np.int32)
        if order > 2:
            # places whose two words before lie in the text (its opening END included)
            second = np.flatnonzero(at - 2 >= first[self.doc])
            del at
            self.deep = second.astype(np.int32)
            code = self.pair[second - 1].astype(np.int64) * n + self.token[second]
            code, triple = np.unique(code, return_inverse=True)
            self.triple = triple.astype(np.int32)
            del triple
            self.count3 = np.bincount(self.triple[train[second]], minlength=len(code)).astype("<u4")
            self.parent3, self.word3 = (code // n).astype(np.int32), (code % n).astype(np.int32)

    def shards(self, hot: dict[int, int], n_shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shard of each word's context, how many it is spread over, and the
        shard of each word pair."""
        home = (self.keys >> np.uint64(20)).astype(np.int64) % n_shards
        spread = np.ones(len(self.keys), dtype=np.int64)
        if hot:
            hot_keys = np.array(sorted(hot), dtype=np.uint64)
            at = np.minimum(np.searchsorted(hot_keys, self.keys), len(hot_keys) - 1)
            is_hot = hot_keys[at] == self.keys
            spread[is_hot] = [hot[int(k)] for k in self.keys[is_hot]]
        step = (self.keys[self.word2] >> np.uint64(8)).astype(np.int64) % spread[self.parent2]
        return home, spread, ((home[self.parent2] + step) % n_shards).astype(np.int32)

    def requests(self, hot: dict[int, int], n_shards: int):
        """Per shard: its contexts, word pairs and (order 3) triples, as index
        arrays in the order in which questions and answers list them."""
        home, spread, pair_shard = self.shards(hot, n_shards)
        ctx = np.repeat(np.arange(len(self.keys)), spread)
        nth = np.arange(len(ctx)) - np.repeat(np.cumsum(spread) - spread, spread)
        ctx_shard = (home[ctx] + nth) % n_shards
        by_ctx = np.argsort(ctx_shard, kind="stable")
        by_pair = np.argsort(pair_shard, kind="stable")
        asked = np.unique(ctx_shard)
        ctx_cut = _cuts(ctx_shard[by_ctx], asked)
        pair_cut = _cuts(pair_shard[by_pair], asked)
        if len(self.deep):
            deep_shard = pair_shard[self.parent3]
            by_deep = np.argsort(deep_shard, kind="stable")
            deep_cut = _cuts(deep_shard[by_deep], asked)
        for k, s in enumerate(asked.tolist()):
            c = ctx[by_ctx[slice(*ctx_cut[k])]]
            p = by_pair[slice(*pair_cut[k])]
            t = by_deep[slice(*deep_cut[k])] if len(self.deep) else self.deep
            yield s, c, p, t


def _ask_task(hot: dict[int, int], n_shards: int, order: int):
    def asked(number, raw):
        b = _Block(raw, order)
        high = b.keys >> _CUT
        for s, c, p, t in b.requests(hot, n_shards):
            place = np.searchsorted(c, b.parent2[p])
            arrays = [b.keys[c], b.count1[c].astype("<u4"),
                      np.bincount(place, minlength=len(c)).astype("<u4"), _five(high[b.word2[p]]), b.count2[p]]
            if order > 2:
                children = np.bincount(np.searchsorted(p, b.parent3[t]), minlength=len(p))
                arrays += [children.astype("<u4"), _five(high[b.word3[t]]), b.count3[t]]
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([s], pa.int32()), "block": pa.array([number], pa.int64()),
                 "payload": pa.array([_pack(arrays)], pa.binary())})

    def run(batches):
        for batch in batches:
            for number, raw in zip(batch.column("block"), batch.column("payload"), strict=True):
                yield from asked(number.as_py(), raw.as_py())
                release()       # one block at a time
    return run


def _answer(order: int, n_shards: int, discount: float):
    def run(batches):
        """Rows arrive ordered by shard; one shard is held at a time."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for a, z in zip(edges, edges[1:], strict=False):
                if a == z:
                    continue
                if held and held[0].column("shard")[0].as_py() != int(shard[a]):
                    yield from answered(held)
                    release()
                held.append(batch.slice(a, z - a))
        if held:
            yield from answered(held)
            release()

    def summed(parents, words, counts, below):
        """Different (parent, word) in order, their summed counts and the
        place of each question among them. Parents and words share 64 bits: a
        shard has fewer than 2^24 nodes a level."""
        if below >= 1 << (64 - SUCCESSOR_BITS):
            raise ValueError("a shard holds too many n-grams: lower SHARD_TOKENS")
        code, which = np.unique((parents.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | words, return_inverse=True)
        total = np.bincount(which, weights=counts, minlength=len(code)).astype(np.int64)
        word = code & np.uint64((1 << SUCCESSOR_BITS) - 1)
        return (code >> np.uint64(SUCCESSOR_BITS)).astype(np.int64), word, total, which.astype(np.int32)

    def parents_of(at, asked, nodes, sizes):
        """The node of the level above for each question of the level."""
        edge = np.cumsum([len(a[nodes]) for a in asked])
        return np.concatenate([np.repeat(x, a[sizes]) for x, a in zip(np.split(at, edge[:-1]), asked, strict=True)])

    def answered(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        """The answers of the shard whose messages are ``held``, which is emptied."""
        table = pa.Table.from_batches(held)
        held.clear()
        shard = table.column("shard")[0].as_py()
        blocks = table.column("block").to_pylist()
        asked = [_unpack(raw.as_py(), "QII5I" + "I5I" * (order > 2)) for raw in table.column("payload")]
        # the different questions of each level, and which of them each block asks
        keys, which1 = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
        which1 = which1.astype(np.int32)
        count1 = np.bincount(which1, weights=np.concatenate([a[1] for a in asked]), minlength=len(keys)).astype(np.int64)
        parent2, word2, count2, which2 = summed(
            parents_of(which1, asked, 0, 2), np.concatenate([a[3] for a in asked]),
            np.concatenate([a[4] for a in asked]), len(keys))
        parent3, word3, count3, which3 = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64),
                                          np.zeros(0, np.int32))
        if order > 2:
            parent3, word3, count3, which3 = summed(
                parents_of(which2, asked, 3, 5), np.concatenate([a[6] for a in asked]),
                np.concatenate([a[7] for a in asked]), len(parent2))
        lengths = [[len(a[i]) for i in ((0, 3, 6) if order > 2 else (0, 3))] for a in asked]
        del asked, table
        # the trie holds what the training documents hold
        kept1, kept2, kept3 = count1 > 0, count2 > 0, count3 > 0
        new1, new2 = np.cumsum(kept1) - 1, np.cumsum(kept2) - 1
        trie = NgramTrie(keys[kept1], count1[kept1], new1[parent2[kept2]], word2[kept2], count2[kept2],
                         new2[parent3[kept3]], word3[kept3], count3[kept3], discount)
        # each different question is searched once, however many blocks ask it
        place, found = trie.find_contexts(keys)
        there = np.flatnonzero(found)
        c1, n1 = np.zeros(len(keys), dtype="<u4"), np.zeros(len(keys), dtype="<u4")
        c1[there], n1[there] = trie.count1[place[there]], trie.size2[place[there]]
        p2, at2 = _look_up(trie, "2", place, found, np.bincount(parent2, minlength=len(keys)), word2)
        levels = [(which1, (c1, n1)), (which2, tuple(p2))]
        if order > 2:
            p3, _ = _look_up(trie, "3", at2, p2[0] > 0, np.bincount(parent3, minlength=len(word2)), word3)
            levels.append((which3, (p3[0],)))
        replies, begin = [], [0] * len(levels)
        for sizes in lengths:
            arrays = []
            for i, (which, values) in enumerate(levels):
                mine = which[begin[i]:begin[i] + sizes[i]]
                arrays += [v[mine] for v in values]
                begin[i] += sizes[i]
            replies.append(_pack(arrays))
        # of a spread word the home shard alone reports the count
        mine = (keys >> np.uint64(20)).astype(np.int64) % n_shards == shard
        report = (int(((count1 > 0) & mine).sum()), int(count1[mine].sum()), trie.bytes)
        return pa.table({
            "block": pa.array([*blocks, -1], pa.int64()), "shard": pa.array([shard] * (len(blocks) + 1), pa.int32()),
            "payload": pa.array([*replies, None], pa.binary()),
            "words": pa.array([None] * len(blocks) + [report[0]], pa.int64()),
            "total": pa.array([None] * len(blocks) + [report[1]], pa.int64()),
            "bytes": pa.array([None] * len(blocks) + [report[2]], pa.int64())}).to_batches()
    return run


def _look_up(trie: NgramTrie, level: str, place, found, sizes, words):
    """Codes of the successors ``words``, ``sizes`` of them under each node."""
    n = len(words)
    codes = np.zeros((2, n), dtype=np.uint8)
    at = np.zeros(n, dtype=np.int64)
    ok = np.repeat(found, sizes)
    ask = np.flatnonzero(ok)
    if len(ask):
        where, hit = trie.find_words(level, place[found], sizes[found], words[ask])
        got, where = ask[hit], where[hit]
        at[got] = where
        codes[0, got] = (trie.p2 if level == "2" else trie.p3)[where]
        if level == "2":
            codes[1, got] = trie.weight2[where]
    return codes, at


def _score_task(n_shards: int, order: int, hot: dict[int, int], total: int, distinct: int, discount: float):
    def run(batches):
        for batch in batches:
            for raw, answers in zip(batch.column("payload"), batch.column("answers"), strict=True):
                yield _score_block(_Block(raw.as_py(), order), {x["shard"]: x["payload"] for x in answers.as_py()},
                                   n_shards, order, hot, total, distinct, discount)
                release()
    return run


def _score_block(b: _Block, answers, n_shards, order, hot, total, distinct, discount):
    n = len(b.keys)
    count, followers = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    p2, weight2 = np.zeros(len(b.parent2)), np.ones(len(b.parent2))
    p3 = np.zeros(len(b.parent3)) if order > 2 else None
    for s, c, p, t in b.requests(hot, n_shards):
        c1, n1, q2, w2, *q3 = _unpack(answers[s], "IIBB" + "B" * (order > 2))
        count[c] = c1               # each shard of a spread word knows its count
        followers[c] += n1
        p2[p] = PROBABILITY[q2]
        weight2[p] = np.where(q2 > 0, PROBABILITY[w2], 1.0)
        if order > 2:
            p3[t] = PROBABILITY[q3[0]]
    base = (count + 0.1) / (total + 0.1 * (distinct + 1))
    weight1 = np.where(count > 0, discount * followers / np.maximum(count, 1), 1.0)
    pair = p2[b.pair] + weight1[b.parent2[b.pair]] * base[b.token]
    if order > 2 and len(b.deep):
        before = b.pair[b.deep - 1]
        pair[b.deep] = p3[b.triple] + weight2[before] * pair[b.deep]
    n_docs = len(b.counts)

    def per_doc(x):
        return np.bincount(b.doc, weights=x, minlength=n_docs)

    columns = [
        pa.array(b.doc_ids, pa.int64(), mask=b.named == 0), pa.array(b.counts + 1, pa.int64()),
        pa.array(per_doc(count[b.token] > 0).astype(np.int64)), pa.array(np.full(n_docs, total, dtype=np.int64)),
        pa.array(per_doc(np.log10(base[b.token]))), pa.array(per_doc(np.log10(np.minimum(pair, 1.0))))]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_known", "train_tokens",
                                                      "base_score", "score"])


def hot_words(blocks: DataFrame, n_shards: int, total: int) -> dict[int, int]:
    """The words that are to be spread, each with the number of shards, of
    ``total`` tokens. A word of a share of 1/(8 shards) of all tokens has
    that share in some block, so blocks name their own; at most 8 * shards
    words have it overall, and only those reach the driver."""
    def run(batches):
        for batch in batches:
            for raw in batch.column("payload").to_pylist():
                keys, which, counts, *_ = _unpack(raw, "QIIqBB")
                times = np.append(np.bincount(which, minlength=len(keys)), len(counts))
                often = np.flatnonzero(times * 8 * n_shards >= times.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(keys, END)[often].view(np.int64)), pa.array(times[often].astype(np.int64))],
                    names=["word", "times"])

    often = (in_arrow(blocks.select("payload"), run, "word bigint, times bigint").groupBy("word")
             .agg(F.sum("times").alias("times")).filter(F.col("times") * 8 * n_shards >= total).collect())
    return {r["word"] & (1 << 64) - 1: min(n_shards, 1 + r["times"] * 8 * n_shards // total) for r in often}


def score_documents(docs: DataFrame, is_training, order: int = 3, discount: float = 0.8,
                    block_tokens: int = 1_500_000) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score.

    ``is_training`` maps a doc_id column to a condition: the model and the
    base counts learn from those rows, all rows are scored. Words are runs of
    anything but ASCII white space with A-Z lower-cased, and each text ends
    with one more token. ``order`` is 2 or 3. Null texts are empty (the end
    alone); null doc_ids are kept; rows that repeat count and are scored
    each; an empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    blocks = make_blocks(docs, is_training, block_tokens)
    tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
    # two shards for each partition, and more partitions for more tokens
    partitions = max(shuffle_partitions(spark), -(-tokens // (2 * SHARD_TOKENS)))
    n_shards = 2 * partitions
    hot = hot_words(blocks, n_shards, tokens)
    asked = in_arrow(
        blocks.select("block", "payload"), _ask_task(hot, n_shards, order), "shard int, block bigint, payload binary")
    # shards are dealt by number, so each task has the same number of them
    dealt = asked.repartitionById(partitions, F.col("shard")).sortWithinPartitions("shard")
    answers = written(in_arrow(
        dealt, _answer(order, n_shards, discount),
        "block bigint, shard int, payload binary, words bigint, total bigint, bytes bigint"), "lm-answers")
    model = answers.filter("block = -1").agg(F.sum("words"), F.sum("total")).first()
    of = answers.filter("block >= 0").groupBy("block").agg(F.collect_list(F.struct("shard", "payload")).alias("answers"))
    return in_arrow(
        blocks.select("block", "payload").join(of, "block").select("payload", "answers"),
        _score_task(n_shards, order, hot, model[1] or 0, model[0] or 0, discount),
        "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
