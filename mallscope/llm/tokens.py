"""Tokenizing documents with a public tokenizer file, inside Spark tasks."""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import public_tokenizers

from mallscope.llm.common import piece_keys, worker_cache

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

_END = "</w>"
_CHUNK = 1 << 21        # bytes that are cut and hashed at once
_SPACE, _LETTER, _PUNCT, _OTHER = 0, 1, 2, 3
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_CLASS = np.array([_SPACE if c in b"\t\n\v\f\r " else _LETTER if 97 <= c <= 122
                   else _PUNCT if chr(c) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else _OTHER
                   for c in range(256)], dtype=np.uint8)


class TextEncoder:
    """Texts to token ids, remembering the ids of the pieces seen.

    The tokenizer lower-cases, drops white space, never joins text across it
    and always cuts where ASCII punctuation follows an ASCII letter. A text's
    ids are therefore those of the pieces between such places, in turn, and
    each different piece is encoded once while it is remembered. Pieces are
    known by a 64-bit polynomial hash. At ``max_pieces`` the memory starts
    anew. Texts that spell a special token are encoded whole.
    """

    def __init__(self, path: str = TOKENIZER, max_pieces: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.max_pieces = max_pieces
        vocabulary = self.tokenizer.get_vocab()
        # which ids end a word of the tokenizer's own
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(_END)]] = True
        self._forget()

    @classmethod
    def of_worker(cls, path: str) -> TextEncoder:
        """The encoder that this Python worker keeps from task to task."""
        return worker_cache(("TextEncoder", path), lambda: cls(path))

    def _forget(self):
        self.keys = np.zeros(0, dtype=np.uint64)        # ascending
        self.at = np.zeros(0, dtype=np.int64)           # where the piece's ids begin
        self.size = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(0, dtype="<u4")

    def _letters(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of pieces of letters, many to a call: as a rule each ends with
        the only id in it that ends a word; where the count differs (a letter
        whose lower case isn't one letter), they are encoded singly."""
        groups = [pieces[i:i + 50] for i in range(0, len(pieces), 50)]
        out: list[np.ndarray] = []
        found = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, x in zip(groups, found, strict=True):
            ids = np.array(x.ids, dtype="<u4")
            stop = np.flatnonzero(self.ends[ids]) + 1
            out += np.split(ids, stop[:-1]) if len(stop) == len(group) else self._any(group)
        return out

    def _any(self, pieces: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4") for x in found]

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        """Encode new pieces (none holds white space) and remember them."""
        texts = b"\n".join(pieces).decode("utf-8", "replace").split("\n")
        letters = np.array([s.isalpha() for s in texts])
        order = np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])
        ids: list[np.ndarray] = []
        for of, encode in ((np.flatnonzero(letters), self._letters), (np.flatnonzero(~letters), self._any)):
            for i in range(0, len(of), 20_000):
                ids += encode([texts[k] for k in of[i:i + 20_000]])
        size = np.array([len(x) for x in ids], dtype=np.int64)
        at = len(self.pool) + np.cumsum(size) - size
        keys = np.concatenate([self.keys, keys[order]])
        by_key = np.argsort(keys, kind="stable")
        self.keys = keys[by_key]
        self.at = np.concatenate([self.at, at])[by_key]
        self.size = np.concatenate([self.size, size])[by_key]
        self.pool = np.concatenate([self.pool, *ids])

    def _chunk(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-cased text, and before which byte each piece begins
        with how many ids up to there: (ids, [byte, ids before])."""
        b = np.frombuffer(raw, dtype=np.uint8)
        kind = _CLASS[b]
        inside = kind != _SPACE
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | (kind[:-1] == _LETTER) & (kind[1:] == _PUNCT)
        stops = inside.copy()
        stops[:-1] &= ~inside[1:] | begins[1:]
        start, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        if not len(start):
            return self.pool[:0], np.zeros((2, 0), dtype=np.int64)
        key = piece_keys(b, start, stop)
        unique, first, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) > self.max_pieces:
            self._forget()
        there = np.searchsorted(self.keys, unique)
        new = np.ones(len(unique), dtype=bool)
        old = there < len(self.keys)
        new[old] = self.keys[there[old]] != unique[old]
        if new.any():
            f = first[new]
            self._learn(unique[new], [raw[x:y] for x, y in zip(start[f].tolist(), stop[f].tolist(), strict=True)])
            there = np.searchsorted(self.keys, unique)
        size, at = self.size[there][which], self.at[there][which]
        before = np.cumsum(size) - size
        ids = self.pool[np.repeat(at - before, size) + np.arange(int(size.sum()))]
        return ids, np.stack([start, before])

    def _long(self, raw: bytes) -> np.ndarray:
        """Ids of one lower-cased text of any length, cut at white space."""
        parts, at = [], 0
        while at < len(raw):
            end = min(len(raw), at + _CHUNK)
            if end < len(raw):
                cut = max(raw.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r"))
                if cut < at:        # a word longer than the chunk
                    cuts = [x for x in (raw.find(c, end) for c in (b" ", b"\n", b"\t", b"\r")) if x >= 0]
                    cut = min(cuts, default=len(raw))
                    word = raw[at:cut].decode("utf-8", "replace")
                    parts.append(np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4"))
                    at = cut
                    continue
                end = cut
            parts.append(self._chunk(raw[at:end])[0])
            at = end + (end == at)
        return np.concatenate(parts) if parts else self.pool[:0]

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn, each followed by ``end_id``, as
        unsigned 32-bit integers, and the number of ids of each text."""
        rows: list[tuple[np.ndarray, np.ndarray]] = []      # ids without ends, counts
        held: list[bytes] = []
        held_n = 0

        def close():
            nonlocal held, held_n
            if held:
                ids, (start, before) = self._chunk(b"\n".join(held))
                edge = np.cumsum([len(t) + 1 for t in held])
                upto = np.append(before, len(ids))[np.searchsorted(start, edge)]
                rows.append((ids, np.diff(upto, prepend=0)))
            held, held_n = [], 0

        for text in texts:
            if b"<|" in text:
                close()
                whole = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
                rows.append((np.array(whole, dtype="<u4"), np.array([len(whole)])))
                continue
            if len(text) + held_n + 1 > _CHUNK:
                close()
            low = text.translate(_LOWER)
            if len(low) >= _CHUNK:
                ids = self._long(low)
                rows.append((ids, np.array([len(ids)])))
            else:
                held.append(low)
                held_n += len(low) + 1
        close()
        if not rows:
            return self.pool[:0], np.zeros(0, dtype=np.int64)
        counts = np.concatenate([n for _, n in rows]).astype(np.int64)
        ids = np.concatenate([x for x, _ in rows])
        return np.insert(ids, np.cumsum(counts), end_id).astype("<u4", copy=False), counts + 1


def packed(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Per text its ids as little-endian unsigned 32-bit integers."""
    raw = ids.tobytes()
    cut = list(chain([0], (4 * np.cumsum(counts)).tolist()))
    return [raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
