"""Exact byte-pair merges of many words at a time, for tokenizers with a word-end suffix."""

from __future__ import annotations

import functools
import heapq
import json

import numpy as np
import regex

# A word of up to this many symbols is merged together with others, in arrays.
SHORT = 48
NONE = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbol = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in symbol]
    return [symbol.get(b) or chr(256 + hidden.index(b)) for b in range(256)]


class Merges:
    """Vocabulary and merge table of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.strings = [""] * self.size
        for string, number in [*vocab.items(), *self.special.items()]:
            self.strings[number] = string
        symbols = byte_symbols()
        self.inner = np.array([vocab[c] for c in symbols], dtype=np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in symbols], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        split = next(
            p["pattern"]["Regex"]
            for p in spec["pre_tokenizer"]["pretokenizers"]
            if p["type"] == "Split"
        )
        # A line end between two texts keeps them apart.
        self.pattern = regex.compile(split + r"|\n")

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NONE without one (or where a side is absent, -1)."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[at], NONE)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word (none is empty), and all ids in a row."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        sizes = np.zeros(len(words), dtype=np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        low = 0
        for high in (8, 16, SHORT):
            rows = np.flatnonzero((lengths > low) & (lengths <= high))
            low = high
            if len(rows):
                ids = self._merge_short([words[i] for i in rows], lengths[rows])
                sizes[rows] = (ids >= 0).sum(axis=1)
                found.append((rows, ids[ids >= 0]))
        for i in np.flatnonzero(lengths > SHORT):
            ids = self._merge_long(words[i])
            sizes[i] = len(ids)
            found.append((np.array([i]), ids))
        starts = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), dtype=np.int32)
        for rows, ids in found:
            own = sizes[rows]
            inside = np.arange(len(ids)) - np.repeat(np.cumsum(own) - own, own)
            out[np.repeat(starts[rows], own) + inside] = ids
        return sizes, out

    def _symbols(self, word: bytes) -> np.ndarray:
        ids = self.inner[np.frombuffer(word, dtype=np.uint8)]
        ids[-1] = self.last[word[-1]]
        return ids

    def _merge_short(self, words: list[bytes], lengths: np.ndarray) -> np.ndarray:
        """A row of ids for each word, filled with -1: one merge in every word at a time."""
        width = int(lengths.max())
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8)
        raw = raw.reshape(len(words), width)
        place = np.arange(width)
        ids = np.where(place < lengths[:, None], self.inner[raw], -1)
        every = np.arange(len(words))
        ids[every, lengths - 1] = self.last[raw[every, lengths - 1]]
        out = np.full_like(ids, -1)
        ranks = self.rank(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((len(words), 1), NONE)
        rows = every
        while len(rows):
            at = ranks.argmin(axis=1)
            going = ranks[np.arange(len(rows)), at] < NONE
            out[rows[~going]] = ids[~going]
            rows, ids, ranks, at = rows[going], ids[going], ranks[going], at[going]
            if not len(rows):
                break
            here = np.arange(len(rows))
            key = ids[here, at] * self.size + ids[here, at + 1]
            merged = self.made[self.ranks[np.searchsorted(self.keys, key)]]
            # Everything behind the pair moves one place to the left.
            source = np.minimum(place + (place > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            ids[:, -1] = -1
            ids[here, at] = merged
            source = np.minimum(place[:-1] + (place[:-1] > at[:, None]), width - 2)
            ranks = np.take_along_axis(ranks, source, axis=1)
            ranks[:, -1] = NONE
            right = np.minimum(at + 1, width - 1)
            new = np.where(at + 1 < width, self.rank(merged, ids[here, right]), NONE)
            inside = at < width - 1
            ranks[here[inside], at[inside]] = new[inside]
            left = at > 0
            ranks[here[left], at[left] - 1] = self.rank(ids[here[left], at[left] - 1], merged[left])
        return out

    @functools.cached_property
    def _table(self) -> dict[int, tuple[int, int]]:
        made = self.made[self.ranks]
        return {
            int(k): (int(r), int(m)) for k, r, m in zip(self.keys, self.ranks, made, strict=True)
        }

    def _merge_long(self, word: bytes) -> np.ndarray:
        """One long word: a heap of mergeable pairs over a linked list of symbols."""
        ids = self._symbols(word).tolist()
        n, table = len(ids), self._table
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                key = ids[i] * self.size + ids[after[i]]
                if key in table:
                    heapq.heappush(heap, (table[key][0], i, key, table[key][1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, key, made = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or ids[i] * self.size + ids[j] != key:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return np.array([x for x in ids if x >= 0], dtype=np.int64)


@functools.cache
def merges(path: str) -> Merges:
    return Merges(path)
