"""Token ids of whole texts, by a public tokenizer of the tokenizers library.

The texts are cut at white space where the tokenizer starts anew anyway, each different piece is
encoded once, and the ids are put together again. This gives the ids of encoding the whole text.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from repo_pulse.llm.arrow_text import (
    IS_SPACE,
    Texts,
    binary_array,
    group_sums,
    lower_ascii,
    ranges,
    texts_of,
    words_of,
)

# White space beyond ASCII. A byte-level tokenizer may join it with white space next to it, so a
# text with such a character is encoded in one go.
WIDE_SPACE = "[\u0085   -     　]"

# What the last id of a word's run ends in, in vocabularies of words.
WORD_END = "</w>"
# How a blank is written in byte-level vocabularies.
BLANK = "Ġ"

# Different pieces a Python worker remembers from batch to batch, and their longest.
REMEMBERED = 400_000
REMEMBERED_BYTES = 32

# Pieces are handed to the library in strings of so many, with a special token between them.
JOINED = 2_000

# Words of printable ASCII without ' and < fall into runs of letters, single digits and runs of
# other characters, each with ids of its own of which only the last ends a word. So their ids can
# be told apart when blanks join them, which costs the library less; so many at a time.
PLAIN_JOINED = 20_000
LETTER, DIGIT, MARK, OTHER = 1, 2, 3, 0
KINDS = np.full(256, OTHER, dtype=np.uint8)
KINDS[0x21:0x7F] = MARK
KINDS[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = LETTER
KINDS[ord("0") : ord("9") + 1] = DIGIT
KINDS[[ord("'"), ord("<")]] = OTHER
# Other words have a word between them that is one id, if none of them holds its character.
BETWEEN = "~"
# To a byte-level tokenizer a blank in front of these starts a run, and no id goes on across it.
BEHIND_BLANK = np.zeros(256, dtype=bool)
BEHIND_BLANK[0x21:] = True
BEHIND_BLANK[[ord("<"), 0x7F]] = False


# Number of each piece asked for; ends and values of the ids of all numbered pieces.
Numbered = tuple[np.ndarray, np.ndarray, np.ndarray]


class Encoder:
    """Encodes columns of texts; keeps white space (byte-level) or drops it (words)."""

    def __init__(self, path: str, drops_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.drops_space = drops_space
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [token.content.encode() for token in added.values()]
        self.mark = next(t.content for t in added.values() if t.special and not t.normalized)
        self.mark_id = self.tokenizer.token_to_id(self.mark)
        self.normalizer = self.tokenizer.normalizer
        self.nothing = normalizers.Sequence([])
        self.folds = drops_space and folds_case(json.loads(self.tokenizer.to_str())["normalizer"])
        # The ids that end a run, or start with the blank in front of one.
        vocabulary = self.tokenizer.get_vocab()
        bounds = [
            i
            for t, i in vocabulary.items()
            if (t.endswith(WORD_END) if drops_space else t.startswith(BLANK))
        ]
        self.at_bound = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.at_bound[bounds] = True
        self.between_id = vocabulary.get(BETWEEN + WORD_END) if drops_space else None
        # Ids of the remembered pieces lie in a row; a piece's number tells where.
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(0, dtype=np.int32)
        self.ends = np.zeros(1, dtype=np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (int32), and where each text's ids end (offsets[0] is 0)."""
        texts = texts_of(column)
        if self.drops_space:
            cut = words_of(texts)
            if self.folds:
                cut.data = folded(cut.data, cut.offsets)
            return assemble(cut.array(), cut.of_text, self._lookup)
        wide = pc.fill_null(pc.match_substring_regex(column, WIDE_SPACE), False)
        starts = self._unit_starts(texts, wide.to_numpy(zero_copy_only=False))
        of_text = np.searchsorted(starts, texts.offsets)
        units = binary_array(texts.data, np.append(starts, len(texts.data)))
        return assemble(units, of_text, self._lookup)

    @staticmethod
    def _unit_starts(texts: Texts, whole: np.ndarray) -> np.ndarray:
        """Each text's start, and each white space after something else; `whole` texts stay one."""
        space = IS_SPACE[texts.data]
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        for i in np.flatnonzero(whole):
            cut[texts.offsets[i] : texts.offsets[i + 1]] = False
        starts = texts.offsets[:-1]
        cut[starts[starts < len(cut)]] = True
        return np.flatnonzero(cut)

    def _lookup(self, units: list[bytes]) -> Numbered:
        """Number of each unit, and the ids of all numbered units: their ends and values."""
        known = self.known
        number = np.fromiter(map(known.get, units, repeat(-1)), dtype=np.int64, count=len(units))
        new = np.flatnonzero(number < 0)
        if not len(new):
            return number, self.ends, self.ids
        # Short ones first: these are the ones to remember.
        lengths = np.fromiter((len(units[i]) for i in new), dtype=np.int64, count=len(new))
        new = new[np.argsort(lengths > REMEMBERED_BYTES, kind="stable")]
        sizes, values = self._encode_words([units[i] for i in new])
        number[new] = len(known) + np.arange(len(new))
        ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        ids = np.concatenate([self.ids, values])
        keep = min(int((lengths <= REMEMBERED_BYTES).sum()), REMEMBERED - len(known))
        if keep > 0:
            first = len(known)
            known.update((units[i], first + k) for k, i in enumerate(new[:keep]))
            self.ends = ends[: len(known) + 1].copy()
            self.ids = ids[: self.ends[-1]].copy()
        return number, ends, ids

    def _encode_words(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each unit, and all ids in a row."""
        runs = runs_in(units) if self.drops_space else behind_blank(units)
        some, others = np.flatnonzero(runs), np.flatnonzero(runs == 0)
        if not len(some):
            return self._encode_new(units)
        sizes = np.zeros(len(units), dtype=np.int64)
        parts = []
        for at in range(0, len(some), PLAIN_JOINED):
            own = some[at : at + PLAIN_JOINED]
            joint = b" " if self.drops_space else b""
            ids = self._plain(joint.join([units[i] for i in own]), normal=self.folds)
            bounds = np.flatnonzero(self.at_bound[ids])
            if self.drops_space:
                sizes[own] = np.diff(bounds[np.cumsum(runs[own]) - 1], prepend=-1)
            else:
                sizes[own] = np.diff(bounds, append=len(ids))
            parts.append(ids)
        if len(others):
            sizes[others], ids = self._encode_new([units[i] for i in others])
            parts.append(ids)
        order = np.concatenate([some, others])
        starts = np.zeros(len(units), dtype=np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return sizes, np.concatenate(parts)[ranges(starts, sizes)]

    def _encode_new(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes, values = [], []
        for at in range(0, len(units), JOINED):
            group = units[at : at + JOINED]
            held = b"".join(group)
            if any(s in held for s in self.special):
                parts = [self._plain(unit) for unit in group]
                sizes.append(np.array([len(p) for p in parts], dtype=np.int64))
                values.extend(parts)
                continue
            mark, mark_id = self.mark, self.mark_id
            if self.between_id is not None and BETWEEN.encode() not in held:
                mark, mark_id = f" {BETWEEN} ", self.between_id
            ids = self._plain(mark.encode().join(group))
            marks = np.flatnonzero(ids == mark_id)
            sizes.append(np.diff(marks, prepend=-1, append=len(ids)) - 1)
            values.append(np.delete(ids, marks))
        return np.concatenate(sizes), np.concatenate(values)

    def _plain(self, text: bytes, normal: bool = False) -> np.ndarray:
        """The ids of a text; a `normal` one is as the normalizer would leave it."""
        if normal:
            self.tokenizer.normalizer = self.nothing
        try:
            encoded = self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)
        finally:
            if normal:
                self.tokenizer.normalizer = self.normalizer
        return np.array(encoded[0].ids, dtype=np.int32)


def folds_case(normalizer: dict | None) -> bool:
    """Whether a normalizer turns A-Z into a-z and leaves other printable ASCII as it is."""
    steps = (normalizer or {}).get("normalizers", [normalizer] if normalizer else [])
    blanks = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    known = all(s["type"] in ("NFC", "Lowercase") or s == blanks for s in steps)
    return known and any(s["type"] == "Lowercase" for s in steps)


def folded(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bytes of words with A-Z as a-z in those of characters whose KINDS are known.

    Other words may hold a special token, or a letter that a normalizer joins to a mark behind it.
    """
    lower = lower_ascii(data)
    odd = np.searchsorted(offsets, np.flatnonzero(KINDS[data] == OTHER), side="right") - 1
    odd = odd[np.diff(odd, prepend=-1) > 0]
    own = ranges(offsets[odd], offsets[odd + 1] - offsets[odd])
    lower[own] = data[own]
    return lower


def runs_in(units: list[bytes]) -> np.ndarray:
    """Runs of each word of characters whose KINDS are known, 0 for other words."""
    lengths = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
    kinds = KINDS[np.frombuffer(b"".join(units), dtype=np.uint8)]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    opens = np.ones(len(kinds), dtype=np.int64)
    opens[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
    opens[bounds[:-1][lengths > 0]] = 1
    odd = group_sums((kinds == OTHER).astype(np.int64), bounds)
    return np.where(odd > 0, 0, group_sums(opens, bounds))


def behind_blank(units: list[bytes]) -> np.ndarray:
    """1 for each unit of one blank and characters that BEHIND_BLANK has, 0 for other units."""
    lengths = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
    raw = np.frombuffer(b"".join(units), dtype=np.uint8)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    odd = ~BEHIND_BLANK[raw]
    found = lengths > 1
    found[found] = raw[bounds[:-1][found]] == ord(" ")
    odd[bounds[:-1][found]] = False
    return (found & (group_sums(odd.astype(np.int64), bounds) == 0)).astype(np.int64)


def assemble(
    units: pa.Array, of_text: np.ndarray, lookup: Callable[[list[bytes]], Numbered]
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts from the ids of their pieces; each different piece is looked up once."""
    coded = units.dictionary_encode()
    number, ends, values = lookup(coded.dictionary.to_pylist())
    distinct = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))
    taken = distinct.take(pa.array(number[coded.indices.to_numpy()]))
    return taken.values.to_numpy(), taken.offsets.to_numpy()[of_text]


def with_last(ids: np.ndarray, ends: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the id `last` behind each text."""
    return np.insert(ids, ends[1:], last), ends + np.arange(len(ends))


def crc32_of(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of each range of ids as little-endian unsigned 32-bit integers."""
    raw = memoryview(np.ascontiguousarray(ids, dtype="<i4")).cast("B")
    return np.fromiter(
        (zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)),
        dtype=np.int64,
        count=len(ends) - 1,
    )


@functools.cache
def encoder(path: str, drops_space: bool) -> Encoder:
    """One encoder for each Python worker and tokenizer."""
    return Encoder(path, drops_space)
