"""Minimal acyclic transducer: words to numbers, with suffixes shared.

A word's number is the sum of the outputs on its path, and the number names its row of ids. The
automaton is a few sorted arrays in one buffer, so workers can map the file into memory and look
up many words at a time, byte by byte.
"""

from __future__ import annotations

import functools
import mmap

import numpy as np

HEADER = 5  # counts of the five parts, as 64-bit integers


def compile_lexicon(words: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """The automaton of different, ascending words; `sizes` and `ids` hold each word's ids."""
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def freeze(final: bool, arcs: list[tuple[int, int]]) -> int:
        """A state with this right language; equal states are one."""
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    # The path of the last word: each entry is (final, arcs so far) of a state not yet frozen.
    path: list[list] = [[False, []]]
    previous = b""
    for word in words:
        common = 0
        while common < min(len(word), len(previous)) and word[common] == previous[common]:
            common += 1
        for depth in range(len(previous), common, -1):
            final, arcs = path.pop()
            path[-1][1].append((previous[depth - 1], freeze(final, arcs)))
        path.extend([False, []] for _ in word[common:])
        path[-1][0] = True
        previous = word
    for depth in range(len(previous), 0, -1):
        final, arcs = path.pop()
        path[-1][1].append((previous[depth - 1], freeze(final, arcs)))
    root = freeze(*path[0])

    # Words that end at or below a state; a state's targets are always frozen before it.
    below = np.zeros(len(states), dtype=np.int64)
    keys, targets, outputs = [], [], []
    for state, (final, arcs) in enumerate(states):
        passed = int(final)
        for byte, target in arcs:
            keys.append(state << 8 | byte)
            targets.append(target)
            outputs.append(passed)
            passed += int(below[target])
        below[state] = passed
    finals = np.array([final for final, _ in states], dtype=np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    parts = [
        np.array(keys, dtype=np.int64),
        np.array(list(zip(targets, outputs, strict=True)), dtype=np.int64).ravel(),
        np.append(finals, root),
        ends.astype(np.int64),
        np.asarray(ids, dtype=np.int64),
    ]
    return b"".join(p.tobytes() for p in [np.array([len(p) for p in parts]), *parts])


class Lexicon:
    """Looks words up in a compiled automaton."""

    def __init__(self, buffer):
        sizes = np.frombuffer(buffer, dtype=np.int64, count=HEADER)
        starts = HEADER + np.cumsum(sizes) - sizes
        keys, arcs, states, ends, ids = (
            np.frombuffer(buffer, dtype=np.int64, count=int(n), offset=8 * int(s))
            for n, s in zip(sizes, starts, strict=True)
        )
        self.keys, self.targets, self.outputs = keys, arcs[0::2], arcs[1::2]
        self.final, self.root = states[:-1].astype(bool), int(states[-1])
        self.ends, self.ids = ends, ids.astype(np.int32)

    def numbers(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Number of each word (its bytes lie in a row), -1 for words that are not in it."""
        lengths = np.diff(offsets)
        number = np.full(len(lengths), -1, dtype=np.int64)
        if not len(self.keys):
            return number
        rows = np.arange(len(lengths))
        state = np.full(len(lengths), self.root, dtype=np.int64)
        total = np.zeros(len(lengths), dtype=np.int64)
        depth = 0
        while len(rows):
            ended = lengths[rows] == depth
            hit = ended & self.final[state]
            number[rows[hit]] = total[hit]
            rows, state, total = rows[~ended], state[~ended], total[~ended]
            key = state << 8 | data[offsets[rows] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            rows, at = rows[found], at[found]
            state, total = self.targets[at], total[found] + self.outputs[at]
            depth += 1
        return number


@functools.cache
def mapped(path: str) -> Lexicon:
    """The lexicon of a file, mapped into memory: workers of one machine share its pages."""
    with open(path, "rb") as file:
        return Lexicon(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
