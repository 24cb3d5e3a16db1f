"""Texts of an Arrow batch as bytes, cut into words without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The six ASCII white-space bytes.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACE_BYTES)] = True

# Texts are worked on in pieces of about this many bytes, so a task's memory does not depend on
# the size of an Arrow batch. A longer single text makes a piece of its own.
PIECE_BYTES = 3 << 20


@dataclass
class Texts:
    """UTF-8 bytes of all texts in a row, and the end of each (offsets[0] is 0)."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts_of(column: pa.Array) -> Texts:
    """Bytes of a string column; a null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return Texts(np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64))
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return Texts(data, offsets - offsets[0])


def pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that the texts of each hold about `size` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False
        )
        piece = np.cumsum(lengths, dtype=np.int64) // size
        starts = np.flatnonzero(np.diff(piece, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, every other byte as it is."""
    upper = (data >= 0x41) & (data <= 0x5A)
    return data + (upper.view(np.uint8) << 5)


@dataclass
class Words:
    """Words of some texts: their bytes in a row, the end of each word, the words of each text."""

    data: np.ndarray
    offsets: np.ndarray
    of_text: np.ndarray
    starts: np.ndarray  # place of each word in the texts' bytes

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.of_text)

    def array(self) -> pa.Array:
        return binary_array(self.data, self.offsets)


def words_of(texts: Texts) -> Words:
    """Runs of bytes that are not white space."""
    solid = ~IS_SPACE[texts.data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    inner = texts.offsets[1:-1]
    inner = inner[inner < len(solid)]
    begins[inner] = solid[inner]
    inner = inner[inner > 0]
    ends[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) + 1 - starts
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    of_text = np.searchsorted(starts, texts.offsets)
    return Words(texts.data[solid], offsets, of_text, starts)


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow array over bytes that lie in a row."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [
            None,
            pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)),
            pa.py_buffer(np.ascontiguousarray(data)),
        ],
    )


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one range after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def group_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i + 1]] for each i; an empty range gives 0."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), dtype=values.dtype)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, bounds[:-1][full], axis=0)
    return out
