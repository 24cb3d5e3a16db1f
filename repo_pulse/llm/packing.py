"""Vector bin packing of token sequences under several limits at a time.

Each example asks for tokens, one segment and some loss-bearing tokens of a sequence. A sequence
is filled by the dot-product heuristic: of the waiting pieces that fit, the one whose demand
points most in the direction of the room that is left is placed next. What no piece can fill is
filled by cutting one. Each task packs what it reads, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.arrow_text import pieces
from repo_pulse.llm.scratch import plain
from repo_pulse.llm.tokenizing import crc32_of, encoder, with_last

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, loss_tokens bigint, ids_crc32 bigint, "
    "doc_tokens bigint, sequence_id bigint, offset bigint"
)

# Pieces waiting in a task at most; more room to choose from packs no better beyond a few hundred.
POOL = 1024
# Sequences are numbered within a partition, so numbers need no agreement between tasks.
IDS_PER_PARTITION = 1 << 36


@dataclass
class Limits:
    """What a sequence holds at most."""

    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1024

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss_tokens], dtype=np.float64)


@dataclass
class Piece:
    """Consecutive ids of a document; the first `quiet` of them bear no loss."""

    doc: object
    start: int
    ids: np.ndarray
    quiet: int
    doc_tokens: int

    @property
    def demand(self) -> tuple[int, int, int]:
        return len(self.ids), 1, len(self.ids) - self.quiet

    def fitting(self, room: np.ndarray) -> int:
        """How many of its first ids fit into what is left of a sequence."""
        if room[1] < 1:
            return 0
        return int(min(room[0], len(self.ids), self.quiet + room[2]))

    def cut(self, at: int) -> tuple[Piece, Piece]:
        quiet = min(self.quiet, at)
        return (
            Piece(self.doc, self.start, self.ids[:at], quiet, self.doc_tokens),
            Piece(self.doc, self.start + at, self.ids[at:], self.quiet - quiet, self.doc_tokens),
        )


class Packer:
    """Packs a stream of pieces; holds at most POOL of them."""

    def __init__(self, limits: Limits):
        if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
            raise ValueError("every limit must be at least 1")
        self.limits = limits.vector()
        self.waiting: list[Piece] = []
        # A row for each limit, so that a limit is compared in one step.
        self.demands = np.zeros((3, POOL))

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Take a document; yields the sequences that are full."""
        while (fits := piece.fitting(self.limits)) < len(piece.ids) or fits == self.limits[0]:
            head, piece = piece.cut(fits)
            yield [head]
            if not len(piece.ids):
                return
        self._wait(piece)
        while len(self.waiting) == POOL:
            yield self._fill()

    def finish(self) -> Iterator[list[Piece]]:
        """The sequences of what is left; the last one is cut at powers of two, to need no pad."""
        while self.waiting:
            sequence = self._fill()
            if self.waiting:
                yield sequence
                continue
            total = sum(len(p.ids) for p in sequence)
            while total:
                size = 1 << (total.bit_length() - 1)
                total -= size
                part: list[Piece] = []
                while size:
                    head = sequence.pop(0)
                    if len(head.ids) > size:
                        head, rest = head.cut(size)
                        sequence.insert(0, rest)
                    part.append(head)
                    size -= len(head.ids)
                yield part

    def _wait(self, piece: Piece) -> None:
        self.demands[:, len(self.waiting)] = np.array(piece.demand) / self.limits
        self.waiting.append(piece)

    def _take(self, i: int) -> Piece:
        taken, last = self.waiting[i], self.waiting.pop()
        if i < len(self.waiting):
            self.waiting[i] = last
            self.demands[:, i] = self.demands[:, len(self.waiting)]
        return taken

    def _fill(self) -> list[Piece]:
        room, sequence = self.limits.copy(), []
        while self.waiting and room[0] >= 1 and room[1] >= 1:
            demands, left = self.demands[:, : len(self.waiting)], room / self.limits
            tokens, segments, loss = demands <= left[:, None] + 1e-9
            gains = np.where(tokens & segments & loss, left @ demands, -1.0)
            best = int(gains.argmax())
            if gains[best] >= 0:
                piece = self._take(best)
            else:
                best = int(demands[0].argmax())
                at = self.waiting[best].fitting(room)
                if at < 1:
                    break
                piece, rest = self._take(best).cut(at)
                self._wait(rest)
            sequence.append(piece)
            room -= piece.demand
        return sequence


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    limits: Limits | None = None,
    prompt_tokens: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """A row for each piece of a document and the sequence it lies in.

    `prompt_tokens` names a column with the number of a text's first tokens that bear no loss
    (null: none). `with_ids` adds the ids themselves. Null and empty texts are packed as their
    end id alone; null and repeated doc_ids are kept as they are, every row is packed by itself.
    Other columns are ignored, an empty table gives no rows. A partition's sequences hold only
    its own rows: the last one of a partition is cut at powers of two.
    """
    limits = limits or Limits()
    docs = plain(docs, "doc_id", "text", *([prompt_tokens] if prompt_tokens else []))
    prompt = F.col(prompt_tokens).cast("bigint") if prompt_tokens else F.lit(0).cast("bigint")
    schema = SCHEMA + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, drops_space=False)
        packer = Packer(limits)
        number = TaskContext.get().partitionId() * IDS_PER_PARTITION
        done: list[list[Piece]] = []
        for batch in pieces(batches):
            ids, ends = with_last(*coder.encode(batch.column(1)), end_id)
            docs_of, quiet_of = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, doc in enumerate(docs_of):
                own = ids[ends[i] : ends[i + 1]].copy()
                quiet = min(max(quiet_of[i] or 0, 0), len(own))
                done.extend(packer.add(Piece(doc, 0, own, quiet, len(own))))
            if done:
                yield rows(done, number)
                number, done = number + len(done), []
        done.extend(packer.finish())
        if done:
            yield rows(done, number)

    def rows(sequences: list[list[Piece]], number: int) -> pa.RecordBatch:
        placed = [p for s in sequences for p in s]
        lengths = np.array([len(p.ids) for p in placed], dtype=np.int64)
        counts = np.array([len(s) for s in sequences])
        ends = np.concatenate([[0], np.cumsum(lengths)])
        first = np.cumsum(counts) - counts
        ids = np.concatenate([p.ids for p in placed])
        columns = [
            pa.array([p.doc for p in placed], pa.int64()),
            pa.array([p.start for p in placed], pa.int64()),
            pa.array(lengths),
            pa.array([len(p.ids) - p.quiet for p in placed], pa.int64()),
            pa.array(crc32_of(ids, ends)),
            pa.array([p.doc_tokens for p in placed], pa.int64()),
            pa.array(np.repeat(number + np.arange(len(sequences)), counts)),
            pa.array(ends[:-1] - np.repeat(ends[first], counts)),
        ]
        if with_ids:
            columns.append(
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            )
        names = [part.split()[0] for part in schema.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names)

    asked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", prompt.alias("_p"))
    return asked.mapInArrow(run, schema)
