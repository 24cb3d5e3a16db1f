"""Repair of conversations by generalised LR parsing of their roles.

The roles of a good conversation form a sentence of GRAMMAR: an optional system turn, then rounds of
user and assistant. The parser reads a conversation's rows in order over a graph-structured stack:
stack nodes are LR states that share what lies below them. At every row each stack top may keep the
row, rerole it or delete it, and before and after it insert an empty turn, each at a weight; tops
that are equal afterwards are merged, the smaller (cost, audit) staying. That loses nothing: two
tops of one state accept the same rest, and of two audits of equal cost neither begins the other.

Rows stream through a task in order and are held only until all stack tops agree on what became of
them, so a conversation of any length takes little memory; it is one stream because the digest of
its repaired text is one chain.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.arrow_text import pieces
from repo_pulse.llm.scratch import plain

START = "Talk"
GRAMMAR = (
    (START, ()),
    (START, ("Rounds",)),
    (START, ("s", "Rounds")),
    ("Rounds", ("Rounds", "Round")),
    ("Rounds", ("Round",)),
    ("Round", ("u", "a")),
)
ROLES = {"u": "user", "a": "assistant"}

# Weights of the edits; a truncated row that stays adds to them.
KEEP, REROLE, DELETE, INSERT, TRUNCATED_STAYS = 0, 1, 2, 5, 5

# A stack top that costs more than this above the cheapest one is dropped. From any state, whatever
# another one reads next can be read at two inserts more at most: an inserted user or assistant
# turn changes sides, two of them make a round where one is missing, and a system turn that comes
# too late can be deleted. So such a top can neither win nor tie.
SLACK = 2 * INSERT

# Faults of a row, the first that holds.
NONE, BLANK, TRUNCATED = 0, 1, 2
WHITE = " \t\n\v\f\r"
SENTENCE_ENDS = (".", "!", "?")

# Rows read between two looks for edits that all stack tops share.
SETTLE_EVERY = 128


def automaton(grammar: tuple) -> tuple[dict, dict, set]:
    """Edges (state, symbol) -> state, states that reduce at once -> production, accepting states.

    States are the LR(0) item sets of the grammar, numbered from 0, the start.
    """
    nonterminals = {left for left, _ in grammar}

    def closed(items: set) -> frozenset:
        todo = list(items)
        while todo:
            rule, dot = todo.pop()
            right = grammar[rule][1]
            if dot < len(right) and right[dot] in nonterminals:
                for other, (left, _) in enumerate(grammar):
                    if left == right[dot] and (other, 0) not in items:
                        items.add((other, 0))
                        todo.append((other, 0))
        return frozenset(items)

    states = [closed({(rule, 0) for rule, (left, _) in enumerate(grammar) if left == START})]
    edges, reduces, accepts = {}, {}, set()
    for number, state in enumerate(states):
        after: dict[str, set] = {}
        for rule, dot in state:
            left, right = grammar[rule]
            if dot < len(right):
                after.setdefault(right[dot], set()).add((rule, dot + 1))
            elif left == START:
                accepts.add(number)
            else:
                reduces[number] = grammar[rule]
        for symbol, items in sorted(after.items()):
            target = closed(items)
            if target not in states:
                states.append(target)
            edges[number, symbol] = states.index(target)
    if any(state in reduces for state, _ in edges):
        raise ValueError("the grammar needs lookahead")
    return edges, reduces, accepts


EDGES, REDUCES, ACCEPTS = automaton(GRAMMAR)


class Node(NamedTuple):
    """A place in the graph-structured stack: a state on top of what lies below."""

    state: int
    below: Node | None


ROOT = Node(0, None)


def shifted(node: Node, symbol: str) -> Node | None:
    """The stack after reading a role, completed productions reduced; None if it does not fit."""
    target = EDGES.get((node.state, symbol))
    if target is None:
        return None
    node = Node(target, node)
    while node.state in REDUCES:
        left, right = REDUCES[node.state]
        for _ in right:
            node = node.below
        node = Node(EDGES[node.state, left], node)
    return node


Tops = dict[int, tuple[int, str, Node]]


def offer(tops: Tops, cost: int, audit: str, node: Node | None) -> bool:
    """Add a stack top; of equal ones the smaller (cost, audit) stays."""
    if node is None:
        return False
    known = tops.get(node.state)
    if known is not None and known[:2] <= (cost, audit):
        return False
    tops[node.state] = (cost, audit, node)
    return True


def with_inserts(tops: Tops) -> Tops:
    """The tops and all that empty turns inserted here lead to."""
    todo = list(tops.values())
    while todo:
        cost, audit, node = todo.pop()
        for symbol in ROLES:
            new = shifted(node, symbol)
            if offer(tops, cost + INSERT, audit + "I", new):
                todo.append(tops[new.state])
    return tops


def read(tops: Tops, initial: str, must_go: bool, truncated: bool) -> Tops:
    """The tops after one more row."""
    after: Tops = {}
    stays = TRUNCATED_STAYS if truncated else 0
    for cost, audit, node in tops.values():
        offer(after, cost + DELETE, audit + "D", node)
        if not must_go:
            offer(after, cost + KEEP + stays, audit + "K", shifted(node, initial))
            for symbol in ROLES:
                offer(after, cost + REROLE + stays, audit + "R", shifted(node, symbol))
    after = with_inserts(after)
    most = min(cost for cost, _, _ in after.values()) + SLACK
    return {state: top for state, top in after.items() if top[0] <= most}


@dataclass
class Conversation:
    """Rows of one conversation, read in order; `out` gets each repaired (role, text, edit)."""

    out: Callable[[str, str, str], None]
    counts: dict[str, int] = field(
        default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    )
    tops: Tops = field(default_factory=lambda: with_inserts({0: (0, "", ROOT)}))
    waiting: list[tuple[str, str]] = field(default_factory=list)
    audit: list[str] = field(default_factory=list)
    last_initial: str | None = None
    last_written: str = ""
    last_said: bytes | None = None
    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0

    def add(self, turn, role: str, text: str, fault: int, said: bytes | None, again: bool) -> None:
        again = again or (said is not None and said == self.last_said)
        self.last_said = said
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1
        initial = role[:1]
        if self.last_initial is not None:
            self.counts["illegal"] += self.last_initial + initial not in ("su", "ua", "au")
        self.last_initial = initial
        must_go = fault == BLANK or again
        truncated = fault == TRUNCATED and not again
        self.counts["blank"] += fault == BLANK
        self.counts["duplicate"] += fault != BLANK and again
        self.counts["truncated"] += truncated
        self.tops = read(self.tops, initial, must_go, truncated)
        self.waiting.append((role, text))
        if len(self.waiting) % SETTLE_EVERY == 0:
            self.settle(os.path.commonprefix([audit for _, audit, _ in self.tops.values()]))

    def settle(self, shared: str) -> None:
        """Carry out the edits that all tops share, and forget their rows."""
        if not shared:
            return
        rows = iter(self.waiting)
        used = 0
        for edit in shared:
            needed = ROLES["a" if self.last_written == "u" else "u"]
            role, text = (needed, "") if edit == "I" else next(rows)
            used += edit != "I"
            if edit != "D":
                role = needed if edit == "R" else role
                self.last_written = role[:1]
                self.out(role, text, edit)
        del self.waiting[:used]
        self.audit.append(shared)
        cut = len(shared)
        self.tops = {s: (cost, audit[cut:], node) for s, (cost, audit, node) in self.tops.items()}

    def finish(self) -> int:
        """Carry out the cheapest repair; returns its cost."""
        cost, audit, _ = min(
            (top for state, top in self.tops.items() if state in ACCEPTS), key=lambda t: t[:2]
        )
        self.settle(audit)
        return cost

    def gaps(self) -> int:
        if self.first_turn is None:
            return 0
        return self.last_turn - self.first_turn + 1 - self.turns


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): the rows, some damaged by a hash of their place.

    A null counts as one space, in the hash as well. A dropped row stays as `gone`, without role
    and text, so that its conversation is known.
    """
    rows = plain(conversations, "conv_id", "turn", "role", "text")
    space = F.lit(" ")
    place = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    rows = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(place.cast("binary")) % 20).alias("damage"),
    )
    damage = F.col("damage")
    role = F.when(damage == 4, F.lit("user")).otherwise(F.col("role"))
    text = (
        F.when(damage == 1, F.lit(""))
        .when(damage == 2, F.translate("text", "".join(SENTENCE_ENDS), ""))
        .otherwise(F.col("text"))
    )
    copies = F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(damage != 0, role).alias("role"),
        F.when(damage != 0, text).alias("text"),
        (damage == 0).alias("gone"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """`rows` (conv_id, turn, role, text, gone) with `fault`, and for what is said more than once in
    a conversation its digest `said` and whether an earlier turn said it (`again`).

    Repeats are counted over digests alone, pre-aggregated, so a row that a hot conversation repeats
    all the time is one entry a task; repeats within a turn lie side by side once sorted.
    """
    last = F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1))
    fault = F.when(last == "", BLANK).when(~last.isin(*SENTENCE_ENDS), TRUNCATED).otherwise(NONE)
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    # Lengths before the parts keep different parts from giving one text. Rows that are gone say
    # nothing, and are spread over the join by their places.
    said = F.concat(conv, F.lit(":"), F.length("role").cast("string"), F.lit(":"), "role", "text")
    turn = F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    said = F.when(F.col("gone"), F.concat(conv, F.lit(" gone "), turn)).otherwise(said)
    rows = rows.select("*", fault.alias("fault"), F.unhex(F.sha2(said, 256)).alias("said"))
    spoken = rows.filter(~F.col("gone"))
    repeated = (
        spoken.groupBy("said")
        .agg(F.count("*").alias("n"), F.min(F.struct("turn")).alias("first"))
        .filter("n > 1")
        .select(F.col("said").alias("repeated"), "first")
    )
    joined = rows.join(repeated, F.col("said") == F.col("repeated"), "left")
    again = F.coalesce(F.struct("turn") > F.col("first"), F.lit(False))
    return joined.select(
        "conv_id", "turn", "role", "text", "gone", "fault",
        F.col("repeated").alias("said"), again.alias("again"),
    )


def in_order(rows: DataFrame) -> DataFrame:
    """Each conversation in one task, its rows by turn (nulls first), role and text."""
    return with_faults(rows).repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text"
    )


def conversations_of(
    batches: Iterator[pa.RecordBatch], begin: Callable[[object], Conversation]
) -> Iterator[tuple[object, Conversation] | None]:
    """Each conversation of sorted rows once all its rows are read; None after each batch."""
    known, current = False, None
    conv_id = None
    for batch in pieces(batches):
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for conv, turn, role, text, gone, fault, said, again in zip(*columns, strict=True):
            if not known or conv != conv_id:
                if known:
                    yield conv_id, current
                known, conv_id, current = True, conv, begin(conv)
            if not gone:
                current.add(turn, role, text, fault, said, again)
        yield None
    if known:
        yield conv_id, current


REPORT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string, repaired_sha256 string"
)


def report(rows: DataFrame) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired text of each conversation.

    `rows` are (conv_id, turn, role, text, gone), without nulls in role and text but where `gone`.
    Rows of one turn are ordered by role and text; a null conv_id is a conversation of its own. A
    conversation whose rows are all gone has zeros, an empty audit and the digest of no text.
    An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[dict] = []
        digest = None

        def begin(_conv) -> Conversation:
            nonlocal digest
            digest, lines = hashlib.sha256(), 0

            def out(role: str, text: str, _edit: str) -> None:
                nonlocal lines
                digest.update(f"{'\n' if lines else ''}{role}:{text}".encode())
                lines += 1

            return Conversation(out)

        for done in conversations_of(batches, begin):
            if done is None:
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=REPORT_ARROW)
                    found = []
                continue
            conv_id, talk = done
            cost = talk.finish()
            found.append(
                {
                    "conv_id": conv_id,
                    "gaps": talk.gaps(),
                    **talk.counts,
                    "cost": cost,
                    "audit": "".join(talk.audit),
                    "repaired_sha256": digest.hexdigest(),
                }
            )
        if found:
            yield pa.RecordBatch.from_pylist(found, schema=REPORT_ARROW)

    return in_order(rows).mapInArrow(run, REPORT)


REPORT_ARROW = pa.schema(
    [
        (name, pa.string() if kind == "string" else pa.int64())
        for name, kind in (column.split() for column in REPORT.split(", "))
    ]
)

REPAIRED = "conv_id bigint, place bigint, role string, text string, edit string"
REPAIRED_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("place", pa.int64()),
        ("role", pa.string()),
        ("text", pa.string()),
        ("edit", pa.string()),
    ]
)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place from 0, role, text, edit: K, R or I).

    Takes rows as `report` does; a conversation of which nothing is left has no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []

        def begin(conv) -> Conversation:
            place = -1

            def out(role: str, text: str, edit: str) -> None:
                nonlocal place
                place += 1
                found.append((conv, place, role, text, edit))

            return Conversation(out)

        def batch() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*found, strict=True)] or [[]] * 5
            arrays = [pa.array(c, f.type) for c, f in zip(columns, REPAIRED_ARROW, strict=True)]
            found.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=REPAIRED_ARROW)

        for done in conversations_of(batches, begin):
            if done is not None:
                done[1].finish()
            elif found:
                yield batch()
        yield batch()

    return in_order(rows).mapInArrow(run, REPAIRED)
