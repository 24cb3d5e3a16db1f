"""Near-duplicate vectors by a forest of random-projection trees.

Every tree cuts the vectors again and again by their projection on a random direction; vectors
near a cut go to both sides. What counts as near is the distance that the wanted cosine allows, not
a share of the rows, and a node is left whole where a cut would not save comparisons: a group of
near copies stays together however large it is. Vectors are compared within leaves, exactly and in
blocks, a large leaf as pairs of parts in several tasks, and what all leaves of all trees find is
united. A pair that meets in several leaves is counted in one of them, the first they share, so
leaves return a row for each vector instead of a row for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.components import components
from repo_pulse.llm.hashing import mixed
from repo_pulse.llm.scratch import plain, written
from repo_pulse.llm.vectors import common_size, is_usable, matrix, sampled, scaled

TREES = 8
LEAF_ROWS = 1_000
# Places where a node may be cut, as shares of its rows, and the part of its comparisons that
# both sides may still have; if the best cut leaves more, the node is a leaf.
CUTS = np.linspace(0.2, 0.8, 13)
WORTH = 0.9
# Splits are fitted to a sample of about this many vectors, which also bounds the broadcast forest.
SAMPLE = 100_000
SAMPLE_PER_LEAF = 32
# Vectors compared with a whole part at a time, and pairs checked in double precision at a time.
BLOCK = 512
PAIRS = 65_536
# Components in a part of a leaf: larger leaves are compared as pairs of parts.
PART_VALUES = 1 << 19
# Rows of a batch that leaves the routing.
OUT = 4_096


@dataclass
class Forest:
    """Binary trees: a direction, the ends of the overlap and two children for each node.

    The first nodes are the roots; a leaf has no children (-1), and its number is its node's.
    """

    trees: int
    directions: np.ndarray  # nodes x components
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf each vector belongs to; leaves are numbered over all trees."""
        rows, keys = [], []
        row = np.tile(np.arange(len(x)), self.trees)
        node = np.repeat(np.arange(self.trees), len(x))
        while len(row):
            done = self.left[node] < 0
            rows.append(row[done])
            keys.append(node[done])
            row, node = row[~done], node[~done]
            p = np.einsum("ij,ij->i", x[row], self.directions[node])
            left, right = p <= self.high[node], p >= self.low[node]
            row, node = (
                np.concatenate([row[left], row[right]]),
                np.concatenate([self.left[node[left]], self.right[node[right]]]),
            )
        return np.concatenate(rows or [row]), np.concatenate(keys or [node])


def fit(
    sample: np.ndarray, rows: int, least: float, trees: int = TREES, leaf_rows: int = LEAF_ROWS
) -> Forest:
    """Random directions, cut where the sample that reaches a node leaves the least to compare.

    Vectors of unit length whose cosine is `least` are a known distance apart, and on a direction
    of independent normal components they differ by that distance on average (root mean square):
    this is the width of the overlap.
    """
    random = np.random.default_rng(42)
    width, share = np.sqrt(2 - 2 * least), rows / max(len(sample), 1)
    held = [np.arange(len(sample))] * trees
    none = np.zeros(sample.shape[1], dtype=np.float32)
    directions, ends, children = [], [], []
    for own in held:  # grows while nodes are cut
        directions.append(none)
        ends.append((0.0, 0.0))
        children.append((-1, -1))
        if len(own) * share <= leaf_rows or len(own) < 2 * SAMPLE_PER_LEAF:
            continue
        direction = random.standard_normal(sample.shape[1]).astype(np.float32)
        p = np.sort(sample[own] @ direction)
        cuts = np.quantile(p, CUTS)
        below = np.searchsorted(p, cuts + width / 2, side="right") / len(p)
        above = 1 - np.searchsorted(p, cuts - width / 2) / len(p)
        left = below**2 + above**2
        if left.min() > WORTH:
            continue
        cut = cuts[left.argmin()]
        side = sample[own] @ direction <= cut
        directions[-1], ends[-1] = direction, (cut - width / 2, cut + width / 2)
        children[-1] = len(held), len(held) + 1
        held += [own[side], own[~side]]
    low, high = np.array(ends).T
    left, right = np.array(children).T
    return Forest(trees, np.array(directions), low, high, left, right)


def compare(
    x: np.ndarray,
    copies: np.ndarray,
    shared: list[np.ndarray],
    leaf: int,
    least: float,
    split: int = 0,
) -> tuple[np.ndarray, np.ndarray]:
    """Links each vector has here for the first time, and the smallest vector it reaches over any
    number of links (by row number).

    With a split, the vectors before it are compared with the others only. Pairs are held for one
    block at a time; links and smallest vectors are all that is kept of them.
    """
    x = scaled(x)
    norms = np.linalg.norm(x, axis=1)
    rough = (x / norms[:, None]).astype(np.float32)
    links, low = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    earlier = _earlier(shared, leaf)
    for start in range(0, split or len(x), BLOCK):
        end = min(start + BLOCK, split or len(x))
        other = split or start
        near = rough[start:end] @ rough[other:].T
        one, two = np.nonzero(near >= least - 1e-4)
        one, two = one + start, two + other
        one, two = one[two > one], two[two > one]
        for at in range(0, len(one), PAIRS):
            p, q = one[at : at + PAIRS], two[at : at + PAIRS]
            linked = near[p - start, q - other] >= least + 1e-4
            doubt = np.flatnonzero(~linked)
            a, b = p[doubt], q[doubt]
            linked[doubt] = np.einsum("ij,ij->i", x[a], x[b]) / (norms[a] * norms[b]) >= least
            p, q = p[linked], q[linked]
            _join(low, p, q)
            first = ~(earlier[p] & earlier[q]).any(axis=1)
            p, q = p[first], q[first]
            links += np.bincount(p, copies[q], len(x)).astype(np.int64)
            links += np.bincount(q, copies[p], len(x)).astype(np.int64)
    return links, low


def _join(low: np.ndarray, one: np.ndarray, other: np.ndarray) -> None:
    """Unite the groups of each pair; `low` names the smallest member of each one's group."""
    while len(one):
        a, b = low[one], low[other]
        apart = a != b
        one, other, a, b = one[apart], other[apart], a[apart], b[apart]
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low[low] != low).any():
            low[:] = low[low]


def _earlier(shared: list[np.ndarray], leaf: int) -> np.ndarray:
    """For each vector the leaves with a smaller number, as bits; leaves of one vector are left out."""
    keys = [own[own < leaf] for own in shared]
    names, at, held = np.unique(
        np.concatenate([*keys, np.zeros(0, np.int64)]), return_inverse=True, return_counts=True
    )
    row, often = np.repeat(np.arange(len(keys)), [len(k) for k in keys]), held[at] > 1
    place = np.cumsum(held > 1) - 1
    bits = np.zeros((len(keys), -(-int((held > 1).sum()) // 8)), dtype=np.uint8)
    column = place[at[often]]
    np.bitwise_or.at(bits, (row[often], column >> 3), (1 << (column & 7)).astype(np.uint8))
    return bits


@dataclass
class Parts:
    """How leaves with more vectors than a part are cut.

    `groups` holds for each large leaf the parts of each class. A class is the first large leaf
    before this one that a vector lies in (-1: none): what has one in common was compared there.
    """

    large: np.ndarray
    groups: dict[int, list[tuple[int, int, int]]]  # leaf: (class, first part, parts)

    def classes(self, row: np.ndarray, leaf: np.ndarray, rows: int) -> np.ndarray:
        """The class of each (row, leaf), for pairs in the order of rows."""
        first = np.full(rows, np.iinfo(np.int64).max)
        big = np.isin(leaf, self.large)
        np.minimum.at(first, row[big], leaf[big])
        return np.where(first[row] < leaf, first[row], -1)

    def spread(self, leaf: np.ndarray, kind: np.ndarray, node: np.ndarray):
        """(index, one, two, side) of each pair of parts that each (leaf, class, node) is in."""
        small = np.flatnonzero(~np.isin(leaf, self.large))
        found = [(small, np.zeros(len(small), int), np.zeros(len(small), int), np.zeros(len(small), int))]
        for own, groups in self.groups.items():
            of_part = {first + i: k for k, first, parts in groups for i in range(parts)}
            for k, first, parts in groups:
                at = np.flatnonzero((leaf == own) & (kind == k))
                if not len(at):
                    continue
                part = first + (mixed(node[at].astype(np.uint64), 5) % np.uint64(parts)).astype(int)
                for other, its in of_part.items():
                    if its == k >= 0:
                        continue
                    found.append(
                        (at, np.minimum(part, other), np.maximum(part, other), (part > other).astype(int))
                    )
        return [np.concatenate(c) for c in zip(*found, strict=True)]


def _parts(nodes: DataFrame, routed, size: int) -> Parts:
    """Cut the leaves that hold more vectors than a part, by the counts of all vectors."""
    most = max(PART_VALUES // max(size, 1), 1)

    def counted(parts: Parts) -> list[tuple[int, int, int]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, leaf = routed(batch.column(0))
                kind = parts.classes(row, leaf, batch.num_rows)
                if len(parts.large):
                    kept = np.isin(leaf, parts.large)
                    leaf, kind = leaf[kept], kind[kept]
                pairs, n = np.unique(np.stack([leaf, kind]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[0]), pa.array(pairs[1]), pa.array(n.astype(np.int64))],
                    ["leaf", "kind", "n"],
                )

        partial = nodes.select("embedding").mapInArrow(run, "leaf bigint, kind bigint, n bigint")
        return [tuple(r) for r in partial.groupBy("leaf", "kind").agg(F.sum("n")).collect()]

    empty = Parts(np.zeros(0, dtype=np.int64), {})
    large = sorted(leaf for leaf, _, n in counted(empty) if n > most)
    if not large:
        return empty
    parts = Parts(np.array(large), {leaf: [] for leaf in large})
    for leaf, kind, n in sorted(counted(parts)):
        before = parts.groups[leaf]
        first = before[-1][1] + before[-1][2] if before else 0
        before.append((kind, first, -(-n // most)))
    return parts


def near_duplicates(vectors: DataFrame, least: float) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row, for links of cosine `least` or more.

    Equal vectors are one node with a number of copies. Null and zero vectors, vectors with null
    or non-finite components, vectors with another number of components than the most frequent,
    and rows with a null vec_id link with nothing and are components of their own (a null vec_id
    gives a null component, kept false). A repeated vec_id is another vector. The size of a vector
    plays no part, however large or small its components. Other columns are ignored, an empty table
    gives no rows.
    """
    spark, vectors = vectors.sparkSession, plain(vectors, "vec_id", "embedding")
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("embedding"),
    )
    usable = rows.filter(F.col("vec_id").isNotNull() & is_usable(F.col("embedding")))
    size = common_size(usable)
    usable = usable.filter(F.size("embedding") == size)
    grouped = usable.groupBy("embedding").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("first")
    )
    nodes = written(grouped.withColumn("node", F.monotonically_increasing_id()), "vectors")
    sample = sampled(nodes, "node", SAMPLE).select("embedding").toArrow()[0]
    sample = scaled(matrix(sample, size or 1))
    forest = fit(sample / np.linalg.norm(sample, axis=1, keepdims=True), nodes.count(), least)
    shared = spark.sparkContext.broadcast(forest)

    def routed_of(embeddings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        x = scaled(matrix(embeddings, size))
        row, leaf = shared.value.leaves(x / np.linalg.norm(x, axis=1, keepdims=True))
        order = np.lexsort((leaf, row))
        return row[order], leaf[order]

    cut = spark.sparkContext.broadcast(_parts(nodes, routed_of, size))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, leaf = routed_of(batch.column(0))
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(leaf, pa.int32()))
            kind = cut.value.classes(row, leaf, batch.num_rows)
            node = batch.column(2).to_numpy()
            at, one, two, side = cut.value.spread(leaf, kind, node[row])
            for step in range(0, len(at), OUT):
                own = at[step : step + OUT]
                taken = batch.take(pa.array(row[own]))
                pair = [pa.array(c[step : step + OUT].astype(np.int64)) for c in (one, two, side)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf[own]), *pair, *taken.columns, lists.take(pa.array(row[own]))],
                    ["leaf", "one", "two", "side", "embedding", "copies", "node", "leaves"],
                )

    def in_leaf(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("side")
        group = group.combine_chunks()
        node = group["node"].to_numpy()
        leaf = group["leaf"][0].as_py()
        split = int((group["side"].to_numpy() == 0).sum())
        apart = group["one"][0].as_py() != group["two"][0].as_py()
        if apart and split in (0, len(node)):
            return pa.table({"node": node[:0], "links": node[:0], "tied": node[:0]})
        lists = group["leaves"].combine_chunks()
        ends = lists.offsets.to_numpy()
        values = lists.values.to_numpy()
        own = [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        x = matrix(group["embedding"], size)
        copies = group["copies"].to_numpy()
        links, low = compare(x, copies, own, leaf, least, split if apart else 0)
        told = np.flatnonzero((links > 0) | (low != np.arange(len(low))))
        return pa.table({"node": node[told], "links": links[told], "tied": node[low[told]]})

    routed = nodes.select("embedding", "copies", "node").mapInArrow(
        route,
        "leaf bigint, one bigint, two bigint, side bigint, embedding array<double>, "
        "copies bigint, node bigint, leaves array<int>",
    )
    pairs = routed.groupBy("leaf", "one", "two")
    found = pairs.applyInArrow(in_leaf, "node bigint, links bigint, tied bigint")
    found = written(found, "links")
    roots = components(found.select("node", "tied"))
    degrees = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.join(roots, "node", "left").join(degrees, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "root").select(
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id",
    )
    # Only usable vectors are looked up; all others keep a key that matches nothing.
    key = F.when(
        F.col("vec_id").isNotNull() & is_usable(F.col("embedding")), F.col("embedding")
    )
    told = rows.select("vec_id", key.alias("embedding")).join(named, "embedding", "left")
    component = F.coalesce("component_id", "vec_id")
    return told.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
