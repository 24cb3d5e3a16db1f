"""Approximate nearest neighbours with balanced posting lists.

Centroids come from splitting a sample in equal halves again and again, so lists have much the
same length. A vector lies in the list of its nearest centroid and, near a boundary, in those of
further centroids that are almost as near. A query finds its nearest centroids by walking a graph
over them in memory, reads the lists of all centroids within a ratio of the nearest distance, and
compares itself with their vectors exactly. Both ratios are measured on the sample: those that reach
a given recall there with the fewest vectors read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repo_pulse.llm.scratch import plain, written
from repo_pulse.llm.vectors import away_from, common_size, is_usable, matrix, sampled, scaled

# The index is fitted to about so many vectors, and its ratio to so many queries among them.
SAMPLE = 20_000
CALIBRATION = 200
MAX_LISTS = 4096
# Boundary vectors: how much farther the centroids of their lists may be (the fit picks one), and
# how many lists at most.
REPLICA_RATIOS = (1.01, 1.02, 1.05, 1.1)
REPLICAS = 4
TARGET_RECALL = 0.97
RATIOS = (1.0, 1.05, 1.1, 1.15, 1.2, 1.3, 1.4, 1.6, 2.0, 3.0)
GRAPH_NEIGHBOURS = 16
# Neighbouring lists share a shelf of up to so many rows or numbers, each compared in a task's turn;
# a longer list and the queries of a shelf are cut into parts of that size. Fewer rows than these
# still make so many shelves.
PART_ROWS = 32_768
PART_VALUES = 1 << 21
SHELVES = 64
# Queries whose centroids are found in one task.
WALKS = 128


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances by blocks, rounded as matrix products are."""
    squares = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.sqrt(np.maximum(squares, 0))


def halves(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of a balanced partition: two means, cut at the median of what tells them apart."""
    random = np.random.default_rng(42)
    groups = [np.arange(len(sample))]
    while len(groups) < lists and min(map(len, groups)) >= 2:
        cut = []
        for own in groups:
            x = sample[own]
            two = x[random.choice(len(x), 2, replace=False)]
            for _ in range(8):
                side = distances(x, two)
                side = side[:, 0] - side[:, 1]
                near = side <= np.median(side)
                if near.all():
                    near = np.arange(len(x)) < len(x) // 2
                two = np.stack([x[near].mean(0), x[~near].mean(0)])
            order = np.argsort(((x - two[0]) ** 2).sum(1) - ((x - two[1]) ** 2).sum(1))
            cut += [own[order[: len(x) // 2]], own[order[len(x) // 2 :]]]
        groups = cut
    return np.stack([sample[own].mean(0) for own in groups])


@dataclass
class Index:
    """Centroids, a graph of near ones, and the ratios within which lists are read and vectors
    replicated."""

    centroids: np.ndarray
    graph: np.ndarray
    ratio: float = 1.0
    replicas: float = REPLICA_RATIOS[0]

    @classmethod
    def over(cls, centroids: np.ndarray, ratio: float = 1.0) -> Index:
        apart = distances(centroids, centroids)
        near = np.argsort(apart, axis=1)[:, 1 : GRAPH_NEIGHBOURS + 1]
        # A ring over all centroids keeps the graph in one piece.
        ring = (np.arange(len(centroids))[:, None] + 1) % len(centroids)
        return cls(centroids, np.concatenate([near, ring], axis=1), ratio)

    def walk(self, query: np.ndarray, ratio: float) -> np.ndarray:
        """Centroids within the ratio of the nearest, by a best-first walk over the graph.

        The walk goes on through every centroid that is near enough by what is known so far, and
        looks beyond for at least GRAPH_NEIGHBOURS steps.
        """

        def to(nodes: np.ndarray) -> np.ndarray:
            return np.sqrt(((self.centroids[nodes] - query) ** 2).sum(axis=1))

        entry = np.unique(np.linspace(0, len(self.centroids) - 1, 8).astype(int))
        known = dict(zip(entry.tolist(), to(entry).tolist(), strict=True))
        heap = [(d, c) for c, d in known.items()]
        heapq.heapify(heap)
        best, patience = min(known.values()), GRAPH_NEIGHBOURS
        while heap:
            d, c = heapq.heappop(heap)
            if d > best * ratio:
                patience -= 1
                if patience < 0:
                    break
            new = np.array([n for n in set(self.graph[c].tolist()) if n not in known], dtype=int)
            if len(new):
                for n, away in zip(new.tolist(), to(new).tolist(), strict=True):
                    known[n] = away
                    best = min(best, away)
                    heapq.heappush(heap, (away, n))
        return np.array([c for c, d in known.items() if d <= best * ratio], dtype=np.int64)

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every vector: its nearest centroid's, and those almost as near."""
        step = max(PART_VALUES // len(self.centroids), 1)
        found = [self._lists(x[at : at + step]) for at in range(0, max(len(x), 1), step)]
        row = np.concatenate([row + i * step for i, (row, _) in enumerate(found)])
        return row, np.concatenate([of_list for _, of_list in found])

    def _lists(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        apart = distances(x, self.centroids)
        most = min(REPLICAS, len(self.centroids))
        near = np.argpartition(apart, most - 1, axis=1)[:, :most]
        away = np.take_along_axis(apart, near, axis=1)
        # The nearest one always counts, whatever rounding says.
        kept = away <= np.maximum(away.min(1, keepdims=True) * self.replicas, 1e-12)
        row, at = np.nonzero(kept)
        return row, near[row, at]


def fit(sample: np.ndarray, rows: int, neighbours: int) -> Index:
    """Centroids and graph, and the ratios that reach the recall on the sample with the fewest
    vectors read; every list is read where none does."""
    lists = min(max(int(2 * rows**0.5) // 2, 1), MAX_LISTS, max(len(sample) // 16, 1))
    lists = 1 << (lists.bit_length() - 1)
    index = Index.over(halves(sample, lists))
    queries = np.linspace(0, len(sample) - 1, min(CALIBRATION, len(sample))).astype(int)
    queries = np.unique(queries)
    apart = distances(sample[queries], sample)
    apart[np.arange(len(queries)), queries] = np.inf
    nearest = np.argsort(apart, axis=1)[:, : min(neighbours, len(sample) - 1)]
    walks = {}
    best = (np.inf, np.inf, REPLICA_RATIOS[0])
    for replicas in REPLICA_RATIOS:
        index.replicas = replicas
        row, of_list = index.lists(sample)
        members = np.zeros((len(sample), len(index.centroids)), dtype=bool)
        members[row, of_list] = True
        sizes = members.sum(axis=0)
        for ratio in RATIOS:
            if ratio not in walks:
                walks[ratio] = [index.walk(sample[q], ratio) for q in queries]
            read = sum(sizes[own].sum() for own in walks[ratio])
            hits = [
                members[own][:, walk].any(axis=1).mean() if len(own) else 1.0
                for walk, own in zip(walks[ratio], nearest, strict=True)
            ]
            if np.mean(hits) >= TARGET_RECALL:
                best = min(best, (float(read), ratio, replicas))
                break
    _, index.ratio, index.replicas = best
    return index


def nearest_in_part(
    queries: np.ndarray,
    query_ids: np.ndarray,
    x: np.ndarray,
    ids: np.ndarray,
    neighbours: int,
    top: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, distance) of each query's nearest in one part, ties to the smaller id; no
    component is larger than `top`."""
    rough = distances(scaled(queries, top), scaled(x, top))
    rough[query_ids[:, None] == ids[None, :]] = np.inf
    k = min(neighbours, len(ids))
    limit = np.partition(rough, k - 1, axis=1)[:, k - 1]
    limit = np.where(np.isfinite(limit), limit, np.finfo(np.float64).max)
    # Products round; everything that could belong to the nearest is measured again.
    slack = 1e-6 * (1 + 2 * x.shape[1] ** 0.5)
    out = []
    for i, q in enumerate(queries):
        near = np.flatnonzero(rough[i] <= limit[i] + slack)
        away = away_from(x[near], q)
        first = np.lexsort((ids[near], away))[:k]
        out.append((np.full(len(first), query_ids[i]), ids[near[first]], away[first]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def shelved(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The shelf of each list, and the number of parts of each shelf.

    Neighbouring lists of up to `most` rows in all share a shelf; a longer list has one for itself,
    cut into parts. Halving leaves near lists next to each other, so a query reads few shelves.
    """
    shelf, held = np.zeros(len(sizes), dtype=np.int64), 0
    for i, n in enumerate(sizes):
        opens = i > 0 and held + n > most
        held = n if opens else held + n
        shelf[i] = shelf[i - 1] + opens if i else 0
    rows = np.bincount(shelf, weights=sizes)
    return shelf, np.maximum(np.ceil(rows / most), 1).astype(np.int64)


def copies(
    batch: pa.RecordBatch, index: Index, shelf: np.ndarray, parts: np.ndarray, size: int, top: float
) -> Iterator[pa.RecordBatch]:
    """(shelf, v, vec_id, embedding, lists): each query of a batch of (vec_id, embedding) once for
    every part of the shelves it reads, with its lists there; a few queries at a time, so no batch
    given back has many more numbers than PART_VALUES, however many lists a query reads."""
    asked = scaled(matrix(batch.column(1), size), top)
    step = max(PART_VALUES // (size * int(parts.sum())), 1)
    for at in range(0, len(asked), step):
        found = [np.sort(index.walk(q, index.ratio)) for q in asked[at : at + step]]
        lists = np.concatenate(found)
        row = np.repeat(np.arange(at, at + len(found)), [len(f) for f in found])
        # Shelves ascend with their lists.
        opens = np.ones(len(lists), dtype=bool)
        opens[1:] = (row[1:] != row[:-1]) | (shelf[lists[1:]] != shelf[lists[:-1]])
        first = np.flatnonzero(opens)
        ends = pa.array(np.append(first, len(lists)), pa.int32())
        read = pa.ListArray.from_arrays(ends, pa.array(lists))
        own = parts[shelf[lists[first]]]
        copy = np.repeat(np.arange(len(first)), own)
        v = np.arange(len(copy)) - np.repeat(np.cumsum(own) - own, own)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(shelf[lists[first]][copy]),
                pa.array(v),
                *batch.take(pa.array(row[first][copy])).columns,
                read.take(pa.array(copy)),
            ],
            ["shelf", "v", "vec_id", "embedding", "lists"],
        )


def nearest_on_shelf(
    asked: pa.Table, own: pa.Table, size: int, neighbours: int, top: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, distance) of the nearest that each query finds in its lists of one shelf."""
    x, ids, of_list = matrix(own["embedding"], size), own["vec_id"].to_numpy(), own["list"].to_numpy()
    queries, query_ids = matrix(asked["embedding"], size), asked["vec_id"].to_numpy()
    read = asked["lists"].combine_chunks()
    row = np.repeat(np.arange(len(queries)), read.value_lengths().to_numpy())
    wanted = read.flatten().to_numpy()
    none = np.zeros(0, dtype=np.int64)
    out = [(none, none, np.zeros(0))]
    for name in np.unique(of_list):
        members, readers = np.flatnonzero(of_list == name), row[wanted == name]
        step = max(PART_VALUES // len(members), 1)
        for at in range(0, len(readers), step):
            some = readers[at : at + step]
            out.append(
                nearest_in_part(
                    queries[some], query_ids[some], x[members], ids[members], neighbours, top
                )
            )
    query, vec, away = (np.concatenate(c) for c in zip(*out, strict=True))
    usable = query != vec
    query, vec, away = query[usable], vec[usable], away[usable]
    # A vector in several lists counts once; then the first few of each query.
    order = np.lexsort((away, vec, query))
    query, vec, away = query[order], vec[order], away[order]
    new = np.ones(len(query), dtype=bool)
    new[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])
    order = np.flatnonzero(new)
    order = order[np.lexsort((vec[order], away[order], query[order]))]
    query, vec, away = query[order], vec[order], away[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return query[rank < neighbours], vec[rank < neighbours], away[rank < neighbours]


def search(vectors: DataFrame, every: int, neighbours: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of each query, by Euclidean distance.

    Queries are the rows whose vec_id is divisible by `every` (1: all of them). Every usable row is
    indexed; a query's own vec_id is no candidate. Ties go to the smaller vec_id; with fewer candidates all are returned. Null and zero vectors, vectors with null or
    non-finite components or another number of components than the most frequent, and rows with a
    null vec_id take no part. Rows that repeat a vec_id count once, with the nearer vector, as
    candidates and as queries. Components may be of any size: a distance that no double holds is
    infinite, and vectors that are tiny beside the largest one are compared with one another in full.
    Other columns are ignored; an empty table, or one without queries, gives no rows.
    """
    spark, vectors = vectors.sparkSession, plain(vectors, "vec_id", "embedding")
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("embedding"),
        (F.col("vec_id") % every == 0).alias("is_query"),
    )
    usable = rows.filter(F.col("vec_id").isNotNull() & is_usable(F.col("embedding")))
    size = common_size(usable)
    if not size:
        return spark.createDataFrame([], schema)
    usable = usable.filter(F.size("embedding") == size)
    largest = F.array_max(F.transform("embedding", F.abs))
    asks = F.count(F.when(F.col("is_query"), 1))
    rows_in_all, n_queries, top = usable.agg(F.count("*"), asks, F.max(largest)).first()
    if not n_queries:
        return spark.createDataFrame([], schema)
    sample = matrix(sampled(usable, "vec_id", SAMPLE).select("embedding").toArrow()[0], size)
    index = fit(scaled(sample, top), rows_in_all, neighbours) if len(sample) else Index.over(
        np.zeros((1, size))
    )
    shared = spark.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, of_list = shared.value.lists(scaled(matrix(batch.column(1), size), top))
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(of_list), *taken.columns], ["list", "vec_id", "embedding"]
            )

    in_lists = "list bigint, vec_id bigint, embedding array<double>"
    lists = written(usable.select("vec_id", "embedding").mapInArrow(place, in_lists), "lists")
    sizes = np.zeros(len(index.centroids), dtype=np.int64)
    for of_list, n in lists.groupBy("list").count().collect():
        sizes[of_list] = n
    most = min(PART_ROWS, max(PART_VALUES // size, 1))
    shelf, parts = shelved(sizes, min(most, max(int(sizes.sum()) // SHELVES, 1)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from copies(batch, shared.value, shelf, parts, size, top)

    # Walks take long beside the size of a query, so tasks are cut by the number of queries.
    queries = usable.filter("is_query").select("vec_id", "embedding").dropDuplicates()
    queries = queries.repartition(min(-(-n_queries // WALKS), MAX_LISTS))
    asked = queries.mapInArrow(
        ask, "shelf bigint, v bigint, vec_id bigint, embedding array<double>, lists array<bigint>"
    )

    # A part of a shelf meets a part of its queries; rows of the shelf are repeated for the others.
    q_parts = -(-n_queries // most)
    left = lists.withColumn("shelf", _at(shelf, "list"))
    left = left.withColumn("v", F.pmod(_dealt("vec_id"), _at(parts, "shelf")))
    left = left.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(q_parts - 1))))
    right = asked.withColumn("q", F.pmod(_dealt("vec_id"), F.lit(q_parts)).cast("int"))
    keys = ["shelf", "v", "q"]

    def meet(own: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not own.num_rows or not asked.num_rows:
            return pa.table(dict(zip(names, (np.zeros(0, int), np.zeros(0, int), np.zeros(0)))))
        found = nearest_on_shelf(asked, own, size, neighbours, top)
        return pa.table(dict(zip(names, found, strict=True)))

    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(meet, "query_id bigint, vec_id bigint, score double")
    )
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )


def _dealt(key: str) -> Column:
    return F.xxhash64(key, F.lit("part"))


def _at(values: np.ndarray, place: str) -> Column:
    """The value at the place that a column tells, from a few thousand numbers."""
    return F.get(F.expr(f"array({','.join(f'{v}L' for v in values)})"), F.col(place).cast("int"))
