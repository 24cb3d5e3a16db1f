"""Centroid clustering in whole numbers over zone maps along a Hilbert curve.

Vectors are sorted along a Hilbert curve through all their dimensions and cut into blocks, each
with the smallest and largest value of every component: its zone map, a box. For each block, the
distance from a centroid to the box bounds its distance to every vector in it, from below by the
nearest point of the box and from above by the farthest corner. Only centroids whose lower bound
does not exceed the smallest upper bound can be nearest to a vector of the block; these candidates
are compared with its vectors exactly. Blocks are written once and read in every round.

All arithmetic is exact: components are whole numbers below 2 ** 27, so a squared distance of 64 of
them fits into 63 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repo_pulse.llm.scratch import plain, written
from repo_pulse.llm.vectors import matrix, sampled

BLOCK_ROWS = 256
CURVE_BITS = 4
# Vectors whose quantiles place the curve's grid; they change the order of rows, never a result.
CURVE_SAMPLE = 4000
# Components beyond this in size have squared distances that no long can hold.
LARGEST = 1 << 27
# Below this, products of 64 components are exact in double precision.
EXACT_IN_DOUBLES = 1 << 20

BLOCKS = "vec_ids array<bigint>, rows binary, low binary, high binary"


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(values * scale).astype(np.int64)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cells (one per dimension, below 2 ** bits) along the curve, as bytes
    that sort like the place.

    The axes are turned into the transposed index dimension by dimension, all rows at once.
    """
    x = np.ascontiguousarray(cells.T).astype(np.uint8)
    for bit in range(bits - 1, 0, -1):
        below = np.uint8((1 << bit) - 1)
        for axis in range(len(x)):
            is_set = (x[axis] >> bit & 1).astype(bool)
            swapped = np.where(is_set, 0, (x[0] ^ x[axis]) & below).astype(np.uint8)
            x[0] ^= np.where(is_set, below, swapped)
            x[axis] ^= swapped
    x = np.bitwise_xor.accumulate(x, axis=0)
    turned = np.zeros(x.shape[1], dtype=np.uint8)
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0).astype(np.uint8)
    x ^= turned
    planes = np.concatenate([(x >> bit & 1) for bit in range(bits - 1, -1, -1)])
    return np.packbits(planes.T, axis=1)


def kept(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part."""
    x = F.col("embedding")
    fits = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < LARGEST / scale)
    )
    rows = plain(vectors, "vec_id", "embedding").select("vec_id", "embedding")
    return rows.filter(F.coalesce((F.size(x) == size) & fits, F.lit(False)))


def first_centroids(rows: DataFrame, count: int, salt: str, scale: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of salt and id, ties by components; at most `count`."""
    named = F.concat(F.lit(salt), F.col("vec_id").cast("string"))
    chosen = rows.orderBy(F.asc_nulls_last(F.sha2(named, 256)), "embedding").limit(count)
    found = [row.embedding for row in chosen.select("embedding").collect()]
    return whole(np.array(found, dtype=np.float64), scale) if found else np.zeros((0, 0), np.int64)


def blocks(rows: DataFrame, size: int, scale: int) -> DataFrame:
    """The vectors as blocks along the curve, written to the shared folder.

    Equal vectors share a place on the curve; a random number beside it lets the sort deal a large
    group of them to several tasks.
    """
    some = sampled(rows, "vec_id", CURVE_SAMPLE).limit(2 * CURVE_SAMPLE)
    some = whole(np.array([r.embedding for r in some.collect()], dtype=np.float64), scale)
    steps = np.arange(1, 1 << CURVE_BITS) / (1 << CURVE_BITS)
    edges = np.quantile(some, steps, axis=0) if len(some) else np.zeros((len(steps), size))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = whole(matrix(batch.column("embedding"), size), scale)
            cells = np.stack([np.searchsorted(edges[:, d], x[:, d]) for d in range(size)], axis=1)
            keys = hilbert_keys(cells, CURVE_BITS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").cast(pa.int64()),
                    pa.array([k.tobytes() for k in keys], pa.binary()),
                    pa.array([v.tobytes() for v in x.astype(np.int32)], pa.binary()),
                ],
                ["vec_id", "place", "row"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, raw = [], []
        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            raw += batch.column("row").to_pylist()
            while len(raw) >= BLOCK_ROWS:
                yield block(ids[:BLOCK_ROWS], raw[:BLOCK_ROWS])
                ids, raw = ids[BLOCK_ROWS:], raw[BLOCK_ROWS:]
        if raw:
            yield block(ids, raw)

    def block(ids: list, raw: list) -> pa.RecordBatch:
        joined = b"".join(raw)
        x = np.frombuffer(joined, dtype=np.int32).reshape(-1, size)
        columns = [[ids], [joined], [x.min(axis=0).tobytes()], [x.max(axis=0).tobytes()]]
        kinds = [pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["vec_ids", "rows", "low", "high"],
        )

    ordered = (
        rows.mapInArrow(placed, "vec_id bigint, place binary, row binary")
        .withColumn("salt", F.rand(0))
        .repartitionByRange("place", "salt")
        .sortWithinPartitions("place", "salt")
    )
    return written(ordered.select("vec_id", "row").mapInArrow(cut, BLOCKS), "zones")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector in the box, ascending."""
    outside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    farthest = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    at_least = (outside * outside).sum(axis=1)
    at_most = (farthest * farthest).sum(axis=1)
    return np.flatnonzero(at_least <= at_most.min())


def nearest(
    x: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number) and squared distance of each row of a block."""
    chosen = candidates(low, high, centroids)
    near = centroids[chosen]
    if max(np.abs(low).max(), np.abs(high).max(), np.abs(near).max()) < EXACT_IN_DOUBLES:
        a, b = x.astype(np.float64), near.astype(np.float64)
        squared = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
        squared = squared.astype(np.int64)
    else:
        squared = np.stack([((x - c) ** 2).sum(axis=1) for c in near], axis=1)
    best = squared.argmin(axis=1)
    return chosen[best], squared[np.arange(len(x)), best]


def opened(batch: pa.RecordBatch, size: int) -> Iterator[tuple]:
    """The blocks of a batch: ids, vectors, box."""
    for ids, rows, low, high in zip(*(batch.column(i) for i in range(4)), strict=True):
        box = [np.frombuffer(v.as_buffer(), dtype=np.int32).astype(np.int64) for v in (low, high)]
        x = np.frombuffer(rows.as_buffer(), dtype=np.int32).astype(np.int64).reshape(-1, size)
        yield ids.values, x, *box


def moved(zones: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: each task adds up its vectors, Spark adds up the tasks."""
    count, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((count, size + 1), dtype=np.int64)
        for batch in batches:
            for _, x, low, high in opened(batch, size):
                labels, _ = nearest(x, low, high, centroids)
                for label in np.unique(labels):
                    mine = x[labels == label]
                    sums[label, :size] += mine.sum(axis=0)
                    sums[label, size] += len(mine)
        cluster, place = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(place, pa.int32()),
             pa.array(sums[cluster, place])],
            ["cluster", "place", "value"],
        )

    partial = zones.mapInArrow(run, "cluster int, place int, value bigint")
    totals = np.zeros((count, size + 1), dtype=np.int64)
    for row in partial.groupBy("cluster", "place").agg(F.sum("value").alias("value")).collect():
        totals[row.cluster, row.place] = row.value
    full = totals[:, size] > 0
    new = centroids.copy()
    new[full] = totals[full, :size] // totals[full, size:]
    return new


def assigned(zones: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of each vector."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x, low, high in opened(batch, size):
                labels, squared = nearest(x, low, high, centroids)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(labels, pa.int32()), pa.array(squared)],
                    ["vec_id", "cluster", "distance"],
                )

    return zones.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def cluster(
    vectors: DataFrame,
    clusters: int = 40,
    rounds: int = 5,
    size: int = 64,
    scale: int = 256,
    salt: str = "2:",
) -> tuple[DataFrame, np.ndarray]:
    """Assignments (vec_id, cluster, distance) of all vectors that take part, and the centroids.

    Vectors of another size, null ones, those with a null or non-finite component, and those with
    a component whose whole number is 2 ** 27 or more in size, whose distances fit no long, take no
    part. Rows that repeat an id each take part. A null id is never a first centroid while others
    are left. With fewer vectors than clusters each is one; without any the result is empty. Other
    columns are ignored, whatever their names.
    """
    rows = kept(vectors, size, scale)
    centroids = first_centroids(rows, clusters, salt, scale)
    if not len(centroids):
        empty = rows.sparkSession.createDataFrame(
            [], "vec_id bigint, cluster int, distance bigint"
        )
        return empty, centroids
    zones = blocks(rows, size, scale)
    for _ in range(rounds):
        centroids = moved(zones, centroids)
    return written(assigned(zones, centroids), "assigned"), centroids


def report(vectors: DataFrame) -> DataFrame:
    """Cluster, distance, inertias and centroid digest of each vector that takes part (see
    `cluster`). An inertia that fits no long is null."""
    found, centroids = cluster(vectors)
    spark: SparkSession = found.sparkSession
    names = [",".join(map(str, row)) for row in centroids.tolist()]
    # A row for each centroid: as many as the parameter says, whatever the table.
    of_cluster = {
        row.cluster: row.inertia
        for row in found.groupBy("cluster").agg(F.try_sum("distance").alias("inertia")).collect()
    }
    total = None if None in of_cluster.values() else sum(of_cluster.values())
    if total is not None and total >= 1 << 63:
        total = None
    named = spark.createDataFrame(
        [
            (number, of_cluster.get(number), total, hashlib.sha256(name.encode()).hexdigest())
            for number, name in enumerate(names)
        ],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return found.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
