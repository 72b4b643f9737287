"""Centroid clustering with a table of pivot distances (LAESA).

Each vector's exact squared distances to a few fixed pivots, the starting
centroids, are worked out and stored once. In a round the driver knows the
distances of the moved centroids to the pivots; by the triangle inequality their
differences to a vector's stored ones bound its distance to every centroid from
below. A vector meets the centroid of the least bound first and then only those
whose bound does not exceed the best distance so far, in exact integers.

A round is one scan of the stored table, whose tasks add up sums and counts per
centroid; what reaches the driver is one number per centroid and component. The
stored table lies in the shared folder, so a lost executor repeats its tasks.

Defined cases: vectors that are null, of another width, or hold null or
non-finite components take no part; every row is a vector, so repeated rows count
each; rows with a null key take part, but their key's hash comes last; equal
hashes are told apart by the vector; fewer vectors than centroids make each a
centroid; ties go to the smaller number; an empty centroid stays where it is; an
empty table gives no row; further columns are ignored. Components of any size are
worked exactly; squared distances must fit 63 bits, as the result column does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardlight.llm.search import floored, usable
from wardlight.session import settled

# Differences of components below twice this fit their squares' sum into 63 bits at
# the widths below 2**7; larger ones are worked in Python integers.
_SMALL = 1 << 27
_STORED = "vec_id bigint, vector array<bigint>, pivots array<bigint>"
_ASSIGNED = "vec_id bigint, cluster int, distance bigint"
_SUMS = "cluster int, place int, total decimal(38,0), size bigint"


def _grid(column: pa.Array, width: int) -> np.ndarray:
    """A list column of one width as rows of integers."""
    grid = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
    small = width < 128 and (not grid.size or (grid.max() < _SMALL and grid.min() > -_SMALL))
    return grid if small else grid.astype(object)


def squared_distances(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one point; ``object`` rows are worked in Python integers."""
    wide = vectors.dtype == object or any(abs(int(x)) >= _SMALL for x in centre)
    apart = vectors - centre.astype(object if wide else np.int64)
    return (apart * apart).sum(axis=1)


def lower_bounds(pivots: np.ndarray, centre_pivots: np.ndarray) -> np.ndarray:
    """Bounds (row, centroid) below the squared distance, from roots of distances to the pivots."""
    bounds = np.zeros((len(pivots), len(centre_pivots)))
    for one, other in zip(pivots.T, centre_pivots.T):
        np.maximum(bounds, np.abs(one[:, None] - other[None, :]), out=bounds)
    # Roots and their differences are rounded; the slack keeps this a bound below.
    slack = 4e-16 * max(pivots.max(initial=0), centre_pivots.max(initial=0))
    return np.square(np.maximum(bounds - slack, 0)) * (1 - 1e-12)


class Centroids:
    """Centroids of one round and their distances to the pivots."""

    def __init__(self, points: list[list[int]], pivots: list[list[int]]):
        self.points = np.array(points, dtype=object)
        self.roots = np.array([[float(sum((a - b) ** 2 for a, b in zip(point, pivot))) ** 0.5
                                for pivot in pivots] for point in points])

    def nearest(self, vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid and squared distance of each row, and how many distances that took."""
        least = lower_bounds(np.sqrt(pivots.astype(np.float64)), self.roots)
        first = least.argmin(axis=1)
        best = np.zeros(len(vectors), dtype=vectors.dtype)
        cluster, met = first.copy(), len(vectors)
        for j, point in enumerate(self.points):
            mine = np.flatnonzero(first == j)
            best[mine] = squared_distances(vectors[mine], point)
        for j, point in enumerate(self.points):
            open_rows = np.flatnonzero((first != j) & (least[:, j] <= best.astype(np.float64)))
            found = squared_distances(vectors[open_rows], point)
            met += len(open_rows)
            nearer = (found < best[open_rows]) | (
                (found == best[open_rows]) & (j < cluster[open_rows]))
            best[open_rows[nearer]] = found[nearer]
            cluster[open_rows[nearer]] = j
        return cluster, best, met


def _with_pivots(pivots: list[list[int]]):
    """Adds the stored distances to rows (vec_id, vector)."""
    points = np.array(pivots, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _grid(batch.column(1), points.shape[1])
            table = np.stack([squared_distances(vectors, p) for p in points], axis=1).astype(np.int64)
            offsets = np.arange(len(table) + 1, dtype=np.int32) * len(points)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.ravel()))],
                names=["vec_id", "vector", "pivots"])

    return run


def _assign(batch: pa.RecordBatch, centroids: Centroids):
    vectors = _grid(batch.column(1), centroids.points.shape[1])
    pivots = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
    return vectors, *centroids.nearest(vectors, pivots)[:2]


def _sums(centroids: Centroids):
    """A task's sums and counts per centroid and component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(centroids.points.shape, dtype=object)
        sizes = np.zeros(len(totals), dtype=np.int64)
        for batch in batches:
            vectors, cluster, _ = _assign(batch, centroids)
            for j in np.unique(cluster):
                mine = vectors[cluster == j]
                totals[j] += mine.sum(axis=0).astype(object)
                sizes[j] += len(mine)
        rows = [(j, i, Decimal(int(totals[j, i])), int(sizes[j])) for j in np.flatnonzero(sizes).tolist()
                for i in range(totals.shape[1])]
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(
                columns, (pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64()))],
            names=["cluster", "place", "total", "size"])

    return run


def _labels(centroids: Centroids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, best = _assign(batch, centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()), pa.array(best.tolist(), pa.int64())],
                names=["vec_id", "cluster", "distance"])

    return run


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: str = "3"
                    ) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id``, ``cluster`` and squared ``distance`` of every row, and the final centroids.

    ``vectors`` has ``vec_id`` and ``vector``, an array of bigint of one width. The start is
    the ``k`` rows whose ``<seed>:<vec_id>`` has the smallest hash.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "vector")
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = [list(r.vector) for r in
              rows.orderBy(mark.asc_nulls_last(), "vector").limit(k).select("vector").collect()]
    if not starts:
        return spark.createDataFrame([], _ASSIGNED), []
    stored = settled(rows.mapInArrow(_with_pivots(starts), _STORED), "pivot-table")
    points = starts
    for _ in range(rounds):
        moved = [list(p) for p in points]
        sums = (stored.mapInArrow(_sums(Centroids(points, starts)), _SUMS)
                .groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("size").alias("size")))
        for row in sums.collect():
            moved[row.cluster][row.place] = int(row.total) // row.size
        if moved == points:
            # Nothing moved, so no later round moves anything.
            break
        points = moved
    return stored.mapInArrow(_labels(Centroids(points, starts)), _ASSIGNED), points


def cluster_table(embeddings: DataFrame, width: int = 64, k: int = 8, rounds: int = 10) -> DataFrame:
    """The contract's clusters of ``embeddings`` (``vec_id``, ``embedding``)."""
    spark = embeddings.sparkSession
    whole = embeddings.where(usable(F.col("embedding")) & (F.size("embedding") == width)).select(
        "vec_id", floored(F.col("embedding"), 1024.0).alias("vector"))
    rows, points = cluster_vectors(whole, k, rounds)
    rows = settled(rows, "clusters")
    # At most one row per centroid from here on.
    inertia = {r.cluster: int(r.total) for r in rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digests = spark.createDataFrame(
        [(c, total, sum(inertia.values()),
          hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest())
         for c, total in inertia.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(digests), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
