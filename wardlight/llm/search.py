"""Exact top-k inner products by columnar branch and bound.

Vectors are kept in blocks in vertical layout, one array per dimension. For a
query, inner products are accumulated a few dimensions at a time over a whole
block; what the remaining dimensions can still add is bounded by the lengths of
the remaining parts, and candidates whose bound falls below the k-th best score
so far are compacted away before the next dimensions are read.

The stated queries meet all rows in blocks: query blocks and candidate blocks
are dealt to (query block, lane) streams, a stream reads its query block, then
its candidate blocks one after the other, and gives k rows per query at the end.
A stream's k-th best only rises, so later blocks are cut earlier. Every block is
read by every stream of its lane; nothing is sampled, and the k best over the
lanes are exact, ties to the smaller key.

Defined cases: vectors that are null or hold null or non-finite components, and
rows with a null key, take no part; missing components of shorter vectors count
as 0; rows that repeat key and vector count once; a key with several vectors
has one list, the best of what any of them reaches, and is a candidate with
each; an empty table gives no row; with fewer than k candidates all are given;
further columns are ignored. Scores must fit 63 bits: larger ones wrap around.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlight.llm.words import each_row
from wardlight.session import settled

BLOCK_ROWS = 4096
# Queries of one block: every candidate block is sent to each of them once.
QUERY_ROWS = 4096
LANES = 32
# Dimensions that are accumulated between two compactions.
STEP = 8
_RESULT = "query_id bigint, vec_id bigint, score bigint"


def usable(vector: Column) -> Column:
    """Whether every component is there and finite."""
    value = vector.cast("array<double>")
    return vector.isNotNull() & ~F.exists(
        value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))


def floored(vector: Column, factor: float = 64.0) -> Column:
    """Components as ``floor(factor * x)``, each worked out as double."""
    return F.transform(vector.cast("array<double>"),
                       lambda x: F.floor(x * F.lit(factor)).cast("bigint"))


def _blocks(rows_per_block: int):
    """Packs rows (vec_id, vector) into blocks of bytes: keys, and dimensions one after another."""
    def run(batches):
        keys, vectors = [], []

        def block():
            width = max(map(len, vectors), default=0)
            grid = np.zeros((width, len(vectors)), dtype=np.int64)
            for at, vector in enumerate(vectors):
                grid[:len(vector), at] = vector
            grid = narrowed(grid)
            return pa.RecordBatch.from_arrays(
                [pa.array([len(keys)], pa.int32()), pa.array([width], pa.int32()),
                 pa.array([grid.itemsize], pa.int32()),
                 pa.array([np.array(keys, dtype="<i8").tobytes()], pa.binary()),
                 pa.array([grid.tobytes()], pa.binary())],
                names=["n", "width", "bytes", "keys", "grid"])

        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            for key, begin, end in zip(batch.column(0).to_pylist(), np.append(0, ends[:-1]), ends):
                keys.append(key)
                vectors.append(flat[begin:end])
                if len(keys) == rows_per_block:
                    yield block()
                    keys, vectors = [], []
        if keys:
            yield block()

    return run


_BLOCK = "n int, width int, bytes int, keys binary, grid binary"


def narrowed(grid: np.ndarray) -> np.ndarray:
    """The same integers in as few bytes each as hold them all."""
    for kind in (np.int8, np.int16, np.int32):
        if not grid.size or (grid.max() <= np.iinfo(kind).max and grid.min() >= np.iinfo(kind).min):
            return grid.astype(kind)
    return grid


def widened(grid: bytes, item_bytes: int, width: int, n: int) -> np.ndarray:
    """A narrowed grid as 64-bit integers, a row per dimension."""
    return np.frombuffer(grid, dtype=f"<i{item_bytes}").reshape(width, n).astype(np.int64)


def _query_block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    blocks = _blocks(max(1, len(table)))(
        table.select(["vec_id", "vector"]).combine_chunks().to_batches())
    made = pa.Table.from_batches(list(blocks))
    return made.add_column(0, "query_block", pa.array([key[0].as_py()], pa.int64()))


class Best:
    """The k best (score, key) of one query so far."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.keys = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def floor(self) -> int | None:
        """The score that a newcomer must reach; None while there is room."""
        return int(self.scores[-1]) if len(self.scores) == self.k else None

    def offer(self, scores: np.ndarray, keys: np.ndarray) -> None:
        scores, keys = np.append(self.scores, scores), np.append(self.keys, keys)
        order = np.lexsort((keys, -scores))[:self.k]
        self.scores, self.keys = scores[order], keys[order]


class Block:
    """Candidates in vertical layout, with the squared lengths of what follows each step."""

    def __init__(self, n: int, width: int, keys: bytes, grid: bytes, step: int = STEP, item_bytes: int = 8):
        self.keys = np.frombuffer(keys, dtype="<i8")
        self.grid = widened(grid, item_bytes, width, n)
        self.cuts = list(range(0, width, step)) + [width]
        masses = [np.square(self.grid[a:b].astype(np.float64)).sum(axis=0)
                  for a, b in zip(self.cuts[:-1], self.cuts[1:])]
        rest = np.cumsum(masses[::-1], axis=0)[::-1] if masses else np.zeros((0, n))
        self.rest = [np.sqrt(rest[i]) for i in range(len(rest))] + [np.zeros(n)]

    def search(self, query: np.ndarray, own: int, best: Best) -> None:
        """Offers every candidate to ``best`` that may belong to its k best."""
        width = min(len(self.grid), len(query))
        alive = np.flatnonzero(self.keys != own)
        sums = np.zeros(len(alive), dtype=np.int64)
        squares = np.square(query[:width].astype(np.float64))
        least = best.floor()
        for at, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:])):
            if a >= width:
                break
            if least is not None:
                # Slack above the rounding of the bound keeps it an upper bound.
                limit = sums + self.rest[at][alive] * (np.sqrt(squares[a:].sum()) * (1 + 1e-9)) + np.abs(sums) * 1e-12 + 1
                stay = limit >= least
                if not stay.all():
                    alive, sums = alive[stay], sums[stay]
            if not len(alive):
                return
            whole = len(alive) == self.grid.shape[1]
            part = self.grid[a:min(b, width)]
            sums = sums + query[a:min(b, width)] @ (part if whole else part[:, alive])
        if least is not None:
            stay = sums >= least
            alive, sums = alive[stay], sums[stay]
        if len(sums) > best.k:
            # Ties at the k-th score all stay, the keys decide among them.
            edge = np.partition(sums, len(sums) - best.k)[len(sums) - best.k]
            alive, sums = alive[sums >= edge], sums[sums >= edge]
        best.offer(sums, self.keys[alive])


def _streams(k: int):
    """Reads (query block, its candidate blocks) streams; gives k rows per query at their ends."""
    def run(batches):
        place, queries, found = None, None, []

        def result():
            rows = [(own, key, score) for own, best in zip(queries[0], found)
                    for score, key in zip(best.scores.tolist(), best.keys.tolist())]
            columns = list(zip(*rows)) if rows else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                              names=["query_id", "vec_id", "score"])

        for batch in batches:
            for row in each_row(batch):
                if not row["late"]:
                    if place is not None:
                        yield result()
                    place = (row["query_block"], row["lane"])
                    grid = widened(row["grid"], row["bytes"], row["width"], row["n"])
                    queries = (np.frombuffer(row["keys"], dtype="<i8").tolist(),
                               np.ascontiguousarray(grid.T))
                    found = [Best(k) for _ in queries[0]]
                elif place == (row["query_block"], row["lane"]):
                    block = Block(row["n"], row["width"], row["keys"], row["grid"], item_bytes=row["bytes"])
                    for own, query, best in zip(*queries, found):
                        block.search(query, own, best)
        if place is not None:
            yield result()

    return run


def top_products(vectors: DataFrame, queries: Column, k: int = 20, lanes: int = LANES
                 ) -> DataFrame:
    """The ``k`` highest inner products of every query row with all other rows.

    ``vectors`` has ``vec_id`` and ``vector`` (array of bigint); ``queries``
    says which rows ask. Work grows with queries times rows, as an exact search
    over a stated set must; bounds cut most of it. Blocks are written to the
    shared folder once: their number fixes the streams.
    """
    rows = vectors.where(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "vector").distinct()
    rows = settled(rows, "vectors")
    asking = rows.where(queries)
    query_blocks = max(1, -(-asking.count() // QUERY_ROWS))
    asked = settled(
        asking.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)))
        .groupBy("query_block").applyInArrow(_query_block, f"query_block bigint, {_BLOCK}"),
        "query-blocks")
    kept = settled(rows.mapInArrow(_blocks(BLOCK_ROWS), _BLOCK)
                   .withColumn("block", F.monotonically_increasing_id()), "vector-blocks")
    lanes = max(1, min(lanes, kept.count()))
    lane = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane")
    first = asked.select("query_block", lane, F.lit(0).alias("late"), "n", "width", "bytes", "keys", "grid")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint")))
    rest = kept.select(every.alias("query_block"),
                       F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int").alias("lane"),
                       F.lit(1).alias("late"), "n", "width", "bytes", "keys", "grid")
    partial = (first.unionByName(rest).repartition("query_block", "lane")
               .sortWithinPartitions("query_block", "lane", "late")
               .mapInArrow(_streams(k), _RESULT))
    rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (partial.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest_table(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The contract's search over ``embeddings`` (``vec_id``, ``embedding``)."""
    whole = embeddings.where(usable(F.col("embedding"))).select(
        "vec_id", floored(F.col("embedding")).alias("vector"))
    return top_products(whole, F.col("vec_id") % every == 0, k)
