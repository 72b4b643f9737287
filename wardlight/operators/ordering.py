"""Ranks and neighbours that hold when one key owns a large share of the rows.

A plain window sends every row of a partition key to one task. The helpers
here first cut a key's rows into buckets that follow the sort order, work
inside each bucket, and carry only one row per bucket across.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlight.session import settled


def _attach(rows: DataFrame, lookup: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Left join of one column of ``lookup`` (unique on ``keys``), null keys included."""
    renamed = lookup.select(*(F.col(k).alias(f"__k_{k}") for k in keys), column)
    match = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys))
    return rows.join(renamed, match, "left").drop(*(f"__k_{k}" for k in keys))


def _rows_before(partition_by: list[str], order_by: str, count: str) -> Column:
    before = (Window.partitionBy(*partition_by).orderBy(order_by)
              .rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(F.sum(count).over(before), F.lit(0))


def bucket_marks(rows: DataFrame, partition_by: list[str], buckets: list[str]) -> DataFrame:
    """One mark per bucket: its keys and ``__offset``, the rows before it in its partition.

    ``buckets`` run from coarse to fine. Counts combine map-side, and each
    level's running sum spans only the buckets below one parent.
    """
    keys = partition_by + buckets
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    marks = counts.withColumn("__offset", _rows_before(keys[:-1], keys[-1], "__n"))
    for depth in range(len(keys) - 1, len(partition_by), -1):
        level = keys[:depth]
        totals = (counts.groupBy(*level).agg(F.sum("__n").alias("__m"))
                  .withColumn("__before", _rows_before(level[:-1], level[-1], "__m")))
        marks = (_attach(marks, totals, level, "__before")
                 .withColumn("__offset", F.col("__offset") + F.col("__before")).drop("__before"))
    return marks.select(*keys, "__offset")


def number_after_marks(rows: DataFrame, marks: DataFrame, name: str, keys: list[str],
                       order_by: list[Column], spread: dict[str, str]) -> DataFrame:
    """Number the rows of each bucket onwards from its mark's ``__offset``.

    Marks are sorted in as the first row of their bucket instead of being
    joined: one shuffle, and null keys need no special care. ``spread`` maps
    further columns of the marks to the names under which every row gets them.
    """
    both = rows.withColumn("__rank", F.lit(1)).unionByName(
        marks.withColumn("__rank", F.lit(0)), allowMissingColumns=True)
    bucket = Window.partitionBy(*keys).orderBy("__rank", *order_by)
    so_far = bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = both.withColumns({
        name: (F.max("__offset").over(so_far) + F.row_number().over(bucket) - 1).cast("bigint"),
        **{new: F.max(old).over(so_far) for old, new in spread.items()},
    })
    return numbered.where(F.col("__rank") == 1).drop("__rank", "__offset", *spread)


def distributed_row_number(rows: DataFrame, name: str, partition_by: list[str],
                           order_by: list[Column], buckets: dict[str, Column],
                           at_most: int | None = None) -> DataFrame:
    """``row_number()`` over ``partition_by`` ordered by ``order_by``.

    ``buckets`` (coarse to fine) must never decrease along ``order_by``; they
    bound how many rows one task sorts. With ``at_most``, rows in buckets that
    start beyond it are dropped before the sort, and the result is exactly the
    rows numbered up to it. ``rows`` is evaluated for the counts and again for
    the numbering, so settle a costly input first.
    """
    tagged = rows.withColumns(buckets)
    keys = partition_by + list(buckets)
    marks = bucket_marks(tagged, partition_by, list(buckets))
    if at_most is not None:
        marks = marks.where(F.col("__offset") < at_most)
        tagged = tagged.join(marks.select(*keys), keys, "left_semi").select(*tagged.columns)
    numbered = number_after_marks(tagged, marks, name, keys, order_by, {}).drop(*buckets)
    return numbered if at_most is None else numbered.where(F.col(name) <= at_most)


def ranked(rows: DataFrame, name: str, order_by: list[Column], within: list[str] | None = None,
           parts: int | None = None) -> DataFrame:
    """Number all rows from 1 by ``order_by``, or anew for each ``within``, whatever the keys look like.

    Rows are dealt into ranges of the whole order (sampled, so ranges hold
    about equally many rows even where most rows share a score) and sorted
    there; a row's number is its place in its range plus the rows of the ranges
    before. ``order_by`` must be total. The sorted rows are written to shared
    storage once, when this is called; beyond them only one row per range, and
    one per value of ``within``, is moved. ``rows`` is read twice (its order is
    sampled first): settle it if it is costly.
    """
    order = [F.col(c) for c in within or []] + list(order_by)
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    # Built from the sorted partition's number and the row's place in it.
    placed = settled(dealt.sortWithinPartitions(*order)
                     .withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__at", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    # One row per range: as many as the shuffle had partitions.
    numbered = (placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
                .withColumn(name, F.col("__offset") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1))
    if within:
        first = numbered.groupBy(*within).agg(F.min(name).alias("__first"))
        numbered = _attach(numbered, first, within, "__first").withColumn(
            name, F.col(name) - F.col("__first") + 1)
    return numbered.select(*rows.columns, name)


def next_in_group(rows: DataFrame, name: str, key: str, order_by: str, value: Column,
                  bucket: Column) -> DataFrame:
    """``lead(value)`` per ``key`` in ``order_by`` order, worked bucket by bucket.

    ``bucket`` must never decrease along ``order_by``. The first value of the
    key's next bucket is sorted in as the last row of each bucket, so the result
    is that of one window over the key, for any ties and nulls.
    """
    tagged = rows.withColumns({"__bucket": bucket, "__value": value})
    following = F.lead("__head").over(Window.partitionBy(key).orderBy("__bucket"))
    marks = (tagged.groupBy(key, "__bucket").agg(F.min_by("__value", order_by).alias("__head"))
             .select(key, "__bucket", following.alias("__value"), F.lit(1).alias("__rank")))
    both = tagged.withColumn("__rank", F.lit(0)).unionByName(marks, allowMissingColumns=True)
    inside = Window.partitionBy(key, "__bucket").orderBy("__rank", order_by)
    return (both.withColumn(name, F.lead("__value").over(inside))
            .where(F.col("__rank") == 0).drop("__rank", "__bucket", "__value"))
