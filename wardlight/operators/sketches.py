"""Counts that merge: distinct patients per month and facility, and the most frequent requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardlight.session import settled
from wardlight.sources.clinical import ClinicalTables
from wardlight.sources.versioned import VersionedTable

# Registers of a sketch (log2): the standard error of a count is 1.04 / sqrt(2 ** 12), 1.6 %.
SKETCH_BITS = 12
# Four standard errors.
SKETCH_BOUND = 0.065
# Requests that a summary keeps.
MOST_ITEMS = 1000


# ---- distinct patients -------------------------------------------------

def _cells(stays: DataFrame) -> DataFrame:
    return stays.where(F.col("discharge_date").isNotNull()).withColumn(
        "discharge_month", F.date_format("discharge_date", "yyyy-MM"))


def patient_sketches(stays: DataFrame) -> DataFrame:
    """One row per discharge month and facility: ``cell``, ``stays`` and a sketch of its patients.

    A sketch is 4 KB at most whatever it has seen, and tasks combine theirs before they shuffle.
    """
    return (_cells(stays).groupBy("discharge_month", "facility")
            .agg(F.count(F.lit(1)).alias("stays"), F.hll_sketch_agg("patient_id", F.lit(SKETCH_BITS)).alias("patients"))
            .select(F.concat_ws("|", "discharge_month", F.coalesce("facility", F.lit(""))).alias("cell"),
                    "discharge_month", "facility", "stays", "patients"))


def add_stays(table: VersionedTable, stays: DataFrame, batch: tuple[str, int] | None = None) -> int:
    """Bring new stays into a stored table of sketches: sketches unite, no earlier stay is read."""
    return table.merge(patient_sketches(stays), batch=batch, matched={
        "patients": F.hll_union("old.patients", "new.patients"),
        "stays": F.col("old.stays") + F.col("new.stays")})


def estimated_patients(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct patients at a coarser level, by merging the stored sketches."""
    return sketches.groupBy(*by).agg(
        F.sum("stays").alias("stays"),
        F.hll_sketch_estimate(F.hll_union_agg("patients")).alias("estimated_patients"))


def estimated_rollup(sketches: DataFrame) -> DataFrame:
    """Estimates by month and facility, by month, and over all (``level`` 0, 1, 3)."""
    return sketches.rollup("discharge_month", "facility").agg(
        F.hll_sketch_estimate(F.hll_union_agg("patients")).alias("estimated_patients"),
        F.grouping_id().cast("int").alias("level"))


def exact_rollup(tables: ClinicalTables) -> DataFrame:
    """Exact distinct patients at the same levels: repeated stays go before the levels are formed."""
    once = _cells(tables.encounters).select("discharge_month", "facility", "patient_id").distinct()
    return once.rollup("discharge_month", "facility").agg(
        F.count_distinct("patient_id").alias("patients"), F.grouping_id().cast("int").alias("level"))


def within_bound(estimate: Column, exact: Column) -> Column:
    """Whether an estimate is as near as four standard errors (or one patient)."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * F.lit(SKETCH_BOUND))


# ---- most frequent requests --------------------------------------------

def normal_text(text: Column) -> Column:
    """A request in lower case with single spaces; null is empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[ \\t\\r\\n]+", " "))


def _row(item: Column, n, total=0, lost=0) -> list[Column]:
    numbers = {"n": n, "total": total, "lost": lost}
    return [item.alias("item"), *((F.lit(v) if isinstance(v, int) else v).cast("bigint").alias(k)
                                  for k, v in numbers.items())]


def counted(items: DataFrame) -> DataFrame:
    """Rows of ``item`` as a summary that lacks nothing; its size is not bounded yet.

    A summary has a row per item with its count ``n``, and one without item that holds the rows
    seen (``total``) and what every count may lack (``lost``).
    """
    none = F.lit(None).cast("string")
    counts = items.where(F.col("item").isNotNull()).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(*_row(F.col("item"), F.col("n"))).unionByName(
        items.agg(F.count("item").alias("rows")).select(*_row(none, 0, F.col("rows"))))


def reduced(summary: DataFrame, most: int = MOST_ITEMS) -> DataFrame:
    """The summary with at most ``most`` items: the count behind the last place is taken off all.

    Whatever is taken off one count is taken off ``most`` others as well, so counts lack at most
    the rows seen divided by ``most`` + 1, however many summaries were put together. Two numbers
    reach the driver.
    """
    items = summary.where(F.col("item").isNotNull()).groupBy("item").agg(F.sum("n").alias("n"))
    first = items.orderBy(F.desc("n"), "item").limit(most + 1)
    cut = first.agg(F.when(F.count(F.lit(1)) > most, F.min("n")).otherwise(0)).first()[0]
    head = summary.where(F.col("item").isNull()).agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("lost"), F.lit(0)).alias("lost"))
    left = items.where(F.col("n") > cut).select(*_row(F.col("item"), F.col("n") - cut))
    return left.unionByName(head.select(*_row(
        F.lit(None).cast("string"), 0, F.col("total"), F.col("lost") + cut)))


def merged(one: DataFrame, other: DataFrame, most: int = MOST_ITEMS) -> DataFrame:
    """The summary of all rows that either has seen, within the same bound, in any order."""
    return reduced(one.unionByName(other), most)


def frequent(summary: DataFrame, share: float) -> DataFrame:
    """``item`` of all rows that may hold more than ``share`` of the rows seen: none that does is left out.

    ``share`` must be at least 1 / (``most`` + 1) of the summary.
    """
    total, lost = summary.where(F.col("item").isNull()).agg(F.sum("total"), F.sum("lost")).first()
    return summary.where(F.col("item").isNotNull() & (F.col("n") + (lost or 0) > share * (total or 0))).select("item")


def exactly_frequent(rows: DataFrame, candidates: DataFrame, share: float) -> DataFrame:
    """``item`` and ``times`` of those that do: a second pass counts the candidates alone."""
    total = rows.agg(F.count("item")).first()[0]
    # The candidates are at most as many as a summary has items.
    return (rows.join(F.broadcast(candidates), "item", "left_semi").groupBy("item")
            .agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > share * total))


def run_summary(feed: DataFrame, item: Column, path: str, checkpoint: str, most: int = MOST_ITEMS
                ) -> VersionedTable:
    """Keep the summary of a stream in the table at ``path``; a replayed micro-batch is skipped."""
    table = VersionedTable(feed.sparkSession, path)

    def step(batch: DataFrame, batch_id: int) -> None:
        new = settled(reduced(counted(batch.select(item.alias("item"))), most), "summary")
        if not table.versions():
            VersionedTable.create(new.limit(0), path, "item", buckets=1)
        table.replace(lambda own: merged(own, new, most), batch=("summary", batch_id))

    query = (feed.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return table
