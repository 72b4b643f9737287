"""Admit/discharge/transfer messages as a stream.

Every query takes a streaming frame, so the feed may be files, Kafka or any
other source; ``read_feed`` is the file form. Progress lives in the
checkpoint folder, results go to a file sink on shared storage, and a query
started with ``availableNow`` stops once the feed is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from wardlight.operators.lookups import only_patients, risk_score_lookup
from wardlight.operators.priority import priority_scores
from wardlight.session import list_folder, remove_path, scratch_path, settled
from wardlight.sources.clinical import ClinicalTables
from wardlight.sources.history import BucketedHistory
from wardlight.sources.versioned import VersionedTable

LATENESS = "1 hour"


def read_feed(spark: SparkSession, path: str, schema, name_filter: str | None = None,
              files_per_batch: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Files that arrive in ``path``, in any of Spark's file formats (Parquet, JSON, ...)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def instant(feed: DataFrame) -> DataFrame:
    """The feed with ``ts`` as an instant.

    A time without a zone is taken as UTC, field by field: a plain cast would
    take it as the session's zone.
    """
    if isinstance(feed.schema["ts"].dataType, T.TimestampNTZType):
        return feed.withColumn("ts", F.expr(
            "make_timestamp_ltz(year(ts), month(ts), day(ts), hour(ts), minute(ts),"
            " extract(SECOND FROM ts), 'UTC')"))
    return feed.withColumn("ts", F.col("ts").cast("timestamp"))


def timed(feed: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The feed with a watermark on ``ts``; messages later than that are dropped."""
    return instant(feed).withWatermark("ts", lateness)


def utc_day(moment: Column) -> Column:
    """The UTC day of an instant, in any session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(moment) / 86400).cast("int"))


def daily_counts(feed: DataFrame) -> DataFrame:
    """Messages per UTC day and type; a day is final once the watermark has passed it."""
    return (timed(feed).groupBy(F.window("ts", "1 day"), "adt_type")
            .agg(F.count(F.lit(1)).alias("messages"))
            .select(utc_day(F.col("window.start")).alias("day"), "adt_type", "messages"))


def closing_counts(rows: DataFrame, final: DataFrame) -> DataFrame:
    """Counts of the days that ``daily_counts`` still holds open when a feed has ended.

    ``rows`` is the whole feed as a batch, ``final`` what the stream has given:
    together they are the counts of all days. Messages that the stream dropped
    as too late belong to days that were given, and stay dropped.
    """
    open_days = (instant(rows).groupBy(utc_day(F.col("ts")).alias("day"), "adt_type")
                 .agg(F.count(F.lit(1)).alias("messages")))
    return open_days.join(final.select("day").distinct(), "day", "left_anti")


def deduplicated(feed: DataFrame) -> DataFrame:
    """Each message once, however often the sender repeats it within the lateness."""
    return timed(feed).dropDuplicatesWithinWatermark(["event_id"])


def corrected_days(feed: DataFrame, path: str, checkpoint: str, lateness: str | None = None
                   ) -> VersionedTable:
    """Messages per UTC day and type, open days included, in a table that later messages correct.

    Every micro-batch merges the counts that it changed into the table at ``path``
    (key ``day_type``), under its own number, so a replay changes nothing. Without
    ``lateness`` a message corrects its day however late it is; the state is one
    count per day and type either way.
    """
    spark = feed.sparkSession
    timely = timed(feed, lateness) if lateness else instant(feed)
    counts = (timely.groupBy(F.window("ts", "1 day"), "adt_type").agg(F.count(F.lit(1)).alias("messages"))
              .select(utc_day(F.col("window.start")).alias("day"), "adt_type", "messages"))
    table = VersionedTable(spark, path)

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.select(F.concat_ws("|", F.col("day").cast("string"), F.coalesce("adt_type", F.lit(""))
                                       ).alias("day_type"), "day", "adt_type", "messages")

    def step(batch: DataFrame, batch_id: int) -> None:
        if not table.versions():
            VersionedTable.create(keyed(batch).limit(0), path, "day_type", buckets=8)
        table.merge(keyed(batch), batch=("days", batch_id))

    query = (counts.writeStream.outputMode("update").foreachBatch(step)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return table


def run_once_each(feed: DataFrame, path: str, checkpoint: str, seen_path: str, buckets: int = 64) -> None:
    """Append each message once to ``path``, whatever was sent before and however long ago.

    The ids seen are a table of their own, bucketed by id, and outlive the query: a feed that is
    replayed under a new checkpoint adds nothing. A micro-batch writes its folder first, which a
    replay overwrites, and then enters its ids under its number; once they are entered, the
    folder is complete and the batch is skipped.
    """
    spark = feed.sparkSession
    seen = VersionedTable(spark, seen_path)
    # Batch numbers begin anew under a new checkpoint, so its name goes with them.
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def step(batch: DataFrame, batch_id: int) -> None:
        ids = settled(batch.where(F.col("event_id").isNotNull()).select("event_id").distinct(), "ids")
        if not seen.versions():
            VersionedTable.create(ids.limit(0), seen_path, "event_id", buckets)
        if seen.manifest().batches.get(run, -1) >= batch_id:
            return
        new = settled(ids.join(seen.read_keys(ids), "event_id", "left_anti"), "new-ids")
        (batch.dropDuplicates(["event_id"]).join(new, "event_id", "left_semi").select(*batch.columns)
         .write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}"))
        seen.append(new, batch=(run, batch_id))

    _run_batches(feed, step, checkpoint)


def with_latest_update(messages: DataFrame, updates: DataFrame, horizon: str, lateness: str = LATENESS
                       ) -> DataFrame:
    """Each message with the patient's latest risk update up to its time, both as streams.

    ``updates`` has ``patient_id``, ``updated`` (instant), ``update_id`` and ``risk_score``. The
    two meet in a left outer interval join, whose state expires with the watermarks, and the
    latest update of a message is taken once no earlier one can come: an update that is late
    by less than ``lateness`` still counts. A message without any update in ``horizon`` keeps
    null. Messages are given once the watermark has passed them.
    """
    left = timed(messages, lateness)
    right = updates.select(F.col("patient_id").alias("u_patient"), "updated", "update_id",
                           F.col("risk_score").alias("u_score")).withWatermark("updated", lateness)
    near = ((F.col("patient_id") == F.col("u_patient")) & (F.col("updated") <= F.col("ts"))
            & (F.col("updated") > F.col("ts") - F.expr(f"INTERVAL {horizon}")))
    return (left.join(right, near, "left_outer")
            .groupBy("ts", "event_id", "patient_id", "adt_type")
            .agg(F.max(F.struct("updated", "update_id", "u_score")).alias("latest"))
            .select("event_id", "ts", "patient_id", "adt_type", F.col("latest.updated").alias("updated"),
                    F.col("latest.u_score").alias("risk_score")))


def latest_update_of(messages: DataFrame, updates: DataFrame, horizon: str) -> DataFrame:
    """The same for a batch: what ``with_latest_update`` gives, for messages it has not given yet.

    Updates and messages of a patient are put in one order, and each message takes the last
    update before it, in buckets of a day so that one patient's feed is not one sort; the last
    update of the days before is sorted in as a bucket's first row.
    """
    day = utc_day(F.col("at"))
    columns = ["patient_id", "at", "kind", "event_id", "adt_type", "update"]
    update = F.struct(F.col("updated"), F.col("update_id"), F.col("risk_score"))
    marks = updates.where(F.col("patient_id").isNotNull()).select("patient_id", F.col("updated").alias("at"), F.lit(0).alias("kind"),
                           F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("adt_type"),
                           update.alias("update"))
    asked = instant(messages).select("patient_id", F.col("ts").alias("at"), F.lit(1).alias("kind"), "event_id",
                                     "adt_type", F.lit(None).cast(marks.schema["update"].dataType).alias("update"))
    both = marks.unionByName(asked).withColumn("day", day)
    last = both.groupBy("patient_id", "day").agg(F.max("update").alias("update"))
    before = F.max("update").over(Window.partitionBy("patient_id").orderBy("day").rowsBetween(
        Window.unboundedPreceding, -1))
    heads = last.select("patient_id", "day", before.alias("update")).select(
        "patient_id", F.lit(None).cast("timestamp").alias("at"), F.lit(-1).alias("kind"),
        F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("adt_type"),
        "update", "day")
    order = Window.partitionBy("patient_id", "day").orderBy(F.col("at").asc_nulls_first(), "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = heads.unionByName(both.select(*columns, "day")).withColumn("latest", F.max("update").over(order))
    fresh = F.col("latest.updated") > F.col("at") - F.expr(f"INTERVAL {horizon}")
    return placed.where(F.col("kind") == 1).select(
        "event_id", F.col("at").alias("ts"), "patient_id", "adt_type",
        F.when(fresh, F.col("latest.updated")).alias("updated"),
        F.when(fresh, F.col("latest.risk_score")).alias("risk_score"))


def run_risk_merge(feed: DataFrame, table: VersionedTable, checkpoint: str, step_size: float = 0.02) -> None:
    """Keep risk scores up to date in place: admissions raise a patient's score.

    ``table`` has ``patient_id``, ``risk_score``, ``messages`` and ``last_message``. A micro-batch
    counts its messages per patient and merges the counts: known patients are raised, new ones
    begin at zero. Only the buckets of its patients are rewritten, and a replayed batch is skipped.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        counts = (instant(batch).where(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(
            F.count_if(F.col("adt_type") == "admit").alias("admits"),
            F.count(F.lit(1)).alias("messages"), F.max("ts").alias("last_message")))

        def raised(before: Column) -> Column:
            return F.least(F.lit(1.0), F.round(before + F.col("new.admits") * F.lit(step_size), 3))

        table.merge(counts, batch=("risk", batch_id), matched={
            "risk_score": raised(F.col("old.risk_score")),
            "messages": F.col("old.messages") + F.col("new.messages"),
            "last_message": F.greatest("old.last_message", "new.last_message"),
        }, inserted={"risk_score": raised(F.lit(0.0))})

    _run_batches(feed, step, checkpoint)


def enriched(feed: DataFrame, tables: ClinicalTables | BucketedHistory) -> DataFrame:
    """Messages (a batch, or one micro-batch) with the patient's record number and latest risk.

    The clinical side is cut to the patients of the messages before anything is
    aggregated, so only their rows are moved; of a bucketed history, only their
    files are read.
    """
    touched = settled(feed.select("patient_id").distinct(), "touched")
    if isinstance(tables, BucketedHistory):
        tables = tables.share(touched)
    risk = risk_score_lookup(tables, touched).select("patient_id", "risk_score", "risk_category")
    people = (only_patients(tables.patients.select("patient_id", "mrn"), touched)
              .join(risk, "patient_id", "left"))
    return feed.join(people, "patient_id", "left").select(
        "event_id", "ts", "patient_id", "adt_type", "mrn", "risk_score", "risk_category")


def run_enriched(feed: DataFrame, tables: ClinicalTables | BucketedHistory, path: str, checkpoint: str) -> None:
    """Write every micro-batch, enriched, to its own folder, which a replay overwrites.

    The clinical tables are read in each micro-batch, so a message meets them
    as they are when it arrives.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        held = settled(batch, "messages")
        enriched(held, tables).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    _run_batches(feed, step, checkpoint)


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append the stream's rows to ``path`` until the feed is used up."""
    query = (stream.writeStream.format("parquet").outputMode("append")
             .option("path", path).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def drained(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Run the stream to its present end and read back what it wrote.

    Windows that the watermark has not passed stay open and are not in it:
    the last days of a daily count come with later messages, or from
    ``closing_counts`` if there will be none.
    """
    root = scratch_path(spark, label)
    run_to_files(stream, f"{root}/rows", f"{root}/progress")
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def _run_batches(feed: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (feed.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def share_of(tables: ClinicalTables | BucketedHistory, touched: DataFrame) -> ClinicalTables:
    """The tables cut to some patients, for work on a few of them.

    A bucketed history opens only the files of their buckets. Otherwise
    ``touched`` (settled, so its size is known) is small next to the history:
    the tables are filtered by it where they are read. The patients' stays are
    settled in turn and filter the diagnoses, so no history is shuffled.
    """
    if isinstance(tables, BucketedHistory):
        return tables.share(touched)
    stays = settled(only_patients(tables.encounters, touched), "stays")
    codes = tables.diagnoses.join(stays.select("encounter_id"), "encounter_id", "left_semi")
    return tables.replace(
        patients=only_patients(tables.patients, touched), encounters=stays, diagnoses=codes,
        risk_scores=only_patients(tables.risk_scores, touched),
        sdoh=only_patients(tables.sdoh, touched))


def score_touched(tables: ClinicalTables | BucketedHistory, path: str, compact_every: int = 0
                  ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` step that rescores only the patients of the batch.

    A batch writes its own version folder and overwrites it when replayed, so
    a batch run twice after a failure leaves one result. Every
    ``compact_every``-th batch writes the newest scores of all earlier versions
    as well and then removes those; a failure in between leaves both, and the
    newest version counts.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = tables.spark
        touched = settled(batch.select("patient_id").distinct(), "touched")
        scores = priority_scores(share_of(tables, touched))
        older = [v for v in versions(spark, path) if v < batch_id]
        target = f"{path}/version={batch_id}"
        if compact_every and older and batch_id % compact_every == compact_every - 1:
            kept = current_scores(spark, path, older).join(touched, "patient_id", "left_anti")
            scores.unionByName(kept).write.mode("overwrite").parquet(target)
            for version in older:
                remove_path(spark, f"{path}/version={version}")
        else:
            scores.write.mode("overwrite").parquet(target)

    return step


def run_incremental(feed: DataFrame, tables: ClinicalTables | BucketedHistory, path: str, checkpoint: str,
                    compact_every: int = 0) -> None:
    _run_batches(feed, score_touched(tables, path, compact_every), checkpoint)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the version folders in ``path``."""
    return sorted(int(name.split("=")[1]) for name in list_folder(spark, path)
                  if name.startswith("version="))


def current_scores(spark: SparkSession, path: str, among: list[int] | None = None) -> DataFrame:
    """The newest score of every patient that any batch (or one ``among`` some) has touched."""
    rows = spark.read.parquet(path) if among is None else spark.read.option(
        "basePath", path).parquet(*(f"{path}/version={v}" for v in among))
    newest = F.max_by(F.struct("priority_score", "risk_factors", "recommendations"), "version")
    return (rows.groupBy("patient_id").agg(newest.alias("s"))
            .select("patient_id", "s.*"))


def compact_scores(spark: SparkSession, path: str, target: str) -> None:
    """Write the newest scores as one table, leaving the versions in place."""
    current_scores(spark, path).write.mode("overwrite").parquet(target)
