"""Writers: overwrite, create-as-select, and dated append."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from wardlight.sources.clinical import ClinicalTables


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace the data and the schema at ``path``."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def overwrite_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0) -> None:
    """Replace a catalog table.

    Bucketing on ``patient_id`` or ``encounter_id`` lets later joins on that
    key run without a shuffle.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)


def write_clinical(tables: ClinicalTables, root: str, fmt: str = "parquet") -> None:
    for name in ("patients", "encounters", "diagnoses", "risk_scores", "sdoh", "care_coordinators"):
        overwrite(tables.table(name), f"{root}/{name}", fmt)


def append_report(report: DataFrame, path: str, report_date: dt.date) -> None:
    """Put one dated report beside those of other dates.

    Only the partition of its date is replaced, so a retried or repeated job
    leaves one report of that date.
    """
    (report.withColumn("report_date", F.lit(report_date))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("report_date").parquet(path))
