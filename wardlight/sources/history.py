"""Clinical history bucketed by patient, so that work on a few patients opens a few files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from wardlight.operators.lookups import only_patients
from wardlight.session import list_folder
from wardlight.sources.clinical import ClinicalTables
from wardlight.sources.versioned import BUCKETS, VersionedTable

# Tables that hold rows of patients. Diagnoses are stored with the patient of their encounter.
KEPT = ("patients", "encounters", "diagnoses", "risk_scores", "sdoh")
KEY = "patient_id"


class BucketedHistory:
    """Patients, stays, coded conditions, scores and assessments as versioned tables by patient.

    ``share`` gives the clinical tables of some patients. The buckets of those patients are
    worked out first, and only their files are listed and read, so a micro-batch costs what it
    touches. More buckets than a batch has patients keep that small; ``append`` and ``merge`` of
    the single tables bring new rows in. An encounter id belongs to one patient.
    """

    def __init__(self, spark: SparkSession, path: str, as_of: dt.date, others: ClinicalTables):
        self.spark, self.path, self.as_of, self._others = spark, path, as_of, others
        self.tables = {name: VersionedTable(spark, f"{path}/{name}") for name in KEPT}

    @staticmethod
    def build(tables: ClinicalTables, path: str, buckets: int = BUCKETS) -> "BucketedHistory":
        """Store the tables once, each in one pass; further tables are taken from ``tables`` as they are."""
        history = BucketedHistory(tables.spark, path, tables.as_of, tables)
        owners = tables.encounters.select("encounter_id", KEY)
        for name in KEPT:
            frame = tables.table(name)
            if name == "diagnoses":
                frame = frame.join(owners, "encounter_id").select(*frame.columns, KEY)
            if not list_folder(tables.spark, f"{path}/{name}"):
                VersionedTable.create(frame, f"{path}/{name}", KEY, buckets)
        return history

    def buckets_of(self, touched: DataFrame) -> list[int]:
        return self.tables["patients"].buckets_of(touched, KEY)

    def share(self, touched: DataFrame) -> ClinicalTables:
        """The tables cut to the patients of ``touched`` (patient_id), as they are now."""
        buckets = self.buckets_of(touched)
        cut = {name: only_patients(table.read(buckets=buckets), touched)
               for name, table in self.tables.items()}
        cut["diagnoses"] = cut["diagnoses"].drop(KEY)
        return self._others.replace(**cut)

    def whole(self) -> ClinicalTables:
        """All rows, as they are now."""
        frames = {name: table.read() for name, table in self.tables.items()}
        frames["diagnoses"] = frames["diagnoses"].drop(KEY)
        return self._others.replace(**frames)

    def add(self, name: str, rows: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Append rows to one table; new diagnoses bring their ``patient_id`` along."""
        return self.tables[name].append(rows, batch)

    def set_scores(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """New risk scores (one row per patient) in the place of the stored ones."""
        return self.tables["risk_scores"].merge(rows, batch=batch)

