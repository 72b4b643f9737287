"""Data checks: row counts, expected cohorts, keys, derived columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from wardlight.operators.lookups import (
    available_coordinators, discharged_since, latest_sdoh, patient_conditions, risk_score_lookup)
from wardlight.operators.readmit import readmission_pairs
from wardlight.schema import CLINICAL_TABLES, HIGH_RISK
from wardlight.sources.clinical import ClinicalTables


def _rows(frame: DataFrame, label: str, name: str, value: str, expression=None) -> DataFrame:
    counted = F.count(F.lit(1)) if expression is None else expression
    return frame.agg(counted.cast("bigint").alias(value)).select(F.lit(label).alias(name), value)


def _stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_row_counts(tables: ClinicalTables) -> DataFrame:
    """Rows per table in one job; plain counts come from the file footers."""
    return _stacked([_rows(tables.table(name), name, "table_name", "row_count")
                     for name in CLINICAL_TABLES])


def planted_counts(tables: ClinicalTables, days_back: int = 7) -> DataFrame:
    """The eight cohort sizes in one row; of repeated risk and social rows the latest counts."""
    conditions = patient_conditions(tables, ["CHF", "COPD"])
    coordinators = available_coordinators(tables, ["CHF", "COPD"])
    counts = {
        "recent_discharges": (discharged_since(tables, days_back), None),
        "chf_patients": (conditions, F.count_if("chf")),
        "copd_patients": (conditions, F.count_if("copd")),
        "high_risk": (risk_score_lookup(tables).where(F.col("risk_score") > HIGH_RISK), None),
        "readmissions_30d": (readmission_pairs(tables).where("is_30_day"), None),
        "transportation_barriers": (latest_sdoh(tables).where("transportation_barrier"), None),
        "housing_instability": (latest_sdoh(tables).where("housing_instability"), None),
        "specialist_coordinators": (coordinators, None),
    }
    stacked = _stacked([_rows(frame, name, "name", "n", agg) for name, (frame, agg) in counts.items()])
    return stacked.agg(*(F.max(F.when(F.col("name") == name, F.col("n"))).alias(name)
                         for name in counts))


def referential_checks(tables: ClinicalTables) -> DataFrame:
    """Rows without a parent and keys held more than once, per rule.

    Foreign keys are counted before they are compared, so a key with very
    many rows is one row in the join.
    """
    def orphans(label: str, child: str, parent: str, key: str) -> DataFrame:
        held = tables.table(child).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        lost = held.join(tables.table(parent).select(key), key, "left_anti")
        return _rows(lost, label, "check_name", "violations", F.coalesce(F.sum("n"), F.lit(0)))

    def repeated(label: str, table: str, key: str) -> DataFrame:
        twice = (tables.table(table).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                 .where(F.col("n") > 1))
        return _rows(twice, label, "check_name", "violations")

    return _stacked([
        orphans("encounter_without_patient", "encounters", "patients", "patient_id"),
        orphans("diagnosis_without_encounter", "diagnoses", "encounters", "encounter_id"),
        orphans("risk_score_without_patient", "risk_scores", "patients", "patient_id"),
        orphans("sdoh_without_patient", "sdoh", "patients", "patient_id"),
        repeated("duplicate_patient", "patients", "patient_id"),
        repeated("duplicate_encounter", "encounters", "encounter_id"),
        repeated("duplicate_diagnosis", "diagnoses", "diagnosis_id"),
        repeated("duplicate_risk_score", "risk_scores", "patient_id"),
        repeated("duplicate_sdoh", "sdoh", "patient_id"),
        repeated("duplicate_coordinator", "care_coordinators", "coordinator_id"),
    ])


def derived_column_checks(tables: ClinicalTables) -> DataFrame:
    """Rows whose derived columns disagree with what they are derived from."""
    capacity = F.col("max_caseload") - F.col("current_caseload")
    planned = F.date_add(F.to_date("admission_date"), F.col("length_of_stay"))
    rules = [
        ("capacity", tables.care_coordinators, F.col("available_capacity") != capacity),
        ("discharge_date", tables.encounters, F.to_date("discharge_date") != planned),
        ("discharge_before_admission", tables.encounters,
         F.col("discharge_date") < F.col("admission_date")),
    ]
    return _stacked([
        frame.agg(F.count(F.lit(1)).alias("checked"), F.count_if(broken).alias("violations"))
        .select(F.lit(label).alias("check_name"), "checked", "violations")
        for label, frame, broken in rules])
