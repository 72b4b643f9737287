"""Cohorts as sets of patient ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wardlight.operators.lookups import discharged_since, patient_conditions
from wardlight.sources.clinical import ClinicalTables


def recently_discharged(tables: ClinicalTables, days_back: int) -> DataFrame:
    """Patients discharged in the last days, with their latest such discharge."""
    return (discharged_since(tables, days_back, bounded=True)
            .groupBy("patient_id").agg(F.max("discharge_date").alias("last_discharge")))


def with_condition(tables: ClinicalTables, *conditions: str,
                   patients: DataFrame | None = None) -> DataFrame:
    """Patients with any of the conditions."""
    return patient_conditions(tables, conditions, patients).select("patient_id")


def both(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("patient_id").intersect(b.select("patient_id"))


def either(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("patient_id").union(b.select("patient_id")).distinct()


def without(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct patients of ``a`` that are not in ``b``."""
    return a.select("patient_id").subtract(b.select("patient_id"))


def within_all(first: DataFrame, others: Sequence[DataFrame]) -> DataFrame:
    """Rows of ``first`` whose patient is in every other cohort."""
    for other in others:
        first = first.join(other.select("patient_id"), "patient_id", "left_semi")
    return first
