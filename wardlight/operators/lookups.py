"""The basic look-ups, each over all rows or a frame of patient ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wardlight.functions.columns import condition_prefix, has_prefix, patient_name
from wardlight.schema import BARRIERS, CONDITION_PREFIXES
from wardlight.sources.clinical import ClinicalTables


def only_patients(rows: DataFrame, patients: DataFrame | None) -> DataFrame:
    """Rows of the given patients; ``None`` keeps everyone.

    A semi-join on a distinct key list, so neither duplicates in the list nor
    its length change the result; AQE broadcasts the list when it is small.
    """
    if patients is None:
        return rows
    return rows.join(patients.select("patient_id"), "patient_id", "left_semi")


def patient_ids(tables: ClinicalTables, ids: Sequence[str]) -> DataFrame:
    """A frame of ids given by the caller, e.g. one patient of a question."""
    return tables.spark.createDataFrame([(i,) for i in ids], "patient_id string")


def discharged_since(tables: ClinicalTables, days_back: int, bounded: bool = False) -> DataFrame:
    """Encounters discharged in the last ``days_back`` days.

    ``bounded`` also drops discharges planned after the reference day; the
    plain form leaves the end open.
    """
    kept = tables.encounters.where(
        F.col("discharge_date") >= F.date_sub(tables.today(), days_back))
    if bounded:
        kept = kept.where(F.col("discharge_date") < F.date_add(tables.today(), 1))
    return kept


def recent_discharges(tables: ClinicalTables, days_back: int, bounded: bool = False) -> DataFrame:
    return (
        discharged_since(tables, days_back, bounded)
        .join(tables.patients.select("patient_id", "mrn", "first_name", "last_name"), "patient_id")
        .select("encounter_id", "patient_id", "mrn", patient_name().alias("patient_name"),
                "discharge_date", "facility", "encounter_type", "length_of_stay",
                "discharge_disposition")
    )


def diagnoses_by_condition(tables: ClinicalTables, condition: str) -> DataFrame:
    """Distinct diagnosis rows of a named condition; an unknown name gives none.

    Duplicates go before the joins: the join keys are functions of the
    encounter, so the fewer rows travel the same distance to the same result.
    """
    prefix = condition_prefix(condition)
    matching = F.col("icd10_code").startswith(prefix) if prefix else F.lit(False)
    found = (tables.diagnoses.where(matching)
             .select("encounter_id", "icd10_code", "description", "is_primary", "diagnosis_date")
             .distinct())
    return (
        found
        .join(tables.encounters.select("encounter_id", "patient_id"), "encounter_id")
        .join(tables.patients.select("patient_id", "mrn", "first_name", "last_name"), "patient_id")
        .select("encounter_id", "patient_id", "mrn", patient_name().alias("patient_name"),
                "icd10_code", "description", "is_primary", "diagnosis_date")
    )


def patient_conditions(tables: ClinicalTables, conditions: Sequence[str],
                       patients: DataFrame | None = None) -> DataFrame:
    """One row per patient with any of the conditions, one flag per condition.

    A single pass over the diagnoses serves every condition. Flags combine
    per encounter before the join and per patient after it, so an encounter
    or patient with very many rows shrinks before any shuffle.
    """
    flags = {c.lower(): CONDITION_PREFIXES[c] for c in conditions}
    encounters = only_patients(tables.encounters.select("encounter_id", "patient_id"), patients)
    per_encounter = (
        tables.diagnoses
        .where(has_prefix(F.col("icd10_code"), flags.values()))
        .groupBy("encounter_id")
        .agg(*(F.bool_or(F.col("icd10_code").startswith(p)).alias(n) for n, p in flags.items()))
    )
    return (per_encounter.join(encounters, "encounter_id")
            .groupBy("patient_id")
            .agg(*(F.bool_or(n).alias(n) for n in flags)))


def risk_score_lookup(tables: ClinicalTables, patients: DataFrame | None = None) -> DataFrame:
    """Latest risk score per patient; equal dates go to the higher score."""
    fields = ("risk_score", "risk_category", "risk_factors", "last_calculated")
    latest = F.max_by(F.struct(*fields), F.struct("last_calculated", "risk_score"))
    return (only_patients(tables.risk_scores, patients)
            .groupBy("patient_id").agg(latest.alias("latest"))
            .select("patient_id", *(f"latest.{name}" for name in fields)))


def latest_sdoh(tables: ClinicalTables, patients: DataFrame | None = None) -> DataFrame:
    """Latest social assessment per patient; an undated one counts as the oldest."""
    fields = (*BARRIERS, "last_assessed")
    latest = F.max_by(F.struct(*fields), F.struct("last_assessed", *BARRIERS))
    return (only_patients(tables.sdoh, patients)
            .groupBy("patient_id").agg(latest.alias("latest"))
            .select("patient_id", *(f"latest.{name}" for name in fields)))


def sdoh_barriers(tables: ClinicalTables, patients: DataFrame | None = None) -> DataFrame:
    return latest_sdoh(tables, patients).select(
        "patient_id", "housing_instability", "transportation_barrier", "food_insecurity",
        "social_isolation", "financial_strain", "last_assessed")


def available_coordinators(tables: ClinicalTables,
                           specialties: str | Sequence[str] | None = None) -> DataFrame:
    """Active coordinators with free places, optionally of a specialty.

    A specialty matches as a literal part of the stored list text; several
    specialties mean any of them.
    """
    free = tables.care_coordinators.where(F.col("active") & (F.col("available_capacity") > 0))
    if specialties is not None:
        wanted = [specialties] if isinstance(specialties, str) else list(specialties)
        match = F.lit(False)
        for specialty in wanted:
            match = match | F.col("specialties").contains(specialty)
        free = free.where(match)
    return free.select("coordinator_id", "name", "title", "current_caseload", "max_caseload",
                       "available_capacity", "specialties", "years_experience")


def condition_labels(tables: ClinicalTables) -> DataFrame:
    """Every diagnosis of a known condition with the condition's name.

    The condition list is a fixed handful, so it is matched as an array inside
    the row; no join is needed, and overlapping prefixes would give one row each.
    """
    known = F.array(*(F.struct(F.lit(c).alias("condition"), F.lit(p).alias("prefix"))
                      for c, p in CONDITION_PREFIXES.items()))
    hits = F.filter(known, lambda entry: F.col("icd10_code").startswith(entry["prefix"]))
    return (tables.diagnoses
            .where(has_prefix(F.col("icd10_code"), CONDITION_PREFIXES.values()))
            .select("diagnosis_id", "encounter_id", "icd10_code",
                    F.explode(F.transform(hits, lambda entry: entry["condition"])).alias("condition")))


def condition_counts(tables: ClinicalTables) -> DataFrame:
    """Distinct patients and diagnosis rows of each condition.

    Rows are counted per encounter before the join and per patient after it,
    one column per condition, so each side is shuffled once and a patient
    appears once in the last step: a distinct count without a distinct.
    """
    code = F.col("icd10_code")
    per_encounter = (
        tables.diagnoses.where(has_prefix(code, CONDITION_PREFIXES.values()))
        .groupBy("encounter_id")
        .agg(*(F.count_if(code.startswith(p)).alias(c) for c, p in CONDITION_PREFIXES.items())))
    per_patient = (
        per_encounter.join(tables.encounters.select("encounter_id", "patient_id"), "encounter_id")
        .groupBy("patient_id").agg(*(F.sum(c).alias(c) for c in CONDITION_PREFIXES)))
    totals = per_patient.agg(*(
        F.struct(F.count_if(F.col(c) > 0).alias("patients"), F.sum(c).alias("diagnosis_rows")).alias(c)
        for c in CONDITION_PREFIXES))
    return totals.unpivot([], list(CONDITION_PREFIXES), "condition", "n").select(
        "condition", "n.patients", "n.diagnosis_rows")


def by_mrn(rows: DataFrame, tables: ClinicalTables) -> DataFrame:
    """Patient rows keyed by medical record number instead of patient id."""
    return tables.patients.select("patient_id", "mrn").join(rows, "patient_id").drop("patient_id")
