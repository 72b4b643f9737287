"""The composite priority score, its tiers, and patient barrier profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardlight.functions.columns import contact_hours, risk_category
from wardlight.operators.lookups import (
    latest_sdoh, only_patients, patient_conditions, risk_score_lookup)
from wardlight.operators.readmit import readmitted_patients
from wardlight.schema import BARRIERS, HIGH_RISK, TIER_1, TIER_2
from wardlight.sources.clinical import ClinicalTables

# Share of the risk score, then factor -> (added points, text), in this order.
RISK_WEIGHT = 0.6
FACTORS = {
    "has_readmission": (0.2, "Prior 30-day readmission"),
    "has_transport": (0.1, "Transportation barrier"),
    "has_housing": (0.15, "Housing instability"),
    "has_chf_copd": (0.1, "CHF/COPD diagnosis"),
}
# Texts of the score record.
NO_SCORE_FACTOR = "No risk score available"
NO_SCORE_ADVICE = "Complete risk assessment"
ADVICE_TIER_1 = "URGENT: Contact within 24 hours. Coordinate with social services."
ADVICE_TIER_2 = "HIGH PRIORITY: Contact within 48 hours. Address barriers."
ADVICE_TIER_3 = "MODERATE: Contact within 72 hours. Standard follow-up."


def patient_factors(tables: ClinicalTables, patients: DataFrame | None = None) -> DataFrame:
    """One row per patient: risk score and category (or null), the four factor flags, all barriers.

    Every joined side is already one row per patient and hash-partitioned on
    it, so the joins add no exchange of their own.
    """
    base = only_patients(tables.patients.select("patient_id"), patients)
    risk = risk_score_lookup(tables, patients).select("patient_id", "risk_score", "risk_category")
    readmitted = readmitted_patients(tables, patients).withColumn("has_readmission", F.lit(True))
    conditions = (patient_conditions(tables, ["CHF", "COPD"], patients)
                  .select("patient_id", (F.col("chf") | F.col("copd")).alias("has_chf_copd")))
    joined = base
    for side in (risk, readmitted, latest_sdoh(tables, patients), conditions):
        joined = joined.join(side, "patient_id", "left")
    joined = joined.drop("last_assessed")
    flags = {"has_readmission": "has_readmission", "has_transport": "transportation_barrier",
             "has_housing": "housing_instability", "has_chf_copd": "has_chf_copd"}
    return joined.select(
        "patient_id", "risk_score", "risk_category",
        *(F.coalesce(column, F.lit(False)).alias(flag) for flag, column in flags.items()),
        *(F.coalesce(barrier, F.lit(False)).alias(barrier) for barrier in BARRIERS))


def with_priority(factors: DataFrame) -> DataFrame:
    """Score, factor texts and advice from the columns of ``patient_factors``."""
    total = F.col("risk_score") * RISK_WEIGHT
    for flag, (points, _) in FACTORS.items():
        total = total + F.when(F.col(flag), points).otherwise(0.0)
    capped = F.least(total, F.lit(1.0))
    unscored = F.col("risk_score").isNull()
    texts = F.array_compact(F.array(*(F.when(F.col(flag), text)
                                      for flag, (_, text) in FACTORS.items())))
    advice = (F.when(F.col("capped") > TIER_1, ADVICE_TIER_1)
              .when(F.col("capped") > TIER_2, ADVICE_TIER_2)
              .otherwise(ADVICE_TIER_3))
    return (factors.withColumn("capped", capped)
            .withColumns({
                "priority_score": F.when(unscored, 0.0).otherwise(F.round("capped", 3)),
                "risk_factors": F.when(unscored, F.array(F.lit(NO_SCORE_FACTOR))).otherwise(texts),
                "recommendations": F.when(unscored, NO_SCORE_ADVICE).otherwise(advice),
            })
            .drop("capped"))


def priority_scores(tables: ClinicalTables, patients: DataFrame | None = None) -> DataFrame:
    """patient_id, priority_score, risk_factors, recommendations for every patient."""
    return with_priority(patient_factors(tables, patients)).select(
        "patient_id", "priority_score", "risk_factors", "recommendations")


def high_risk_patients(tables: ClinicalTables, above: float = HIGH_RISK) -> DataFrame:
    """Patients whose latest score is strictly above the threshold."""
    return (risk_score_lookup(tables).where(F.col("risk_score") > above)
            .select("patient_id", "risk_score", "risk_category"))


def recomputed_category(tables: ClinicalTables) -> DataFrame:
    return tables.risk_scores.select(
        "patient_id", "risk_score", risk_category(F.col("risk_score")).alias("risk_category"))


def priority_tiers(tables: ClinicalTables) -> DataFrame:
    """Patients per outreach deadline; patients without a score are counted apart."""
    hours = F.when(F.col("risk_score").isNull(), None).otherwise(contact_hours(F.col("priority_score")))
    return (with_priority(patient_factors(tables))
            .groupBy(hours.cast("int").alias("contact_within_hours"))
            .agg(F.count(F.lit(1)).alias("patients")))


def priority_top(tables: ClinicalTables, top: int = 18) -> DataFrame:
    return (priority_scores(tables)
            .orderBy(F.desc("priority_score"), "patient_id").limit(top))


def barrier_profile(tables: ClinicalTables) -> DataFrame:
    """Number and list of active barriers per assessed patient."""
    count: Column = F.lit(0)
    for flag in BARRIERS:
        count = count + F.col(flag).cast("int")
    active = F.array_compact(F.array(*(F.when(F.col(flag), flag) for flag in BARRIERS)))
    return latest_sdoh(tables).select(
        "patient_id", count.alias("barrier_count"), active.alias("barriers"))


def barrier_counts(tables: ClinicalTables, patients: DataFrame) -> DataFrame:
    """Patients per barrier among the given ones, long form."""
    totals = (latest_sdoh(tables, patients)
              .agg(*(F.count_if(F.col(flag)).alias(flag) for flag in BARRIERS)))
    return totals.unpivot([], list(BARRIERS), "barrier", "patients")
