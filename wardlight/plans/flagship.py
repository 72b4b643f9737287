"""The Monday question: who needs outreach this week, and from whom."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardlight.functions.columns import tier_label
from wardlight.operators.assign import assign_coordinators
from wardlight.operators.cohorts import recently_discharged
from wardlight.operators.lookups import only_patients
from wardlight.operators.priority import patient_factors, with_priority
from wardlight.schema import BARRIERS, HIGH_RISK
from wardlight.session import settled
from wardlight.sources.clinical import ClinicalTables


def high_risk_recent(tables: ClinicalTables, days_back: int) -> DataFrame:
    """Recently discharged patients with a score above the threshold.

    Risk scores are one row per patient, so this cut is the cheapest and runs
    before any history is read.
    """
    risky = tables.risk_scores.where(F.col("risk_score") > HIGH_RISK)
    return only_patients(recently_discharged(tables, days_back), risky)


def flagship_outreach(tables: ClinicalTables, days_back: int = 7) -> DataFrame:
    """High-risk recent discharges with CHF or COPD and a 30-day readmission.

    The recent cohort comes first. It is settled, so its size is known and
    every other table is cut to it by a semi-join that reads no history again.
    """
    cohort = settled(high_risk_recent(tables, days_back), "cohort")
    factors = patient_factors(tables, cohort).where(
        (F.col("risk_score") > HIGH_RISK) & F.col("has_chf_copd") & F.col("has_readmission"))
    return with_priority(factors).join(cohort, "patient_id").select(
        "patient_id", "last_discharge", "risk_score", "priority_score",
        tier_label(F.col("priority_score")).alias("tier"), *BARRIERS)


def outreach_assignments(tables: ClinicalTables, days_back: int = 7) -> DataFrame:
    """The flagship list with a coordinator for each patient while places last."""
    patients = flagship_outreach(tables, days_back).select("patient_id", "priority_score")
    return assign_coordinators(tables, settled(patients, "outreach"))


def monday_worklist(tables: ClinicalTables, days_back: int = 7) -> DataFrame:
    """Ranked work list: flags, tier and coordinator in one table."""
    patients = settled(flagship_outreach(tables, days_back), "outreach")
    assigned = assign_coordinators(tables, patients).drop("priority_score")
    return patients.join(assigned, "patient_id").orderBy(F.desc("priority_score"), "patient_id")
