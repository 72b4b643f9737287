"""The twenty evaluation questions and the further documented ones, as plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardlight.functions.columns import contact_hours
from wardlight.operators import assign, cohorts, lookups, priority, readmit, report
from wardlight.plans import flagship
from wardlight.schema import BARRIERS
from wardlight.session import settled
from wardlight.sources.clinical import ClinicalTables


def _patients(frame: DataFrame) -> DataFrame:
    """Number of distinct patients; the distinct step spreads over the ids."""
    return frame.select("patient_id").distinct().agg(F.count(F.lit(1)).alias("patients"))


def q_01(t: ClinicalTables) -> DataFrame:
    """How many patients were discharged in the last 7 days?"""
    return cohorts.recently_discharged(t, 7).agg(F.count(F.lit(1)).alias("patients"))


def q_02(t: ClinicalTables) -> DataFrame:
    """List all care coordinators with available capacity."""
    return lookups.available_coordinators(t)


def q_03(t: ClinicalTables) -> DataFrame:
    """How many CHF patients are in the system?"""
    return _patients(cohorts.with_condition(t, "CHF"))


def q_04(t: ClinicalTables) -> DataFrame:
    """Show all COPD patients."""
    return lookups.only_patients(t.patients, cohorts.with_condition(t, "COPD")).select(
        "patient_id", "mrn", lookups.patient_name().alias("patient_name"), "age", "gender")


def q_05(t: ClinicalTables) -> DataFrame:
    """What is the risk score for patient-000001?"""
    return lookups.risk_score_lookup(t, lookups.patient_ids(t, ["patient-000001"]))


def q_06(t: ClinicalTables) -> DataFrame:
    """Show recent discharges from the last 3 days."""
    return lookups.recent_discharges(t, 3, bounded=True)


def q_07(t: ClinicalTables) -> DataFrame:
    """Which CHF patients were discharged in the last 7 days?"""
    recent = cohorts.recently_discharged(t, 7)
    chf = cohorts.with_condition(t, "CHF", patients=recent)
    return lookups.only_patients(lookups.recent_discharges(t, 7, bounded=True), chf)


def q_08(t: ClinicalTables) -> DataFrame:
    """How many COPD patients have transportation barriers?"""
    hindered = priority.latest_sdoh(t).where("transportation_barrier")
    return _patients(cohorts.with_condition(t, "COPD", patients=hindered))


def q_09(t: ClinicalTables) -> DataFrame:
    """Which care coordinators specialize in CHF and have availability?"""
    return lookups.available_coordinators(t, "CHF")


def q_10(t: ClinicalTables) -> DataFrame:
    """Show patients with risk scores above 0.7."""
    return priority.high_risk_patients(t)


def q_11(t: ClinicalTables) -> DataFrame:
    """How many patients have both CHF and prior readmissions?"""
    chf = cohorts.with_condition(t, "CHF")
    return _patients(lookups.only_patients(
        readmit.readmitted_patients(t, within_30_days=False), chf))


def q_12(t: ClinicalTables) -> DataFrame:
    """What are the social barriers for high-risk CHF patients?"""
    return priority.barrier_counts(t, cohorts.with_condition(t, "CHF", patients=priority.high_risk_patients(t)))


def q_13(t: ClinicalTables) -> DataFrame:
    """Which patients discharged last week have housing instability?"""
    unstable = priority.latest_sdoh(t).where("housing_instability")
    return lookups.only_patients(lookups.recent_discharges(t, 7, bounded=True), unstable)


def q_14(t: ClinicalTables) -> DataFrame:
    """How many patients with 30-day readmissions are in the recent discharge cohort?"""
    return _patients(readmit.readmitted_patients(t, cohorts.recently_discharged(t, 7)))


def q_15(t: ClinicalTables) -> DataFrame:
    """High-risk recent discharges with CHF or COPD and readmissions, with coordinators."""
    return flagship.monday_worklist(t)


def q_16(t: ClinicalTables) -> DataFrame:
    """Whom to prioritise this week by risk and coordinator capacity: everyone, in order."""
    scores = priority.priority_scores(t).select("patient_id", "priority_score")
    return assign.assign_coordinators(t, settled(scores, "scores"))


def q_17(t: ClinicalTables) -> DataFrame:
    """Monday morning readmission prevention report, as document parts."""
    patients = settled(flagship.flagship_outreach(t).select("patient_id", "priority_score"),
                       "outreach")
    return report.report_document(t, patients,
                                  assignments=assign.assign_coordinators(t, patients))


def q_18(t: ClinicalTables) -> DataFrame:
    """CHF patients with readmission, social barrier and high score, with coordinators."""
    any_barrier = F.lit(False)
    for flag in BARRIERS:
        any_barrier = any_barrier | F.col(flag)
    risky = priority.high_risk_patients(t).select("patient_id")
    social = priority.latest_sdoh(t, risky).where(any_barrier)
    chf = settled(cohorts.with_condition(t, "CHF", patients=social), "chf")
    group = lookups.only_patients(chf, readmit.readmitted_patients(t, chf))
    scores = settled(priority.priority_scores(t, settled(group, "group")).select(
        "patient_id", "priority_score"), "scores")
    return assign.assign_coordinators(t, scores, ["CHF"])


def q_19(t: ClinicalTables) -> DataFrame:
    """Interventions for COPD patients with both clinical and social risk."""
    social = priority.latest_sdoh(t).where(
        F.col("transportation_barrier") | F.col("housing_instability")).select(
        "patient_id", "transportation_barrier", "housing_instability")
    copd = cohorts.with_condition(t, "COPD", patients=social)
    readmitted = readmit.readmitted_patients(t, copd)
    steps = F.concat_ws(
        "; ", F.lit("Post-discharge follow-up"),
        F.when(F.col("transportation_barrier"), "Arrange transportation"),
        F.when(F.col("housing_instability"), "Refer to housing support"))
    scores = lookups.risk_score_lookup(t, readmitted).select("patient_id", "risk_score")
    return (lookups.only_patients(social, readmitted)
            .join(scores, "patient_id", "left")
            .select("patient_id", "risk_score", "transportation_barrier", "housing_instability",
                    steps.alias("interventions")))


def q_20(t: ClinicalTables) -> DataFrame:
    """Outreach plan for all high-risk patients by capacity, specialty and acuity."""
    scores = priority.priority_scores(t, priority.high_risk_patients(t)).select(
        "patient_id", "priority_score")
    assigned = assign.assign_coordinators(t, settled(scores, "scores"))
    return assigned.select(
        "patient_id", "priority_score", "priority_rank",
        contact_hours(F.col("priority_score")).alias("contact_within_hours"),
        "specialty", "coordinator_id", "coordinator_name", "match_quality")


def diabetes_and_readmitted(t: ClinicalTables) -> DataFrame:
    diabetic = cohorts.with_condition(t, "Diabetes")
    return _patients(cohorts.both(
        diabetic, readmit.readmitted_patients(t, within_30_days=False)))


def high_risk_barrier_counts(t: ClinicalTables) -> DataFrame:
    return priority.barrier_counts(t, priority.high_risk_patients(t))


def risk_above_08(t: ClinicalTables) -> DataFrame:
    return priority.high_risk_patients(t, 0.8)


def risk_by_mrn(t: ClinicalTables) -> DataFrame:
    return lookups.by_mrn(lookups.risk_score_lookup(t), t)


def sdoh_by_mrn(t: ClinicalTables) -> DataFrame:
    return lookups.by_mrn(lookups.sdoh_barriers(t), t)


QUESTIONS = {f"q_{n:02d}": globals()[f"q_{n:02d}"] for n in range(1, 21)}
