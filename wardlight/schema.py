"""Table schemas and the clinical constants."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D, _B, _TS = (T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType(),
                       T.TimestampType())


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


PATIENTS = _struct(
    patient_id=_S, mrn=_S, first_name=_S, last_name=_S, age=_I, gender=_S, zip_code=_S,
    city=_S, state=_S, race_ethnicity=_S, created_at=_TS)

ENCOUNTERS = _struct(
    encounter_id=_S, patient_id=_S, admission_date=_TS, discharge_date=_TS,
    encounter_type=_S, facility=_S, length_of_stay=_I, discharge_disposition=_S)

DIAGNOSES = _struct(
    diagnosis_id=_S, encounter_id=_S, icd10_code=_S, description=_S, is_primary=_B,
    diagnosis_date=_TS)

RISK_SCORES = _struct(
    patient_id=_S, risk_score=_D, risk_category=_S, risk_factors=_S, last_calculated=_TS,
    model_version=_S)

SDOH = _struct(
    patient_id=_S, housing_instability=_B, transportation_barrier=_B, food_insecurity=_B,
    social_isolation=_B, financial_strain=_B, utility_assistance_needed=_B,
    last_assessed=_TS)

CARE_COORDINATORS = _struct(
    coordinator_id=_S, name=_S, title=_S, current_caseload=_I, max_caseload=_I,
    available_capacity=_I, specialties=_S, years_experience=_I, active=_B)

ADT_FEED = _struct(event_id=T.LongType(), ts=_TS, patient_id=_S, adt_type=_S, value=_D)

QUESTIONS = _struct(
    request_id=_S, complexity=_S, request=_S, expected_facts=_S, expected_tools=_S)

CLINICAL_TABLES = {
    "patients": PATIENTS,
    "encounters": ENCOUNTERS,
    "diagnoses": DIAGNOSES,
    "risk_scores": RISK_SCORES,
    "sdoh": SDOH,
    "care_coordinators": CARE_COORDINATORS,
}

# Condition name to ICD-10 prefix.
CONDITION_PREFIXES = {
    "CHF": "I50",
    "COPD": "J44",
    "Diabetes": "E11",
    "Hypertension": "I10",
    "Sepsis": "A41",
}

# The social barrier flags, in table order.
BARRIERS = (
    "housing_instability",
    "transportation_barrier",
    "food_insecurity",
    "social_isolation",
    "financial_strain",
    "utility_assistance_needed",
)

# Thresholds of the clinical rules.
HIGH_RISK = 0.7
TIER_1 = 0.8
TIER_2 = 0.6
LOW_RISK_BELOW = 0.3
READMISSION_WINDOW_DAYS = 30
READMISSION_LOOKAHEAD_DAYS = 365
