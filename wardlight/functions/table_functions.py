"""The look-ups as SQL table functions of the session.

They read temporary views of the clinical tables, so plain SQL users can call
``SELECT * FROM get_recent_discharges(7)`` or, per row of another relation,
``LATERAL get_risk_score(p.patient_id)``, which Spark turns into a join.
Parameters never share a name with a column: a column would win silently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardlight.operators.lookups import risk_score_lookup, sdoh_barriers
from wardlight.operators.priority import priority_scores
from wardlight.operators.readmit import readmission_history
from wardlight.operators.report import outreach_report_rows, section_text
from wardlight.schema import CLINICAL_TABLES, CONDITION_PREFIXES
from wardlight.sources.clinical import ClinicalTables

# function name -> (parameters, returned columns, body); {today} is the reference day.
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "get_recent_discharges": (
        "within_days INT",
        "encounter_id STRING, patient_id STRING, mrn STRING, patient_name STRING,"
        " discharge_date TIMESTAMP, facility STRING, encounter_type STRING,"
        " length_of_stay INT, discharge_disposition STRING",
        """SELECT encounter_id, patient_id, mrn, first_name || ' ' || last_name, discharge_date,
                  facility, encounter_type, length_of_stay, discharge_disposition
           FROM encounters INNER JOIN patients USING (patient_id)
           WHERE discharge_date >= date_sub({today}, within_days)""",
    ),
    "get_diagnoses_by_condition": (
        "wanted_condition STRING",
        "encounter_id STRING, patient_id STRING, mrn STRING, patient_name STRING,"
        " icd10_code STRING, description STRING, is_primary BOOLEAN, diagnosis_date TIMESTAMP",
        """SELECT DISTINCT encounter_id, patient_id, mrn, first_name || ' ' || last_name,
                  icd10_code, description, is_primary, diagnosis_date
           FROM diagnoses INNER JOIN encounters USING (encounter_id)
                INNER JOIN patients USING (patient_id)
           WHERE startswith(icd10_code, {prefix_of_wanted})""",
    ),
    "get_patient_readmission_history": (
        "wanted_patient STRING",
        "readmission_id STRING, patient_id STRING, original_discharge_date TIMESTAMP,"
        " readmit_admission_date TIMESTAMP, days_between INT, is_30_day BOOLEAN",
        """SELECT readmission_id, patient_id, original_discharge_date, readmit_admission_date,
                  days_between, is_30_day
           FROM readmissions WHERE patient_id = wanted_patient""",
    ),
    "get_risk_score": (
        "wanted_patient STRING",
        "patient_id STRING, risk_score DOUBLE, risk_category STRING, risk_factors STRING,"
        " last_calculated TIMESTAMP",
        """SELECT patient_id, risk_score, risk_category, risk_factors, last_calculated
           FROM latest_risk WHERE patient_id = wanted_patient""",
    ),
    "get_sdoh_barriers": (
        "wanted_patient STRING",
        "patient_id STRING, housing_instability BOOLEAN, transportation_barrier BOOLEAN,"
        " food_insecurity BOOLEAN, social_isolation BOOLEAN, financial_strain BOOLEAN,"
        " last_assessed TIMESTAMP",
        """SELECT patient_id, housing_instability, transportation_barrier, food_insecurity,
                  social_isolation, financial_strain, last_assessed
           FROM latest_sdoh WHERE patient_id = wanted_patient""",
    ),
    "get_available_care_coordinators": (
        "wanted_specialty STRING",
        "coordinator_id STRING, name STRING, title STRING, current_caseload INT,"
        " max_caseload INT, available_capacity INT, specialties STRING, years_experience INT",
        """SELECT coordinator_id, name, title, current_caseload, max_caseload,
                  available_capacity, specialties, years_experience
           FROM care_coordinators
           WHERE active AND available_capacity > 0
             AND coalesce(contains(specialties, wanted_specialty), true)""",
    ),
    "suggest_coordinator_for_patient": (
        "for_patient STRING, wanted_specialty STRING",
        "patient_id STRING, coordinator_id STRING, coordinator_name STRING,"
        " available_capacity INT, match_quality STRING",
        """SELECT for_patient, best.coordinator_id, best.name, best.available_capacity,
                  CASE WHEN best.fits THEN 'Perfect Match'
                       WHEN contains(best.specialties, 'Geriatrics') THEN 'General Match'
                       ELSE 'Available' END
           FROM (SELECT min_by(named_struct('coordinator_id', coordinator_id, 'name', name,
                                            'available_capacity', available_capacity,
                                            'specialties', specialties, 'fits', fits),
                               struct(NOT fits, -available_capacity, coordinator_id)) AS best
                 FROM (SELECT *, coalesce(contains(specialties, wanted_specialty), false) AS fits
                       FROM care_coordinators WHERE active AND available_capacity > 0))
           WHERE best IS NOT NULL""",
    ),
    "calculate_priority_score": (
        "wanted_patient STRING",
        "patient_id STRING, priority_score DOUBLE, risk_factors ARRAY<STRING>, recommendations STRING",
        """SELECT patient_id, priority_score, risk_factors, recommendations
           FROM priority WHERE patient_id = wanted_patient""",
    ),
    "generate_outreach_report": (
        "wanted_patient STRING",
        "patient_id STRING, tier STRING, risk_score DOUBLE, section STRING",
        """SELECT patient_id, tier, risk_score, section
           FROM outreach_report WHERE patient_id = wanted_patient""",
    ),
}
# Only where an assignment is given: it is worked out for all patients together.
ASSIGNMENT = (
    "assign_care_coordinator",
    "wanted_patient STRING",
    "patient_id STRING, specialty STRING, coordinator_id STRING, coordinator_name STRING,"
    " match_quality STRING",
    """SELECT patient_id, specialty, coordinator_id, coordinator_name, match_quality
       FROM assignments WHERE patient_id = wanted_patient""",
)


def register_table_functions(tables: ClinicalTables, assignments: DataFrame | None = None
                             ) -> list[str]:
    """Create the views and functions in the tables' session; returns the names.

    ``priority`` and ``outreach_report`` are views over everyone: a query that
    asks for many patients joins them instead of calling a function per patient.
    ``assignments`` is a result of ``assign_coordinators``; capacity is shared by
    all patients, so no function can assign one patient alone.
    """
    spark = tables.spark
    for name in CLINICAL_TABLES:
        tables.table(name).createOrReplaceTempView(name)
    readmission_history(tables).createOrReplaceTempView("readmissions")
    priority_scores(tables).createOrReplaceTempView("priority")
    outreach_report_rows(tables).select(
        "patient_id", "tier", "risk_score", section_text().alias("section")
    ).createOrReplaceTempView("outreach_report")
    risk_score_lookup(tables).createOrReplaceTempView("latest_risk")
    sdoh_barriers(tables).createOrReplaceTempView("latest_sdoh")
    functions = dict(FUNCTIONS)
    if assignments is not None:
        assignments.createOrReplaceTempView("assignments")
        name, *definition = ASSIGNMENT
        functions[name] = tuple(definition)
    arms = " ".join(f"WHEN '{c.upper()}' THEN '{p}'" for c, p in CONDITION_PREFIXES.items())
    fillers = {
        "today": f"DATE '{tables.as_of.isoformat()}'",
        "prefix_of_wanted": f"CASE upper(wanted_condition) {arms} END",
    }
    for name, (parameters, columns, body) in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters})"
                  f" RETURNS TABLE({columns}) RETURN {body.format(**fillers)}")
    return list(functions)
