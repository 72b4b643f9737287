"""The driver's test tables seen as clinical tables.

Each mapping is a list of SQL expressions that mean the same in Spark and in
the SQL engine used for checking, so both sides start from equal rows. The
rules (who has no risk row, who has no social assessment) are those of
FIXTURES.md; they describe the test data and are not part of any query.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlight.schema import QUESTIONS
from wardlight.sources.clinical import ClinicalTables
from wardlight.sources.questions import QUESTION_ROWS

AS_OF = dt.date(2001, 8, 1)



def _numbered(prefix: str, width: int) -> str:
    """An id text of at least ``width`` digits; longer numbers keep all of theirs."""
    text = "cast({0} + 1 AS string)"
    return f"'{prefix}-' || lpad({text}, greatest({width}, cast(length({text}) AS int)), '0')"


_PATIENT, _ENCOUNTER = _numbered("patient", 6), _numbered("encounter", 8)
_COORDINATOR = _numbered("coord", 6)

# name -> (source relation, filter or None, [(expression, column), ...])
MAPPING: dict[str, tuple[str, str | None, list[tuple[str, str]]]] = {
    "patients": (
        "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
        None,
        [
            (_PATIENT.format("c_custkey"), "patient_id"),
            ("'MRN' || cast(100000 + c_custkey * 7919 AS string)", "mrn"),
            ("'First' || cast(c_custkey % 97 AS string)", "first_name"),
            ("'Last' || cast(c_custkey % 211 AS string)", "last_name"),
            ("cast(18 + c_custkey % 78 AS int)", "age"),
            ("CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END", "gender"),
            ("lpad(cast((c_custkey * 31) % 100000 AS string), 5, '0')", "zip_code"),
            ("n_name", "city"),
            ("r_name", "state"),
            ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'White'"
             " WHEN 'BUILDING' THEN 'Black or African American'"
             " WHEN 'FURNITURE' THEN 'Hispanic or Latino'"
             " WHEN 'HOUSEHOLD' THEN 'Asian' ELSE 'Other' END", "race_ethnicity"),
        ],
    ),
    "encounters": (
        "orders",
        None,
        [
            (_ENCOUNTER.format("o_orderkey"), "encounter_id"),
            (_PATIENT.format("o_custkey"), "patient_id"),
            ("cast(o_orderdate AS date)", "admission_date"),
            ("cast(o_orderdate AS date) + cast(1 + o_orderkey % 14 AS int)", "discharge_date"),
            ("CASE o_orderstatus WHEN 'F' THEN 'Inpatient' WHEN 'O' THEN 'Emergency'"
             " ELSE 'Observation' END", "encounter_type"),
            ("'Facility ' || substr(o_orderpriority, 1, 1)", "facility"),
            ("cast(1 + o_orderkey % 14 AS int)", "length_of_stay"),
            ("CASE o_orderkey % 5 WHEN 0 THEN 'Home' WHEN 1 THEN 'Home Health' WHEN 2 THEN 'SNF'"
             " WHEN 3 THEN 'Rehab' ELSE 'AMA' END", "discharge_disposition"),
        ],
    ),
    "diagnoses": (
        "lineitem",
        None,
        [
            ("'diagnosis-' || md5(cast(l_orderkey AS string) || '|' || cast(l_partkey AS string)"
             " || '|' || cast(l_suppkey AS string) || '|' || cast(l_linenumber AS string)"
             " || '|' || cast(cast(l_shipdate AS date) AS string)"
             " || '|' || cast(cast(round(l_extendedprice * 100) AS bigint) AS string))",
             "diagnosis_id"),
            (_ENCOUNTER.format("l_orderkey"), "encounter_id"),
            ("CASE l_partkey % 50 WHEN 0 THEN 'I50.9' WHEN 1 THEN 'I50.23' WHEN 2 THEN 'J44.1'"
             " WHEN 3 THEN 'J44.0' WHEN 4 THEN 'E11.9' WHEN 5 THEN 'I10' WHEN 6 THEN 'I48.91'"
             " WHEN 7 THEN 'N18.3' WHEN 8 THEN 'J18.9' WHEN 9 THEN 'A41.9' ELSE 'Z00.0' END",
             "icd10_code"),
            ("CASE l_partkey % 50 WHEN 0 THEN 'Congestive Heart Failure, unspecified'"
             " WHEN 1 THEN 'Acute on chronic systolic heart failure'"
             " WHEN 2 THEN 'Chronic obstructive pulmonary disease with acute exacerbation'"
             " WHEN 3 THEN 'COPD with acute lower respiratory infection'"
             " WHEN 4 THEN 'Type 2 diabetes mellitus without complications'"
             " WHEN 5 THEN 'Essential (primary) hypertension'"
             " WHEN 6 THEN 'Atrial fibrillation, unspecified'"
             " WHEN 7 THEN 'Chronic kidney disease, stage 3'"
             " WHEN 8 THEN 'Pneumonia, unspecified organism'"
             " WHEN 9 THEN 'Sepsis, unspecified organism' ELSE 'General examination' END",
             "description"),
            ("l_linenumber = 1", "is_primary"),
            ("cast(l_shipdate AS date)", "diagnosis_date"),
        ],
    ),
    "risk_scores": (
        "customer",
        "c_custkey % 20 <> 19",
        [
            (_PATIENT.format("c_custkey"), "patient_id"),
            ("round((c_acctbal + 1000) / 11000, 3)", "risk_score"),
            ("CASE WHEN round((c_acctbal + 1000) / 11000, 3) < 0.3e0 THEN 'Low'"
             " WHEN round((c_acctbal + 1000) / 11000, 3) < 0.7e0 THEN 'Moderate'"
             " ELSE 'High' END", "risk_category"),
            ("CASE WHEN round((c_acctbal + 1000) / 11000, 3) > 0.7e0"
             " THEN '[\"Age > 65\", \"Polypharmacy\"]' ELSE '[]' END", "risk_factors"),
            ("date '2001-08-01' - cast(c_custkey % 30 AS int)", "last_calculated"),
            ("'v2.3.1'", "model_version"),
        ],
    ),
    "sdoh": (
        "customer",
        "c_custkey % 5 <> 4",
        [
            (_PATIENT.format("c_custkey"), "patient_id"),
            ("c_custkey % 7 = 2", "housing_instability"),
            ("c_custkey % 6 = 1", "transportation_barrier"),
            ("c_custkey % 8 = 3", "food_insecurity"),
            ("c_custkey % 9 = 4", "social_isolation"),
            ("c_custkey % 11 = 5", "financial_strain"),
            ("c_custkey % 13 = 6", "utility_assistance_needed"),
            ("date '2001-08-01' - cast(c_custkey % 90 AS int)", "last_assessed"),
        ],
    ),
    "care_coordinators": (
        "supplier",
        None,
        [
            (_COORDINATOR.format("s_suppkey"), "coordinator_id"),
            ("s_name", "name"),
            ("CASE WHEN s_suppkey % 3 = 0 THEN 'Senior Care Coordinator'"
             " ELSE 'Care Coordinator' END", "title"),
            ("cast(15 + s_suppkey % 16 AS int)", "current_caseload"),
            ("cast(30 AS int)", "max_caseload"),
            ("cast(15 - s_suppkey % 16 AS int)", "available_capacity"),
            ("CASE s_suppkey % 8 WHEN 0 THEN '[\"CHF\", \"COPD\", \"Cardiology\"]'"
             " WHEN 1 THEN '[\"COPD\", \"Pulmonary\", \"Geriatrics\"]'"
             " WHEN 2 THEN '[\"Diabetes\", \"Endocrinology\"]'"
             " WHEN 3 THEN '[\"Oncology\", \"Palliative Care\"]' WHEN 4 THEN '[\"Geriatrics\"]'"
             " WHEN 5 THEN '[\"Nephrology\"]' WHEN 6 THEN '[\"Behavioral Health\"]'"
             " ELSE '[\"Pain Management\"]' END", "specialties"),
            ("cast(5 + s_suppkey % 14 AS int)", "years_experience"),
            ("s_acctbal >= 0", "active"),
        ],
    ),
    "adt_feed": (
        "events",
        None,
        [
            ("event_id", "event_id"),
            ("ts", "ts"),
            (_PATIENT.format("user_id"), "patient_id"),
            ("CASE event_type WHEN 'signup' THEN 'admit' WHEN 'purchase' THEN 'discharge'"
             " WHEN 'view' THEN 'transfer' WHEN 'click' THEN 'update' ELSE 'cancel' END",
             "adt_type"),
            ("value", "value"),
        ],
    ),
    "answers": (
        "conversations",
        "role = 'assistant'",
        [
            ("'chat-' || cast(conv_id AS string) || '-' || cast(turn AS string)", "answer_id"),
            ("'q_' || lpad(cast(conv_id % 20 + 1 AS string), 2, '0')", "request_id"),
            ("'basic'", "variant"),
            ("text", "response"),
        ],
    ),
    "user_turns": (
        "conversations",
        "role = 'user'",
        [("conv_id", "conv_id"), ("turn", "turn"), ("text", "request")],
    ),
}

SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
                " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
                " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
                " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
              " value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def mapped_columns(name: str) -> list[str]:
    return [f"{expression} AS {column}" for expression, column in MAPPING[name][2]]


def load_fixture(spark: SparkSession, sf_dir: str) -> ClinicalTables:
    """Clinical tables over one of the driver's test directories."""

    def source(name: str) -> DataFrame:
        if name == "patients":
            return (read_source(spark, sf_dir, "customer")
                    .join(read_source(spark, sf_dir, "nation"),
                          F.col("c_nationkey") == F.col("n_nationkey"))
                    .join(read_source(spark, sf_dir, "region"),
                          F.col("n_regionkey") == F.col("r_regionkey")))
        relation, keep, _ = MAPPING[name]
        frame = read_source(spark, sf_dir, relation)
        return frame.where(keep) if keep else frame

    def loader(name: str):
        return lambda: source(name).selectExpr(*mapped_columns(name))

    loaders = {name: loader(name) for name in MAPPING}
    loaders["questions"] = lambda: questions(spark)
    return ClinicalTables(spark, loaders, AS_OF)


def questions(spark: SparkSession) -> DataFrame:
    """The question set, a dimension of fixed size."""
    return spark.createDataFrame(QUESTION_ROWS, QUESTIONS)
