import pytest

from wardlight.functions.table_functions import register_table_functions
from wardlight.functions.toolbox import TOOLS
from wardlight.operators import assign, lookups, priority, readmit
from wardlight.plans.flagship import outreach_assignments


@pytest.fixture(scope="module")
def registered(spark, small):
    return register_table_functions(small, outreach_assignments(small, 90))


def same(sql_frame, frame):
    key = lambda r: repr(tuple(str(v).removesuffix(" 00:00:00") for v in r))
    assert sorted(map(key, sql_frame.collect())) == sorted(
        map(key, frame.select(*sql_frame.columns).collect()))


def test_functions_equal_operators(spark, small, registered):
    assert len(registered) == 10
    one = lookups.patient_ids(small, ["patient-000002"])
    same(spark.sql("SELECT * FROM get_recent_discharges(7)"), lookups.recent_discharges(small, 7))
    for name in ("chf", "COPD", "nothing"):
        same(spark.sql(f"SELECT * FROM get_diagnoses_by_condition('{name}')"),
             lookups.diagnoses_by_condition(small, name))
    same(spark.sql("SELECT * FROM get_patient_readmission_history('patient-000002')"),
         readmit.readmission_history(small, one))
    same(spark.sql("SELECT * FROM get_risk_score('patient-000002')"), lookups.risk_score_lookup(small, one))
    same(spark.sql("SELECT * FROM get_sdoh_barriers('patient-000002')"), lookups.sdoh_barriers(small, one))
    for arg, value in (("NULL", None), ("'CHF'", "CHF"), ("'Gout'", "Gout")):
        same(spark.sql(f"SELECT * FROM get_available_care_coordinators({arg})"),
             lookups.available_coordinators(small, value))
        same(spark.sql(f"SELECT * FROM suggest_coordinator_for_patient('p', {arg})"),
             assign.suggest_coordinator(small, "p", value))


def test_scores_reports_and_assignments_from_sql(spark, small, registered):
    one = lookups.patient_ids(small, ["patient-000002"])
    same(spark.sql("SELECT * FROM calculate_priority_score('patient-000002')"),
         priority.priority_scores(small, one))
    row = spark.sql("SELECT * FROM generate_outreach_report('patient-000002')").first()
    assert row.tier in row.section and "**Risk Score:**" in row.section
    many = spark.sql("SELECT a.patient_id, f.coordinator_id FROM assignments a,"
                     " LATERAL assign_care_coordinator(a.patient_id) f")
    same(many, spark.table("assignments"))


def test_tools_sort_what_people_read(small):
    free = TOOLS["get_available_care_coordinators"](small).collect()
    keys = [(-r.available_capacity, -r.years_experience, r.coordinator_id) for r in free]
    assert keys == sorted(keys) and len(keys) > 3
    ids = [r.patient_id for r in small.patients.collect()]
    days = [r.original_discharge_date for r in TOOLS["get_patient_readmission_history"](small, ids).collect()]
    assert days == sorted(days, reverse=True) and len(days) > 100


def test_lateral_call_per_patient(spark, small, registered):
    joined = spark.sql("SELECT p.patient_id, r.risk_score FROM patients p, LATERAL get_risk_score(p.patient_id) r")
    same(joined, small.risk_scores)


def test_toolbox_names_every_capability(small):
    assert len(TOOLS) == 10
    assert TOOLS["get_risk_score"](small, "patient-000001").count() == 1
    assert TOOLS["get_patient_readmission_history"](small, ["patient-000001"]).count() >= 1
    assert TOOLS["get_sdoh_barriers"](small, "patient-000001").count() == 1
    assert TOOLS["calculate_priority_score"](small, "patient-000001").first().priority_score > 0
    assert TOOLS["generate_outreach_report"](small, ["patient-000001"]).count() == 3
    assert TOOLS["suggest_coordinator_for_patient"](small, "patient-000001", "CHF").count() == 1
