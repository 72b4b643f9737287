"""Plan shapes: what reaches the scan, and what must never appear."""

import datetime as dt
import re

import pytest

from wardlight.operators import lookups, readmit
from wardlight.plans.catalog import BATCH
from wardlight.plans.flagship import flagship_outreach
from wardlight.sources.clinical import catalog_clinical, read_clinical
from wardlight.sources.fixtures import AS_OF
from wardlight.sources.sinks import overwrite_table, write_clinical


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    """The clinical tables as their own files, with timestamps as declared."""
    root = str(tmp_path_factory.mktemp("clinical"))
    dated = {}
    for name in ("encounters", "diagnoses", "risk_scores", "sdoh"):
        frame = small.table(name)
        dated[name] = frame.withColumns({c: frame[c].cast("timestamp")
                                         for c, t in frame.dtypes if t == "date"})
    write_clinical(small.replace(**dated), root)
    return read_clinical(spark, root, AS_OF)


@pytest.mark.parametrize("key", sorted(BATCH))
def test_no_cross_join_or_python_in_any_plan(small, key):
    text = plan(BATCH[key](small))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|InPandas|InArrow", text)


@pytest.mark.parametrize("key, most", [
    ("flagship_outreach", 4), ("cohort_mark_first_n", 1), ("judge_compare", 4), ("readmission_pairs", 2),
    ("facility_readmission_rate", 3), ("quality_rollup", 3), ("encounter_sequence", 2)])
def test_encounters_are_read_few_times(small, key, most):
    """Scans of the stays in the first plan, before any exchange is found to be the same."""
    assert len(re.findall(r"FileScan parquet \[[^\]]*\bo_", plan(BATCH[key](small)))) <= most


def test_date_filter_and_columns_reach_the_scan(stored):
    text = plan(lookups.recent_discharges(stored, 7))
    assert "GreaterThanOrEqual(discharge_date" in text
    people = next(line for line in text.splitlines() if "FileScan" in line and "mrn" in line)
    assert "ReadSchema: struct<patient_id:string,mrn:string,first_name:string,last_name:string>" in people


def test_code_prefix_reaches_the_scan(stored):
    assert "StringStartsWith(icd10_code,I50)" in plan(lookups.diagnoses_by_condition(stored, "CHF"))
    both = plan(lookups.patient_conditions(stored, ["CHF", "COPD"]))
    assert "Or(StringStartsWith(icd10_code,I50),StringStartsWith(icd10_code,J44))" in both
    assert "ReadSchema: struct<encounter_id:string,icd10_code:string>" in both


def test_stored_tables_give_the_same_answers(small, stored):
    for make in (flagship_outreach, readmit.readmission_history):
        ours = make(stored)
        ours = ours.withColumns({c: ours[c].cast("date") for c, t in ours.dtypes if t == "timestamp"})
        assert sorted(map(repr, ours.collect())) == sorted(map(repr, make(small).collect()))


def test_bucketed_tables_join_without_a_shuffle(spark, small):
    spark.sql("CREATE DATABASE IF NOT EXISTS ward")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        overwrite_table(small.encounters, "ward.encounters", "encounter_id", 4)
        overwrite_table(small.diagnoses, "ward.diagnoses", "encounter_id", 4)
        tables = catalog_clinical(spark, "ward", dt.date(2001, 8, 1))
        joined = tables.diagnoses.join(tables.encounters, "encounter_id")
        assert "Exchange" not in plan(joined)
        assert joined.count() == small.diagnoses.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_formats_round_trip(spark, clinic, person, stay, tmp_path, fmt):
    tables = clinic(patients=[person("p")], encounters=[stay(1, "p", -3, 1)])
    write_clinical(tables, str(tmp_path), fmt)
    again = read_clinical(spark, str(tmp_path), tables.as_of, fmt)
    assert again.patients.collect() == tables.patients.collect()
    assert again.encounters.collect() == tables.encounters.collect()
