"""One patient, and one encounter, holding a third of all rows."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wardlight.operators import lookups, priority, readmit, report
from wardlight.sources.clinical import ClinicalTables
from wardlight.sources.fixtures import AS_OF

STAYS = 6000


@pytest.fixture(scope="module")
def crowded(spark):
    n = F.col("id")
    patient = F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), (n * 7 % 400).cast("string")))
    day = F.date_sub(F.lit(AS_OF), (n * 37 % 1500).cast("int"))
    stays = spark.range(STAYS).select(
        F.format_string("e%06d", n).alias("encounter_id"), patient.alias("patient_id"),
        day.alias("admission_date"), F.date_add(day, (n % 9).cast("int")).alias("discharge_date"),
        F.when(n % 4 == 0, "Emergency").otherwise("Inpatient").alias("encounter_type"),
        F.lit("North").alias("facility"), (n % 9).cast("int").alias("length_of_stay"))
    codes = spark.range(3 * STAYS).select(
        F.format_string("d%06d", n).alias("diagnosis_id"),
        F.when(n % 3 == 0, "e000003").otherwise(F.format_string("e%06d", n % STAYS)).alias("encounter_id"),
        F.when(n % 5 == 0, "I50.1").otherwise("Z00").alias("icd10_code"))
    people = stays.select("patient_id").distinct().select(
        "patient_id", F.lit("m").alias("mrn"), F.lit("A").alias("first_name"),
        F.lit("B").alias("last_name"), F.lit(50).alias("age"))
    risk = people.select("patient_id", F.lit(0.5).alias("risk_score"), F.lit("x").alias("risk_category"),
                         F.lit("[]").alias("risk_factors"), F.lit(AS_OF).alias("last_calculated"))
    social = spark.createDataFrame(
        [], "patient_id string, housing_instability boolean, transportation_barrier boolean,"
        "food_insecurity boolean, social_isolation boolean, financial_strain boolean,"
        "utility_assistance_needed boolean, last_assessed date")
    frames = {"encounters": stays, "diagnoses": codes, "patients": people, "risk_scores": risk,
              "sdoh": social}
    return ClinicalTables(spark, {k: (lambda f=f: f) for k, f in frames.items()}, AS_OF)


@pytest.fixture(scope="module")
def histories(crowded):
    by_patient = defaultdict(list)
    for r in crowded.encounters.collect():
        by_patient[r.patient_id].append(r)
    for rows in by_patient.values():
        rows.sort(key=lambda r: (r.admission_date, r.encounter_id))
    return by_patient


def expected_pairs(histories):
    return {(a.encounter_id, b.encounter_id, (b.admission_date - a.discharge_date).days)
            for rows in histories.values() for a, b in zip(rows, rows[1:])
            if 0 < (b.admission_date - a.discharge_date).days <= 365}


@pytest.mark.parametrize("unit", ["date", "timestamp"])
def test_pairs(crowded, histories, unit):
    stays = crowded.encounters
    typed = crowded.replace(encounters=stays.withColumns(
        {c: stays[c].cast(unit) for c in ("admission_date", "discharge_date")}))
    got = {(r.original_encounter_id, r.readmit_encounter_id, r.days_between)
           for r in readmit.readmission_pairs(typed).collect()}
    assert got == expected_pairs(histories) and len(got) > 500


def test_sequence(crowded, histories):
    got = {r.encounter_id: (r.enc_num, r.total_encs)
           for r in readmit.encounter_sequence(crowded).collect()}
    assert got == {r.encounter_id: (n, len(rows)) for rows in histories.values()
                   for n, r in enumerate(rows, start=1)}


def test_lace_emergency_points(crowded, histories):
    got = {r.encounter_id: r.e_points for r in readmit.lace_index(crowded).collect()}
    assert len(got) == STAYS
    for r in histories["hot"][::50] + histories["p7"]:
        visits = sum(v.encounter_type == "Emergency" and 0 < (r.admission_date - v.admission_date).days <= 183
                     for v in histories[r.patient_id])
        assert got[r.encounter_id] == min(visits, 4)


def test_counts_and_fanout(crowded, histories):
    counts = {r.condition: (r.patients, r.diagnosis_rows) for r in lookups.condition_counts(crowded).collect()}
    owner = {r.encounter_id: p for p, rows in histories.items() for r in rows}
    rows = [r for r in crowded.diagnoses.collect() if r.icd10_code == "I50.1"]
    assert counts["CHF"] == (len({owner[r.encounter_id] for r in rows}), len(rows))
    assert report.outreach_rows_fanout(crowded).count() == STAYS
    assert priority.priority_scores(crowded).count() == len(histories)
