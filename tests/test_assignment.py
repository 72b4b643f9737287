"""Assignment by two numbers per specialty: against serving one after another, and what it writes."""

import random

import pytest
from pyspark.sql import functions as F

from wardlight import session
from wardlight.operators import assign as A
from wardlight.plans.flagship import outreach_assignments


@pytest.mark.parametrize("ranges", [2, 3, 7, 4096])
def test_number_of_the_nth(spark, monkeypatch, ranges):
    monkeypatch.setattr(A, "_RANGES", ranges)
    numbers = sorted(random.Random(ranges).sample(range(1, 400), 60))
    rows = spark.createDataFrame([(n,) for n in numbers], "number bigint")
    for nth in (1, 2, 31, 60):
        assert A.number_of_nth(rows, "number", nth, 400) == (numbers[nth - 1], 60)
    assert A.number_of_nth(rows, "number", 99, 400) == (numbers[-1], 60)
    assert A.number_of_nth(rows, "number", 0, 400) == (0, 60)
    assert A.number_of_nth(rows.limit(0), "number", 5, 400) == (0, 0)


def one_after_another(patients, needs, coordinators, specialties):
    """The same by serving patients one by one."""
    places = sorted((slot, -c["available_capacity"], -c["years_experience"], c["coordinator_id"], c["specialties"])
                    for c in coordinators for slot in range(1, c["available_capacity"] + 1))
    waiting = sorted(patients, key=lambda p: (-p[1], p[0]))
    given = {}
    for specialty in (*specialties, None):
        for patient, _ in waiting:
            if patient in given or (specialty and needs[patient] != specialty):
                continue
            place = next((p for p in places if not specialty or specialty in p[4]), None)
            if place:
                places.remove(place)
                given[patient] = place[3]
    return given


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("ranges", [3, 4096])
def test_equals_serving_one_after_another(spark, clinic, person, stay, coordinator, monkeypatch, seed, ranges):
    monkeypatch.setattr(A, "_RANGES", ranges)
    rng = random.Random(seed)
    codes = {"CHF": "I50.1", "COPD": "J44.0", "Diabetes": "E11.9", None: "Z00"}
    needs = {f"p{i:03d}": rng.choice(list(codes)) for i in range(60)}
    lists = ['["CHF"]', '["CHF", "COPD"]', '["COPD", "Diabetes"]', '["Oncology"]', '["Geriatrics"]', '["Diabetes", "CHF"]']
    people = [coordinator(f"c{i}", rng.randint(0, 4), rng.choice(lists), rng.randint(1, 3)) for i in range(rng.choice([3, 12, 40]))]
    tables = clinic(
        patients=[person(p) for p in needs], encounters=[stay(p, p, -9, 1) for p in needs],
        diagnoses=[{"diagnosis_id": p, "encounter_id": f"e{p}", "icd10_code": codes[n]} for p, n in needs.items()],
        care_coordinators=people)
    scored = [(p, rng.choice([0.2, 0.5, 0.9])) for p in needs]
    frame = spark.createDataFrame(scored, "patient_id string, priority_score double")
    got = A.assign_coordinators(tables, frame).collect()
    assert sorted(r.patient_id for r in got) == sorted(needs)
    assert {r.patient_id: r.coordinator_id for r in got if r.coordinator_id} == one_after_another(
        scored, needs, people, A.SPECIALTIES)


def test_no_row_set_is_written_twice(spark, small, monkeypatch):
    written = []
    plain = session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda spark, label: (written.append(label), plain(spark, label))[1])
    outreach_assignments(small, 90).count()
    assert sorted(written) == ["cohort", "needs", "outreach", "ranked", "ranked"]


def test_nobody_and_nowhere(spark, clinic, person, coordinator):
    nobody = spark.createDataFrame([], "patient_id string, priority_score double")
    tables = clinic(patients=[person("p")], care_coordinators=[coordinator("c", 2)])
    assert A.assign_coordinators(tables, nobody).count() == 0
    one = spark.createDataFrame([("p", 0.5)], nobody.schema)
    assert A.assign_coordinators(tables, one).select("coordinator_id").first()[0] == "c"
    assert A.assign_coordinators(clinic(patients=[person("p")]), one).where(F.col("coordinator_id").isNull()).count() == 1
