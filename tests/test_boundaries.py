"""Hand-made frames for the edges of the clinical rules."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from wardlight.functions.columns import contact_hours, risk_category, tier_label, two_decimals
from wardlight.operators import assign, checks, lookups, priority, readmit, report
from wardlight.plans.flagship import flagship_outreach
from wardlight.sources.sinks import append_report


def _by(frame, key):
    return {row[key]: row for row in frame.collect()}


def _risk(patient, score, day=0):
    return {"patient_id": patient, "risk_score": score, "risk_category": "x", "risk_factors": "[]",
            "last_calculated": dt.datetime(2024, 6, 1) + dt.timedelta(days=day)}


def test_score_bins(spark):
    scores = spark.createDataFrame(
        [(0.299,), (0.3,), (0.6,), (0.7,), (0.701,), (0.8,), (0.801,), (None,)], "s double")
    rows = scores.select("s", risk_category(F.col("s")).alias("c"), tier_label(F.col("s")).alias("t"),
                         contact_hours(F.col("s")).alias("h")).collect()
    assert [(r.c, r.t, r.h) for r in rows] == [
        ("Low", "TIER 3", 72), ("Moderate", "TIER 3", 72), ("Moderate", "TIER 3", 72),
        ("High", "TIER 2", 48), ("High", "TIER 2", 48), ("High", "TIER 2", 48),
        ("High", "TIER 1", 24), ("High", "TIER 3", 72)]


def test_two_decimals_round_the_binary_value(spark):
    values = [0.345, 0.125, 0.675, 0.285, 0.375, 0.005, 1.0, 0.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in frame.select(two_decimals(F.col("v"))).collect()] == [f"{v:.2f}" for v in values]


@pytest.mark.parametrize("gap, kept, within", [
    (0, False, None), (1, True, True), (30, True, True), (31, True, False), (365, True, False),
    (366, False, None)])
def test_days_between(clinic, stay, gap, kept, within):
    tables = clinic(encounters=[stay(1, "p", -900, 5), stay(2, "p", -895 + gap, 1)])
    rows = readmit.readmission_pairs(tables).collect()
    assert len(rows) == (1 if kept else 0)
    if kept:
        assert (rows[0].days_between, rows[0].is_30_day) == (gap, within)


def test_same_day_readmission_counts_as_zero_days(clinic, stay):
    later = stay(2, "p", -95, 3)
    later["admission_date"] += dt.timedelta(hours=9)
    rows = readmit.readmission_pairs(clinic(encounters=[stay(1, "p", -100, 5), later])).collect()
    assert [(r.days_between, r.is_30_day) for r in rows] == [(0, True)]


def test_overlapping_stay_ends_the_search(clinic, stay):
    tables = clinic(encounters=[
        stay(1, "p", -100, 20), stay(2, "p", -90, 2), stay(3, "p", -70, 2)])
    pairs = readmit.readmission_pairs(tables).collect()
    assert [(p.original_encounter_id, p.readmit_encounter_id) for p in pairs] == [("e2", "e3")]


def test_stays_that_begin_together(clinic, stay):
    tables = clinic(encounters=[stay(1, "p", -100, 2), stay(2, "p", -100, 3),
                                stay(3, "p", -80, 1), stay(4, "p", -80, 1)])
    pairs = readmit.readmission_pairs(tables).collect()
    assert [(p.original_encounter_id, p.readmit_encounter_id) for p in pairs] == [("e2", "e3")]


def test_pairs_cross_day_buckets(clinic, stay):
    """Stays are worked day by day; a plain walk over the sorted stays agrees."""
    stays = [stay(n, f"p{n % 3}", -1000 + 11 * n, 1 + n % 9) for n in range(60)]
    got = {(r.original_encounter_id, r.readmit_encounter_id)
           for r in readmit.readmission_pairs(clinic(encounters=stays)).collect()}
    expected = set()
    for p in {s["patient_id"] for s in stays}:
        mine = sorted((s for s in stays if s["patient_id"] == p), key=lambda s: s["admission_date"])
        for a, b in zip(mine, mine[1:]):
            gap = (b["admission_date"].date() - a["discharge_date"].date()).days
            if b["admission_date"] > a["discharge_date"] and gap <= 365:
                expected.add((a["encounter_id"], b["encounter_id"]))
    assert got == expected and expected


@pytest.mark.parametrize("seed", range(4))
def test_next_stay_equals_a_plain_window(clinic, stay, seed):
    """Ties, nulls, and discharges before their own admission."""
    draw = random.Random(seed)
    stays = []
    for n in range(400):
        row = stay(n, draw.choice(["hot", "hot", "b", "c", None]), -draw.randrange(60),
                   draw.randrange(-3, 9))
        if draw.random() < 0.3:
            row["admission_date"] += dt.timedelta(hours=draw.randrange(23))
        for column, share in (("admission_date", 0.05), ("discharge_date", 0.05), ("encounter_id", 0.02)):
            if draw.random() < share:
                row[column] = None
        stays.append(row)
    tables = clinic(encounters=stays)
    history = Window.partitionBy("patient_id").orderBy("admission_date", "encounter_id")
    plain = (tables.encounters.where("patient_id IS NOT NULL")
             .withColumns({"next_id": F.lead("encounter_id").over(history),
                           "start": F.lead("admission_date").over(history)})
             .withColumn("days", F.datediff("start", "discharge_date"))
             .where("start > discharge_date AND days <= 365")
             .select("patient_id", "encounter_id", "next_id", "days"))
    got = readmit.readmission_pairs(tables).select(
        "patient_id", "original_encounter_id", "readmit_encounter_id", "days_between")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_rates_count_unknown_facilities_and_no_future_stay(clinic, stay):
    tables = clinic(encounters=[
        stay(1, "p", -40, 2, facility=None), stay(2, "p", -30, 2, facility=None),
        stay(3, "q", -10, 2), stay(4, "q", 5, 2), stay(5, None, -9, 1)])
    got = {r.facility: (r.discharges, r.readmissions_30d)
           for r in readmit.facility_readmission_rate(tables).collect()}
    assert got == {None: (2, 1), "North": (2, 0)}
    whole = readmit.readmission_rate_overall(tables).first()
    assert (whole.discharges, whole.readmissions_30d, whole.readmission_rate) == (4, 1, 0.25)
    total = readmit.quality_rollup(tables).where("level = 3").first()
    assert (total.discharges, total.readmissions_30d) == (4, 1)


def test_latest_assessment_counts(clinic, person):
    tables = clinic(patients=[person("p")], sdoh=[
        {"patient_id": "p", "housing_instability": True, "last_assessed": dt.datetime(2024, 1, 1)},
        {"patient_id": "p", "housing_instability": False, "last_assessed": dt.datetime(2024, 5, 1)}],
        risk_scores=[_risk("p", 0.9, 0), _risk("p", 0.2, 9)])
    assert [r.housing_instability for r in lookups.sdoh_barriers(tables).collect()] == [False]
    assert lookups.by_mrn(lookups.sdoh_barriers(tables), tables).count() == 1
    assert priority.barrier_profile(tables).count() == 1
    counts = checks.planted_counts(tables).first()
    assert (counts.housing_instability, counts.high_risk) == (0, 0)


def test_last_discharge_is_not_in_the_future(clinic, person, stay):
    tables = clinic(patients=[person("p"), person("q")],
                    encounters=[stay(1, "p", -30, 5), stay(2, "p", -1, 9), stay(3, "q", 3, 2)])
    got = _by(report.outreach_report_rows(tables), "patient_id")
    assert got["p"].last_discharge == dt.datetime(2024, 6, 5) and got["q"].last_discharge is None


def test_a_repeated_report_replaces_itself(spark, tmp_path):
    rows = spark.createDataFrame([("p",), ("q",)], "patient_id string")
    for day in (dt.date(2024, 1, 1), dt.date(2024, 1, 8), dt.date(2024, 1, 8)):
        append_report(rows, str(tmp_path / "r"), day)
    assert spark.read.parquet(str(tmp_path / "r")).groupBy("report_date").count().count() == 2
    assert spark.read.parquet(str(tmp_path / "r")).count() == 4


def test_priority_record(clinic, stay, person):
    tables = clinic(
        patients=[person(p) for p in ("full", "none", "bare", "stale")],
        encounters=[stay(1, "full", -60, 5), stay(2, "full", -40, 5)],
        diagnoses=[{"diagnosis_id": "d1", "encounter_id": "e1", "icd10_code": "J44.1"}],
        risk_scores=[_risk("full", 0.9), _risk("bare", 0.5), _risk("stale", 0.1, 0),
                     _risk("stale", 0.8, 5)],
        sdoh=[{"patient_id": "full", "housing_instability": True, "transportation_barrier": True}])
    got = _by(priority.priority_scores(tables), "patient_id")
    assert got["full"].priority_score == 1.0
    assert got["full"].risk_factors == ["Prior 30-day readmission", "Transportation barrier",
                                        "Housing instability", "CHF/COPD diagnosis"]
    assert got["full"].recommendations.startswith("URGENT")
    assert (got["none"].priority_score, got["none"].risk_factors, got["none"].recommendations) == (
        0.0, ["No risk score available"], "Complete risk assessment")
    assert (got["bare"].priority_score, got["bare"].risk_factors) == (0.3, [])
    assert got["stale"].priority_score == 0.48


def test_advice_uses_the_unrounded_score(clinic, person):
    tables = clinic(patients=[person("p")], risk_scores=[_risk("p", 1.0)])
    row = priority.priority_scores(tables).first()
    assert row.priority_score == 0.6 and row.recommendations.startswith("MODERATE")


def test_conditions(clinic, stay, person):
    tables = clinic(
        patients=[person("p")], encounters=[stay(1, "p", -9, 1)],
        diagnoses=[{"diagnosis_id": f"d{i}", "encounter_id": "e1", "icd10_code": "I50.9",
                    "description": "x", "is_primary": True} for i in range(3)]
        + [{"diagnosis_id": "d9", "encounter_id": "e1", "icd10_code": "Z00.0"}])
    assert lookups.diagnoses_by_condition(tables, "chf").count() == 1
    assert lookups.diagnoses_by_condition(tables, "Gout").count() == 0
    assert [r.condition for r in lookups.condition_labels(tables).collect()] == ["CHF"] * 3
    counts = _by(lookups.condition_counts(tables), "condition")
    assert (counts["CHF"].patients, counts["CHF"].diagnosis_rows) == (1, 3)
    assert counts["Sepsis"].patients == 0


@pytest.mark.parametrize("specialty, expected", [
    (None, {"a", "b", "c"}), ("CHF", {"a", "b"}), ("Gout", set()), ("CHF/COPD", set()),
    ("%", set()), (["COPD", "Pulm"], {"b", "c"})])
def test_available_coordinators(clinic, coordinator, specialty, expected):
    tables = clinic(care_coordinators=[
        coordinator("a", 2), coordinator("b", 1, '["CHF", "COPD"]'), coordinator("c", 3, '["Pulm"]'),
        coordinator("full", 0), coordinator("gone", 4, active=False)])
    got = {r.coordinator_id for r in lookups.available_coordinators(tables, specialty).collect()}
    assert got == expected


def test_suggestions(clinic, coordinator):
    tables = clinic(care_coordinators=[
        coordinator("a", 2), coordinator("b", 9, '["Geriatrics"]'), coordinator("c", 9, '["Pulm"]'),
        coordinator("d", 2)])
    got = {s: assign.suggest_coordinator(tables, "p", s).first() for s in ("CHF", "Gout", None)}
    assert (got["CHF"].coordinator_id, got["CHF"].match_quality) == ("a", "Perfect Match")
    assert (got["Gout"].coordinator_id, got["Gout"].match_quality) == ("b", "General Match")
    assert got[None].coordinator_id == "b"
    assert assign.suggest_coordinator(clinic(), "p", "CHF").count() == 0


def test_round_robin_and_overflow(spark, clinic, coordinator):
    tables = clinic(care_coordinators=[coordinator("a", 2, years=3), coordinator("b", 3),
                                       coordinator("c", 1)])
    patients = spark.createDataFrame(
        [(f"p{i}", round(0.9 - i / 10, 1)) for i in range(7)], "patient_id string, priority_score double")
    got = sorted(assign.assign_coordinators(tables, patients).collect(), key=lambda r: r.priority_rank)
    assert [r.patient_id for r in got] == [f"p{i}" for i in range(7)]
    assert [r.coordinator_id for r in got] == ["b", "a", "c", "b", "a", "b", None]


def test_specialties_are_matched_within_capacity(spark, clinic, coordinator, person, stay):
    codes = {"c": "I50.1", "o": "J44.0", "d": "E11.9", "x": "Z00"}
    names = [f"{kind}{n}" for kind in codes for n in range(3)]
    tables = clinic(
        patients=[person(p) for p in names],
        encounters=[stay(i, p, -50, 1) for i, p in enumerate(names)],
        diagnoses=[{"diagnosis_id": p, "encounter_id": f"e{i}", "icd10_code": codes[p[0]]}
                   for i, p in enumerate(names)],
        care_coordinators=[coordinator("both", 2, '["CHF", "COPD"]'), coordinator("copd", 3, '["COPD"]'),
                           coordinator("old", 2, '["Geriatrics"]'), coordinator("gone", 5, active=False)])
    patients = spark.createDataFrame([(p, 0.5) for p in names], "patient_id string, priority_score double")
    got = _by(assign.assign_coordinators(tables, patients), "patient_id")
    assert {p: r.coordinator_id for p, r in got.items()} == {
        "c0": "both", "c1": "both", "c2": "old", "o0": "copd", "o1": "copd", "o2": "copd",
        "d0": "old", "d1": None, "d2": None, "x0": None, "x1": None, "x2": None}
    assert (got["c0"].match_quality, got["c2"].match_quality, got["d1"].match_quality) == (
        "Perfect Match", "General Match", None)
    assert [got[p].specialty for p in ("c2", "o0", "d0", "x0")] == ["CHF", "COPD", "Diabetes", None]


def test_unlisted_needs_get_anybody(spark, clinic, coordinator):
    needs = spark.createDataFrame([("p", "Gout"), ("q", "CHF"), ("r", None)],
                                  "patient_id string, specialty string")
    tables = clinic(care_coordinators=[coordinator("a", 1), coordinator("b", 5, '["Pulm"]')])
    got = _by(assign.suggest_coordinators(tables, needs, ["CHF"]), "patient_id")
    assert {p: r.coordinator_id for p, r in got.items()} == {"p": "b", "q": "a", "r": "b"}


def test_equal_scores_go_by_id(spark, clinic, coordinator):
    tables = clinic(care_coordinators=[coordinator("a", 5)])
    patients = spark.createDataFrame([("p2", 0.5), ("p1", 0.5), ("p3", 0.5)],
                                     "patient_id string, priority_score double")
    got = {r.patient_id: r.priority_rank for r in assign.assign_coordinators(tables, patients).collect()}
    assert got == {"p1": 1, "p2": 2, "p3": 3}


def test_empty_id_frame(clinic, person, stay):
    tables = clinic(patients=[person("p")], encounters=[stay(1, "p", -9, 1)],
                    risk_scores=[_risk("p", 0.9)])
    nobody = lookups.patient_ids(tables, [])
    assert priority.priority_scores(tables, nobody).count() == 0
    assert report.outreach_report_rows(tables, nobody).count() == 0
    parts = report.report_document(tables, nobody).orderBy("part").collect()
    assert [p.part for p in parts] == [0, 1] and "**Patients Identified:** 0" in parts[0].document


def test_report_rows_and_document(clinic, person, stay):
    tables = clinic(
        patients=[person(p) for p in ("p1", "p2", "p3")],
        encounters=[stay(1, "p1", -30, 5, facility="Old"), stay(2, "p1", -9, 1, facility="New")],
        risk_scores=[_risk("p1", 0.85), _risk("p2", 0.65)],
        sdoh=[{"patient_id": "p1", "housing_instability": True, "transportation_barrier": True},
              {"patient_id": "p2", "housing_instability": False}])
    rows = _by(report.outreach_report_rows(tables), "patient_id")
    assert (rows["p1"].facility, rows["p1"].tier, rows["p1"].action) == (
        "New", "TIER 1", "Contact within 24h")
    assert rows["p1"].barriers == "🚗 Transportation, 🏠 Housing"
    assert rows["p2"].barriers == rows["p3"].barriers == "None identified"
    assert report.outreach_rows_fanout(tables).count() == 4
    parts = report.report_document(tables, page_size=2).orderBy("part").collect()
    assert [(p.part, p.patients) for p in parts] == [(0, 0), (1, 1), (2, 1), (3, 1), (4, 0)]
    assert parts[1].document.startswith("## 🔴 TIER 1 (1)\n\n### 1. A p1 (MRN: M-p1) - 🔴 TIER 1")
    assert "**Risk Score:** 0.85 (x)" in parts[1].document
    assert "### 3. A p3" in parts[3].document and "not scored" in parts[3].document
    assert "Care Coordinator:" not in "".join(p.document for p in parts)


def test_report_pages_and_coordinators(spark, clinic, person):
    names = [f"p{n}" for n in range(7)]
    tables = clinic(patients=[person(p) for p in names],
                    risk_scores=[_risk(p, 0.9 if n < 5 else 0.1) for n, p in enumerate(names)])
    given = spark.createDataFrame([("p0", "Ann"), ("p1", None)], "patient_id string, coordinator_name string")
    parts = report.report_document(tables, page_size=2, assignments=given).orderBy("part").collect()
    assert [p.patients for p in parts] == [0, 2, 2, 1, 2, 0]
    assert [p.document.startswith("## ") for p in parts] == [False, True, False, False, True, False]
    assert "**Care Coordinator:** Ann" in parts[1].document
    assert "**Care Coordinator:** unassigned" in parts[1].document


def test_open_and_closed_end(clinic, stay, person):
    tables = clinic(patients=[person("p")], encounters=[
        stay(1, "p", -8, 1), stay(2, "p", -3, 3), stay(3, "p", -1, 9), stay(4, "p", -30, 1)])
    assert {r.encounter_id for r in lookups.recent_discharges(tables, 7).collect()} == {"e1", "e2", "e3"}
    assert {r.encounter_id for r in lookups.recent_discharges(tables, 7, bounded=True).collect()} == {
        "e1", "e2"}


def test_flagship_needs_every_condition(clinic, stay, person):
    def patient(name, number, code="I50.1", score=0.8, second=-20, recent=True):
        last = -6 if recent else -60
        return dict(
            patients=[person(name)], risk_scores=[_risk(name, score)],
            encounters=[stay(f"{number}0", name, second - 20 if recent else -120, 2),
                        stay(f"{number}1", name, second if recent else -100, 2),
                        stay(f"{number}2", name, last, 2)],
            diagnoses=[{"diagnosis_id": f"d{number}", "encounter_id": f"e{number}0", "icd10_code": code}])

    cases = [patient("yes", 1), patient("wrongdx", 2, code="E11.9"), patient("lowrisk", 3, score=0.7),
             patient("notrecent", 4, recent=False)]
    merged = {k: [r for c in cases for r in c[k]] for k in cases[0]}
    assert [r.patient_id for r in flagship_outreach(clinic(**merged), 7).collect()] == ["yes"]


def test_lace_points(clinic, stay):
    tables = clinic(
        encounters=[stay(1, "p", -400, 1, encounter_type="Emergency"),
                    stay(2, "p", -200, 3, encounter_type="Emergency"),
                    stay(3, "p", -17, 5), stay(4, "p", -16, 14)],
        diagnoses=[{"diagnosis_id": "a", "encounter_id": "e2", "icd10_code": "I50.9"},
                   {"diagnosis_id": "b", "encounter_id": "e4", "icd10_code": "N18.3"}])
    got = _by(readmit.lace_index(tables), "encounter_id")
    assert tuple(got["e1"])[2:] == (1, 3, 0, 0, 4)
    assert tuple(got["e2"])[2:] == (3, 3, 2, 0, 8)
    assert tuple(got["e3"])[2:] == (4, 0, 2, 1, 7)
    assert tuple(got["e4"])[2:] == (7, 0, 5, 0, 12)


def test_checks_find_faults(clinic, stay, person, coordinator):
    broken = coordinator("a", 5) | {"available_capacity": 6}
    tables = clinic(
        patients=[person("p"), person("p")],
        encounters=[stay(1, "p", -9, 1), stay(2, "ghost", -9, 1), stay(3, "ghost", -8, 1) | {"length_of_stay": 4}],
        diagnoses=[{"diagnosis_id": "d", "encounter_id": "lost", "icd10_code": "I10"}],
        care_coordinators=[broken])
    found = {r.check_name: r.violations for r in checks.referential_checks(tables).collect()}
    assert (found["encounter_without_patient"], found["diagnosis_without_encounter"],
            found["duplicate_patient"]) == (2, 1, 1)
    derived = {r.check_name: r.violations for r in checks.derived_column_checks(tables).collect()}
    assert derived == {"capacity": 1, "discharge_date": 1, "discharge_before_admission": 0}


def test_stays_without_a_patient(clinic, stay):
    stays = [stay(1, None, -50, 1), stay(2, None, -40, 1), stay(3, "p", -50, 1)]
    assert readmit.readmission_pairs(clinic(encounters=stays)).count() == 0
    got = _by(readmit.encounter_sequence(clinic(encounters=stays)), "encounter_id")
    assert [(got[e].enc_num, got[e].total_encs) for e in ("e1", "e2", "e3")] == [(1, 2), (2, 2), (1, 1)]
