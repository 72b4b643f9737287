"""The judges against brute force over small texts."""

import pytest

from wardlight.operators import judges

SCHEMA = "answer_id string, response string, expected_facts array<string>"
TEXTS = [
    ("", []),
    (None, ["CHF"]),
    ("CHF and COPD patients with prior readmission, ICD-10 I50", ["CHF", "copd", "Readmission"]),
    ("Risk score 0.9; 30-day READMISSION; call within 24 hours; coordinator Ann", ["risk score", "x"]),
    ("one clinical word: readmission", ["readmission"]),
    ("Please email the export to a third party", ["email"]),
    ("Discharge, diagnoses, readmission, risk, SDOH, social, coordinator", ["discharge"] * 4 + ["no"]),
    ("priority tier list; contact the patient this week; you should recommend outreach", ["a.b"]),
    ("percent % and under_score, regex .* [x]", [".*", "%", "under_score", "[x]"]),
    ("within hipaa limits; synthetic data", list("abcdefgh")),
]


def rows(spark):
    return spark.createDataFrame([(f"a{i}", t, f) for i, (t, f) in enumerate(TEXTS)], SCHEMA)


def collected(frame):
    return {r.answer_id: r for r in frame.collect()}


def test_clinical_accuracy(spark):
    got = collected(judges.add_clinical_accuracy(rows(spark)))
    for i, (text, facts) in enumerate(TEXTS):
        low = (text or "").lower()
        share = sum(f.lower() in low for f in facts) / len(facts) if facts else 1.0
        grade = next(g for limit, g in ((0.3, 1), (0.6, 3), (0.8, 4), (9, 5)) if share < limit)
        if sum(t in low for t in judges.CLINICAL_TERMS) < 2:
            grade = min(grade, 2)
        row = got[f"a{i}"]
        assert (row.clinical_accuracy, row.fact_coverage) == (grade, round(share, 2)), text
    assert got["a4"].clinical_rationale == (
        "All key clinical facts present; Limited use of clinical terminology")
    assert got["a3"].clinical_rationale == "Missing some key clinical facts"


def test_whole_word_facts(spark):
    frame = spark.createDataFrame(
        [("a", "in 2024 we had 2 chf cases", ["2"]), ("b", "in 2024", ["2"]), ("c", "a.b", ["a.b"])], SCHEMA)
    got = collected(judges.add_clinical_accuracy(frame, whole_words=True))
    assert [got[k].fact_coverage for k in "abc"] == [1.0, 0.0, 1.0]
    assert collected(judges.add_clinical_accuracy(frame))["b"].fact_coverage == 1.0


@pytest.mark.parametrize("column, count, words, limits", [
    ("completeness", "sources_mentioned", [(w,) for w in judges.DATA_SOURCES], (2, 4, 6)),
    ("actionability", "actionable_elements", list(judges.ACTION_GROUPS.values()), (2, 3, 4)),
])
def test_counting_judges(spark, column, count, words, limits):
    got = collected(getattr(judges, f"add_{column}")(rows(spark)))
    for i, (text, _) in enumerate(TEXTS):
        n = sum(any(w in (text or "").lower() for w in group) for group in words)
        assert (got[f"a{i}"][count], got[f"a{i}"][column]) == (n, 2 + sum(n >= x for x in limits))


def test_privacy(spark):
    got = collected(judges.add_privacy(rows(spark)))
    assert (got["a5"].privacy, got["a5"].violations, got["a5"].compliance_indicators) == (
        "FAIL", ["third party", "export", "email"], None)
    assert got["a5"].privacy_rationale == "Potential HIPAA violation: third party, export, email"
    assert (got["a9"].privacy, got["a9"].compliance_indicators) == ("PASS", 3)


def test_winner_must_be_strictly_better(spark):
    same = spark.createDataFrame([("basic", 3, 3, 3), ("improved", 3, 3, 3)],
                                 "variant string, clinical_accuracy int, completeness int, actionability int")
    assert {r.winner for r in judges.judge_compare(same).collect()} == {"basic"}


def test_error_answers(spark):
    frame = spark.createDataFrame([("basic", "Error: timeout"), ("basic", "No Error: here")],
                                  "variant string, response string")
    row = judges.error_answers(frame).first()
    assert (row.answers, row.errors) == (2, 1)
