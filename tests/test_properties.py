"""Properties that hold for any data."""

from collections import Counter

from wardlight.operators import assign, lookups, priority
from wardlight.plans.flagship import outreach_assignments


def test_scores_stay_within_bounds(small):
    rows = priority.priority_scores(small).collect()
    assert len(rows) == small.patients.count() == len({r.patient_id for r in rows})
    assert all(0.0 <= r.priority_score <= 1.0 for r in rows)


def test_capacity_holds_and_nobody_is_assigned_twice(small):
    everyone = priority.priority_scores(small).select("patient_id", "priority_score")
    got = assign.assign_coordinators(small, everyone).collect()
    assert len({r.patient_id for r in got}) == len(got) == 150
    used = Counter(r.coordinator_id for r in got if r.coordinator_id)
    free = {r.coordinator_id: r.available_capacity
            for r in lookups.available_coordinators(small).collect()}
    assert all(used[c] <= free[c] for c in used)
    assert sum(used.values()) == min(150, sum(free.values()))


def test_no_specialist_place_goes_to_others_while_a_matching_patient_waits(small):
    everyone = priority.priority_scores(small).select("patient_id", "priority_score")
    got = assign.assign_coordinators(small, everyone).collect()
    lists = {r.coordinator_id: r.specialties for r in lookups.available_coordinators(small).collect()}
    for need in assign.SPECIALTIES:
        waiting = any(r.specialty == need and r.match_quality != "Perfect Match" for r in got)
        strangers = [r for r in got if r.coordinator_id and need in lists[r.coordinator_id]
                     and r.match_quality != "Perfect Match"]
        assert not (waiting and strangers)


def test_longer_look_back_only_adds(small):
    seen = set()
    for days in (3, 7, 30):
        now = {r.encounter_id for r in lookups.recent_discharges(small, days).collect()}
        assert seen <= now
        seen = now


def test_reruns_agree(small):
    runs = [sorted(map(repr, outreach_assignments(small, 90).collect())) for _ in range(2)]
    assert runs[0] == runs[1]
