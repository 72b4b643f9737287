"""The ten user-facing capabilities by name."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from wardlight.operators import assign, lookups, priority, readmit, report
from wardlight.sources.clinical import ClinicalTables


def _for(tables: ClinicalTables, patient_ids: Sequence[str] | str) -> DataFrame:
    ids = [patient_ids] if isinstance(patient_ids, str) else patient_ids
    return lookups.patient_ids(tables, ids)


def _history(tables: ClinicalTables, ids: Sequence[str] | str) -> DataFrame:
    """Newest discharge first."""
    return readmit.readmission_history(tables, _for(tables, ids)).orderBy(
        F.desc("original_discharge_date"), "readmission_id")


def _coordinators(tables: ClinicalTables, specialty: str | Sequence[str] | None = None) -> DataFrame:
    """Most free places first, then the most experienced."""
    return lookups.available_coordinators(tables, specialty).orderBy(
        F.desc("available_capacity"), F.desc("years_experience"), "coordinator_id")


# Results a person reads are sorted here, at the outer edge; plans join the unsorted operators.
TOOLS: dict[str, Callable[..., DataFrame]] = {
    "get_recent_discharges": lambda tables, days_back: lookups.recent_discharges(
        tables, days_back).orderBy(F.desc("discharge_date"), "encounter_id"),
    "get_diagnoses_by_condition": lookups.diagnoses_by_condition,
    "get_patient_readmission_history": _history,
    "get_risk_score": lambda tables, ids: lookups.risk_score_lookup(tables, _for(tables, ids)),
    "get_sdoh_barriers": lambda tables, ids: lookups.sdoh_barriers(tables, _for(tables, ids)),
    "get_available_care_coordinators": _coordinators,
    "suggest_coordinator_for_patient": assign.suggest_coordinator,
    "calculate_priority_score":
        lambda tables, ids: priority.priority_scores(tables, _for(tables, ids)),
    "assign_care_coordinator": assign.assign_coordinators,
    "generate_outreach_report":
        lambda tables, ids: report.report_document(tables, _for(tables, ids)),
}
