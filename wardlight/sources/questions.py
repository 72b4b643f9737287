"""The twenty evaluation questions."""

from __future__ import annotations

import json

# Complexity, question, facts an answer must name, capabilities it needs.
_QUESTIONS = [
    ("simple", "How many patients were discharged in the last 7 days?",
     ["127", "discharged", "last 7 days"],
     ["get_recent_discharges"]),
    ("simple", "List all care coordinators with available capacity",
     ["care coordinator", "available", "capacity"],
     ["get_available_care_coordinators"]),
    ("simple", "How many CHF patients are in the system?",
     ["CHF", "Congestive Heart Failure", "patients"],
     ["get_diagnoses_by_condition"]),
    ("simple", "Show me all COPD patients in the database",
     ["COPD", "Chronic Obstructive Pulmonary Disease"],
     ["get_diagnoses_by_condition"]),
    ("simple", "What is the risk score for patient-000001?",
     ["risk score", "patient-000001"],
     ["get_risk_score"]),
    ("simple", "Show me recent discharges from the last 3 days",
     ["discharged", "3 days", "recent"],
     ["get_recent_discharges"]),
    ("medium", "Which CHF patients were discharged in the last 7 days?",
     ["CHF", "discharged", "7 days", "23"],
     ["get_recent_discharges", "get_diagnoses_by_condition"]),
    ("medium", "How many COPD patients have transportation barriers?",
     ["COPD", "transportation", "barrier"],
     ["get_diagnoses_by_condition", "get_sdoh_barriers"]),
    ("medium", "Which care coordinators specialize in CHF and have availability?",
     ["CHF", "care coordinator", "available", "2"],
     ["get_available_care_coordinators"]),
    ("medium", "Show me patients with risk scores above 0.7",
     ["risk score", "0.7", "high risk", "18"],
     ["get_risk_score"]),
    ("medium", "How many patients have both CHF and prior readmissions?",
     ["CHF", "readmission", "prior"],
     ["get_diagnoses_by_condition", "get_patient_readmission_history"]),
    ("medium", "What are the social barriers for high-risk CHF patients?",
     ["CHF", "social", "barriers", "SDOH", "transportation", "housing"],
     ["get_diagnoses_by_condition", "get_risk_score", "get_sdoh_barriers"]),
    ("medium", "Which patients discharged last week have housing instability?",
     ["discharged", "housing", "instability", "3"],
     ["get_recent_discharges", "get_sdoh_barriers"]),
    ("medium", "How many patients with 30-day readmissions are in the recent discharge cohort?",
     ["30-day", "readmission", "discharged", "32"],
     ["get_recent_discharges", "get_patient_readmission_history"]),
    ("complex", "Show me high-risk patients discharged in the last 7 days who need outreach this"
     " week. Focus on CHF and COPD patients with prior readmissions.",
     ["127", "discharged", "7 days", "23", "CHF", "19", "COPD", "32", "readmission", "18",
      "high-risk", "0.7", "transportation", "housing", "2", "care coordinator", "outreach",
      "priority"],
     ["get_recent_discharges", "get_diagnoses_by_condition", "get_patient_readmission_history",
      "get_risk_score", "get_sdoh_barriers", "get_available_care_coordinators",
      "calculate_priority_score", "generate_outreach_report"]),
    ("complex", "Which patients should we prioritize for care coordination this week based on risk"
     " scores and coordinator capacity?",
     ["risk score", "high-risk", "priority", "care coordinator", "capacity", "assignment",
      "specialty"],
     ["get_risk_score", "get_available_care_coordinators", "suggest_coordinator_for_patient",
      "calculate_priority_score"]),
    ("complex", "Generate a Monday morning readmission prevention report for the VP of Care"
     " Management including patient prioritization and coordinator assignments.",
     ["readmission", "prevention", "high-risk", "priority", "CHF", "COPD", "care coordinator",
      "assignment", "outreach", "recommendations"],
     ["get_recent_discharges", "get_diagnoses_by_condition", "get_risk_score",
      "get_patient_readmission_history", "get_sdoh_barriers",
      "get_available_care_coordinators"]),
    ("complex", "Identify CHF patients with multiple risk factors (prior readmission, social"
     " barriers, high risk score) and assign them to appropriate coordinators.",
     ["CHF", "risk factors", "readmission", "social barriers", "risk score", "high-risk",
      "care coordinator", "assignment", "CHF"],
     ["get_diagnoses_by_condition", "get_patient_readmission_history", "get_sdoh_barriers",
      "get_risk_score", "get_available_care_coordinators", "suggest_coordinator_for_patient"]),
    ("complex", "What interventions should we prioritize for COPD patients with both clinical risk"
     " (readmissions) and social risk factors (transportation, housing)?",
     ["COPD", "interventions", "readmission", "clinical risk", "social risk", "transportation",
      "housing", "priority", "outreach"],
     ["get_diagnoses_by_condition", "get_patient_readmission_history", "get_sdoh_barriers",
      "get_risk_score"]),
    ("complex", "Create an outreach plan for high-risk patients considering care coordinator"
     " capacity, specialty matching, and patient acuity levels.",
     ["high-risk", "outreach plan", "care coordinator", "capacity", "specialty", "acuity",
      "assignment", "priority", "timeline"],
     ["get_risk_score", "get_recent_discharges", "get_available_care_coordinators",
      "suggest_coordinator_for_patient"]),
]

# (request_id, complexity, request, expected_facts as JSON, expected_tools as JSON)
QUESTION_ROWS = [
    (f"q_{number:02d}", complexity, request, json.dumps(facts), json.dumps(tools))
    for number, (complexity, request, facts, tools) in enumerate(_QUESTIONS, start=1)
]
