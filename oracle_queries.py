"""SQL oracles: every named query written again as SQL over the driver's tables.

Shared relations are named once in ``RELATIONS``; ``_oracle`` prefixes a query
with those it mentions, directly or through others. Apart from the column
mapping of the test tables nothing is shared with the Spark plans, and each
relation is written in the plain textbook way rather than the distributed one.
"""

from __future__ import annotations

import json
import re

from wardlight.sources.fixtures import MAPPING
from wardlight.sources.questions import QUESTION_ROWS

DAY = "DATE '2001-08-01'"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_quoted(w) for w in words) + "]"


def _mapped(name: str) -> str:
    relation, keep, columns = MAPPING[name]
    selected = ", ".join(f"{expression} AS {column}" for expression, column in columns)
    return f"SELECT {selected} FROM {relation}" + (f" WHERE {keep}" if keep else "")


_QUESTION_VALUES = ", ".join(
    f"({_quoted(i)}, {_quoted(c)}, {_quoted(r)}, {_list(json.loads(f))}, {_list(json.loads(t))})"
    for i, c, r, f, t in QUESTION_ROWS)

_TIER = "CASE WHEN {0} > 0.8e0 THEN 'TIER 1' WHEN {0} > 0.6e0 THEN 'TIER 2' ELSE 'TIER 3' END"
_HOURS = "CASE WHEN {0} > 0.8e0 THEN 24 WHEN {0} > 0.6e0 THEN 48 ELSE 72 END"
_FLAGS = ["housing_instability", "transportation_barrier", "food_insecurity", "social_isolation",
          "financial_strain", "utility_assistance_needed"]


def _draw(seed: str, key: str) -> str:
    return f"cast('0x' || substr(md5('{seed}' || {key}), 1, 8) AS bigint)"


def _grade(value: str, *steps: tuple[float, int]) -> str:
    arms = " ".join(f"WHEN {value} < {below} THEN {score}" for below, score in steps)
    return f"CASE {arms} ELSE 5 END"


def _found(words) -> str:
    return " + ".join(f"contains(txt, {_quoted(w)})::int" for w in words)


def _assigned(source: str, specialties: tuple[str, ...] = ("CHF", "COPD", "Diabetes")) -> str:
    """Specialties take their places one after another, then whoever is left takes what is left."""
    wanted = " WHEN ".join(f"specialty = '{s}' THEN '{s}'" for s in specialties)
    steps, before = [], []
    for i, specialty in enumerate((*specialties, None)):
        used = " UNION ALL ".join(f"SELECT patient_id, turn FROM step{j}" for j in before)
        fits = f"contains(specialties, '{specialty}')" if specialty else "true"
        free = f"turn NOT IN (SELECT turn FROM ({used}))" if before else "true"
        who = f"specialty = '{specialty}'" if specialty else (
            f"patient_id NOT IN (SELECT patient_id FROM ({used}))")
        steps.append(f"""
        step{i} AS (
          SELECT w.patient_id, f.turn
          FROM (SELECT patient_id, row_number() OVER (ORDER BY priority_rank) AS k
                FROM ordered WHERE {who}) w
               JOIN (SELECT turn, row_number() OVER (ORDER BY turn) AS k
                     FROM turns WHERE {fits} AND {free}) f ON w.k = f.k)""")
        before.append(i)
    every = " UNION ALL ".join(f"SELECT * FROM step{i}" for i in before)
    return f"""
        WITH ordered AS (
          SELECT o.patient_id, o.priority_score, CASE WHEN {wanted} END AS specialty,
                 row_number() OVER (ORDER BY o.priority_score DESC, o.patient_id) AS priority_rank
          FROM {source} o JOIN needed n ON o.patient_id = n.patient_id),
        {", ".join(steps)}
        SELECT o.patient_id, o.priority_score, o.priority_rank, o.specialty, t.coordinator_id,
               t.coordinator_name,
               CASE WHEN contains(t.specialties, o.specialty) THEN 'Perfect Match'
                    WHEN contains(t.specialties, 'Geriatrics') THEN 'General Match'
                    WHEN t.coordinator_id IS NOT NULL THEN 'Available' END AS match_quality
        FROM ordered o LEFT JOIN ({every}) g ON o.patient_id = g.patient_id
             LEFT JOIN turns t ON t.turn = g.turn"""


RELATIONS: dict[str, str] = {name: _mapped(name) for name in MAPPING} | {
    "readmissions": """
        SELECT 'readmit-' || encounter_id || '-' || next_id AS readmission_id, patient_id,
               encounter_id AS original_encounter_id, next_id AS readmit_encounter_id,
               discharge_date AS original_discharge_date, next_day AS readmit_admission_date,
               cast(datediff('day', discharge_date, next_day) AS int) AS days_between,
               datediff('day', discharge_date, next_day) <= 30 AS is_30_day, facility
        FROM (SELECT *, lead(encounter_id) OVER w AS next_id, lead(admission_date) OVER w AS next_day
              FROM encounters
              WINDOW w AS (PARTITION BY patient_id ORDER BY admission_date, encounter_id)) s
        WHERE next_day > discharge_date AND datediff('day', discharge_date, next_day) <= 365""",
    "dx": """
        SELECT d.*, e.patient_id, e.admission_date
        FROM diagnoses d JOIN encounters e ON d.encounter_id = e.encounter_id""",
    "chf": "SELECT DISTINCT patient_id FROM dx WHERE icd10_code LIKE 'I50%'",
    "copd": "SELECT DISTINCT patient_id FROM dx WHERE icd10_code LIKE 'J44%'",
    "readmitted_30": "SELECT DISTINCT patient_id FROM readmissions WHERE is_30_day",
    "discharged_7": f"""
        SELECT * FROM encounters
        WHERE discharge_date >= {DAY} - 7 AND discharge_date <= {DAY}""",
    "factors": """
        SELECT p.patient_id, r.risk_score,
               coalesce(s.transportation_barrier, false) AS transport,
               coalesce(s.housing_instability, false) AS housing,
               p.patient_id IN (SELECT patient_id FROM readmitted_30) AS readmitted,
               p.patient_id IN (SELECT patient_id FROM chf UNION SELECT patient_id FROM copd)
                 AS chf_copd
        FROM patients p LEFT JOIN risk_scores r ON p.patient_id = r.patient_id
             LEFT JOIN sdoh s ON p.patient_id = s.patient_id""",
    "raw_priority": """
        SELECT *, least(risk_score * 0.6e0 + CASE WHEN readmitted THEN 0.2e0 ELSE 0e0 END
                        + CASE WHEN transport THEN 0.1e0 ELSE 0e0 END
                        + CASE WHEN housing THEN 0.15e0 ELSE 0e0 END
                        + CASE WHEN chf_copd THEN 0.1e0 ELSE 0e0 END, 1e0) AS points
        FROM factors""",
    "priority": """
        SELECT patient_id, risk_score, readmitted, chf_copd,
               CASE WHEN risk_score IS NULL THEN 0e0 ELSE round(points, 3) END AS priority_score,
               CASE WHEN risk_score IS NULL THEN 'No risk score available'
                    ELSE concat_ws('; ', CASE WHEN readmitted THEN 'Prior 30-day readmission' END,
                                   CASE WHEN transport THEN 'Transportation barrier' END,
                                   CASE WHEN housing THEN 'Housing instability' END,
                                   CASE WHEN chf_copd THEN 'CHF/COPD diagnosis' END) END
                 AS risk_factors,
               CASE WHEN risk_score IS NULL THEN 'Complete risk assessment'
                    WHEN points > 0.8e0
                    THEN 'URGENT: Contact within 24 hours. Coordinate with social services.'
                    WHEN points > 0.6e0
                    THEN 'HIGH PRIORITY: Contact within 48 hours. Address barriers.'
                    ELSE 'MODERATE: Contact within 72 hours. Standard follow-up.' END
                 AS recommendations
        FROM raw_priority""",
    "outreach_base": """
        SELECT p.patient_id, p.priority_score, p.risk_score, e.last_discharge, """
        + ", ".join(f"coalesce(s.{f}, false) AS {f}" for f in _FLAGS) + """
        FROM priority p
             JOIN (SELECT patient_id, max(discharge_date) AS last_discharge FROM encounters
                   WHERE discharge_date <= DATE '2001-08-01' GROUP BY patient_id) e
               ON p.patient_id = e.patient_id
             LEFT JOIN sdoh s ON p.patient_id = s.patient_id
        WHERE p.risk_score > 0.7e0 AND p.readmitted AND p.chf_copd""",
    "outreach": f"""
        SELECT *, {_TIER.format('priority_score')} AS tier FROM outreach_base
        WHERE last_discharge >= {DAY} - 7""",
    "outreach_90": f"SELECT * FROM outreach_base WHERE last_discharge >= {DAY} - 90",
    "free_coordinators": """
        SELECT coordinator_id, name, title, current_caseload, max_caseload, available_capacity,
               specialties, years_experience
        FROM care_coordinators WHERE active AND available_capacity > 0""",
    "needed": """
        SELECT patient_id, CASE WHEN patient_id IN (SELECT patient_id FROM chf) THEN 'CHF'
                                WHEN patient_id IN (SELECT patient_id FROM copd) THEN 'COPD'
                                WHEN patient_id IN (SELECT patient_id FROM dx
                                                    WHERE icd10_code LIKE 'E11%') THEN 'Diabetes' END
                 AS specialty
        FROM patients""",
    "turns": """
        SELECT coordinator_id, name AS coordinator_name, specialties, row_number() OVER (
                 ORDER BY slot, available_capacity DESC, years_experience DESC, coordinator_id) AS turn
        FROM (SELECT *, unnest(range(1, available_capacity + 1)) AS slot FROM free_coordinators)""",
    "chf_social": f"""
        SELECT p.patient_id, p.priority_score
        FROM priority p JOIN sdoh s ON p.patient_id = s.patient_id
        WHERE p.risk_score > 0.7e0 AND p.readmitted AND ({' OR '.join(_FLAGS)})
          AND p.patient_id IN (SELECT patient_id FROM chf)""",
    "high_priority": "SELECT patient_id, priority_score FROM priority WHERE risk_score > 0.7e0",
    "assigned_90": _assigned("outreach_90"),
    "assigned_7": _assigned("outreach"),
    "assigned_all": _assigned("priority"),
    "assigned_high": _assigned("high_priority"),
    "assigned_chf": _assigned("chf_social", ("CHF",)),
    "report_rows": f"""
        SELECT p.patient_id, p.mrn, p.first_name || ' ' || p.last_name AS patient_name, p.age,
               r.risk_score, r.risk_category, e.discharge_date AS last_discharge, e.facility,
               coalesce(s.transportation_barrier, false) AS transportation_barrier,
               coalesce(s.housing_instability, false) AS housing_instability,
               CASE WHEN s.transportation_barrier AND s.housing_instability
                    THEN '🚗 Transportation, 🏠 Housing'
                    WHEN s.transportation_barrier THEN '🚗 Transportation'
                    WHEN s.housing_instability THEN '🏠 Housing'
                    ELSE 'None identified' END AS barriers,
               {_TIER.format('r.risk_score')} AS tier,
               CASE WHEN r.risk_score > 0.8e0 THEN 'Contact within 24h'
                    ELSE 'Contact within 48h' END AS action
        FROM patients p LEFT JOIN risk_scores r ON p.patient_id = r.patient_id
             LEFT JOIN sdoh s ON p.patient_id = s.patient_id
             LEFT JOIN (SELECT * FROM encounters WHERE discharge_date <= {DAY} QUALIFY row_number() OVER (
                          PARTITION BY patient_id ORDER BY discharge_date DESC, encounter_id DESC) = 1) e
               ON p.patient_id = e.patient_id""",
    "report_sections": """
        SELECT *, patient_name || ' (MRN: ' || mrn || ') - '
               || CASE tier WHEN 'TIER 1' THEN '🔴' WHEN 'TIER 2' THEN '🟡' ELSE '🟢' END
               || ' ' || tier || chr(10) || chr(10) || '- **Age:** ' || age
               || chr(10) || '- **Risk Score:** '
               || coalesce(printf('%.2f', risk_score) || ' (' || risk_category || ')', 'not scored')
               || chr(10) || '- **Last Discharge:** '
               || coalesce(strftime(last_discharge, '%Y-%m-%d') || ' from ' || facility, 'none')
               || chr(10) || '- **Social Barriers:** ' || barriers
               || chr(10) || '- **Recommended Action:** ' || action AS section
        FROM report_rows""",
    "questions": f"""
        SELECT * FROM (VALUES {_QUESTION_VALUES})
             q(request_id, complexity, request, expected_facts, expected_tools)""",
    "given": """
        SELECT answer_id, request_id, variant, response FROM answers
        UNION ALL
        SELECT 'report-' || s.patient_id,
               'q_' || lpad(cast(cast(substr(s.patient_id, 9) AS bigint) % 20 + 1 AS string), 2, '0'),
               'improved', '### ' || section || chr(10) || '- **Risk Factors:** '
               || replace(p.risk_factors, '; ', ', ')
               || chr(10) || '- **Recommendation:** ' || p.recommendations
        FROM report_sections s JOIN priority p ON s.patient_id = p.patient_id""",
    "texts": """
        SELECT g.*, q.complexity, q.request, q.expected_facts, lower(g.response) AS txt
        FROM given g JOIN questions q ON g.request_id = q.request_id""",
    "judged": f"""
        SELECT *, round_even(coverage, 2) AS fact_coverage,
               CASE WHEN terms < 2 THEN least({_grade('coverage', (0.3, 1), (0.6, 3), (0.8, 4))}, 2)
                    ELSE {_grade('coverage', (0.3, 1), (0.6, 3), (0.8, 4))} END AS clinical_accuracy,
               {_grade('sources_mentioned', (2, 2), (4, 3), (6, 4))} AS completeness,
               {_grade('actionable_elements', (2, 2), (3, 3), (4, 4))} AS actionability
        FROM (SELECT *,
                len(list_filter(expected_facts, lambda f: contains(txt, lower(f))))::double
                  / len(expected_facts) AS coverage,
                {_found(["risk score", "readmission", "chf", "copd", "icd-10", "30-day"])} AS terms,
                {_found(["discharge", "diagnos", "readmission", "risk", "sdoh", "social",
                         "coordinator"])} AS sources_mentioned,
                (contains(txt, 'patient') OR contains(txt, 'mrn') OR contains(txt, 'list'))::int
                + contains(txt, 'coordinator')::int
                + (contains(txt, 'priority') OR contains(txt, 'tier') OR contains(txt, 'urgent'))::int
                + (contains(txt, '24 hour') OR contains(txt, '48 hour') OR contains(txt, 'week')
                   OR contains(txt, 'immediately'))::int
                + (contains(txt, 'recommend') OR contains(txt, 'should') OR contains(txt, 'contact')
                   OR contains(txt, 'outreach'))::int AS actionable_elements
              FROM texts)""",
    "finished": f"""
        SELECT e.*, CASE WHEN x.original_encounter_id IS NOT NULL THEN 1 ELSE 0 END AS back
        FROM encounters e
             LEFT JOIN (SELECT * FROM readmissions
                        WHERE is_30_day AND readmit_admission_date <= {DAY}) x
               ON e.encounter_id = x.original_encounter_id
        WHERE e.discharge_date <= {DAY}""",
}


def _oracle(sql: str) -> str:
    """``sql`` behind the relations it needs, in order of dependence."""
    order: list[str] = []

    def visit(text: str) -> None:
        words = set(re.findall(r"[a-z_0-9]+", re.sub(r"'(?:[^']|'')*'", "", text)))
        for name in RELATIONS:
            if name in words and name not in order:
                visit(RELATIONS[name])
                order.append(name)

    visit(sql)
    named = ",\n".join(f"{name} AS ({RELATIONS[name].strip()})" for name in order)
    return (f"WITH {named}\n" if named else "") + sql.strip()


_RECENT_COLUMNS = """e.encounter_id, e.patient_id, p.mrn,
    p.first_name || ' ' || p.last_name AS patient_name, e.discharge_date, e.facility,
    e.encounter_type, e.length_of_stay, e.discharge_disposition"""
_RISK_COLUMNS = "risk_score, risk_category, risk_factors, last_calculated"
_SDOH_COLUMNS = """housing_instability, transportation_barrier, food_insecurity, social_isolation,
    financial_strain, last_assessed"""


def _barrier_counts(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS barrier, count(*) AS patients FROM {source} WHERE {f}" for f in _FLAGS)


def _best(specialty: str | None) -> str:
    match = f"contains(specialties, '{specialty}')" if specialty else "false"
    return f"""(SELECT {_quoted(specialty or 'any')} AS specialty, coordinator_id,
        name AS coordinator_name, available_capacity,
        CASE WHEN {match} THEN 'Perfect Match' WHEN contains(specialties, 'Geriatrics')
             THEN 'General Match' ELSE 'Available' END AS match_quality
        FROM free_coordinators
        ORDER BY CASE WHEN {match} THEN 1 ELSE 2 END, available_capacity DESC, coordinator_id LIMIT 1)"""


def _document(rows: str, page_size: int = 100) -> str:
    steps = ("1. Assign care coordinators to Tier 1 patients immediately\n"
             "2. Schedule outreach calls within recommended timeframes\n"
             "3. Address transportation and housing barriers with social services\n"
             "4. Document all interventions in the care management system")
    return f"""
        SELECT 0 AS part, cast(0 AS bigint) AS patients,
               '# 🏥 Care Coordination Outreach Report' || chr(10) || chr(10)
               || '**Generated:** 2001-08-01' || chr(10) || '**Patients Identified:** ' || count(*)
               || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '## 📊 Executive Summary'
               || chr(10) || chr(10) || '- **High-Risk Patients:** '
               || count(*) FILTER (WHERE risk_score > 0.7e0)
               || chr(10) || '- **Transportation Barriers:** '
               || count(*) FILTER (WHERE transportation_barrier)
               || chr(10) || '- **Housing Instability:** ' || count(*) FILTER (WHERE housing_instability)
               || chr(10) || chr(10) || '---' || chr(10) || chr(10)
               || '## 👥 Patient List (Priority Order)' AS document
        FROM {rows}
        UNION ALL
        SELECT cast(p.part AS int), p.patients,
               CASE WHEN p.page = 0 THEN '## ' || CASE p.tier WHEN 'TIER 1' THEN '🔴'
                    WHEN 'TIER 2' THEN '🟡' ELSE '🟢' END || ' ' || p.tier || ' (' || p.n || ')'
                    || chr(10) || chr(10) ELSE '' END || p.texts
        FROM (SELECT tier, page, count(*) AS patients, max(n) AS n,
                     row_number() OVER (ORDER BY tier, page) AS part,
                     string_agg('### ' || k || '. ' || section, chr(10) || chr(10) ORDER BY k) AS texts
              FROM (SELECT *, (k_tier - 1) // {page_size} AS page FROM (
                      SELECT *, row_number() OVER (ORDER BY risk_score DESC NULLS LAST, patient_id) AS k,
                             row_number() OVER (PARTITION BY tier
                               ORDER BY risk_score DESC NULLS LAST, patient_id) AS k_tier,
                             count(*) OVER (PARTITION BY tier) AS n
                      FROM {rows})) GROUP BY tier, page) p
        UNION ALL
        SELECT cast(coalesce(sum(ceil(n / {page_size}.0)), 0) + 1 AS int), 0,
               '---' || chr(10) || chr(10) || '## 📝 Next Steps' || chr(10) || chr(10) || {_quoted(steps)}
        FROM (SELECT tier, count(*) AS n FROM {rows} GROUP BY tier)"""


def _averages(by: str) -> str:
    return f"""SELECT {by}, round(avg(clinical_accuracy), 4) AS avg_clinical_accuracy,
        round(avg(completeness), 4) AS avg_completeness,
        round(avg(actionability), 4) AS avg_actionability FROM judged GROUP BY {by}"""


_RED = ["external api", "third party", "export", "email", "download", "share outside"]
_GREEN = ["databricks", "unity catalog", "within", "synthetic", "hipaa"]
_ANY_BARRIER = "(" + " OR ".join(_FLAGS) + ")"
_SAMPLE = f"""(SELECT patient_id FROM patients
    ORDER BY {_draw('outreach', 'patient_id')}, patient_id LIMIT 100)"""
_PRIORITY_COLUMNS = "patient_id, priority_score, risk_factors, recommendations"
_LACE_GROUPS = {"I50": 2, "J44": 2, "E11": 1, "N18": 2}
_LACE_C = " + ".join(
    f"CASE WHEN EXISTS (SELECT 1 FROM onsets o WHERE o.patient_id = e.patient_id AND o.grp = '{g}'"
    f" AND o.onset <= e.admission_date) THEN {w} ELSE 0 END" for g, w in _LACE_GROUPS.items())

_SQL: dict[str, str] = {
    "flagship_outreach": f"""
        SELECT patient_id, last_discharge, risk_score, priority_score, tier, {', '.join(_FLAGS)}
        FROM outreach""",
    "recent_discharges": f"""
        SELECT {_RECENT_COLUMNS} FROM encounters e JOIN patients p ON e.patient_id = p.patient_id
        WHERE e.discharge_date >= {DAY} - 7""",
    "recent_discharge_count": f"""
        SELECT count(*) AS recent_discharges FROM encounters WHERE discharge_date >= {DAY} - 7""",
    "diagnoses_by_condition": """
        SELECT DISTINCT d.encounter_id, d.patient_id, p.mrn,
               p.first_name || ' ' || p.last_name AS patient_name, d.icd10_code, d.description,
               d.is_primary, d.diagnosis_date
        FROM dx d JOIN patients p ON d.patient_id = p.patient_id WHERE d.icd10_code LIKE 'I50%'""",
    "condition_label_all": """
        SELECT d.diagnosis_id, d.encounter_id, d.icd10_code, c.condition
        FROM diagnoses d JOIN (VALUES ('CHF', 'I50%'), ('COPD', 'J44%'), ('Diabetes', 'E11%'),
                                      ('Hypertension', 'I10%'), ('Sepsis', 'A41%')) c(condition, pat)
             ON d.icd10_code LIKE c.pat""",
    "patients_per_condition": """
        SELECT c.condition, count(DISTINCT d.patient_id) AS patients, count(*) AS diagnosis_rows
        FROM dx d JOIN (VALUES ('CHF', 'I50%'), ('COPD', 'J44%'), ('Diabetes', 'E11%'),
                               ('Hypertension', 'I10%'), ('Sepsis', 'A41%')) c(condition, pat)
             ON d.icd10_code LIKE c.pat
        GROUP BY c.condition""",
    "readmission_history": """
        SELECT readmission_id, patient_id, original_discharge_date, readmit_admission_date,
               days_between, is_30_day
        FROM readmissions""",
    "risk_score_lookup": f"SELECT patient_id, {_RISK_COLUMNS} FROM risk_scores",
    "sdoh_barriers": f"SELECT patient_id, {_SDOH_COLUMNS} FROM sdoh",
    "available_coordinators": "SELECT * FROM free_coordinators WHERE specialties LIKE '%CHF%'",
    "available_coordinators_any": "SELECT * FROM free_coordinators",
    "high_risk_patients": """
        SELECT patient_id, risk_score, risk_category FROM risk_scores WHERE risk_score > 0.7e0""",
    "risk_category": "SELECT patient_id, risk_score, risk_category FROM risk_scores",
    "dx_description_search": """
        SELECT icd10_code, description, count(*) AS diagnosis_rows,
               count(*) FILTER (WHERE description LIKE '%Heart Failure%') AS found_case_sensitive
        FROM diagnoses WHERE lower(description) LIKE '%heart failure%'
        GROUP BY icd10_code, description""",
    "scalar_projection": f"""
        SELECT r.patient_id, p.first_name || ' ' || p.last_name AS patient_name,
               upper(p.last_name) AS upper_name, lpad(cast(p.age AS string), 7, '0') AS padded_age,
               {DAY} - 7 AS week_ago, r.last_calculated + 30 AS recalculate_on,
               cast(datediff('day', r.last_calculated, {DAY}) AS int) AS days_old,
               strftime(r.last_calculated, '%Y-%m-%d') AS calculated_text,
               round(r.risk_score * 0.6e0, 3) AS weighted,
               least(r.risk_score + 0.5e0, 1e0) AS capped,
               printf('%.2f', r.risk_score) AS score_text,
               cast(CASE WHEN r.risk_factors = '[]' THEN 0 ELSE 2 END AS int) AS factor_count,
               contains(r.risk_factors, '"Polypharmacy"') AS polypharmacy,
               CASE WHEN r.risk_factors = '[]' THEN '' ELSE 'Age > 65, Polypharmacy' END AS factor_text,
               p.mrn LIKE 'MRN1%' AS mrn_starts_1,
               {_TIER.format('r.risk_score')} AS tier
        FROM risk_scores r JOIN patients p ON r.patient_id = p.patient_id""",
    "cohort_set_ops": """
        SELECT 'both' AS cohort, count(*) AS patients
        FROM (SELECT * FROM chf INTERSECT SELECT * FROM copd)
        UNION ALL SELECT 'either', count(*) FROM (SELECT * FROM chf UNION SELECT * FROM copd)
        UNION ALL SELECT 'chf_only', count(*) FROM (SELECT * FROM chf EXCEPT SELECT * FROM copd)""",
    "encounter_sequence": """
        SELECT patient_id, encounter_id, admission_date,
               row_number() OVER (PARTITION BY patient_id ORDER BY admission_date, encounter_id)
                 AS enc_num,
               count(*) OVER (PARTITION BY patient_id) AS total_encs
        FROM encounters""",
    "readmission_pairs": "SELECT * EXCLUDE (facility) FROM readmissions",
    "facility_readmission_rate": """
        SELECT facility, count(*) AS discharges, cast(sum(back) AS bigint) AS readmissions_30d,
               round(sum(back) / count(*), 4) AS readmission_rate
        FROM finished GROUP BY facility""",
    "readmission_rate_overall": """
        SELECT count(*) AS discharges, cast(sum(back) AS bigint) AS readmissions_30d,
               round(sum(back) / count(*), 4) AS readmission_rate FROM finished""",
    "readmits_last_month": """
        SELECT count(*) AS readmissions_30d, count(DISTINCT patient_id) AS patients
        FROM readmissions WHERE is_30_day AND readmit_admission_date >= DATE '2001-07-01'
          AND readmit_admission_date < DATE '2001-08-01'""",
    "top_dx_readmitted": """
        SELECT d.icd10_code, count(*) AS diagnosis_rows, count(DISTINCT r.patient_id) AS patients
        FROM readmissions r JOIN diagnoses d ON d.encounter_id = r.original_encounter_id
        WHERE r.is_30_day GROUP BY d.icd10_code ORDER BY 2 DESC, 1 LIMIT 10""",
    "quality_rollup": """
        SELECT discharge_month, facility,
               cast(grouping(discharge_month, facility) AS int) AS level,
               cast(sum(n) AS bigint) AS discharges, cast(sum(r) AS bigint) AS readmissions_30d,
               round(sum(r) / sum(n), 4) AS readmission_rate, round(sum(days) / sum(n), 4) AS mean_stay
        FROM (SELECT strftime(discharge_date, '%Y-%m') AS discharge_month, facility, 1 AS n,
                     length_of_stay AS days, back AS r FROM finished)
        GROUP BY ROLLUP (discharge_month, facility)""",
    "lace_index": f"""
        , onsets AS (SELECT patient_id, substr(icd10_code, 1, 3) AS grp, min(admission_date) AS onset
                     FROM dx GROUP BY 1, 2),
        scored AS (
          SELECT e.encounter_id, e.patient_id,
                 CASE WHEN length_of_stay <= 3 THEN length_of_stay WHEN length_of_stay <= 6 THEN 4
                      WHEN length_of_stay <= 13 THEN 5 ELSE 7 END AS l_points,
                 CASE WHEN encounter_type = 'Emergency' THEN 3 ELSE 0 END AS a_points,
                 {_LACE_C} AS c_raw,
                 cast(least((SELECT count(*) FROM encounters v WHERE v.patient_id = e.patient_id
                        AND v.encounter_type = 'Emergency'
                        AND v.admission_date >= e.admission_date - 183
                        AND v.admission_date < e.admission_date), 4) AS int) AS e_points
          FROM encounters e)
        SELECT encounter_id, patient_id, l_points, a_points,
               CASE WHEN c_raw >= 4 THEN 5 ELSE c_raw END AS c_points, e_points,
               l_points + a_points + CASE WHEN c_raw >= 4 THEN 5 ELSE c_raw END + e_points AS lace
        FROM scored""",
    "priority_score_all": f"SELECT {_PRIORITY_COLUMNS} FROM priority",
    "priority_tiers": f"""
        SELECT CASE WHEN risk_score IS NOT NULL THEN {_HOURS.format('priority_score')} END
                 AS contact_within_hours, count(*) AS patients
        FROM priority GROUP BY 1""",
    "priority_top_k": f"""
        SELECT {_PRIORITY_COLUMNS} FROM priority ORDER BY priority_score DESC, patient_id LIMIT 18""",
    "sdoh_barrier_profile": f"""
        SELECT patient_id, {' + '.join(f + '::int' for f in _FLAGS)} AS barrier_count,
               concat_ws('; ', {', '.join(f"CASE WHEN {f} THEN '{f}' END" for f in _FLAGS)}) AS barriers
        FROM sdoh""",
    "suggest_coordinator_one": f"""
        SELECT 'patient-000001' AS patient_id, * EXCLUDE (specialty) FROM {_best('COPD')}""",
    "suggest_coordinator_bulk": f"""
        SELECT n.patient_id, b.* EXCLUDE (specialty)
        FROM (SELECT p.patient_id,
                     CASE WHEN p.patient_id IN (SELECT patient_id FROM chf) THEN 'CHF'
                          WHEN p.patient_id IN (SELECT patient_id FROM copd) THEN 'COPD'
                          WHEN p.patient_id IN (SELECT patient_id FROM dx
                                                WHERE icd10_code LIKE 'E11%') THEN 'Diabetes'
                          ELSE 'any' END AS specialty
              FROM patients p) n
             JOIN ({_best('CHF')} UNION ALL {_best('COPD')} UNION ALL {_best('Diabetes')}
                   UNION ALL {_best(None)}) b ON n.specialty = b.specialty""",
    "assign_coordinators": "SELECT * FROM assigned_90",
    "coordinator_utilisation": """
        SELECT c.coordinator_id, c.current_caseload, coalesce(a.n, 0) AS assigned,
               round(c.current_caseload / c.max_caseload, 4) AS load_before,
               round((c.current_caseload + coalesce(a.n, 0)) / c.max_caseload, 4) AS load_after
        FROM care_coordinators c
             LEFT JOIN (SELECT coordinator_id, count(*) AS n FROM assigned_90
                        WHERE coordinator_id IS NOT NULL GROUP BY 1) a
               ON c.coordinator_id = a.coordinator_id""",
    "outreach_rows_fanout": """
        SELECT p.patient_id, p.mrn, p.first_name || ' ' || p.last_name AS patient_name, p.age,
               r.risk_score, r.risk_category, r.risk_factors, s.housing_instability,
               s.transportation_barrier, e.discharge_date, e.facility
        FROM patients p LEFT JOIN risk_scores r ON p.patient_id = r.patient_id
             LEFT JOIN sdoh s ON p.patient_id = s.patient_id
             LEFT JOIN encounters e ON p.patient_id = e.patient_id""",
    "outreach_report_rows": "SELECT * FROM report_rows",
    "report_summary": """
        SELECT count(*) AS patients_identified, count(*) FILTER (WHERE risk_score > 0.7e0) AS high_risk,
               count(*) FILTER (WHERE transportation_barrier) AS transportation_barriers,
               count(*) FILTER (WHERE housing_instability) AS housing_instability
        FROM report_rows""",
    "report_document": _document("report_sections"),
    "sink_roundtrip_overwrite": "SELECT * EXCLUDE (facility) FROM readmissions",
    "weekly_report_append": f"""
        SELECT w.day AS report_date, count(*) AS patients,
               count(*) FILTER (WHERE r.tier = 'TIER 1') AS tier_1
        FROM (VALUES ({DAY}), ({DAY} - 7)) w(day)
             JOIN (SELECT DISTINCT day, patient_id
                   FROM (VALUES ({DAY}), ({DAY} - 7)) v(day) JOIN encounters
                        ON discharge_date >= day - 7 AND discharge_date <= day) d ON d.day = w.day
             JOIN report_rows r ON r.patient_id = d.patient_id
        GROUP BY w.day""",
    "judge_clinical_accuracy": """
        SELECT answer_id, clinical_accuracy, fact_coverage,
               CASE WHEN coverage < 0.3 THEN 'Missing most expected clinical facts'
                    WHEN coverage < 0.6 THEN 'Missing some key clinical facts'
                    WHEN coverage < 0.8 THEN 'Most clinical facts present'
                    ELSE 'All key clinical facts present' END
               || CASE WHEN terms < 2 THEN '; Limited use of clinical terminology' ELSE '' END
                 AS clinical_rationale
        FROM judged""",
    "judge_completeness": """
        SELECT answer_id, completeness, sources_mentioned,
               CASE WHEN sources_mentioned < 2 THEN 'Very limited data source coverage'
                    WHEN sources_mentioned < 4 THEN 'Some data sources checked'
                    WHEN sources_mentioned < 6 THEN 'Good data source coverage'
                    ELSE 'Comprehensive data source coverage' END AS completeness_rationale
        FROM judged""",
    "judge_actionability": """
        SELECT answer_id, actionability, actionable_elements,
               CASE WHEN actionable_elements < 2 THEN 'Limited actionable guidance'
                    WHEN actionable_elements < 3 THEN 'Some actionable elements'
                    WHEN actionable_elements < 4 THEN 'Good actionable recommendations'
                    ELSE 'Highly actionable with clear next steps' END AS actionability_rationale
        FROM judged""",
    "judge_privacy": f"""
        SELECT answer_id, CASE WHEN violations = '' THEN 'PASS' ELSE 'FAIL' END AS privacy,
               CASE WHEN violations = '' THEN {_found(_GREEN)} END AS compliance_indicators, violations,
               CASE WHEN violations = ''
                    THEN 'No HIPAA violations detected; data stays within Databricks'
                    ELSE 'Potential HIPAA violation: ' || replace(violations, '; ', ', ') END
                 AS privacy_rationale
        FROM (SELECT *, concat_ws('; ', {', '.join(
            f"CASE WHEN contains(txt, {_quoted(w)}) THEN {_quoted(w)} END" for w in _RED)})
              AS violations FROM texts)""",
    "judge_averages": _averages("variant"),
    "judge_by_complexity": _averages("variant, complexity"),
    "judge_compare": """
        , means AS (
          SELECT variant, avg(clinical_accuracy) AS clinical_accuracy, avg(completeness) AS completeness,
                 avg(actionability) AS actionability,
                 (avg(clinical_accuracy) + avg(completeness) + avg(actionability)) / 3 AS overall
          FROM judged GROUP BY variant),
        lines AS (
          SELECT variant, unnest(['clinical_accuracy', 'completeness', 'actionability', 'overall'])
                   AS judge,
                 unnest([clinical_accuracy, completeness, actionability, overall]) AS mean FROM means)
        SELECT b.judge, round(b.mean, 4) AS basic, round(i.mean, 4) AS improved,
               round(i.mean - b.mean, 4) AS improvement,
               round((i.mean - b.mean) / b.mean * 100, 2) AS improvement_pct,
               CASE WHEN i.mean > b.mean THEN 'improved' ELSE 'basic' END AS winner
        FROM lines b JOIN lines i ON b.judge = i.judge
        WHERE b.variant = 'basic' AND i.variant = 'improved'""",
    "judge_low_scores": """
        SELECT answer_id, variant, request_id, request, clinical_accuracy, completeness, actionability
        FROM judged WHERE clinical_accuracy < 3 OR completeness < 3 OR actionability < 3""",
    "questions_by_complexity": """
        SELECT complexity, count(DISTINCT request_id) AS questions, count(*) AS answers
        FROM texts GROUP BY complexity""",
    "sample_per_complexity": """
        SELECT complexity, request_id, request, answer_id,
               cast(length(response) AS int) AS response_chars
        FROM texts
        QUALIFY row_number() OVER (PARTITION BY complexity ORDER BY request_id, answer_id) = 1""",
    "fact_tool_explode": """
        , asked AS (SELECT q.*, (SELECT count(*) FROM given g WHERE g.request_id = q.request_id) AS n
                    FROM questions q)
        SELECT kind, item, count(DISTINCT request_id) AS questions, cast(sum(n) AS bigint) AS answers
        FROM (SELECT 'fact' AS kind, request_id, n, unnest(expected_facts) AS item FROM asked
              UNION ALL
              SELECT 'tool', request_id, n, unnest(expected_tools) FROM asked)
        GROUP BY kind, item""",
    "query_log_usage": r"""
        SELECT trim(regexp_replace(lower(request), '[ \t\r\n]+', ' ', 'g')) AS request_text,
               count(*) AS times_asked, count(DISTINCT conv_id) AS conversations
        FROM user_turns GROUP BY 1""",
    "error_answers": """
        SELECT variant, count(*) AS answers, count(*) FILTER (WHERE response LIKE 'Error:%') AS errors
        FROM given GROUP BY variant""",
    "sample_n_without_replacement": f"SELECT patient_id FROM {_SAMPLE}",
    "weighted_bucket_assign": f"""
        SELECT patient_id,
               CASE WHEN u < 60 THEN 'White' WHEN u < 73 THEN 'Black or African American'
                    WHEN u < 91 THEN 'Hispanic or Latino' WHEN u < 97 THEN 'Asian' ELSE 'Other' END
                 AS assigned_group
        FROM (SELECT patient_id, {_draw('outreach', 'patient_id')} / 4294967296.0 * 100 AS u
              FROM patients)""",
    "cohort_exclusion": f"""
        SELECT patient_id FROM patients WHERE patient_id NOT IN (SELECT patient_id FROM {_SAMPLE})
        ORDER BY {_draw('second', 'patient_id')}, patient_id LIMIT 100""",
    "cohort_mark_first_n": f"""
        SELECT readmission_id, original_discharge_date,
               row_number() OVER (ORDER BY original_discharge_date < {DAY} - 90,
                                  {_draw('outreach', 'readmission_id')}, readmission_id) <= 32 AS marked
        FROM readmissions""",
    "risk_histogram": """
        SELECT risk_category, cast(floor(risk_score * 10) + 1 AS int) AS bin, count(*) AS patients,
               min(risk_score) AS lowest, max(risk_score) AS highest
        FROM risk_scores GROUP BY 1, 2""",
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("patients", "encounters", "diagnoses", "risk_scores", "sdoh", "care_coordinators")),
    "check_planted_counts": f"""
        SELECT (SELECT count(*) FROM encounters WHERE discharge_date >= {DAY} - 7) AS recent_discharges,
               (SELECT count(*) FROM chf) AS chf_patients, (SELECT count(*) FROM copd) AS copd_patients,
               (SELECT count(*) FROM risk_scores WHERE risk_score > 0.7e0) AS high_risk,
               (SELECT count(*) FROM readmissions WHERE is_30_day) AS readmissions_30d,
               (SELECT count(*) FROM sdoh WHERE transportation_barrier) AS transportation_barriers,
               (SELECT count(*) FROM sdoh WHERE housing_instability) AS housing_instability,
               (SELECT count(*) FROM free_coordinators
                WHERE contains(specialties, 'CHF') OR contains(specialties, 'COPD'))
                 AS specialist_coordinators""",
    "check_referential": " UNION ALL ".join(
        [f"SELECT '{label}' AS check_name, count(*) AS violations FROM {child}"
         f" WHERE {key} NOT IN (SELECT {key} FROM {parent})"
         for label, child, parent, key in (
             ("encounter_without_patient", "encounters", "patients", "patient_id"),
             ("diagnosis_without_encounter", "diagnoses", "encounters", "encounter_id"),
             ("risk_score_without_patient", "risk_scores", "patients", "patient_id"),
             ("sdoh_without_patient", "sdoh", "patients", "patient_id"))]
        + [f"SELECT '{label}', count(*) FROM"
           f" (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)"
           for label, table, key in (
               ("duplicate_patient", "patients", "patient_id"),
               ("duplicate_encounter", "encounters", "encounter_id"),
               ("duplicate_diagnosis", "diagnoses", "diagnosis_id"),
               ("duplicate_risk_score", "risk_scores", "patient_id"),
               ("duplicate_sdoh", "sdoh", "patient_id"),
               ("duplicate_coordinator", "care_coordinators", "coordinator_id"))]),
    "check_capacity_consistent": """
        SELECT 'capacity' AS check_name, count(*) AS checked,
               count(*) FILTER (WHERE available_capacity <> max_caseload - current_caseload)
                 AS violations
        FROM care_coordinators
        UNION ALL
        SELECT 'discharge_date', count(*),
               count(*) FILTER (WHERE discharge_date <> admission_date + length_of_stay) FROM encounters
        UNION ALL
        SELECT 'discharge_before_admission', count(*),
               count(*) FILTER (WHERE discharge_date < admission_date) FROM encounters""",
    "q_01": "SELECT count(DISTINCT patient_id) AS patients FROM discharged_7",
    "q_02": "SELECT * FROM free_coordinators",
    "q_03": "SELECT count(*) AS patients FROM chf",
    "q_04": """
        SELECT patient_id, mrn, first_name || ' ' || last_name AS patient_name, age, gender
        FROM patients WHERE patient_id IN (SELECT patient_id FROM copd)""",
    "q_05": f"""
        SELECT patient_id, {_RISK_COLUMNS} FROM risk_scores WHERE patient_id = 'patient-000001'""",
    "q_06": f"""
        SELECT {_RECENT_COLUMNS} FROM encounters e JOIN patients p ON e.patient_id = p.patient_id
        WHERE e.discharge_date BETWEEN {DAY} - 3 AND {DAY}""",
    "q_07": f"""
        SELECT {_RECENT_COLUMNS} FROM discharged_7 e JOIN patients p ON e.patient_id = p.patient_id
        WHERE e.patient_id IN (SELECT patient_id FROM chf)""",
    "q_08": """
        SELECT count(*) AS patients
        FROM copd JOIN sdoh ON copd.patient_id = sdoh.patient_id WHERE transportation_barrier""",
    "q_09": "SELECT * FROM free_coordinators WHERE contains(specialties, 'CHF')",
    "q_10": """
        SELECT patient_id, risk_score, risk_category FROM risk_scores WHERE risk_score > 0.7e0""",
    "q_11": """
        SELECT count(DISTINCT patient_id) AS patients FROM readmissions
        WHERE patient_id IN (SELECT patient_id FROM chf)""",
    "q_12": """
        , sick AS (SELECT s.* FROM sdoh s JOIN chf ON s.patient_id = chf.patient_id
                     JOIN risk_scores r ON s.patient_id = r.patient_id WHERE r.risk_score > 0.7e0)
        """ + _barrier_counts("sick"),
    "q_13": f"""
        SELECT {_RECENT_COLUMNS} FROM discharged_7 e JOIN patients p ON e.patient_id = p.patient_id
             JOIN sdoh s ON s.patient_id = p.patient_id WHERE s.housing_instability""",
    "q_14": """
        SELECT count(*) AS patients FROM readmitted_30
        WHERE patient_id IN (SELECT patient_id FROM discharged_7)""",
    "q_15": f"""
        SELECT o.patient_id, o.last_discharge, o.risk_score, o.priority_score, o.tier,
               {', '.join('o.' + f for f in _FLAGS)}, a.priority_rank, a.specialty, a.coordinator_id,
               a.coordinator_name, a.match_quality
        FROM outreach o JOIN assigned_7 a ON o.patient_id = a.patient_id""",
    "q_16": "SELECT * FROM assigned_all",
    "q_17": ", chosen AS (SELECT s.* REPLACE (s.section || chr(10) || '- **Care Coordinator:** '"
            " || coalesce(a.coordinator_name, 'unassigned') AS section)"
            " FROM report_sections s JOIN assigned_7 a"
            " ON s.patient_id = a.patient_id)" + _document("chosen"),
    "q_18": "SELECT * FROM assigned_chf",
    "q_19": """
        SELECT s.patient_id, k.risk_score, s.transportation_barrier, s.housing_instability,
               concat_ws('; ', 'Post-discharge follow-up',
                         CASE WHEN s.transportation_barrier THEN 'Arrange transportation' END,
                         CASE WHEN s.housing_instability THEN 'Refer to housing support' END)
                 AS interventions
        FROM sdoh s JOIN copd ON s.patient_id = copd.patient_id
             JOIN readmitted_30 r ON s.patient_id = r.patient_id
             LEFT JOIN risk_scores k ON s.patient_id = k.patient_id
        WHERE s.transportation_barrier OR s.housing_instability""",
    "q_20": f"""
        SELECT patient_id, priority_score, priority_rank,
               {_HOURS.format('priority_score')} AS contact_within_hours, specialty, coordinator_id,
               coordinator_name, match_quality
        FROM assigned_high""",
    "diabetes_and_readmitted": """
        SELECT count(DISTINCT patient_id) AS patients FROM readmissions
        WHERE patient_id IN (SELECT patient_id FROM dx WHERE icd10_code LIKE 'E11%')""",
    "high_risk_barrier_counts": """
        , sick AS (SELECT s.* FROM sdoh s JOIN risk_scores r ON s.patient_id = r.patient_id
                   WHERE r.risk_score > 0.7e0)
        """ + _barrier_counts("sick"),
    "risk_above_08": """
        SELECT patient_id, risk_score, risk_category FROM risk_scores WHERE risk_score > 0.8e0""",
    "risk_by_mrn": f"""
        SELECT p.mrn, {_RISK_COLUMNS} FROM risk_scores r JOIN patients p ON r.patient_id = p.patient_id""",
    "sdoh_by_mrn": f"""
        SELECT p.mrn, {_SDOH_COLUMNS} FROM sdoh s JOIN patients p ON s.patient_id = p.patient_id""",
    "adt_stream_daily": """
        SELECT cast(ts AS date) AS day, adt_type, count(*) AS messages FROM adt_feed
        WHERE cast(cast(ts AS date) + 1 AS timestamp)
              <= (SELECT max(ts) FROM adt_feed) - INTERVAL 1 HOUR
        GROUP BY 1, 2""",
    "adt_stream_dedup": """
        SELECT adt_type, count(*) AS messages, min(event_id) AS first_event,
               max(event_id) AS last_event
        FROM adt_feed GROUP BY adt_type""",
    "adt_stream_enrich": """
        SELECT f.event_id, f.patient_id, f.adt_type, p.mrn, r.risk_score, r.risk_category
        FROM adt_feed f LEFT JOIN patients p ON f.patient_id = p.patient_id
             LEFT JOIN risk_scores r ON f.patient_id = r.patient_id""",
    "risk_incremental": f"""
        SELECT {_PRIORITY_COLUMNS} FROM priority
        WHERE patient_id IN (SELECT patient_id FROM adt_feed)""",
    "table_as_select": """
        SELECT readmission_id, patient_id, days_between, days_between <= 7 AS within_week
        FROM readmissions WHERE days_between <= 20""",
    "risk_table_merge": f"""
        , counts AS (SELECT patient_id, count(*) FILTER (WHERE adt_type = 'admit') AS admits, count(*) AS messages,
                            cast(max(ts) AS date) AS last_day FROM adt_feed GROUP BY patient_id),
        raised AS (SELECT coalesce(r.patient_id, c.patient_id) AS patient_id,
                          least(1e0, round(coalesce(risk_score, 0e0) + coalesce(admits, 0) * 0.02e0, 3)) AS risk_score,
                          messages, last_day
                   FROM (SELECT patient_id, risk_score FROM risk_scores) r
                        FULL JOIN counts c ON r.patient_id = c.patient_id)
        SELECT patient_id, risk_score, coalesce(messages, 0) AS messages,
               {_TIER.format("risk_score")} AS tier, last_day FROM raised""",
    "adt_daily_corrected": """
        SELECT cast(ts AS date) AS day, adt_type, count(*) AS messages FROM adt_feed GROUP BY 1, 2""",
    "adt_replay_once": """
        SELECT adt_type, count(*) AS messages, count(DISTINCT event_id) AS events
        FROM adt_feed GROUP BY adt_type""",
    "adt_latest_risk": """
        SELECT m.event_id, m.patient_id, m.adt_type,
               (SELECT arg_max(u.value, (u.ts, u.event_id)) FROM adt_feed u
                WHERE u.adt_type = 'update' AND u.patient_id = m.patient_id AND u.ts <= m.ts
                      AND u.ts > m.ts - INTERVAL 3 DAY) AS risk_score
        FROM adt_feed m WHERE m.adt_type <> 'update'""",
    "distinct_patients_rollup": """
        SELECT strftime(discharge_date, '%Y-%m') AS discharge_month, facility,
               cast(grouping_id(strftime(discharge_date, '%Y-%m'), facility) AS int) AS level,
               count(DISTINCT patient_id) AS patients, true AS estimate_within_bound
        FROM encounters WHERE discharge_date IS NOT NULL
        GROUP BY ROLLUP (strftime(discharge_date, '%Y-%m'), facility)""",
    "request_heavy_words": r"""
        , words AS (SELECT unnest(string_split(trim(regexp_replace(lower(request), '[ \t\r\n]+', ' ', 'g')), ' ')) AS word
                    FROM user_turns)
        SELECT word, count(*) AS times FROM words GROUP BY word
        HAVING count(*) > 0.01e0 * (SELECT count(*) FROM words)""",
    "dx_description_index": """
        SELECT literal, case_blind, icd10_code, description, count(*) AS diagnosis_rows
        FROM diagnoses JOIN (VALUES ('heart failure', true), ('Heart Failure', false), ('2', true), (', UNSPEC', true))
                            v(literal, case_blind)
             ON CASE WHEN case_blind THEN contains(lower(description), lower(literal))
                     ELSE contains(description, literal) END
        GROUP BY ALL""",
    "code_group_counts": """
        , groups AS (
            SELECT DISTINCT substr(icd10_code, 1, n) AS prefix, label
            FROM diagnoses, (VALUES (1, 'chapter'), (3, 'category'), (20, 'code')) v(n, label))
        SELECT g.prefix, g.label, count(*) AS diagnosis_rows, count(DISTINCT patient_id) AS patients
        FROM groups g JOIN dx ON dx.icd10_code LIKE g.prefix || '%' GROUP BY g.prefix, g.label""",
    "sql_table_functions": f"""
        SELECT 'get_recent_discharges' AS function, count(*) AS rows, count(DISTINCT encounter_id) AS found
        FROM encounters WHERE discharge_date >= {DAY} - 30
        UNION ALL SELECT 'get_diagnoses_by_condition', count(*), count(DISTINCT encounter_id || icd10_code)
        FROM (SELECT DISTINCT encounter_id, icd10_code, description, is_primary, diagnosis_date FROM dx
              WHERE icd10_code LIKE 'J44%')
        UNION ALL SELECT 'get_patient_readmission_history', count(*), count(DISTINCT readmission_id) FROM readmissions
        UNION ALL SELECT 'get_risk_score', count(*), count(DISTINCT risk_category) FROM risk_scores
        UNION ALL SELECT 'get_sdoh_barriers', count(*), count(DISTINCT housing_instability) FROM sdoh
        UNION ALL SELECT 'get_available_care_coordinators', count(*), count(DISTINCT coordinator_id)
        FROM care_coordinators WHERE active AND available_capacity > 0 AND contains(specialties, 'COPD')
        UNION ALL SELECT 'suggest_coordinator_for_patient', count(*), count(*)
        FROM (SELECT 1 FROM care_coordinators WHERE active AND available_capacity > 0 LIMIT 1)
        UNION ALL SELECT 'calculate_priority_score', count(*), count(DISTINCT recommendations) FROM priority
        UNION ALL SELECT 'generate_outreach_report', count(*), count(DISTINCT {_TIER.format("r.risk_score")})
        FROM patients LEFT JOIN risk_scores r USING (patient_id)""",
    "toolbox_calls": f"""
        , forty AS (SELECT patient_id FROM patients WHERE patient_id BETWEEN 'patient-000001' AND 'patient-000040'
                   AND length(patient_id) = 14)
        SELECT 'get_recent_discharges' AS tool, count(*) AS rows FROM encounters WHERE discharge_date >= {DAY} - 30
        UNION ALL SELECT 'get_diagnoses_by_condition', count(*)
        FROM (SELECT DISTINCT encounter_id, icd10_code, description, is_primary, diagnosis_date FROM dx
              WHERE icd10_code LIKE 'I50%')
        UNION ALL SELECT 'get_patient_readmission_history', count(*) FROM readmissions JOIN forty USING (patient_id)
        UNION ALL SELECT 'get_risk_score', count(*) FROM risk_scores JOIN forty USING (patient_id)
        UNION ALL SELECT 'get_sdoh_barriers', count(*) FROM sdoh JOIN forty USING (patient_id)
        UNION ALL SELECT 'get_available_care_coordinators', count(*)
        FROM care_coordinators WHERE active AND available_capacity > 0 AND contains(specialties, 'CHF')
        UNION ALL SELECT 'suggest_coordinator_for_patient', count(*)
        FROM (SELECT 1 FROM care_coordinators WHERE active AND available_capacity > 0 LIMIT 1)
        UNION ALL SELECT 'calculate_priority_score', count(*) FROM forty
        UNION ALL SELECT 'assign_care_coordinator', count(*) FROM patients
        UNION ALL SELECT 'generate_outreach_report', 2 + count(DISTINCT {_TIER.format("r.risk_score")})
        FROM forty LEFT JOIN risk_scores r USING (patient_id)""",
    "ingest_quarantine": """
        SELECT 'stays' AS source, CASE k % 50 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'missing patient_id'
                    WHEN 3 THEN 'bad admission_date' ELSE 'accepted' END AS outcome,
               count(*) AS lines, count(*) FILTER (WHERE k % 50 = 4) AS drifted
        FROM (SELECT cast(substr(encounter_id, 11) AS bigint) AS k FROM encounters) GROUP BY 1, 2
        UNION ALL
        SELECT 'messages', CASE event_id % 40 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'bad ts'
                    ELSE 'accepted' END, count(*), 0 FROM adt_feed GROUP BY 1, 2""",
}


def _complete(sql: str) -> str:
    """A query may open with further relations of its own, written ``, name AS (…)``."""
    full = _oracle(sql)
    return re.sub(r"\n\s*,\s+", ",\n", full, count=1) if sql.lstrip().startswith(",") else full


ORACLES: dict[str, str] = {key: _complete(sql) for key, sql in _SQL.items()}
