"""Outreach report rows, summary counts and report text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardlight.functions.columns import patient_name, tier_label, two_decimals
from wardlight.operators.lookups import latest_sdoh, only_patients, risk_score_lookup
from wardlight.operators.ordering import ranked
from wardlight.schema import HIGH_RISK, TIER_1
from wardlight.session import settled
from wardlight.sources.clinical import ClinicalTables

# Marks and phrases of the report.
TIER_MARKS = {"TIER 1": "🔴", "TIER 2": "🟡", "TIER 3": "🟢"}
TRANSPORT_TEXT = "🚗 Transportation"
HOUSING_TEXT = "🏠 Housing"
NO_BARRIER_TEXT = "None identified"
ACTION_TIER_1 = "Contact within 24h"
ACTION_OTHER = "Contact within 48h"
UNASSIGNED = "unassigned"
NEXT_STEPS = (
    "Assign care coordinators to Tier 1 patients immediately",
    "Schedule outreach calls within recommended timeframes",
    "Address transportation and housing barriers with social services",
    "Document all interventions in the care management system",
)


def latest_encounter(tables: ClinicalTables, patients: DataFrame | None = None) -> DataFrame:
    """Latest discharge per patient up to the reference day.

    An aggregate, so long histories combine map-side.
    """
    past = tables.encounters.where(F.col("discharge_date") < F.date_add(tables.today(), 1))
    latest = F.max_by(F.struct("discharge_date", "facility"),
                      F.struct("discharge_date", "encounter_id"))
    return (only_patients(past, patients)
            .groupBy("patient_id").agg(latest.alias("latest"))
            .select("patient_id", "latest.discharge_date", "latest.facility"))


def _patient_picture(tables: ClinicalTables, patients: DataFrame | None) -> DataFrame:
    people = only_patients(tables.patients, patients).select(
        "patient_id", "mrn", patient_name().alias("patient_name"), "age")
    risk = risk_score_lookup(tables, patients).drop("last_calculated")
    social = latest_sdoh(tables, patients).select(
        "patient_id", "housing_instability", "transportation_barrier")
    return people.join(risk, "patient_id", "left").join(social, "patient_id", "left")


def outreach_rows_fanout(tables: ClinicalTables, patients: DataFrame | None = None) -> DataFrame:
    """One row per patient and encounter, patients without encounters included.

    A left join cannot be split where one patient has very many encounters,
    an inner join can; patients without any are added from an anti-join.
    """
    stays = only_patients(tables.encounters, patients).select(
        "patient_id", "discharge_date", "facility")
    picture = _patient_picture(tables, patients)
    alone = picture.join(stays.select("patient_id").distinct(), "patient_id", "left_anti")
    rows = picture.join(stays, "patient_id").unionByName(alone, allowMissingColumns=True)
    return rows.select(
        "patient_id", "mrn", "patient_name", "age", "risk_score", "risk_category", "risk_factors",
        "housing_instability", "transportation_barrier", "discharge_date", "facility")


def barriers_text() -> Column:
    named = F.concat_ws(", ", F.when(F.col("transportation_barrier"), TRANSPORT_TEXT),
                        F.when(F.col("housing_instability"), HOUSING_TEXT))
    return F.when(named == "", NO_BARRIER_TEXT).otherwise(named)


def outreach_report_rows(tables: ClinicalTables, patients: DataFrame | None = None) -> DataFrame:
    """One row per patient: picture, last discharge, tier and action by risk score."""
    return report_columns(_patient_picture(tables, patients).join(
        latest_encounter(tables, patients), "patient_id", "left"))


def report_columns(picture: DataFrame, *keep: str) -> DataFrame:
    """The report's columns, and some to keep, from who a patient is, risk, barriers and last stay."""
    return picture.select(
        "patient_id", "mrn", "patient_name", "age", "risk_score", "risk_category",
        F.col("discharge_date").alias("last_discharge"), "facility",
        F.coalesce("transportation_barrier", F.lit(False)).alias("transportation_barrier"),
        F.coalesce("housing_instability", F.lit(False)).alias("housing_instability"),
        barriers_text().alias("barriers"),
        tier_label(F.col("risk_score")).alias("tier"),
        F.when(F.col("risk_score") > TIER_1, ACTION_TIER_1).otherwise(ACTION_OTHER).alias("action"),
        *keep)


def report_summary(report_rows: DataFrame) -> DataFrame:
    """The executive counts, over patients."""
    return report_rows.agg(
        F.count(F.lit(1)).alias("patients_identified"),
        F.count_if(F.col("risk_score") > HIGH_RISK).alias("high_risk"),
        F.count_if("transportation_barrier").alias("transportation_barriers"),
        F.count_if("housing_instability").alias("housing_instability"))


def section_text(number: Column | None = None, coordinator: Column | None = None) -> Column:
    """The report's paragraph about one patient, with the coordinator if there is a column of them."""
    mark = F.coalesce(*(F.when(F.col("tier") == t, m) for t, m in TIER_MARKS.items()))
    lead = F.lit("### ") if number is None else F.concat(F.lit("### "), number.cast("string"), F.lit(". "))
    risk = F.when(F.col("risk_score").isNull(), "not scored").otherwise(
        F.concat(two_decimals(F.col("risk_score")), F.lit(" ("), "risk_category", F.lit(")")))
    discharge = F.when(F.col("last_discharge").isNull(), "none").otherwise(
        F.concat(F.date_format("last_discharge", "yyyy-MM-dd"), F.lit(" from "), "facility"))
    return F.concat(
        lead, "patient_name", F.lit(" (MRN: "), "mrn", F.lit(") - "), mark, F.lit(" "), "tier",
        F.lit("\n\n- **Age:** "), F.col("age").cast("string"),
        F.lit("\n- **Risk Score:** "), risk,
        F.lit("\n- **Last Discharge:** "), discharge,
        F.lit("\n- **Social Barriers:** "), "barriers",
        F.lit("\n- **Recommended Action:** "), "action",
        *([F.lit("\n- **Care Coordinator:** "), coordinator] if coordinator is not None else []))


def numbered_rows(report_rows: DataFrame) -> DataFrame:
    """Report rows with their place in the report: score falling, unscored last."""
    return ranked(report_rows, "place", [F.desc_nulls_last("risk_score"), F.col("patient_id")])


def report_document(tables: ClinicalTables, patients: DataFrame | None = None,
                    page_size: int = 100, title: str = "Care Coordination Outreach Report",
                    assignments: DataFrame | None = None) -> DataFrame:
    """The report as numbered parts: head with summary, pages of patients by tier, next steps.

    Read in order of ``part`` the texts form one document. Pages keep the
    group that is concatenated small however many patients are reported; a tier
    begins on a page of its own. The ranked rows are settled first, and their
    counts per tier, three at most, fix the number of pages. With
    ``assignments`` (patient_id, coordinator_name) each patient's coordinator,
    or that there is none, is reported too.
    """
    rows = outreach_report_rows(tables, patients)
    coordinator = None
    if assignments is not None:
        rows = rows.join(assignments.select("patient_id", "coordinator_name"), "patient_id", "left")
        coordinator = F.coalesce("coordinator_name", F.lit(UNASSIGNED))
    rows = numbered_rows(settled(rows, "report"))
    per_tier = {r["tier"]: r for r in rows.groupBy("tier").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).collect()}
    counts = report_summary(rows).first()

    part, pages_before = F.lit(0), 0
    for tier in TIER_MARKS:
        if tier in per_tier:
            page = F.floor((F.col("place") - per_tier[tier]["first"]) / page_size) + 1 + pages_before
            part = F.when(F.col("tier") == tier, page).otherwise(part)
            pages_before += -(-per_tier[tier]["n"] // page_size)
    sections = F.array_sort(F.collect_list(F.struct(
        "place", section_text(F.col("place"), coordinator).alias("text"))))
    heads = {r["first"]: f"## {TIER_MARKS[t]} {t} ({r['n']})\n\n" for t, r in per_tier.items()}
    heading = F
    for first, text in heads.items():
        heading = heading.when(F.min("place") == first, text)
    pages = rows.groupBy(part.cast("int").alias("part")).agg(
        F.count(F.lit(1)).alias("patients"),
        F.concat(heading.otherwise("") if heads else F.lit(""), F.array_join(
            F.transform(sections, lambda s: s["text"]), "\n\n")).alias("document"))

    head = (f"# 🏥 {title}\n\n**Generated:** {tables.as_of.isoformat()}\n"
            f"**Patients Identified:** {counts['patients_identified']}"
            "\n\n---\n\n## 📊 Executive Summary\n\n"
            f"- **High-Risk Patients:** {counts['high_risk']}\n"
            f"- **Transportation Barriers:** {counts['transportation_barriers']}\n"
            f"- **Housing Instability:** {counts['housing_instability']}"
            "\n\n---\n\n## 👥 Patient List (Priority Order)")
    steps = "\n".join(f"{n}. {text}" for n, text in enumerate(NEXT_STEPS, start=1))
    outer = tables.spark.createDataFrame(
        [(0, 0, head), (pages_before + 1, 0, f"---\n\n## 📝 Next Steps\n\n{steps}")],
        "part int, patients bigint, document string")
    return outer.unionByName(pages)
