"""Every named query: key -> plan over the clinical tables.

List columns are joined to text here, at the outer edge, so that results
compare by value everywhere; the operators themselves return arrays.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from wardlight.functions.columns import (
    patient_name, tier_label, two_decimals)
from wardlight.operators import (
    assign, checks, cohorts, judges, lookups, priority, readmit, report, sampling)
from wardlight.plans import flagship, questions, upkeep
from wardlight.session import scratch_path, settled
from wardlight.sources.clinical import ClinicalTables
from wardlight.sources.fixtures import SOURCE_SCHEMAS, mapped_columns
from wardlight.sources.sinks import append_report, overwrite
from wardlight.streaming import adt

SEED = "outreach"
# Population shares used as weights.
RACE_WEIGHTS = {"White": 60, "Black or African American": 13, "Hispanic or Latino": 18,
                "Asian": 6, "Other": 3}
SAMPLE_SIZE = 100
MARKED = 32


def _joined(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.concat_ws("; ", F.col(c)) for c in columns})


# ---- sinks -------------------------------------------------------------

def sink_roundtrip_overwrite(t: ClinicalTables) -> DataFrame:
    """Write readmissions twice to one place with different schemas, read the second back."""
    path = f"{scratch_path(t.spark, 'roundtrip')}/readmissions"
    pairs = readmit.readmission_pairs(t)
    overwrite(pairs.select("readmission_id", "days_between"), path)
    overwrite(pairs, path)
    return t.spark.read.schema(pairs.schema).parquet(path)


def weekly_report_append(t: ClinicalTables) -> DataFrame:
    """Reports of two weeks kept in one place; lines and high-risk lines per date."""
    path = f"{scratch_path(t.spark, 'weekly')}/reports"
    for day in (t.as_of - dt.timedelta(days=7), t.as_of):
        week = t.at(day)
        rows = report.outreach_report_rows(week, cohorts.recently_discharged(week, 7))
        append_report(rows, path, day)
    return (t.spark.read.parquet(path).groupBy("report_date")
            .agg(F.count(F.lit(1)).alias("patients"),
                 F.count_if(F.col("tier") == "TIER 1").alias("tier_1")))


# ---- projections, filters, sets ----------------------------------------

def dx_description_search(t: ClinicalTables) -> DataFrame:
    """Diagnoses that name heart failure, and which of them a case-sensitive search finds."""
    exact = F.col("description").contains("Heart Failure")
    return (t.diagnoses.where(F.lower("description").contains("heart failure"))
            .groupBy("icd10_code", "description")
            .agg(F.count(F.lit(1)).alias("diagnosis_rows"),
                 F.count_if(exact).alias("found_case_sensitive")))


def scalar_projection(t: ClinicalTables) -> DataFrame:
    """Name, padding, dates, rounding, list decoding and tiers for every scored patient."""
    score = F.col("risk_score")
    factors = F.from_json("risk_factors", "array<string>")
    return (t.risk_scores.join(t.patients, "patient_id").select(
        "patient_id",
        patient_name().alias("patient_name"),
        F.upper("last_name").alias("upper_name"),
        F.lpad(F.col("age").cast("string"), 7, "0").alias("padded_age"),
        F.date_sub(t.today(), 7).alias("week_ago"),
        F.date_add("last_calculated", 30).alias("recalculate_on"),
        F.datediff(t.today(), "last_calculated").alias("days_old"),
        F.date_format("last_calculated", "yyyy-MM-dd").alias("calculated_text"),
        F.round(score * 0.6, 3).alias("weighted"),
        F.least(score + 0.5, F.lit(1.0)).alias("capped"),
        two_decimals(score).alias("score_text"),
        F.size(factors).alias("factor_count"),
        F.array_contains(factors, "Polypharmacy").alias("polypharmacy"),
        F.array_join(factors, ", ").alias("factor_text"),
        F.col("mrn").startswith("MRN1").alias("mrn_starts_1"),
        tier_label(score).alias("tier")))


def cohort_set_ops(t: ClinicalTables) -> DataFrame:
    chf, copd = cohorts.with_condition(t, "CHF"), cohorts.with_condition(t, "COPD")
    sets = {"both": cohorts.both(chf, copd), "either": cohorts.either(chf, copd),
            "chf_only": cohorts.without(chf, copd)}
    parts = [frame.agg(F.count(F.lit(1)).alias("patients")).select(F.lit(name).alias("cohort"), "patients")
             for name, frame in sets.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- sampling ----------------------------------------------------------

def sample_n_without_replacement(t: ClinicalTables) -> DataFrame:
    return sampling.sample_n(t.patients.select("patient_id"), "patient_id", SAMPLE_SIZE, SEED)


def cohort_exclusion(t: ClinicalTables) -> DataFrame:
    """A second sample from the patients the first one left."""
    everyone = t.patients.select("patient_id")
    first = sampling.sample_n(everyone, "patient_id", SAMPLE_SIZE, SEED)
    return sampling.sample_rest(everyone, first, "patient_id", SAMPLE_SIZE, "second")


def weighted_bucket_assign(t: ClinicalTables) -> DataFrame:
    return sampling.weighted_bucket(t.patients.select("patient_id"), "patient_id", RACE_WEIGHTS,
                                    SEED, "assigned_group")


def cohort_mark_first_n(t: ClinicalTables) -> DataFrame:
    """Readmission pairs with a fixed number flagged, those after recent discharges first."""
    recent = F.col("original_discharge_date") >= F.date_sub(t.today(), 90)
    pairs = settled(readmit.readmission_pairs(t).select(
        "readmission_id", "original_discharge_date"), "pairs")
    return sampling.mark_first_n(pairs, "readmission_id", MARKED, recent, SEED, "marked")


# ---- judges ------------------------------------------------------------

def _scores(t: ClinicalTables) -> DataFrame:
    return judges.score_answers(judges.all_answers(t))


def judge_clinical_accuracy(t: ClinicalTables) -> DataFrame:
    return judges.add_clinical_accuracy(judges.all_answers(t)).select(
        "answer_id", "clinical_accuracy", "fact_coverage", "clinical_rationale")


def judge_completeness(t: ClinicalTables) -> DataFrame:
    return judges.add_completeness(judges.all_answers(t)).select(
        "answer_id", "completeness", "sources_mentioned", "completeness_rationale")


def judge_actionability(t: ClinicalTables) -> DataFrame:
    return judges.add_actionability(judges.all_answers(t)).select(
        "answer_id", "actionability", "actionable_elements", "actionability_rationale")


def judge_privacy(t: ClinicalTables) -> DataFrame:
    return _joined(judges.add_privacy(judges.all_answers(t)).select(
        "answer_id", "privacy", "compliance_indicators", "violations", "privacy_rationale"),
        "violations")


# ---- streaming ---------------------------------------------------------

def _feed_columns(stream: DataFrame) -> DataFrame:
    return stream.selectExpr(*mapped_columns("adt_feed"))


def adt_feed_stream(t: ClinicalTables, sf_dir: str) -> DataFrame:
    return _feed_columns(adt.read_feed(t.spark, sf_dir, SOURCE_SCHEMAS["events"], "events.parquet"))


def adt_stream_daily(t: ClinicalTables, sf_dir: str) -> DataFrame:
    return adt.drained(t.spark, adt.daily_counts(adt_feed_stream(t, sf_dir)), "daily")


def adt_stream_dedup(t: ClinicalTables, sf_dir: str) -> DataFrame:
    """Every message sent twice, counted once, per type."""
    feed = adt_feed_stream(t, sf_dir).unionByName(adt_feed_stream(t, sf_dir))
    once = adt.drained(t.spark, adt.deduplicated(feed), "dedup")
    return once.groupBy("adt_type").agg(F.count(F.lit(1)).alias("messages"),
                                        F.min("event_id").alias("first_event"),
                                        F.max("event_id").alias("last_event"))


def adt_stream_enrich(t: ClinicalTables, sf_dir: str) -> DataFrame:
    root = scratch_path(t.spark, "enrich")
    adt.run_enriched(adt_feed_stream(t, sf_dir), upkeep.bucketed_history(t), f"{root}/rows", f"{root}/progress")
    return t.spark.read.parquet(f"{root}/rows").drop("ts", "batch")


def risk_incremental(t: ClinicalTables, sf_dir: str, batches: int = 4) -> DataFrame:
    """The feed in several micro-batches; each rescores the patients it touches."""
    root = scratch_path(t.spark, "incremental")
    feed = t.table("adt_feed")
    feed.repartitionByRange(batches, "event_id").write.parquet(f"{root}/feed")
    stream = adt.read_feed(t.spark, f"{root}/feed", feed.schema, files_per_batch=1)
    adt.run_incremental(stream, upkeep.bucketed_history(t), f"{root}/scores", f"{root}/progress", compact_every=3)
    return _joined(adt.current_scores(t.spark, f"{root}/scores"), "risk_factors")


# ---- the catalog -------------------------------------------------------

Plan = Callable[[ClinicalTables], DataFrame]

BATCH: dict[str, Plan] = {
    # flagship
    "flagship_outreach": flagship.flagship_outreach,
    # look-ups and table functions
    "recent_discharges": lambda t: lookups.recent_discharges(t, 7),
    "recent_discharge_count": lambda t: lookups.discharged_since(t, 7).agg(
        F.count(F.lit(1)).alias("recent_discharges")),
    "diagnoses_by_condition": lambda t: lookups.diagnoses_by_condition(t, "chf"),
    "condition_label_all": lookups.condition_labels,
    "patients_per_condition": lookups.condition_counts,
    "readmission_history": readmit.readmission_history,
    "risk_score_lookup": lookups.risk_score_lookup,
    "sdoh_barriers": lookups.sdoh_barriers,
    "available_coordinators": lambda t: lookups.available_coordinators(t, "CHF"),
    "available_coordinators_any": lookups.available_coordinators,
    "high_risk_patients": priority.high_risk_patients,
    "risk_category": priority.recomputed_category,
    "dx_description_search": dx_description_search,
    "scalar_projection": scalar_projection,
    "cohort_set_ops": cohort_set_ops,
    # readmissions and measures
    "encounter_sequence": readmit.encounter_sequence,
    "readmission_pairs": readmit.readmission_pairs,
    "facility_readmission_rate": readmit.facility_readmission_rate,
    "readmission_rate_overall": readmit.readmission_rate_overall,
    "readmits_last_month": readmit.readmits_last_month,
    "top_dx_readmitted": readmit.top_diagnoses_readmitted,
    "quality_rollup": readmit.quality_rollup,
    "lace_index": readmit.lace_index,
    # priority
    "priority_score_all": lambda t: _joined(priority.priority_scores(t), "risk_factors"),
    "priority_tiers": priority.priority_tiers,
    "priority_top_k": lambda t: _joined(priority.priority_top(t), "risk_factors"),
    "sdoh_barrier_profile": lambda t: _joined(priority.barrier_profile(t), "barriers"),
    # coordinators
    "suggest_coordinator_one": lambda t: assign.suggest_coordinator(t, "patient-000001", "COPD"),
    "suggest_coordinator_bulk": lambda t: assign.suggest_coordinators(
        t, assign.patient_needs(t), ["CHF", "COPD", "Diabetes", None]),
    "assign_coordinators": lambda t: flagship.outreach_assignments(t, 90),
    "coordinator_utilisation": lambda t: assign.coordinator_utilisation(
        t, flagship.outreach_assignments(t, 90)),
    # reports and sinks
    "outreach_rows_fanout": report.outreach_rows_fanout,
    "outreach_report_rows": report.outreach_report_rows,
    "report_summary": lambda t: report.report_summary(report.outreach_report_rows(t)),
    "report_document": report.report_document,
    "sink_roundtrip_overwrite": sink_roundtrip_overwrite,
    "weekly_report_append": weekly_report_append,
    "table_as_select": upkeep.table_as_select,
    "ingest_quarantine": upkeep.ingest_quarantine,
    "sql_table_functions": upkeep.sql_table_functions,
    "toolbox_calls": upkeep.toolbox_calls,
    "distinct_patients_rollup": upkeep.distinct_patients_rollup,
    "dx_description_index": upkeep.dx_description_index,
    "code_group_counts": upkeep.code_group_counts,
    # judges
    "judge_clinical_accuracy": judge_clinical_accuracy,
    "judge_completeness": judge_completeness,
    "judge_actionability": judge_actionability,
    "judge_privacy": judge_privacy,
    "judge_averages": lambda t: judges.judge_averages(_scores(t)),
    "judge_by_complexity": lambda t: judges.judge_by_complexity(_scores(t)),
    "judge_compare": lambda t: judges.judge_compare(_scores(t)),
    "judge_low_scores": lambda t: judges.judge_low_scores(_scores(t)),
    "questions_by_complexity": lambda t: judges.questions_by_complexity(judges.all_answers(t)),
    "sample_per_complexity": lambda t: judges.sample_per_complexity(judges.all_answers(t)),
    "fact_tool_explode": lambda t: judges.fact_tool_usage(
        t.table("questions"), judges.all_answers(t)),
    "query_log_usage": lambda t: judges.query_log_usage(t.table("user_turns")),
    "error_answers": lambda t: judges.error_answers(judges.all_answers(t)),
    # sampling
    "sample_n_without_replacement": sample_n_without_replacement,
    "weighted_bucket_assign": weighted_bucket_assign,
    "cohort_exclusion": cohort_exclusion,
    "cohort_mark_first_n": cohort_mark_first_n,
    "risk_histogram": lambda t: sampling.score_histogram(t.risk_scores),
    # checks
    "table_row_counts": checks.table_row_counts,
    "check_planted_counts": checks.planted_counts,
    "check_referential": checks.referential_checks,
    "check_capacity_consistent": checks.derived_column_checks,
    # questions
    **questions.QUESTIONS,
    "diabetes_and_readmitted": questions.diabetes_and_readmitted,
    "high_risk_barrier_counts": questions.high_risk_barrier_counts,
    "risk_above_08": questions.risk_above_08,
    "risk_by_mrn": questions.risk_by_mrn,
    "sdoh_by_mrn": questions.sdoh_by_mrn,
}

STREAMS: dict[str, Callable[[ClinicalTables, str], DataFrame]] = {
    "adt_stream_daily": adt_stream_daily,
    "adt_stream_dedup": adt_stream_dedup,
    "adt_stream_enrich": adt_stream_enrich,
    "risk_incremental": risk_incremental,
    "risk_table_merge": upkeep.risk_table_merge,
    "adt_daily_corrected": upkeep.adt_daily_corrected,
    "adt_replay_once": upkeep.adt_replay_once,
    "adt_latest_risk": upkeep.adt_latest_risk,
    "request_heavy_words": upkeep.request_heavy_words,
}
