"""Readmission pairs and the measures built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from wardlight.functions.columns import has_prefix
from wardlight.operators.lookups import only_patients
from wardlight.operators.ordering import next_in_group, number_after_marks
from wardlight.schema import READMISSION_LOOKAHEAD_DAYS, READMISSION_WINDOW_DAYS
from wardlight.sources.clinical import ClinicalTables


def encounter_sequence(tables: ClinicalTables) -> DataFrame:
    """Position of each encounter in its patient's history, and the history's length.

    Numbered by admission date, then encounter id. Stays are counted per
    patient and day, the running counts are taken over days, and only the stays
    of one day are sorted together: a patient with a third of all stays is
    worked like any other.
    """
    stays = tables.encounters.select("patient_id", "encounter_id", "admission_date").withColumn(
        "__day", F.to_date("admission_date"))
    history = Window.partitionBy("patient_id")
    marks = (
        stays.groupBy("patient_id", "__day").agg(F.count(F.lit(1)).alias("__n"))
        .select("patient_id", "__day",
                F.coalesce(F.sum("__n").over(history.orderBy("__day").rowsBetween(
                    Window.unboundedPreceding, -1)), F.lit(0)).alias("__offset"),
                F.sum("__n").over(history).alias("__total")))
    return number_after_marks(
        stays, marks, "enc_num", ["patient_id", "__day"],
        [F.col("admission_date"), F.col("encounter_id")], {"__total": "total_encs"}).drop("__day")


def stays_with_next(tables: ClinicalTables, patients: DataFrame | None = None,
                    carry: Sequence[str] = ()) -> DataFrame:
    """Every stay with the patient's very next one, where it follows within a year.

    Adds ``next_id``, ``next_admission`` and ``days_between``, null where the
    next stay begins before the discharge, lies more than 365 days after it, or
    does not exist; an overlapping next stay ends the search rather than being
    skipped. A stay without a patient has no next one. Each patient's stays are
    worked day by day, not in one window and not by a self-join.
    """
    stays = only_patients(tables.encounters, patients).select(
        "patient_id", "admission_date", "encounter_id", "discharge_date", *carry)
    known = stays.where(F.col("patient_id").isNotNull()).withColumn(
        "__order", F.struct("admission_date", "encounter_id"))
    linked = next_in_group(
        known, "next", "patient_id", "__order",
        F.struct(F.col("encounter_id").alias("id"), F.col("admission_date").alias("start")),
        F.to_date("admission_date")).drop("__order")
    days = F.datediff("next.start", "discharge_date")
    follows = (F.col("next.start") > F.col("discharge_date")) & (days <= READMISSION_LOOKAHEAD_DAYS)
    found = linked.select(
        *stays.columns, F.when(follows, F.col("next.id")).alias("next_id"),
        F.when(follows, F.col("next.start")).alias("next_admission"),
        F.when(follows, days).alias("days_between"))
    return found.unionByName(stays.where(F.col("patient_id").isNull()), allowMissingColumns=True)


def readmission_pairs(tables: ClinicalTables, patients: DataFrame | None = None,
                      carry: Sequence[str] = ()) -> DataFrame:
    """Each stay followed, as the patient's very next stay, by one within a year.

    ``carry`` names further columns of the first stay to keep. The id is made
    of the two encounter ids: no global numbering is needed.
    """
    return (
        stays_with_next(tables, patients, carry).where(F.col("days_between").isNotNull())
        .select(F.concat_ws("-", F.lit("readmit"), "encounter_id", "next_id").alias("readmission_id"),
                "patient_id",
                F.col("encounter_id").alias("original_encounter_id"),
                F.col("next_id").alias("readmit_encounter_id"),
                F.col("discharge_date").alias("original_discharge_date"),
                F.col("next_admission").alias("readmit_admission_date"),
                "days_between",
                (F.col("days_between") <= READMISSION_WINDOW_DAYS).alias("is_30_day"),
                *carry)
    )


def readmission_history(tables: ClinicalTables, patients: DataFrame | None = None) -> DataFrame:
    return readmission_pairs(tables, patients).select(
        "readmission_id", "patient_id", "original_discharge_date", "readmit_admission_date",
        "days_between", "is_30_day")


def readmitted_patients(tables: ClinicalTables, patients: DataFrame | None = None,
                        within_30_days: bool = True) -> DataFrame:
    pairs = readmission_pairs(tables, patients)
    if within_30_days:
        pairs = pairs.where("is_30_day")
    return pairs.select("patient_id").distinct()


def _rate(pairs, stays):
    return F.round(pairs / stays, 4)


def _finished_stays(tables: ClinicalTables, carry: Sequence[str]) -> DataFrame:
    """Stays that ended by the reference day; ``back`` marks a 30-day readmission by then."""
    tomorrow = F.date_add(tables.today(), 1)
    back = (F.col("days_between") <= READMISSION_WINDOW_DAYS) & (F.col("next_admission") < tomorrow)
    return (stays_with_next(tables, carry=carry).where(F.col("discharge_date") < tomorrow)
            .withColumn("back", F.coalesce(back, F.lit(False))))


def facility_readmission_rate(tables: ClinicalTables) -> DataFrame:
    """30-day readmissions per finished stay, by the facility of the first stay.

    Counted in one pass, stays of an unknown facility as a group of their own.
    A readmission counts once it has happened by the reference day.
    """
    return (_finished_stays(tables, ["facility"]).groupBy("facility")
            .agg(F.count(F.lit(1)).alias("discharges"), F.count_if("back").alias("readmissions_30d"))
            .withColumn("readmission_rate", _rate(F.col("readmissions_30d"), F.col("discharges"))))


def readmission_rate_overall(tables: ClinicalTables) -> DataFrame:
    return (facility_readmission_rate(tables)
            .agg(F.sum("discharges").alias("discharges"),
                 F.sum("readmissions_30d").alias("readmissions_30d"))
            .withColumn("readmission_rate", _rate(F.col("readmissions_30d"), F.col("discharges"))))


def readmits_last_month(tables: ClinicalTables) -> DataFrame:
    """30-day readmissions admitted in the calendar month before the reference day's."""
    this_month = F.trunc(tables.today(), "month")
    return (readmission_pairs(tables)
            .where(F.col("is_30_day")
                   & (F.col("readmit_admission_date") >= F.add_months(this_month, -1))
                   & (F.col("readmit_admission_date") < this_month))
            .agg(F.count(F.lit(1)).alias("readmissions_30d"),
                 F.count_distinct("patient_id").alias("patients")))


def top_diagnoses_readmitted(tables: ClinicalTables, top: int = 10) -> DataFrame:
    """Most frequent codes on stays that led to a 30-day readmission.

    The stay ids on the right are unique, so the join cannot multiply rows;
    distinct patients are counted by a two-step aggregation.
    """
    originals = (readmission_pairs(tables).where("is_30_day")
                 .select(F.col("original_encounter_id").alias("encounter_id"), "patient_id"))
    per_patient = (tables.diagnoses.select("encounter_id", "icd10_code")
                   .join(originals, "encounter_id")
                   .groupBy("icd10_code", "patient_id").agg(F.count(F.lit(1)).alias("n")))
    return (per_patient.groupBy("icd10_code")
            .agg(F.sum("n").alias("diagnosis_rows"), F.count(F.lit(1)).alias("patients"))
            .orderBy(F.desc("diagnosis_rows"), "icd10_code").limit(top))


def quality_rollup(tables: ClinicalTables) -> DataFrame:
    """Discharges, 30-day readmissions, rate and mean stay by month and facility.

    One pass over the stays counts everything. Subtotals per month and the grand total come from the same pass over
    already counted rows; ``level`` is 0 for detail, 1 per month, 3 for all.
    """
    cells = (_finished_stays(tables, ["facility", "length_of_stay"])
             .groupBy(F.date_format("discharge_date", "yyyy-MM").alias("discharge_month"), "facility")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("length_of_stay").alias("days"),
                  F.count_if("back").alias("r")))
    return (cells.rollup("discharge_month", "facility")
            .agg(F.sum("n").alias("discharges"),
                 F.sum("r").alias("readmissions_30d"),
                 F.sum("days").alias("days"),
                 F.grouping_id().cast("int").alias("level"))
            .select("discharge_month", "facility", "level", "discharges", "readmissions_30d",
                    _rate(F.col("readmissions_30d"), F.col("discharges")).alias("readmission_rate"),
                    F.round(F.col("days") / F.col("discharges"), 4).alias("mean_stay")))


# Published LACE weights for the code groups present in the data.
LACE_COMORBIDITY = {"I50": 2, "J44": 2, "E11": 1, "N18": 2}
LACE_EMERGENCY_DAYS = 183


def lace_index(tables: ClinicalTables) -> DataFrame:
    """LACE readmission index per stay (length, acuity, comorbidity, emergency use).

    Comorbidities count from the first stay of the patient that shows the code
    group, which makes one small row per patient. They and the emergency
    visits depend on the patient and the day only, so they are worked out per
    patient and day, where the range window sees days rather than stays, and
    joined to the stays once.
    """
    stays = tables.encounters.select(
        "encounter_id", "patient_id", F.to_date("admission_date").alias("admission_day"),
        "length_of_stay", "encounter_type")
    onset_columns = {p: f"onset_{p.lower()}" for p in LACE_COMORBIDITY}
    per_stay = (
        tables.diagnoses
        .where(has_prefix(F.col("icd10_code"), LACE_COMORBIDITY))
        .groupBy("encounter_id")
        .agg(*(F.bool_or(F.col("icd10_code").startswith(p)).alias(p) for p in LACE_COMORBIDITY)))
    onset = (
        per_stay.join(stays.select("encounter_id", "patient_id", "admission_day"), "encounter_id")
        .groupBy("patient_id")
        .agg(*(F.min(F.when(F.col(p), F.col("admission_day"))).alias(c)
               for p, c in onset_columns.items())))

    half_year = (Window.partitionBy("patient_id").orderBy(F.unix_date("admission_day"))
                 .rangeBetween(-LACE_EMERGENCY_DAYS, -1))
    days = (stays.groupBy("patient_id", "admission_day")
            .agg(F.count_if(F.col("encounter_type") == "Emergency").alias("n"))
            .withColumn("visits", F.coalesce(F.sum("n").over(half_year), F.lit(0))))
    comorbidity = F.lit(0)
    for prefix, column in onset_columns.items():
        seen = F.coalesce(F.col(column) <= F.col("admission_day"), F.lit(False))
        comorbidity = comorbidity + seen.cast("int") * LACE_COMORBIDITY[prefix]
    per_day = (
        days.join(onset, "patient_id", "left")
        .withColumn("c_raw", comorbidity)
        .select("patient_id", "admission_day",
                F.when(F.col("c_raw") >= 4, 5).otherwise(F.col("c_raw")).alias("c_points"),
                F.least("visits", F.lit(4)).cast("int").alias("e_points")))

    length = F.col("length_of_stay")
    points = ("l_points", "a_points", "c_points", "e_points")
    return (
        stays.join(per_day, ["patient_id", "admission_day"], "left")
        .select("encounter_id", "patient_id",
                F.when(length < 1, 0).when(length <= 3, length).when(length <= 6, 4)
                 .when(length <= 13, 5).otherwise(7).alias("l_points"),
                F.when(F.col("encounter_type") == "Emergency", 3).otherwise(0).alias("a_points"),
                F.coalesce("c_points", F.lit(0)).alias("c_points"),
                F.coalesce("e_points", F.lit(0)).alias("e_points"))
        .withColumn("lace", sum((F.col(p) for p in points), F.lit(0))))
