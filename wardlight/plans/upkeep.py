"""Named queries about tables that are kept up to date: merges, ingest, streams with state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardlight.functions.columns import tier_label
from wardlight.functions.table_functions import register_table_functions
from wardlight.functions.toolbox import TOOLS
from wardlight.operators import codes, readmit, sketches
from wardlight.operators.priority import priority_scores
from wardlight.session import scratch_path, settled
from wardlight.sources.clinical import ClinicalTables
from wardlight.sources.history import BucketedHistory
from wardlight.sources.ingest import Source, ingest
from wardlight.sources.versioned import VersionedTable
from wardlight.streaming import adt

BUCKETS = 16
HORIZON = "3 days"

# Raw sources of the test tables: field names as the senders write them.
STAYS = Source("stays", "encounter_id string, patient_id string, admission_date date, facility string",
               required=("encounter_id", "patient_id"), aliases={"patient_id": ("subject",)})
MESSAGES = Source("messages", "event_id bigint, ts timestamp_ntz, patient_id string, adt_type string",
                  required=("event_id", "ts"), fmt="csv", fields=("event_id", "ts", "patient_id", "adt_type"))


def bucketed_history(t: ClinicalTables, buckets: int = BUCKETS) -> BucketedHistory:
    return BucketedHistory.build(t, scratch_path(t.spark, "history"), buckets)


def in_batches(t: ClinicalTables, rows: DataFrame, order: str, batches: int, label: str) -> DataFrame:
    """Rows written as several files, streamed one by one."""
    path = f"{scratch_path(t.spark, label)}/feed"
    rows.repartitionByRange(batches, order).write.parquet(path)
    return adt.read_feed(t.spark, path, rows.schema, files_per_batch=1)


def table_as_select(t: ClinicalTables) -> DataFrame:
    """Readmission pairs kept as a table, which is then replaced by a query over itself."""
    pairs = readmit.readmission_pairs(t).select("readmission_id", "patient_id", "days_between")
    table = VersionedTable.create(pairs, f"{scratch_path(t.spark, 'replaced')}/pairs", "readmission_id", BUCKETS)
    table.replace(lambda own: own.where(F.col("days_between") <= 20).withColumn(
        "within_week", F.col("days_between") <= 7))
    return table.read()


def risk_table_merge(t: ClinicalTables, sf_dir: str, batches: int = 4) -> DataFrame:
    """Scores kept in place by a feed in several micro-batches, then put into categories by a
    query over the table itself."""
    root = scratch_path(t.spark, "risk-merge")
    base = t.risk_scores.select("patient_id", "risk_score", F.lit(0).cast("bigint").alias("messages"),
                                F.lit(None).cast("timestamp").alias("last_message"))
    table = VersionedTable.create(base, f"{root}/risk", "patient_id", BUCKETS)
    feed = in_batches(t, t.table("adt_feed"), "event_id", batches, "risk-feed")
    adt.run_risk_merge(feed, table, f"{root}/progress")
    table.replace(lambda own: own.withColumn("tier", tier_label(F.col("risk_score"))))
    return table.read().select("patient_id", "risk_score", "messages", "tier",
                               adt.utc_day(F.col("last_message")).alias("last_day"))


def adt_daily_corrected(t: ClinicalTables, sf_dir: str, batches: int = 4) -> DataFrame:
    """Counts of all days, the open ones included, after the last of several micro-batches."""
    root = scratch_path(t.spark, "days")
    # By hash, so that every file holds messages of every day and each batch corrects all of them.
    rows = t.table("adt_feed").withColumn("spread", F.xxhash64("event_id"))
    feed = in_batches(t, rows, "spread", batches, "day-feed")
    return adt.corrected_days(feed, f"{root}/days", f"{root}/progress").read().drop("day_type")


def adt_replay_once(t: ClinicalTables, sf_dir: str, batches: int = 3) -> DataFrame:
    """A feed read twice, the second time under a new checkpoint, long after the first."""
    root = scratch_path(t.spark, "once")
    feed = t.table("adt_feed")
    for run in ("first", "second"):
        adt.run_once_each(in_batches(t, feed, "event_id", batches, "once-feed"), f"{root}/rows",
                          f"{root}/{run}", f"{root}/seen", BUCKETS)
    return t.spark.read.parquet(f"{root}/rows").groupBy("adt_type").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("event_id").alias("events"))


def adt_latest_risk(t: ClinicalTables, sf_dir: str) -> DataFrame:
    """Messages with the latest score update of the last days, both as streams; the messages that
    the watermark has not passed are answered from the same files as a batch."""
    feed = t.table("adt_feed")
    streamed = in_batches(t, feed, "event_id", 2, "asof-feed")

    def messages(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("adt_type") != "update").select("event_id", "ts", "patient_id", "adt_type")

    def updates(rows: DataFrame) -> DataFrame:
        return adt.instant(rows.where((F.col("adt_type") == "update") & F.col("patient_id").isNotNull())).select(
            "patient_id", F.col("ts").alias("updated"), F.col("event_id").alias("update_id"),
            F.col("value").alias("risk_score"))

    given = adt.drained(t.spark, adt.with_latest_update(messages(streamed), updates(streamed), HORIZON), "asof")
    rest = messages(feed).join(given.select("event_id"), "event_id", "left_anti")
    every = given.unionByName(adt.latest_update_of(rest, updates(feed), HORIZON))
    return every.select("event_id", "patient_id", "adt_type", "risk_score")


def ingest_quarantine(t: ClinicalTables) -> DataFrame:
    """Stays as JSON and messages as CSV, some lines broken, renamed or extended on the way."""
    root = scratch_path(t.spark, "ingest")
    number = F.substring("encounter_id", 11, 20).cast("bigint")
    fault = F.pmod(number, F.lit(50))
    whole = F.to_json(F.struct(
        "encounter_id", F.when(~fault.isin(1, 2), F.col("patient_id")).alias("patient_id"),
        F.when(fault == 2, F.col("patient_id")).alias("subject"),
        F.when(fault == 3, "unknown").otherwise(F.col("admission_date").cast("string")).alias("admission_date"),
        "facility", F.when(fault == 4, "7b").alias("ward")))
    cut = F.substring(whole, F.lit(1), F.length(whole) - 2)
    t.encounters.select(F.when(fault == 0, cut).otherwise(whole).alias("value")).write.text(f"{root}/raw/stays")
    fault = F.pmod("event_id", F.lit(40))
    t.table("adt_feed").select(
        F.when(fault == 0, F.concat_ws(",", F.col("event_id").cast("string"), "adt_type")).otherwise(F.concat_ws(
            ",", F.col("event_id").cast("string"),
            F.when(fault == 1, "n/a").otherwise(F.col("ts").cast("string")), "patient_id", "adt_type")).alias("value")
    ).write.text(f"{root}/raw/messages")
    return ingest([(source, t.spark.read.text(f"{root}/raw/{source.name}")) for source in (STAYS, MESSAGES)],
                  f"{root}/tables")


def distinct_patients_rollup(t: ClinicalTables) -> DataFrame:
    """Exact distinct patients per month and facility and above, and whether the estimate from
    stored sketches, brought in by two halves, is within its bound."""
    table = VersionedTable.create(sketches.patient_sketches(t.encounters.limit(0)),
                                  f"{scratch_path(t.spark, 'sketches')}/cells", "cell", 4)
    for half in (0, 1):
        sketches.add_stays(table, t.encounters.where(F.pmod(F.xxhash64("encounter_id"), F.lit(2)) == half),
                           batch=("stays", half))
    estimates = sketches.estimated_rollup(table.read())
    exact = sketches.exact_rollup(t)
    same = [exact[c].eqNullSafe(estimates[c]) for c in ("discharge_month", "facility", "level")]
    return exact.join(estimates, same[0] & same[1] & same[2]).select(
        exact["discharge_month"], exact["facility"], exact["level"], "patients",
        sketches.within_bound(F.col("estimated_patients"), F.col("patients")).alias("estimate_within_bound"))


WORD_SHARE, SUMMARY_ITEMS = 0.01, 400


def request_heavy_words(t: ClinicalTables, sf_dir: str, batches: int = 3) -> DataFrame:
    """Words that make up more than a stated share of all words that users write.

    A stream keeps a bounded summary; a second pass counts the few words it names.
    """
    root = scratch_path(t.spark, "words")
    word = F.explode(F.split(sketches.normal_text(F.col("request")), " "))
    feed = in_batches(t, t.table("user_turns"), "conv_id", batches, "word-feed")
    summary = sketches.run_summary(feed, word, f"{root}/summary", f"{root}/progress", SUMMARY_ITEMS)
    named = sketches.frequent(settled(summary.read(), "named"), WORD_SHARE)
    return sketches.exactly_frequent(t.table("user_turns").select(word.alias("item")), named, WORD_SHARE).select(
        F.col("item").alias("word"), "times")


def dx_description_index(t: ClinicalTables) -> DataFrame:
    """Descriptions that hold some literals, found through the index."""
    index = codes.DescriptionIndex.build(t.diagnoses, scratch_path(t.spark, "descriptions"), BUCKETS)
    found = None
    for literal, case_blind in (("heart failure", True), ("Heart Failure", False), ("2", True), (", UNSPEC", True)):
        rows = index.search(literal, case_blind).select(
            F.lit(literal).alias("literal"), F.lit(case_blind).alias("case_blind"), "icd10_code", "description",
            F.col("n").alias("diagnosis_rows"))
        found = rows if found is None else found.unionByName(rows)
    return found


def code_group_counts(t: ClinicalTables) -> DataFrame:
    """Diagnosis rows and patients of overlapping code groups: every chapter letter, category and code."""
    once = t.diagnoses.select("icd10_code").where(F.col("icd10_code").isNotNull()).distinct()
    groups = once.select(F.explode(F.array(*(F.struct(
        F.substring("icd10_code", 1, n).alias("prefix"), F.lit(label).alias("label"))
        for n, label in ((1, "chapter"), (3, "category"), (20, "code"))))).alias("g")).select("g.*").distinct()
    return codes.group_counts(t.diagnoses, t.encounters, groups)


_CALLS = {
    "get_recent_discharges": "SELECT encounter_id AS found FROM get_recent_discharges(30)",
    "get_diagnoses_by_condition": "SELECT encounter_id || icd10_code AS found FROM get_diagnoses_by_condition('copd')",
    "get_patient_readmission_history":
        "SELECT f.readmission_id AS found FROM patients p, LATERAL get_patient_readmission_history(p.patient_id) f",
    "get_risk_score":
        "SELECT f.risk_category AS found FROM patients p, LATERAL get_risk_score(p.patient_id) f",
    "get_sdoh_barriers":
        "SELECT cast(f.housing_instability AS string) AS found FROM patients p, LATERAL get_sdoh_barriers(p.patient_id) f",
    "get_available_care_coordinators": "SELECT coordinator_id AS found FROM get_available_care_coordinators('COPD')",
    "suggest_coordinator_for_patient":
        "SELECT coordinator_id AS found FROM suggest_coordinator_for_patient('patient-000001', 'CHF')",
    "calculate_priority_score":
        "SELECT f.recommendations AS found FROM patients p, LATERAL calculate_priority_score(p.patient_id) f",
    "generate_outreach_report":
        "SELECT f.tier AS found FROM patients p, LATERAL generate_outreach_report(p.patient_id) f",
}


def sql_table_functions(t: ClinicalTables) -> DataFrame:
    """Rows and different values that each SQL table function gives, called over whole tables."""
    register_table_functions(t)
    return t.spark.sql(" UNION ALL ".join(
        f"SELECT '{name}' AS function, count(*) AS rows, count(DISTINCT found) AS found FROM ({call})"
        for name, call in _CALLS.items()))


def toolbox_calls(t: ClinicalTables) -> DataFrame:
    """Rows that each named capability gives, for all patients where it takes patients."""
    everyone = settled(priority_scores(t).select("patient_id", "priority_score"), "everyone")
    ids = [f"patient-{n:06d}" for n in range(1, 41)]
    arguments = {"get_recent_discharges": (30,), "get_diagnoses_by_condition": ("chf",),
                 "get_available_care_coordinators": ("CHF",), "suggest_coordinator_for_patient": (ids[0], "COPD"),
                 "assign_care_coordinator": (everyone,)}
    found = None
    for name, tool in TOOLS.items():
        rows = tool(t, *arguments.get(name, (ids,))).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("tool"), "rows")
        found = rows if found is None else found.unionByName(rows)
    return found
