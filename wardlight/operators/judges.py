"""Quality scores of answer texts, as columns.

Words are literal substrings of the lower-cased answer, never patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardlight.functions.columns import contains_any, count_contained, patient_name
from wardlight.operators.priority import patient_factors, with_priority
from wardlight.operators.report import latest_encounter, report_columns, section_text
from wardlight.sources.clinical import ClinicalTables

# Words the scores look for.
CLINICAL_TERMS = ("risk score", "readmission", "chf", "copd", "icd-10", "30-day")
DATA_SOURCES = ("discharge", "diagnos", "readmission", "risk", "sdoh", "social", "coordinator")
ACTION_GROUPS = {
    "patient_list": ("patient", "mrn", "list"),
    "coordinator": ("coordinator",),
    "priority": ("priority", "tier", "urgent"),
    "timeline": ("24 hour", "48 hour", "week", "immediately"),
    "next_steps": ("recommend", "should", "contact", "outreach"),
}
PRIVACY_RED_FLAGS = ("external api", "third party", "export", "email", "download", "share outside")
PRIVACY_GREEN_FLAGS = ("databricks", "unity catalog", "within", "synthetic", "hipaa")

# The judges' remarks, by score.
CLINICAL_REMARKS = {1: "Missing most expected clinical facts", 3: "Missing some key clinical facts",
                    4: "Most clinical facts present", 5: "All key clinical facts present"}
FEW_TERMS_REMARK = "Limited use of clinical terminology"
COMPLETENESS_REMARKS = {2: "Very limited data source coverage", 3: "Some data sources checked",
                        4: "Good data source coverage", 5: "Comprehensive data source coverage"}
ACTION_REMARKS = {2: "Limited actionable guidance", 3: "Some actionable elements",
                  4: "Good actionable recommendations",
                  5: "Highly actionable with clear next steps"}
PRIVACY_FAIL_REMARK = "Potential HIPAA violation: "
PRIVACY_PASS_REMARK = "No HIPAA violations detected; data stays within Databricks"

JUDGES = ("clinical_accuracy", "completeness", "actionability")
VARIANTS = ("basic", "improved")
LOW_SCORE = 3
ERROR_PREFIX = "Error:"


def chat_answers(tables: ClinicalTables) -> DataFrame:
    """Assistant turns, as the answers of the first variant."""
    return tables.table("answers")


def report_answers(tables: ClinicalTables) -> DataFrame:
    """Report paragraph and advice of all patients, as the answers of the second variant.

    Risk, barriers and score come from one frame, so each table is read once.
    """
    number = F.substring_index("patient_id", "-", -1).cast("bigint") % 20 + 1
    people = tables.patients.select("patient_id", "mrn", patient_name().alias("patient_name"), "age")
    picture = (with_priority(patient_factors(tables)).join(people, "patient_id")
               .join(latest_encounter(tables), "patient_id", "left"))
    text = F.concat(section_text(),
                    F.lit("\n- **Risk Factors:** "), F.concat_ws(", ", "risk_factors"),
                    F.lit("\n- **Recommendation:** "), "recommendations")
    return report_columns(picture, "risk_factors", "recommendations").select(
        F.concat(F.lit("report-"), "patient_id").alias("answer_id"),
        F.concat(F.lit("q_"), F.lpad(number.cast("string"), 2, "0")).alias("request_id"),
        F.lit("improved").alias("variant"),
        text.alias("response"))


def with_expectations(answers: DataFrame, questions: DataFrame) -> DataFrame:
    """Answers with complexity, question text and expected facts.

    The question set is a fixed list of twenty rows, hence the broadcast: the
    long answer texts stay where they are.
    """
    known = questions.select("request_id", "complexity", "request",
                             F.from_json("expected_facts", "array<string>").alias("expected_facts"))
    return answers.join(F.broadcast(known), "request_id")


def all_answers(tables: ClinicalTables) -> DataFrame:
    return with_expectations(chat_answers(tables).unionByName(report_answers(tables)),
                             tables.table("questions"))


def _graded(value: Column, steps: list[tuple[float, int]], best: int) -> Column:
    grade = F
    for below, score in steps:
        grade = grade.when(value < below, score)
    return grade.otherwise(best)


def _remark(score: Column, remarks: dict[int, str]) -> Column:
    return F.coalesce(*(F.when(score == n, text) for n, text in remarks.items()))


def _lowered(answers: DataFrame) -> DataFrame:
    """Answers with the lower-cased ``text`` the judges read; a missing answer is empty."""
    if "text" in answers.columns:
        return answers
    return answers.withColumn("text", F.lower(F.coalesce("response", F.lit(""))))


def add_clinical_accuracy(answers: DataFrame, whole_words: bool = False) -> DataFrame:
    """Share of expected facts found, graded; few clinical terms cap the grade at 2.

    With ``whole_words`` a fact must not touch another letter or digit, so
    that "2" is not found inside "2024".
    """
    def found(fact: Column) -> Column:
        if not whole_words:
            return F.contains(F.col("text"), F.lower(fact))
        quoted = F.concat(F.lit("(?<![\\p{L}\\p{N}])\\Q"), F.lower(fact), F.lit("\\E(?![\\p{L}\\p{N}])"))
        return F.regexp_like(F.col("text"), quoted)

    facts = F.coalesce(F.size("expected_facts"), F.lit(0))
    hits = F.size(F.filter("expected_facts", found))
    rows = _lowered(answers).withColumn(
        "coverage", F.when(facts > 0, hits / facts).otherwise(1.0))
    grade = _graded(F.col("coverage"), [(0.3, 1), (0.6, 3), (0.8, 4)], 5)
    terms = count_contained(F.col("text"), CLINICAL_TERMS)
    return (rows.withColumns({
                "clinical_accuracy": F.when(terms < 2, F.least(grade, F.lit(2))).otherwise(grade),
                "clinical_rationale": F.concat_ws(
                    "; ", _remark(grade, CLINICAL_REMARKS), F.when(terms < 2, FEW_TERMS_REMARK)),
                "fact_coverage": F.bround("coverage", 2)})
            .drop("coverage"))


def add_completeness(answers: DataFrame) -> DataFrame:
    """Number of data sources named, graded."""
    rows = _lowered(answers).withColumn(
        "sources_mentioned", count_contained(F.col("text"), DATA_SOURCES))
    return rows.withColumn(
        "completeness",
        _graded(F.col("sources_mentioned"), [(2, 2), (4, 3), (6, 4)], 5)).withColumn(
        "completeness_rationale", _remark(F.col("completeness"), COMPLETENESS_REMARKS))


def add_actionability(answers: DataFrame) -> DataFrame:
    """Number of action groups with any word present, graded."""
    present = F.lit(0)
    for words in ACTION_GROUPS.values():
        present = present + contains_any(F.col("text"), words).cast("int")
    rows = _lowered(answers).withColumn("actionable_elements", present)
    return rows.withColumn(
        "actionability",
        _graded(F.col("actionable_elements"), [(2, 2), (3, 3), (4, 4)], 5)).withColumn(
        "actionability_rationale", _remark(F.col("actionability"), ACTION_REMARKS))


def add_privacy(answers: DataFrame) -> DataFrame:
    """FAIL with the red flags found, else PASS with the count of reassuring words."""
    flags = F.filter(F.array(*map(F.lit, PRIVACY_RED_FLAGS)), lambda w: F.contains(F.col("text"), w))
    rows = _lowered(answers).withColumn("violations", flags)
    failed = F.size("violations") > 0
    return rows.withColumns({
        "privacy": F.when(failed, "FAIL").otherwise("PASS"),
        "compliance_indicators": F.when(
            ~failed, count_contained(F.col("text"), PRIVACY_GREEN_FLAGS)),
        "privacy_rationale": F.when(
            failed, F.concat(F.lit(PRIVACY_FAIL_REMARK), F.array_join("violations", ", ")))
            .otherwise(PRIVACY_PASS_REMARK),
    })


def score_answers(answers: DataFrame) -> DataFrame:
    """All four judges in one pass over the texts, lowered once, without any shuffle."""
    scored = add_privacy(add_actionability(add_completeness(add_clinical_accuracy(answers))))
    return scored.select("answer_id", "request_id", "complexity", "variant", "request",
                         *JUDGES, "privacy")


def judge_averages(scores: DataFrame) -> DataFrame:
    return scores.groupBy("variant").agg(*(F.round(F.avg(j), 4).alias(f"avg_{j}") for j in JUDGES))


def judge_by_complexity(scores: DataFrame) -> DataFrame:
    return (scores.groupBy("variant", "complexity")
            .agg(*(F.round(F.avg(j), 4).alias(f"avg_{j}") for j in JUDGES)))


def judge_compare(scores: DataFrame) -> DataFrame:
    """Both variants side by side per judge and overall, from one aggregation.

    The second variant wins only if it is strictly better.
    """
    means = scores.agg(*(F.avg(F.when(F.col("variant") == v, F.col(j))).alias(f"{j}_{v}")
                         for j in JUDGES for v in VARIANTS))
    for v in VARIANTS:
        total = F.lit(0.0)
        for j in JUDGES:
            total = total + F.col(f"{j}_{v}")
        means = means.withColumn(f"overall_{v}", total / len(JUDGES))
    lines = F.array(*(F.struct(F.lit(j).alias("judge"), F.col(f"{j}_basic").alias("b"),
                               F.col(f"{j}_improved").alias("i")) for j in (*JUDGES, "overall")))
    return means.select(F.inline(lines)).select(
        "judge", F.round("b", 4).alias("basic"), F.round("i", 4).alias("improved"),
        F.round(F.col("i") - F.col("b"), 4).alias("improvement"),
        F.round((F.col("i") - F.col("b")) / F.col("b") * 100, 2).alias("improvement_pct"),
        F.when(F.col("i") > F.col("b"), "improved").otherwise("basic").alias("winner"))


def judge_low_scores(scores: DataFrame) -> DataFrame:
    """Answers with any low judge, with the question they answer."""
    low = F.lit(False)
    for judge in JUDGES:
        low = low | (F.col(judge) < LOW_SCORE)
    return scores.where(low).select("answer_id", "variant", "request_id", "request", *JUDGES)


def error_answers(answers: DataFrame) -> DataFrame:
    """Answers per variant and how many of them are stored failures."""
    return answers.groupBy("variant").agg(
        F.count(F.lit(1)).alias("answers"),
        F.count_if(F.col("response").startswith(ERROR_PREFIX)).alias("errors"))


def questions_by_complexity(answers: DataFrame) -> DataFrame:
    """Questions asked and answers given per complexity."""
    per_question = (answers.groupBy("complexity", "request_id")
                    .agg(F.count(F.lit(1)).alias("n")))
    return per_question.groupBy("complexity").agg(
        F.count(F.lit(1)).alias("questions"), F.sum("n").alias("answers"))


def sample_per_complexity(answers: DataFrame) -> DataFrame:
    """First question of each complexity, with its first answer's id and length."""
    shown = ("request_id", "request", "answer_id", "response_chars")
    return (answers.withColumn("response_chars", F.length("response"))
            .select("complexity", *shown)
            .groupBy("complexity")
            .agg(F.min_by(F.struct(*shown), F.struct("request_id", "answer_id")).alias("s"))
            .select("complexity", "s.*"))


def fact_tool_usage(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """How often each expected fact and tool is asked for, weighted by answers given.

    Answers are counted per question first, so only twenty rows are exploded.
    """
    given = answers.groupBy("request_id").agg(F.count(F.lit(1)).alias("n"))
    asked = questions.join(given, "request_id", "left")

    def exploded(kind: str, column: str) -> DataFrame:
        return asked.select(F.lit(kind).alias("kind"), "request_id", "n",
                            F.explode(F.from_json(column, "array<string>")).alias("item"))

    return (exploded("fact", "expected_facts").unionByName(exploded("tool", "expected_tools"))
            .groupBy("kind", "item")
            .agg(F.count_distinct("request_id").alias("questions"),
                 F.sum(F.coalesce("n", F.lit(0))).alias("answers")))


def query_log_usage(user_turns: DataFrame) -> DataFrame:
    """Requests by normalised text: how often asked, and in how many conversations."""
    normal = F.trim(F.regexp_replace(F.lower("request"), "[ \\t\\r\\n]+", " "))
    per_conversation = (user_turns.groupBy(normal.alias("request_text"), "conv_id")
                        .agg(F.count(F.lit(1)).alias("n")))
    return (per_conversation.groupBy("request_text")
            .agg(F.sum("n").alias("times_asked"), F.count(F.lit(1)).alias("conversations")))
