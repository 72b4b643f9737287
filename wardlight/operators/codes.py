"""Codes and their descriptions: search by literal through an index, and groups by prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardlight.session import settled
from wardlight.sources.versioned import VersionedTable

GRAM = 3
_ID = "text_id"


def _folded(text: Column) -> Column:
    """Letters in lower case one by one, so that a part of a text folds to a part of the folded text."""
    letters = F.transform(F.split(text, ""), F.lower)
    return F.translate(F.array_join(letters, ""), "\u03c2", "\u03c3")


def _grams(text: Column) -> Column:
    """Distinct runs of ``GRAM`` letters of a folded text; none if it is shorter."""
    last = F.length(text) - GRAM + 1
    return F.when(last >= 1, F.array_distinct(F.transform(
        F.sequence(F.lit(1), last), lambda at: F.substring(text, at, F.lit(GRAM))))).otherwise(
        F.array().cast("array<string>"))


class DescriptionIndex:
    """An inverted index of the different descriptions of diagnoses.

    ``texts`` holds each (code, description) once with its number of rows, ``postings`` the letter
    runs of each, bucketed by run. A search opens the postings of the literal's runs, keeps the
    descriptions that have them all and compares those; the diagnoses themselves are not read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.texts = VersionedTable(spark, f"{path}/texts")
        self.postings = VersionedTable(spark, f"{path}/postings")

    @staticmethod
    def build(diagnoses: DataFrame, path: str, buckets: int = 64) -> "DescriptionIndex":
        texts = settled(_texts(diagnoses), "descriptions")
        index = DescriptionIndex(diagnoses.sparkSession, path)
        VersionedTable.create(texts, index.texts.path, _ID, buckets)
        VersionedTable.create(_postings(texts), index.postings.path, "gram", buckets)
        return index

    def add(self, diagnoses: DataFrame, batch: tuple[str, int] | None = None) -> None:
        """Count new diagnoses in; only descriptions not seen before get postings.

        Postings come first: if the counts are not reached, a replay finds its postings there and
        only repeats them, which changes no result.
        """
        new = settled(_texts(diagnoses), "descriptions")
        unseen = new.join(self.texts.read_keys(new).select(_ID), _ID, "left_anti")
        self.postings.append(_postings(unseen), batch)
        self.texts.merge(new, {"n": F.col("old.n") + F.col("new.n")}, batch=batch)

    def candidates(self, literal: str) -> DataFrame:
        """Descriptions that have all letter runs of the literal; all of them if it has none."""
        one = self.spark.createDataFrame([(literal,)], "literal string")
        wanted = one.select(F.explode(_grams(_folded(F.col("literal")))).alias("gram"))
        runs = wanted.count()
        if not runs:
            return self.texts.read()
        ids = settled(self.postings.read_keys(wanted).select(_ID, "gram").distinct().groupBy(_ID).agg(
            F.count(F.lit(1)).alias("runs")).where(F.col("runs") == runs).select(_ID), "found")
        return self.texts.read_keys(ids)

    def search(self, literal: str, case_blind: bool = True) -> DataFrame:
        """``icd10_code``, ``description`` and the diagnosis rows ``n`` whose description has the literal."""
        held = (F.lower("description").contains(F.lower(F.lit(literal))) if case_blind
                else F.col("description").contains(F.lit(literal)))
        return self.candidates(literal).where(held).select("icd10_code", "description", "n")


def _texts(diagnoses: DataFrame) -> DataFrame:
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("icd10_code", "description")]
    mark = F.sha2(F.concat_ws("\x1f", F.length(parts[0]).cast("string"), *parts), 256)
    return (diagnoses.where(F.col("description").isNotNull()).groupBy("icd10_code", "description")
            .agg(F.count(F.lit(1)).alias("n")).select(mark.alias(_ID), "icd10_code", "description", "n"))


def _postings(texts: DataFrame) -> DataFrame:
    return texts.select(F.explode(_grams(_folded(F.col("description")))).alias("gram"), _ID)


def in_code_groups(codes: DataFrame, groups: DataFrame) -> DataFrame:
    """Every (``icd10_code``, group) whose prefix the code begins with, for any number of groups.

    ``groups`` has ``prefix`` and further columns. A code stands in the interval of a prefix exactly
    if one of its own beginnings is that prefix, so each different code is written out by its few
    beginnings and meets the groups on equality: no pair of code and group is compared that does not
    match. Prefixes that overlap give a row each; the empty prefix takes every code.
    """
    once = codes.select("icd10_code").where(F.col("icd10_code").isNotNull()).distinct()
    lengths = F.sequence(F.lit(0), F.length("icd10_code"))
    begun = once.select("icd10_code", F.explode(F.transform(
        lengths, lambda n: F.substring(F.col("icd10_code"), F.lit(1), n))).alias("prefix"))
    return begun.join(groups.where(F.col("prefix").isNotNull()), "prefix")


def group_counts(diagnoses: DataFrame, encounters: DataFrame, groups: DataFrame) -> DataFrame:
    """Per group (``prefix``, ``label``): diagnosis rows and different patients.

    Rows shrink to one per code and patient before they meet their groups; a code that most rows
    carry is then as many rows as it has patients, and the join may split them.
    """
    owned = diagnoses.select("encounter_id", "icd10_code").join(
        encounters.select("encounter_id", "patient_id"), "encounter_id")
    per_patient = owned.groupBy("icd10_code", "patient_id").agg(F.count(F.lit(1)).alias("n"))
    held = in_code_groups(diagnoses, groups).select("icd10_code", "prefix", "label")
    return (per_patient.join(held, "icd10_code").groupBy("prefix", "label", "patient_id")
            .agg(F.sum("n").alias("n")).groupBy("prefix", "label")
            .agg(F.sum("n").alias("diagnosis_rows"), F.count("patient_id").alias("patients")))
