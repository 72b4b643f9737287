"""The clinical tables as one lazily read object."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlight.schema import CLINICAL_TABLES


class ClinicalTables:
    """Named DataFrames plus the day that stands for "today".

    Each table is read on first use only, so a query opens no file it does
    not need. ``as_of`` is a literal in every plan, which keeps date filters
    pushable and reruns repeatable.
    """

    def __init__(self, spark: SparkSession, loaders: Mapping[str, Callable[[], DataFrame]],
                 as_of: dt.date):
        self.spark = spark
        self.as_of = as_of
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._loaders[name]()
        return self._frames[name]

    def names(self) -> list[str]:
        return list(self._loaders)

    @property
    def patients(self) -> DataFrame:
        return self.table("patients")

    @property
    def encounters(self) -> DataFrame:
        return self.table("encounters")

    @property
    def diagnoses(self) -> DataFrame:
        return self.table("diagnoses")

    @property
    def risk_scores(self) -> DataFrame:
        return self.table("risk_scores")

    @property
    def sdoh(self) -> DataFrame:
        return self.table("sdoh")

    @property
    def care_coordinators(self) -> DataFrame:
        return self.table("care_coordinators")

    def replace(self, **frames: DataFrame) -> "ClinicalTables":
        """A copy with some tables replaced, e.g. by a cohort's share of them."""
        loaders = {**self._loaders, **{n: (lambda f=f: f) for n, f in frames.items()}}
        copy = ClinicalTables(self.spark, loaders, self.as_of)
        copy._frames = {n: f for n, f in self._frames.items() if n not in frames}
        return copy

    def at(self, as_of: dt.date) -> "ClinicalTables":
        """The same tables seen from another day."""
        copy = self.replace()
        copy.as_of = as_of
        return copy

    def today(self):
        return F.lit(self.as_of)


def read_clinical(spark: SparkSession, root: str, as_of: dt.date,
                  fmt: str = "parquet") -> ClinicalTables:
    """Clinical tables stored as ``root/<table>`` in any Spark file format.

    The schema is declared, never inferred, so nothing is read before a query
    runs and numbers keep the declared width.
    """
    def loader(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.format(fmt).schema(CLINICAL_TABLES[name]).load(f"{root}/{name}")

    return ClinicalTables(spark, {name: loader(name) for name in CLINICAL_TABLES}, as_of)


def catalog_clinical(spark: SparkSession, schema_name: str, as_of: dt.date) -> ClinicalTables:
    """Clinical tables kept in a catalog schema (``schema`` or ``catalog.schema``)."""
    def loader(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.table(f"{schema_name}.{name}")

    return ClinicalTables(spark, {name: loader(name) for name in CLINICAL_TABLES}, as_of)
