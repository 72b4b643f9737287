"""Several sources of raw lines brought into declared tables; what does not fit is kept aside.

A source says how its lines are written (JSON objects, or CSV with known fields), which raw
fields a column may come from, and which columns must be there. Every line is either accepted,
with all its columns in their declared types, or goes to quarantine as it came, with the reason:
``unreadable``, ``missing <column>`` or ``bad <column>``. Fields that no column asks for are
counted as drift and lose nothing: the line is accepted without them.

Everything is an expression on the line, so it works on batches and on streams alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from wardlight.session import settled

UNREADABLE = "unreadable"


@dataclass(frozen=True)
class Source:
    """How the lines of one source become rows of ``schema`` (a DDL text).

    ``fields`` names the fields of a CSV line in order; a JSON line names its own. ``aliases``
    lists further raw fields for a column, tried in order after its own name, so that a renamed
    field goes on arriving. Columns in ``required`` may not be null.
    """

    name: str
    schema: str
    required: Sequence[str] = ()
    aliases: Mapping[str, Sequence[str]] = field(default_factory=dict)
    fmt: str = "json"
    fields: Sequence[str] = ()

    def raw(self, line: Column) -> Column:
        """The line as a map of texts; null if it cannot be read."""
        if self.fmt == "json":
            return F.from_json(line, "map<string,string>")
        if self.fmt != "csv":
            raise ValueError(f"unknown format {self.fmt}")
        shape = ", ".join(f"`{f}` string" for f in self.fields)
        read = F.from_csv(line, f"{shape}, __wrong string", {"columnNameOfCorruptRecord": "__wrong"})
        pairs = [x for f in self.fields for x in (F.lit(f), read[f])]
        return F.when(read["__wrong"].isNull() & line.isNotNull(), F.create_map(*pairs))

    def names_of(self, column: str) -> list[str]:
        return [column, *self.aliases.get(column, ())]


def parsed(lines: DataFrame, source: Source, line: str = "value") -> DataFrame:
    """Every line once: ``source``, ``line``, ``reason`` (null if accepted), ``unknown`` (fields that
    no column takes) and the columns as a struct ``row``."""
    read = lines.select(F.col(line).alias("line"), source.raw(F.col(line)).alias("raw"))
    columns = StructType.fromDDL(source.schema)
    texts = {c.name: F.coalesce(*(F.try_element_at("raw", F.lit(n)) for n in source.names_of(c.name)))
             for c in columns}
    values = {c.name: texts[c.name].try_cast(c.dataType) for c in columns}
    wrong = [F.when(F.col("raw").isNull(), UNREADABLE)]
    wrong += [F.when(texts[c].isNull(), f"missing {c}") for c in source.required]
    wrong += [F.when(texts[c].isNotNull() & values[c].isNull(), f"bad {c}") for c in columns.names]
    known = F.array(*(F.lit(n) for c in columns.names for n in source.names_of(c)))
    return read.select(
        F.lit(source.name).alias("source"), "line", F.coalesce(*wrong).alias("reason"),
        F.array_except(F.map_keys("raw"), known).alias("unknown"),
        F.struct(*(values[c.name].alias(c.name) for c in columns)).alias("row"))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reason").isNull()).select("row.*")


def quarantined(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reason").isNotNull()).select("source", "line", "reason")


def outcome_counts(rows: DataFrame) -> DataFrame:
    """Lines per source and outcome; the counts of a source add up to the lines read."""
    return rows.groupBy("source", F.coalesce("reason", F.lit("accepted")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.size("unknown") > 0).alias("drifted"))


def ingest(sources: Sequence[tuple[Source, DataFrame]], path: str) -> DataFrame:
    """Read all sources once; rows go to ``path/<source>``, rejects to ``path/quarantine``.

    Each folder is overwritten, so a repeated run leaves one result. Returns the counts.
    """
    counts, rejects = None, None
    for source, lines in sources:
        rows = settled(parsed(lines, source), f"ingest-{source.name}")
        accepted(rows).write.mode("overwrite").parquet(f"{path}/{source.name}")
        some, bad = outcome_counts(rows), quarantined(rows)
        counts = some if counts is None else counts.unionByName(some)
        rejects = bad if rejects is None else rejects.unionByName(bad)
    rejects.write.mode("overwrite").partitionBy("source").parquet(f"{path}/quarantine")
    return counts


def replayed(quarantine: DataFrame, source: Source) -> DataFrame:
    """Quarantined lines of one source parsed anew, e.g. once an alias for a renamed field is known."""
    return parsed(quarantine.where(F.col("source") == source.name), source, "line")
