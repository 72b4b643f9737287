"""Licence scans by canonical digest.

A text is made canonical: lower case, every run of punctuation or space one
separator, copyright lines gone, equivalent spellings made one. The digest of
the whole canonical text, and of each of its lines, is looked up among the
digests of known licences, which are made canonical by the same expressions.
The known table is fixed (a few hundred rows), so it is broadcast; neither
texts nor lines are shuffled, and only hits are grouped. All of it is DataFrame
functions.

Defined cases: null or empty text, and lines that are empty once canonical,
match nothing; rows with one ``doc_id`` share their findings; a null
``doc_id`` is a document like another; a line that names two licences at once
is no known notice and matches nothing; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardlight.llm.license_texts import DIGESTS, LEADS, NAMES, SPELLINGS, TEXTS

# A line that only states who holds the rights begins so, and does not go on like a clause.
COPYRIGHT = r"^[^\p{L}\p{N}(©]*(copyright|\(c\)|©|all rights reserved)"
CLAUSE = (r"^[^\p{L}\p{N}(©]*copyright[^\p{L}\p{N}]+(notice|notices|holder|holders|owner|owners|law|laws|license|"
          r"licenses|licence|statement|statements|interest|interests|and|or|in|to|is|act|treaty|protection|claims|"
          r"infringement|disclaimer|permission)([^\p{L}\p{N}]|$)")
_BREAK = r"[^\p{L}\p{N}]+"
# Two spaces stand between words, so that each has its own on both sides.
_GAP = "  "


def canonical_line(line: Column) -> Column:
    """One line made canonical; copyright lines become empty."""
    lower = F.lower(line)
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(lower, _BREAK, _GAP)), F.lit(" "))
    one = functools.reduce(
        lambda text, pair: F.replace(text, F.lit(f" {pair[0]} "), F.lit(f" {pair[1]} ")),
        SPELLINGS.items(), spaced)
    return F.when(lower.rlike(COPYRIGHT) & ~lower.rlike(CLAUSE), F.lit("")).otherwise(F.trim(one))


def canonical_lines(text: Column) -> Column:
    """The lines of a text, each canonical; those that become empty are left out."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), canonical_line),
                    lambda line: line != "")


def whole(lines: Column) -> Column:
    return F.array_join(lines, _GAP)


def notices() -> list[tuple[str, str]]:
    """Every known text with its identifier: whole texts, titles, and notices built by rule."""
    known = list(TEXTS.items())
    for spdx, text in TEXTS.items():
        known += [(spdx, f"{name}\n{text}") for name in NAMES[spdx]]
        known += [(spdx, f"The {name}\n{text}") for name in NAMES[spdx]]
    for spdx, names in NAMES.items():
        known += [(spdx, f"{lead} {article}{name}") for name in [*names, spdx] for lead in LEADS
                  for article in ("", "the ")]
    return known


def known_digests(spark: SparkSession) -> DataFrame:
    """``digest`` and ``spdx`` of every known text, one row per digest."""
    table = spark.createDataFrame(notices(), "spdx string, known string")
    digests = spark.createDataFrame(list(DIGESTS.items()), "spdx string, digest string")
    made = table.select("spdx", F.sha2(whole(canonical_lines(F.col("known"))), 256).alias("digest"))
    return made.unionByName(digests).groupBy("digest").agg(F.min("spdx").alias("spdx"))


def license_hits(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Every text and line that is a known licence: ``doc_id``, ``place``, ``spdx``.

    ``place`` is 0 for the whole text, else the line's number among the lines
    that are not empty once canonical.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    lines = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        canonical_lines(F.col("text").cast("string")).alias("lines"))
    units = lines.select("doc_id", F.posexplode(
        F.concat(F.array(whole(F.col("lines"))), F.col("lines"))).alias("place", "unit"))
    digested = units.where(F.col("unit") != "").select(
        "doc_id", "place", F.sha2("unit", 256).alias("digest"))
    return digested.join(F.broadcast(known), "digest").select("doc_id", "place", "spdx")


def license_table(docs: DataFrame) -> DataFrame:
    """Per document: the licences found, how many of its lines are notices, whether all of it is."""
    found = license_hits(docs).groupBy("doc_id").agg(
        F.array_join(F.sort_array(F.collect_set("spdx")), ",").alias("licenses"),
        F.count_if(F.col("place") > 0).alias("n_notices"),
        F.max(F.col("place") == 0).alias("whole_text")).withColumnRenamed("doc_id", "f_doc")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("f_doc")), "left").select(
        "doc_id", F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"),
        F.coalesce("whole_text", F.lit(False)).alias("whole_text"))
