"""The corpus pipeline: documents judged, cleaned, thinned, mixed and packed.

Every stage reads what its predecessor wrote; ``run`` writes each stage's rows
to the shared folder and reads them again, as a scheduler of stages would.

Defined cases, in every stage but the last: the columns of ``docs`` come back as
they are, whatever their names. Null or empty text fails the quality rules and
goes there; given to a later stage it stays: it has no line to lose, resembles
nothing, and is never taken by the mix, as is a text without words. Repeated rows
are judged each, lose the same lines, stay together if their document stays, and
are mixed each. A null ``doc_id`` is no document of its own to the line and
similarity stages, which keep it; a null source is a source. An empty table gives
an empty one. The last stage packs a null text as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardlight.llm.linededup import clean_documents
from wardlight.llm.mixing import mixed_documents
from wardlight.llm.packing import pack
from wardlight.llm.parity_join import one_of_each
from wardlight.llm.quality import good_documents
from wardlight.session import settled

# Near duplicates in the pipeline: shingles of this many words, this similarity in percent.
SHINGLE_WORDS, SIMILARITY = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules and the classifier keep."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds."""
    return clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return one_of_each(docs, percent=SIMILARITY, words=SHINGLE_WORDS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of one length."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
          ("mixing", mixing), ("packing", packing)]

# The classifier and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
