"""Reversible removal of lines that several documents share.

An index of a corpus holds three tables:

* ``references``: one row per document and distinct line key in it;
* ``counts``: per key its exact number of references and its first and last
  document, so a key is repeated exactly if those two differ;
* ``filters``: per shard of keys a cuckoo filter of the repeated ones.

Documents can be added and removed: counts of the touched keys are worked out
anew from the references, and filters gain or lose the keys that became, or
ceased to be, repeated. To clean documents, their references pass the
filter of their shard first; most lines are in one document only and go no
further. What may be repeated is settled by the exact counts.

References reach a filter as a stream, sorted behind it, and a shard is dealt
out under several salts, so neither a shard nor a key in a third of all
documents is ever held by one task.

A line's key is the line without white space at its ends, A-Z lower-cased;
keys shorter than ``LEAST_CHARS`` are never removed. Keys are compared by a
128-bit hash. Defined cases: null or empty text is one empty line; rows with one
``doc_id`` count as one document; rows with a null ``doc_id`` have no place in
the order of documents, hold no key and lose no line; an empty table gives an
empty result; further columns are carried along untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wardlight.llm.cuckoo import CuckooFilter
from wardlight.llm.words import as_bytes
from wardlight.session import settled

LEAST_CHARS = 10
# Repeated keys of one shard, on average, and parts that a shard's references are dealt into.
SHARD_KEYS = 1 << 16
SALTS = 32
_KEY = ["key_a", "key_b"]
_ROW = "shard int, salt int, late int, key_a bigint, key_b bigint, doc_id bigint, filter binary"


def line_key(line: bytes) -> bytes | None:
    """128-bit hash of a line's key; None for lines that are too short to be compared."""
    key = line.strip().lower()
    if len(key) < LEAST_CHARS:
        return None
    if len(key) < 4 * LEAST_CHARS and len(key.decode("utf-8", "replace")) < LEAST_CHARS:
        return None
    return xxhash.xxh3_128_digest(key)


def _reference_rows(batches):
    for batch in batches:
        docs, keys = [], []
        for doc, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            found = {line_key(line) for line in (text or b"").split(b"\n")} - {None}
            docs += [doc] * len(found)
            keys += found
        halves = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(halves[:, 0])),
             pa.array(np.ascontiguousarray(halves[:, 1])), pa.array(docs, pa.int64())],
            names=[*_KEY, "doc_id"])


def line_references(docs: DataFrame) -> DataFrame:
    """One row per document and distinct key."""
    return (docs.where(F.col("doc_id").isNotNull())
            .select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
            .mapInArrow(_reference_rows, "key_a bigint, key_b bigint, doc_id bigint"))


def reference_counts(references: DataFrame) -> DataFrame:
    """Per key: references, first and last document. Combines before it shuffles."""
    return references.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("n_references"), F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"))


def _repeated(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("first_doc") != F.col("last_doc"))


def _shard(shards: int) -> Column:
    return F.pmod("key_a", F.lit(shards)).cast("int").alias("shard")


def _unsigned(column) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


def _filter_of(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    keys = _unsigned(table.column("key_b").combine_chunks())
    room = len(keys)
    while True:
        built = CuckooFilter.sized(room)
        if built.add(keys):
            break
        room *= 2
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()),
                     "filter": pa.array([built.dumped()], pa.binary())})


def build_filters(counts: DataFrame, shards: int) -> DataFrame:
    """A cuckoo filter of the repeated keys of every shard that has any."""
    return (_repeated(counts).select(_shard(shards), "key_b").groupBy("shard")
            .applyInArrow(_filter_of, "shard int, filter binary"))


@dataclass(frozen=True)
class LineIndex:
    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int


def _shards_for(counts: DataFrame) -> int:
    return max(1, -(-_repeated(counts).count() // SHARD_KEYS))


def index_lines(docs: DataFrame) -> LineIndex:
    """The index of ``docs``; its tables are written to the shared folder."""
    references = settled(line_references(docs), "line-references")
    counts = settled(reference_counts(references), "line-counts")
    shards = _shards_for(counts)
    return LineIndex(references, counts, settled(build_filters(counts, shards), "line-filters"),
                     shards)


def _filter_change(key: tuple[pa.Scalar, ...], old: pa.Table, change: pa.Table) -> pa.Table:
    stored = old.column("filter").to_pylist()
    keys = _unsigned(change.column("key_b").combine_chunks())
    gained = np.array(change.column("gained").to_pylist(), dtype=bool)
    current = CuckooFilter.loaded(stored[0]) if stored else CuckooFilter.sized(
        max(1024, 2 * int(gained.sum())))
    current.remove(keys[~gained])
    whole = current.add(keys[gained])
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()),
                     "filter": pa.array([current.dumped()], pa.binary()),
                     "whole": pa.array([whole], pa.bool_())})


def _changed(index: LineIndex, references: DataFrame, touched: DataFrame) -> LineIndex:
    """The index over ``references``, where only the keys of ``touched`` may differ."""
    references = settled(references, "line-references")
    again = reference_counts(references.join(touched, _KEY, "left_semi"))
    counts = settled(index.counts.join(touched, _KEY, "left_anti").unionByName(again),
                     "line-counts")
    before = _repeated(index.counts).join(touched, _KEY, "left_semi").select(*_KEY)
    after = _repeated(counts).join(touched, _KEY, "left_semi").select(*_KEY)
    change = (after.join(before, _KEY, "left_anti").withColumn("gained", F.lit(True))
              .unionByName(before.join(after, _KEY, "left_anti")
                           .withColumn("gained", F.lit(False)))
              .select(_shard(index.shards), "key_b", "gained"))
    filters = settled(
        index.filters.groupBy("shard").cogroup(change.groupBy("shard")).applyInArrow(
            _filter_change, "shard int, filter binary, whole boolean"), "line-filters")
    if filters.where(~F.col("whole")).isEmpty():
        return LineIndex(references, counts, filters.drop("whole"), index.shards)
    shards = max(2 * index.shards, _shards_for(counts))
    return LineIndex(references, counts, settled(build_filters(counts, shards), "line-filters"),
                     shards)


def add_documents(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with further documents. Documents it holds already are replaced."""
    kept = index
    added = settled(line_references(docs), "line-references")
    ids = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    leaving = index.references.join(ids, "doc_id", "left_semi")
    touched = settled(added.select(*_KEY).unionByName(leaving.select(*_KEY)).distinct(),
                      "line-touched")
    stay = index.references.join(ids, "doc_id", "left_anti").select(*_KEY, "doc_id")
    return _changed(kept, stay.unionByName(added), touched)


def remove_documents(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """The index without some documents (``doc_id``): lines they shared become free again."""
    ids = doc_ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    touched = settled(index.references.join(ids, "doc_id", "left_semi").select(*_KEY).distinct(),
                      "line-touched")
    stay = index.references.join(ids, "doc_id", "left_anti").select(*_KEY, "doc_id")
    return _changed(index, stay, touched)


def _probe(batches):
    """References that pass the filter sorted in before them; a shard without one has no hits."""
    current, place = None, None
    for batch in batches:
        late = batch.column(2).to_numpy()
        shard, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        keys = _unsigned(batch.column(4))
        passed = np.zeros(len(late), dtype=bool)
        new = np.ones(len(late), dtype=bool)
        new[1:] = (shard[1:] != shard[:-1]) | (salt[1:] != salt[:-1]) | (late[1:] != late[:-1])
        edges = np.append(np.flatnonzero(new), len(late))
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            here = (int(shard[begin]), int(salt[begin]))
            if not late[begin]:
                current, place = CuckooFilter.loaded(batch.column(6)[begin].as_py()), here
            elif here == place:
                passed[begin:end] = current.holds(keys[begin:end])
        chosen = pa.array(passed)
        yield pa.RecordBatch.from_arrays(
            [batch.column(i).filter(chosen) for i in (3, 4, 5)], names=[*_KEY, "doc_id"])


def maybe_repeated(references: DataFrame, index: LineIndex) -> DataFrame:
    """References whose key a filter may hold; all of the repeated ones are among them."""
    salts = F.explode(F.array(*(F.lit(s) for s in range(SALTS)))).alias("salt")
    nothing = F.lit(None).cast("bigint")
    first = index.filters.select("shard", salts, F.lit(0).alias("late"), F.lit(0).cast("bigint")
                                 .alias("key_a"), F.lit(0).cast("bigint").alias("key_b"),
                                 nothing.alias("doc_id"), "filter")
    rest = references.select(
        _shard(index.shards),
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"),
        F.lit(1).alias("late"), *_KEY, "doc_id", F.lit(None).cast("binary").alias("filter"))
    return (first.unionByName(rest).repartition("shard", "salt")
            .sortWithinPartitions("shard", "salt", "late")
            .mapInArrow(_probe, "key_a bigint, key_b bigint, doc_id bigint"))


def removable_keys(references: DataFrame, index: LineIndex) -> DataFrame:
    """Per document the keys whose lines it loses: repeated ones that an earlier one holds."""
    hits = maybe_repeated(references, index)
    owned = _repeated(index.counts).select(*_KEY, "first_doc")
    lost = hits.join(owned, _KEY).where(F.col("doc_id") != F.col("first_doc"))
    return (lost.groupBy("doc_id").agg(F.collect_set(F.struct(*_KEY)).alias("lost_keys"))
            .select(F.col("doc_id").alias("lost_doc"), "lost_keys"))


def _without(texts: pa.Array, keys: pa.Array) -> pa.Array:
    kept, dropped = [], []
    for text, lost in zip(as_bytes(texts), keys.to_pylist()):
        if text is None or not lost:
            kept.append(None)
            dropped.append(0)
            continue
        gone = set(np.array([(k["key_a"], k["key_b"]) for k in lost], dtype=np.int64)
                   .reshape(-1).view("V16").tolist())
        lines = text.split(b"\n")
        stay = [line for line in lines if line_key(line) not in gone]
        kept.append(b"\n".join(stay).decode())
        dropped.append(len(lines) - len(stay))
    return pa.StructArray.from_arrays(
        [pa.array(kept, pa.string()), pa.array(dropped, pa.int64())], ["text", "n_dropped"])


def _run_without(texts: pa.Array, keys: pa.Array) -> pa.Array:
    return _without(texts, keys)


def clean_rows(docs: DataFrame, index: LineIndex) -> DataFrame:
    """``docs`` whole in ``line_row``, with ``line_text``, ``n_lines`` and ``n_dropped``.

    Texts move once, to meet the list of what they lose; only texts that lose
    a line are read in Python. Only documents that the index holds lose lines:
    others, also those that share a line with it, come back as they are; add them to
    the index first.
    """
    # References of the indexed documents are written already.
    lost = removable_keys(index.references, index)
    rows = docs.select(F.struct("*").alias("line_row"), F.col("doc_id").cast("bigint")
                       .alias("line_doc"), F.coalesce(F.col("text").cast("string"), F.lit(""))
                       .alias("line_text"))
    met = rows.join(lost.hint("shuffle_hash"), F.col("line_doc") == F.col("lost_doc"), "left")
    cut = F.arrow_udf(_run_without, "struct<text:string,n_dropped:bigint>")(
        F.when(F.col("lost_keys").isNotNull(), F.col("line_text")), F.col("lost_keys"))
    return (met.withColumn("line_cut", cut).select(
        "line_row", "line_doc",
        F.coalesce("line_cut.text", "line_text").alias("line_text"),
        (F.length("line_text") - F.length(F.replace("line_text", F.lit("\n"), F.lit(""))) + 1)
        .cast("bigint").alias("n_lines"),
        F.coalesce("line_cut.n_dropped", F.lit(0)).cast("bigint").alias("n_dropped")))


def line_table(docs: DataFrame) -> DataFrame:
    """Per document: lines, dropped lines, and the digest of the text that stays."""
    return clean_rows(docs, index_lines(docs)).select(
        F.col("line_doc").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(F.col("line_text").cast("binary"), 256).alias("kept_sha256"))


def clean_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with their repeated lines removed; null texts stay null."""
    cleaned = clean_rows(docs, index_lines(docs))
    return cleaned.select(*(
        F.when(F.col("line_row.text").isNotNull(), F.col("line_text")).alias(c) if c == "text"
        else F.col(f"line_row.`{c}`").alias(c) for c in docs.columns))
