"""Quality rules: plain counts, and a calibrated classifier on hashed n-grams.

Word and character n-grams of a text are hashed into a fixed number of buckets;
a logistic regression on their relative frequencies is fitted on at most
``max_labels`` labelled rows (chosen by hash, so reruns agree), calibrated on
a fold of them that it was not fitted on, and applied in Arrow batches; where the
labels are so few that no fold leaves both classes on both sides, it is fitted on
all of them and its own probability stands uncalibrated. A text
is kept if no rule rejects it and the calibrated probability of good quality
reaches a fixed threshold.

Defined cases: null or empty text has no words and fails the rules; rows with
a null label or a label outside 0 and 1 are not learned from; several labels of
one document count as the lowest; with one class only, or none, in the labels
there is no classifier and the rules alone decide; repeated rows are judged
each; further columns are carried along untouched. Long texts are worked in
sections, all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardlight.llm.linear import SparseRows, fit_logistic, fit_platt
from wardlight.llm.words import hand_back, mixed, sections, word_hashes

# Labelled rows that are learned from, at most.
MAX_LABELS = 3000
# Calibrated probability of good quality from which a text is kept.
KEEP_FROM = 0.5
# Rules: fewer words than this, or a larger share of repeated words in percent, fail.
LEAST_WORDS, MOST_REPEATED = 10, 20
WORD_BITS, CHAR_BITS = 15, 14
WIDTH = (1 << WORD_BITS) + (1 << CHAR_BITS)
# Frequencies are small numbers; the factor brings weights into a common range.
_SCALE = 30.0
_CHARS = 1 << 18
_FOLDS = 5
# Texts of a batch that are held as Python objects together.
_AT_ONCE = 500

_SYMBOLS = list(b"#*$%&|<>")
_SPACES = [0x20, *range(0x09, 0x0E)]
RESULT = ("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
          "n_repeat_words:bigint,base_failed:boolean,quality:double,kept:boolean>")


def text_words(data: bytes) -> np.ndarray:
    """Hashes of all words of a text, in order."""
    return np.concatenate([word_hashes(s)[0] for s in sections(data)])


def joined(*parts: np.ndarray) -> np.ndarray:
    """One hash for each run of neighbouring hashes (or code points)."""
    total = parts[0].astype(np.uint64)
    for part in parts[1:]:
        total = total * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64) + np.uint64(1)
    return mixed(total)


def repeated_words(words: np.ndarray, window: int = 5) -> int:
    """Words inside windows that occur at least twice."""
    if len(words) <= window:
        return 0
    count = len(words) - window + 1
    keys = joined(*(words[i:i + count] for i in range(window)))
    order = np.argsort(keys)
    same = np.zeros(count + 1, dtype=bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    again = order[same[1:] | same[:-1]]
    if not len(again):
        return 0
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def gram_sections(text: str, words: np.ndarray):
    """Buckets of the text's n-grams: word unigrams and bigrams, then 1 to 3 characters.

    Yields (first bucket of the kind, buckets), section by section.
    """
    shift = np.uint64(64 - WORD_BITS)
    yield 0, (mixed(words) >> shift).astype(np.int64)
    if len(words) > 1:
        yield 0, (joined(words[:-1], words[1:]) >> shift).astype(np.int64)
    shift = np.uint64(64 - CHAR_BITS)
    for at in range(0, len(text), _CHARS):
        points = np.frombuffer(text[at:at + _CHARS + 2].encode("utf-32-le", "surrogatepass"),
                               dtype="<u4").astype(np.uint64)
        inside = min(_CHARS, len(text) - at)
        for order in (1, 2, 3):
            count = min(inside, len(points) - order + 1)
            if count > 0:
                grams = joined(*(points[i:i + count] for i in range(order)))
                yield 1 << WORD_BITS, (grams >> shift).astype(np.int64)


def gram_frequencies(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their scaled frequencies within their kind."""
    counts = np.zeros(WIDTH)
    for first, buckets in gram_sections(text, text_words(text.encode("utf-8", "replace"))):
        counts[first:] += np.bincount(buckets, minlength=WIDTH - first)[:WIDTH - first]
    half = 1 << WORD_BITS
    for part in (counts[:half], counts[half:]):
        part *= _SCALE / max(1.0, part.sum())
    found = np.flatnonzero(counts)
    return found.astype(np.int32), counts[found].astype(np.float32)


@dataclass(frozen=True)
class QualityModel:
    """Weights per bucket, bias, and the calibration's slope and offset."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, text: str, words: np.ndarray) -> float:
        sums, counts = [0.0, 0.0], [0, 0]
        for first, buckets in gram_sections(text, words):
            kind = int(first > 0)
            sums[kind] += float(self.weights[first + buckets].sum())
            counts[kind] += len(buckets)
        score = self.bias + _SCALE * sum(s / max(1, n) for s, n in zip(sums, counts))
        return float(1 / (1 + np.exp(-np.clip(self.slope * score + self.offset, -35, 35))))


def _feature_rows(batches):
    for batch in batches:
        pairs = [gram_frequencies(t or "") for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             pa.array([b.tobytes() for b, _ in pairs], pa.binary()),
             pa.array([v.tobytes() for _, v in pairs], pa.binary())],
            names=["fold", "quality", "buckets", "frequencies"])
    hand_back()


def fit_quality(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS
                ) -> QualityModel | None:
    """The model, from at most ``max_labels`` labelled rows; None without both classes.

    The chosen labels are few by their limit, so they are broadcast and no text
    is shuffled; the features of those rows alone reach the driver.
    """
    chosen = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").cast("bigint").alias("l_doc"))
              .agg(F.min("quality").cast("int").alias("l_quality"))
              .orderBy(F.xxhash64("l_doc"), "l_doc").limit(max_labels))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "l_doc"), F.lit(_FOLDS)).cast("int")
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("q_doc"),
                        F.col("text").cast("string").alias("q_text"))
            .join(F.broadcast(chosen), F.col("q_doc") == F.col("l_doc"))
            .select(fold.alias("fold"), "l_quality", "q_text")
            .mapInArrow(_feature_rows,
                        "fold int, quality int, buckets binary, frequencies binary").collect())
    good = np.array([r["quality"] == 1 for r in rows], dtype=bool)
    fold = np.array([r["fold"] for r in rows], dtype=np.int64)
    if good.all() or not good.any():
        return None
    folds = [held for held in ((fold + f) % _FOLDS == 0 for f in range(_FOLDS))
             if 0 < good[held].sum() < held.sum() and 0 < good[~held].sum() < (~held).sum()]
    held = folds[0] if folds else np.zeros(len(good), dtype=bool)
    matrix = SparseRows.of([(r["buckets"], r["frequencies"]) for r in rows], WIDTH)
    del rows
    weights, bias = fit_logistic(matrix.take(~held), good[~held])
    slope, offset = fit_platt(matrix.take(held).times(weights) + bias, good[held]) if folds else (1.0, 0.0)
    hand_back()
    return QualityModel(weights.astype(np.float32), bias, slope, offset)


def judged(model: QualityModel | None, text: str | None, keep_from: float = KEEP_FROM) -> dict:
    """Counts, rule verdict, probability and final verdict of one text."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = text_words(data)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeated = repeated_words(words)
    failed = len(words) < LEAST_WORDS or 100 * repeated > MOST_REPEATED * len(words)
    quality = model.probability(text, words) if model else None
    return {"n_words": len(words),
            "word_chars": int(counts.sum() - counts[0x80:0xC0].sum() - counts[_SPACES].sum()),
            "n_symbols": int(counts[_SYMBOLS].sum()), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": repeated, "base_failed": failed, "quality": quality,
            "kept": not failed and (quality is None or quality >= keep_from)}


_TYPE = pa.struct([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                   ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
                   ("base_failed", pa.bool_()), ("quality", pa.float64()), ("kept", pa.bool_())])


def quality_of(text: Column, model: QualityModel | None, keep_from: float = KEEP_FROM) -> Column:
    """A struct of counts and verdicts, worked out in Arrow batches."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = []
            for at in range(0, len(texts), _AT_ONCE):
                found += [judged(model, t, keep_from) for t in texts.slice(at, _AT_ONCE).to_pylist()]
            yield pa.array(found, type=_TYPE)
        hand_back()

    return F.arrow_udf(run, RESULT)(text.cast("string"))


def quality_table(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """One row per document: ``doc_id``, the counts, the probability and the verdicts."""
    model = fit_quality(docs, labels, **settings)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       quality_of(F.col("text"), model).alias("judged")).select(
        "doc_id", "judged.*")


def good_documents(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are kept, all their columns unchanged."""
    model = fit_quality(docs, labels, **settings)
    return docs.where(quality_of(F.col("text"), model).getField("kept"))
