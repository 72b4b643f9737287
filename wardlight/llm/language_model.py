"""A bigram language model by deleted interpolation, and log probabilities under it.

A word's probability after its context mixes three maximum-likelihood
estimates: of the bigram, of the word alone, and the smoothed share that also
covers unknown words. The mixture depends on how often the context was seen:
contexts are put into buckets of doubling counts, and each bucket's weights are
learned by expectation-maximisation on a fold of the training documents whose
own counts are deleted from the estimates.

Counts cover every document and every n-gram. The work is laid out for it:

1. Documents are read once into chunks of some million tokens; a chunk keeps
   its vocabulary and its tokens as numbers into it.
2. A chunk asks for the counts of its distinct n-grams only. Requests are dealt
   out by ranges of the n-grams' hashes; a range adds up all chunks' counts and
   answers each request in its own order, so an answer holds no keys. A frequent
   word or pair is one entry per chunk, never one per occurrence.
3. Answers meet their chunk as a stream, one chunk in memory at a time, and every
   token gets its counts. The fold's tokens give a histogram of bounded size,
   from which the weights are learned; then every document is scored.

The number of ranges follows the number of tokens, so one range's counts stay
within a task's memory at any size. Words are told apart by 64-bit hashes,
pairs by 56 bits of theirs.

Defined cases: null text is empty and holds the end token only; a null
``doc_id`` is trained on and not held out; repeated rows count each; without
training tokens the smoothed share alone is used; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardlight.llm.arrays import loosened, sorted_counts, squeezed, steps
from wardlight.llm.quality import joined
from wardlight.llm.words import as_bytes, each_row, grouped_words, mixed
from wardlight.session import settled, settled_alone

# Tokens of one chunk, at most (one longer text alone is a chunk), and of one range, about.
CHUNK_TOKENS = 1_000_000
RANGE_TOKENS = 1 << 20
_END, _BEGIN = (mixed(np.array([v], dtype=np.uint64))[0] for v in (0xE0D, 0xBE61))
_PAIR_DROPPED = 8
_BUCKETS = 40
_QUARTERS = 4
# Weights of bigram, word and smoothed share where nothing can be learned.
_DEFAULT = np.array([0.5, 0.3, 0.2])

TRAIN, FOLD, HELD = 0, 1, 2
_CHUNK = "doc_ids array<bigint>, parts binary, lengths binary, vocabulary binary, tokens binary"


def _pack_chunk(docs: list, parts: list[int], lengths: list[int], hashes: list[np.ndarray]
                ) -> pa.RecordBatch:
    """Vocabulary by falling frequency, then by hash; tokens as places in it."""
    stream = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    codes, words = pd.factorize(stream)
    words = np.asarray(words, dtype=np.uint64)
    order = np.lexsort((words, -np.bincount(codes, minlength=len(words))))
    place = np.empty(len(words), dtype=np.uint32)
    place[order] = np.arange(len(words), dtype=np.uint32)
    return pa.RecordBatch.from_arrays(
        [pa.array([docs], pa.list_(pa.int64())),
         pa.array([np.array(parts, dtype=np.uint8).tobytes()], pa.binary()),
         pa.array([np.array(lengths, dtype="<u4").tobytes()], pa.binary()),
         pa.array([squeezed(steps(words[order]))], pa.binary()),
         pa.array([squeezed(place[codes])], pa.binary())],
        names=["doc_ids", "parts", "lengths", "vocabulary", "tokens"])


def _chunk_rows(chunk_tokens: int):
    def run(batches):
        docs, parts, lengths, hashes, size = [], [], [], [], 0
        for batch in batches:
            ids, folds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = as_bytes(batch.column(2), lower=True)
            for first, end, words, before in grouped_words(texts):
                if size and size + len(words) + end - first > chunk_tokens:
                    yield _pack_chunk(docs, parts, lengths, hashes)
                    docs, parts, lengths, hashes, size = [], [], [], [], 0
                # The end token goes behind every document's words.
                hashes.append(np.insert(words, before[1:], _END))
                docs += ids[first:end]
                parts += folds[first:end]
                lengths += (np.diff(before) + 1).tolist()
                size += len(words) + end - first
        if docs:
            yield _pack_chunk(docs, parts, lengths, hashes)

    return run


def _numbered(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For each value the number of its equals, and one value per number.

    Values below ``limit`` are sorted together with their places in one word
    each where both fit, which needs less memory than a table of them.
    """
    bits = max(1, len(values) - 1).bit_length()
    if limit << bits > 1 << 63:
        codes, distinct = pd.factorize(values)
        return codes, np.asarray(distinct)
    packed = np.sort(values << bits | np.arange(len(values)))
    at = packed & ((1 << bits) - 1)
    packed >>= bits
    new = np.append(True, packed[1:] != packed[:-1])
    codes = np.empty(len(values), dtype=np.int32)
    codes[at] = np.cumsum(new, dtype=np.int32) - 1
    return codes, packed[new]


@dataclass
class Chunk:
    """A chunk's tokens, their documents, and the distinct n-grams they make."""

    parts: np.ndarray
    lengths: np.ndarray
    vocabulary: np.ndarray
    tokens: np.ndarray

    @staticmethod
    def of(row: dict) -> "Chunk":
        return Chunk(np.frombuffer(row["parts"], dtype=np.uint8),
                     np.frombuffer(row["lengths"], dtype="<u4").astype(np.int64),
                     np.cumsum(loosened(row["vocabulary"], np.uint64), dtype=np.uint64),
                     loosened(row["tokens"], np.uint32).astype(np.int64))

    def starts(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths

    def token_parts(self) -> np.ndarray:
        return np.repeat(self.parts, self.lengths)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted word keys with the begin mark, and for each token the place of its word;
        the begin mark's place last."""
        keys = np.append(self.vocabulary, _BEGIN)
        order = np.argsort(keys)
        place = np.empty(len(keys), dtype=np.int64)
        place[order] = np.arange(len(keys))
        return keys[order], place[self.tokens], place[-1:]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct pair keys, and for each token the place of the pair it ends."""
        before = np.empty(len(self.tokens), dtype=np.int64)
        before[1:] = self.tokens[:-1]
        before[self.starts()] = len(self.vocabulary)
        codes, distinct = _numbered(before * (len(self.vocabulary) + 1) + self.tokens,
                                    (len(self.vocabulary) + 1) ** 2)
        keys = np.append(self.vocabulary, _BEGIN)
        left, right = np.divmod(distinct, len(self.vocabulary) + 1)
        hashes = joined(keys[left], keys[right]) >> np.uint64(_PAIR_DROPPED)
        order = np.argsort(hashes)
        place = np.empty(len(hashes), dtype=np.int32)
        place[order] = np.arange(len(hashes), dtype=np.int32)
        return hashes[order], place[codes]


def _range_cuts(keys: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Where each of ``ranges`` equal ranges of ``bits``-bit keys begins, and the end."""
    width = (1 << bits) // ranges
    edges = np.array([i * width for i in range(ranges)], dtype=np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


_REQUEST = "range int, kind int, chunk bigint, keys binary, trained binary, folded binary"


def _request_rows(ranges: int):
    def run(batches):
        for batch in batches:
            for row in each_row(batch):
                chunk = Chunk.of(row)
                part = chunk.token_parts()
                for kind, bits in ((1, 64), (2, 64 - _PAIR_DROPPED)):
                    if kind == 1:
                        own, at, begin = chunk.words()
                    else:
                        own, at = chunk.pairs()
                    trained = np.bincount(at[part != HELD], minlength=len(own))
                    folded = np.bincount(at[part == FOLD], minlength=len(own))
                    if kind == 1:
                        trained[begin] += int((chunk.parts != HELD).sum())
                        folded[begin] += int((chunk.parts == FOLD).sum())
                    cuts = _range_cuts(own, bits, ranges)
                    slices = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(range(ranges), pa.int32()), pa.array([kind] * ranges, pa.int32()),
                         pa.array([row["chunk"]] * ranges, pa.int64()),
                         pa.array([squeezed(steps(own[s])) for s in slices], pa.binary()),
                         pa.array([squeezed(trained[s].astype(np.uint32)) for s in slices],
                                  pa.binary()),
                         pa.array([squeezed(folded[s].astype(np.uint32)) for s in slices],
                                  pa.binary())],
                        names=["range", "kind", "chunk", "keys", "trained", "folded"])

    return run


_ANSWER = ("range int, kind int, chunk bigint, trained binary, folded binary, types bigint, "
           "trained_tokens bigint, folded_tokens bigint")


def _answer_range(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """All chunks' counts of one range added up, and one answer per request."""
    out = []
    for kind in (1, 2):
        rows = [r for r in table.to_pylist() if r["kind"] == kind]
        keys = [np.cumsum(loosened(r["keys"], np.uint64), dtype=np.uint64) for r in rows]
        if not rows:
            continue
        distinct, _ = sorted_counts(np.concatenate(keys))
        trained = np.zeros(len(distinct), dtype=np.uint64)
        folded = np.zeros(len(distinct), dtype=np.uint64)
        places = [np.searchsorted(distinct, k) for k in keys]
        for row, place in zip(rows, places):
            # A chunk's keys are distinct, but for pairs whose shortened hashes agree.
            np.add.at(trained, place, loosened(row["trained"], np.uint32).astype(np.uint64))
            np.add.at(folded, place, loosened(row["folded"], np.uint32).astype(np.uint64))
        for row, place in zip(rows, places):
            out.append({"range": row["range"], "kind": kind, "chunk": row["chunk"],
                        "trained": squeezed(trained[place]), "folded": squeezed(folded[place])})
        if kind == 1:
            real = distinct != _BEGIN
            out.append({"range": key[0].as_py(), "kind": 0, "chunk": -1,
                        "types": int((trained[real] > 0).sum()),
                        "trained_tokens": int(trained[real].sum()),
                        "folded_tokens": int(folded[real].sum())})
    schema = pa.schema([("range", pa.int32()), ("kind", pa.int32()), ("chunk", pa.int64()),
                        ("trained", pa.binary()), ("folded", pa.binary()),
                        ("types", pa.int64()), ("trained_tokens", pa.int64()),
                        ("folded_tokens", pa.int64())])
    return pa.Table.from_pylist(out, schema=schema)


@dataclass(frozen=True)
class Totals:
    types: int
    tokens: int
    folded: int

    def share(self, counts: np.ndarray, deleted: int = 0) -> np.ndarray:
        """The smoothed share of words with these counts; unknown words have one share."""
        return (counts + 1) / (self.tokens - deleted + self.types + 1)


def bucket_of(contexts: np.ndarray) -> np.ndarray:
    """Bucket of a context's count: 0 unseen, then one per power of two."""
    return np.where(contexts > 0, np.minimum(
        np.log2(np.maximum(contexts, 1)).astype(np.int64) + 1, _BUCKETS - 1), 0)


_COUNTED = ("doc_ids array<bigint>, parts binary, lengths binary, known binary, bases binary, "
            "words binary, contexts binary, pairs binary, histogram binary")


def _fold_histogram(words, contexts, pairs, totals: Totals) -> np.ndarray:
    """(context bucket, bigram estimate, word count) in quarter powers of two, with counts."""
    bucket = bucket_of(contexts)
    with np.errstate(divide="ignore", invalid="ignore"):
        level = np.where((pairs > 0) & (contexts > 0), np.round(
            -_QUARTERS * np.log2(pairs / np.maximum(contexts, 1))), 255).astype(np.int64)
    level = np.minimum(level, 255)
    count = np.round(_QUARTERS * np.log2(words + 1.0)).astype(np.int64)
    cells, n = sorted_counts(((bucket * 256 + level) * 256 + np.minimum(count, 255))
                             .astype(np.uint64))
    return np.stack([cells.astype(np.int64), n])


def _count_tokens(totals: Totals):
    """Reads answers, then their chunk, sorted one behind the other."""
    def run(batches):
        place, answers = None, []
        for batch in batches:
            for row in each_row(batch):
                if row["chunk"] != place:
                    place, answers = row["chunk"], []
                if not row["late"]:
                    answers.append((row["kind"], row["range"], row["trained"], row["folded"]))
                    continue
                answers.sort(key=lambda a: a[:2])
                counts = {(kind, at): np.concatenate(
                    [loosened(a[at], np.uint64) for a in answers if a[0] == kind]).astype(np.int64)
                    for kind in (1, 2) for at in (2, 3)}
                answers = []
                chunk = Chunk.of(row)
                _, words, begin = chunk.words()
                _, pairs = chunk.pairs()
                starts = chunk.starts()
                before = np.empty(len(words), dtype=np.int64)
                before[1:] = words[:-1]
                before[starts] = begin[0]
                word, context = counts[1, 2][words], counts[1, 2][before]
                pair = counts[2, 2][pairs]
                fold = chunk.token_parts() == FOLD
                histogram = _fold_histogram(
                    (word - counts[1, 3][words])[fold], (context - counts[1, 3][before])[fold],
                    (pair - counts[2, 3][pairs])[fold], totals)
                base = np.add.reduceat(np.log10(totals.share(word)), starts)
                known = np.add.reduceat((word > 0).astype(np.int64), starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_ids"]], pa.list_(pa.int64())),
                     *(pa.array([b], pa.binary()) for b in (
                         row["parts"], row["lengths"], known.astype("<i8").tobytes(),
                         base.astype("<f8").tobytes(), squeezed(word.astype(np.uint64)),
                         squeezed(context[starts].astype(np.uint64)),
                         squeezed(pair.astype(np.uint64)), histogram.tobytes()))],
                    names=["doc_ids", "parts", "lengths", "known", "bases", "words", "contexts",
                           "pairs", "histogram"])

    return run


def _histogram_rows(batches):
    for batch in batches:
        for data in batch.column(0).to_pylist():
            cells, n = np.frombuffer(data, dtype=np.int64).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n)], names=["cell", "n"])


def learn_weights(cells: np.ndarray, n: np.ndarray, totals: Totals, rounds: int = 60
                  ) -> np.ndarray:
    """Mixture weights per context bucket, by expectation-maximisation over the histogram."""
    weights = np.tile(_DEFAULT, (_BUCKETS, 1))
    weights[0] = [0.0, 0.6, 0.4]
    if not totals.tokens:
        return np.tile([0.0, 0.0, 1.0], (_BUCKETS, 1))
    bucket, level, count = cells >> 16, (cells >> 8) & 255, cells & 255
    word = 2.0 ** (count / _QUARTERS) - 1
    estimates = np.stack([
        np.where(level < 255, 2.0 ** (-level / _QUARTERS), 0.0),
        word / max(1, totals.tokens - totals.folded), totals.share(word, totals.folded)], axis=1)
    n = n.astype(np.float64)
    pooled = weights[1]
    for _ in range(rounds if len(n) else 0):
        each = estimates * pooled
        pooled = (n[:, None] * each / each.sum(axis=1, keepdims=True)).sum(axis=0)
        pooled = pooled / pooled.sum()
    for b in range(_BUCKETS):
        here = bucket == b
        if not here.any():
            if b:
                weights[b] = pooled
            continue
        own, weight = weights[b], n[here]
        for _ in range(rounds):
            each = estimates[here] * own
            own = (weight[:, None] * each / each.sum(axis=1, keepdims=True)).sum(axis=0)
            # One token's worth of the pooled weights keeps every estimate in play.
            own = (own + pooled) / (own.sum() + 1)
        weights[b] = own
    weights[0] = [0.0, *(weights[0][1:] / weights[0][1:].sum())]
    return weights


_SCORE = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def token_chances(words, contexts, pairs, weights: np.ndarray, totals: Totals) -> np.ndarray:
    """Mixed probability of every token from its counts."""
    mix = weights[bucket_of(contexts)]
    return (mix[:, 0] * pairs / np.maximum(contexts, 1) + mix[:, 1] * words / max(1, totals.tokens)
            + mix[:, 2] * totals.share(words))


def _score_rows(weights: np.ndarray, totals: Totals):
    def run(batches):
        for batch in batches:
            for row in each_row(batch):
                lengths = np.frombuffer(row["lengths"], dtype="<u4").astype(np.int64)
                starts = np.cumsum(lengths) - lengths
                words = loosened(row["words"], np.uint64).astype(np.int64)
                contexts = np.empty_like(words)
                contexts[1:] = words[:-1]
                contexts[starts] = loosened(row["contexts"], np.uint64).astype(np.int64)
                pairs = loosened(row["pairs"], np.uint64).astype(np.int64)
                chances = token_chances(words, contexts, pairs, weights, totals)
                scores = np.add.reduceat(np.log10(chances), starts)
                parts = np.frombuffer(row["parts"], dtype=np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(parts == HELD),
                     pa.array(lengths), pa.array(np.frombuffer(row["known"], dtype="<i8")),
                     pa.array(np.full(len(lengths), totals.tokens, dtype=np.int64)),
                     pa.array(np.frombuffer(row["bases"], dtype="<f8")), pa.array(scores)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                           "base_score", "score"])

    return run


def score_documents(docs: DataFrame, folds: int = 7, held: int = 2, tuned: int = 3,
                    chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Every document's log10 probability; held-out documents are scored, never learned from.

    Documents whose checksum of the key falls into fold ``held`` are held out;
    those of fold ``tuned`` are trained on and also set the mixture weights.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    part = (F.when(fold == held, HELD).when(fold == tuned, FOLD).otherwise(TRAIN)).cast("int")
    chunks = settled(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), part.alias("part"),
                    F.col("text").cast("string").alias("text"))
        .mapInArrow(_chunk_rows(chunk_tokens), _CHUNK)
        .withColumn("chunk", F.monotonically_increasing_id()), "lm-chunks")
    tokens = sum(r["n"] for r in chunks.mapInArrow(_token_totals, "n bigint").groupBy().agg(
        F.sum("n").alias("n")).collect() if r["n"])
    ranges = 1 << max(0, (tokens // RANGE_TOKENS)).bit_length()
    answers = settled_alone(
        chunks.mapInArrow(_request_rows(ranges), _REQUEST).groupBy("range").applyInArrow(
            _answer_range, _ANSWER), "lm-answers")
    sums = answers.where(F.col("kind") == 0).agg(
        F.sum("types"), F.sum("trained_tokens"), F.sum("folded_tokens")).first()
    totals = Totals(*(int(v or 0) for v in sums))
    nothing = F.lit(None).cast("binary")
    first = answers.where(F.col("kind") > 0).select(
        "chunk", F.lit(0).alias("late"), "kind", "range", "trained", "folded",
        F.lit(None).cast("array<bigint>").alias("doc_ids"),
        *(nothing.alias(c) for c in ("parts", "lengths", "vocabulary", "tokens")))
    last = chunks.select(
        "chunk", F.lit(1).alias("late"), F.lit(0).alias("kind"), F.lit(0).alias("range"),
        nothing.alias("trained"), nothing.alias("folded"), "doc_ids", "parts", "lengths",
        "vocabulary", "tokens")
    counted = settled_alone(
        first.unionByName(last).repartition("chunk").sortWithinPartitions("chunk", "late")
        .mapInArrow(_count_tokens(totals), _COUNTED), "lm-counted")
    cells = counted.select("histogram").mapInArrow(
        _histogram_rows, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    weights = learn_weights(np.array([r["cell"] for r in cells], dtype=np.int64),
                            np.array([r["n"] for r in cells], dtype=np.int64), totals)
    return counted.drop("histogram").mapInArrow(_score_rows(weights, totals), _SCORE)


def _token_totals(batches):
    for batch in batches:
        sizes = [int(np.frombuffer(b, dtype="<u4").sum()) for b in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], names=["n"])
