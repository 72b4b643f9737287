"""Language identification by hierarchical discrimination.

First the language family is predicted, then linear support vector machines,
one for each pair of closely related languages, decide within it. Features are
hashed runs of 1 to 4 characters over the letters of the lower-cased text, all
of it. Families come from a fixed table; a language outside it is a family of its
own, but if there are more than ``UNLISTED`` of them, they are put together in
families of so many in order of their names, so that the machines stay few.

The machines are fitted on about ``per_language`` rows of every language, and on
some ``MOST_ROWS`` in all, chosen by hash, so that reruns agree and rare languages
are learned in full.

Defined cases: text that is null or has no letter is ``und`` with score 0; with
nothing to learn from, every text is ``und``; with one learned language every
text with a letter is that language with score 1; rows with null ``lang`` or
null text are predicted but never learned from; repeated rows count each;
further columns are carried along untouched by :func:`language_of`.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardlight.llm.linear import SparseRows, fit_svm
from wardlight.llm.quality import joined

# Rows per language that are learned from, on average, and rows in all if languages are many.
PER_LANGUAGE, MOST_ROWS = 600, 12_000
# Languages of one family where the table names none.
UNLISTED = 8
WIDTH = 1 << 15
ORDERS = (1, 2, 3, 4)
_SCALE = 30.0
_CHARS = 1 << 18

# ISO 639-1 codes by language family.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "hellenic": "el",
    "indo-aryan": "as bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt ug uz",
    "semitic": "am ar he mt",
    "sinitic": "zh",
    "japonic": "ja",
    "koreanic": "ko",
    "austronesian": "id jv mg mi ms su tl",
    "dravidian": "kn ml ta te",
    "bantu": "rw sw xh zu",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
_letters: list[np.ndarray] = []


def family_of(lang: str) -> str:
    code = lang.lower().split("-")[0].split("_")[0]
    return _FAMILY.get(code, f"only {lang}")


def families_of(langs: list[str]) -> dict[str, str]:
    """The family of every language; many that the table does not list are put together in order of name."""
    found = {lang: family_of(lang) for lang in sorted(set(langs))}
    unlisted = [lang for lang, family in found.items() if family == f"only {lang}"]
    if len(unlisted) > UNLISTED:
        found |= {lang: f"unlisted {at // UNLISTED}" for at, lang in enumerate(unlisted)}
    return found


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool))
    return _letters[0]


def letter_sections(text: str):
    """The lower-cased text's letters, runs of anything else made one space, in sections."""
    table = _letter_table()
    last_space = True
    for at in range(0, len(text), _CHARS):
        points = np.frombuffer(
            text[at:at + _CHARS].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letters = table[points]
        keep = letters.copy()
        keep[1:] |= letters[:-1]
        keep[0] = letters[0] or not last_space
        last_space = not letters[-1]
        yield np.where(letters, points, 32)[keep].astype(np.uint64)


def letter_buckets(text: str):
    """Buckets of the n-grams of a text's letters, section by section; empty without letters."""
    shift = np.uint64(64 - WIDTH.bit_length() + 1)
    carried = np.full(1, 32, dtype=np.uint64)
    for points in letter_sections(text):
        run = np.concatenate([carried, points])
        fresh = len(run) - len(points)
        for order in ORDERS:
            # Runs that end inside this section.
            begin = max(0, fresh - order + 1)
            count = len(run) - order + 1 - begin
            if count > 0:
                yield (joined(*(run[begin + i:begin + i + count] for i in range(order)),
                              np.full(count, order)) >> shift).astype(np.int64)
        carried = run[-(max(ORDERS) - 1):]


def letter_frequencies(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and scaled relative frequencies."""
    counts = np.zeros(WIDTH)
    for buckets in letter_buckets(text):
        counts += np.bincount(buckets, minlength=WIDTH)
    counts *= _SCALE / max(1.0, counts.sum())
    found = np.flatnonzero(counts)
    return found.astype(np.int32), counts[found].astype(np.float32)


@dataclass(frozen=True)
class Machines:
    """One machine for each pair of ``names``: the column's sum is positive for the first."""

    names: list[str]
    weights: np.ndarray = field(repr=False)   # bucket x pair
    biases: np.ndarray = field(repr=False)

    def chances(self, means: np.ndarray) -> np.ndarray:
        """A chance per name: the softmax of its mean margin against the others."""
        margins = means + self.biases
        total = np.zeros(len(self.names))
        for value, (a, b) in zip(margins, combinations(range(len(self.names)), 2)):
            total[a] += value
            total[b] -= value
        total = 2 * total / max(1, len(self.names) - 1)
        total = np.exp(np.clip(total - total.max(), -60, 0))
        return total / total.sum()


@dataclass(frozen=True)
class LanguageModel:
    families: Machines
    within: dict[str, Machines]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score of one text."""
        if not text or not self.families.names:
            return "und", 0.0
        counts = np.zeros(WIDTH)
        for buckets in letter_buckets(text):
            counts += np.bincount(buckets, minlength=WIDTH)
        total = counts.sum()
        if not _letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"),
                                             dtype="<u4")].any():
            return "und", 0.0
        counts = (counts * (_SCALE / total)).astype(np.float32)
        score, machines = 1.0, self.families
        while True:
            chances = (machines.chances(counts @ machines.weights)
                       if len(machines.names) > 1 else np.ones(1))
            best = int(np.argmax(chances))
            score, name = score * float(chances[best]), machines.names[best]
            if machines is not self.families:
                return name, score
            machines = self.within[name]


def fit_machines(rows: SparseRows, labels: np.ndarray) -> Machines:
    """One support vector machine per pair of the labels' values."""
    names = sorted(set(labels.tolist()))
    pairs = list(combinations(names, 2))
    weights = np.zeros((rows.width, len(pairs)), dtype=np.float32)
    biases = np.zeros(len(pairs))
    for at, (a, b) in enumerate(pairs):
        both = (labels == a) | (labels == b)
        weights[:, at], biases[at] = fit_svm(rows.take(both), labels[both] == a)
    return Machines(names, weights, biases)


def _feature_rows(batches):
    for batch in batches:
        pairs = [letter_frequencies(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([b.tobytes() for b, _ in pairs], pa.binary()),
             pa.array([v.tobytes() for _, v in pairs], pa.binary())],
            names=["lang", "buckets", "frequencies"])


def fit_languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """The model, from about ``per_language`` rows of each language of ``docs``.

    The number of rows of every language sets the share of them that is drawn;
    the draw is a hash of the key, so it needs no sort and no shuffle of texts.
    The counts hold one row per language.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("s_doc"), F.col("lang").cast("string").alias("s_lang"),
        F.col("text").cast("string").alias("s_text"))
    counts = known.groupBy("s_lang").count().collect()
    per_language = min(per_language, max(1, MOST_ROWS // max(1, len(counts))))
    shares = F.create_map(*(F.lit(x) for r in counts for x in (
        r["s_lang"], min(1.0, per_language / r["count"])))) if counts else None
    if shares is None:
        return LanguageModel(Machines([], np.zeros((WIDTH, 0)), np.zeros(0)), {})
    draw = F.pmod(F.xxhash64(F.lit("draw"), "s_doc"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = (known.where(draw < shares[F.col("s_lang")]).select("s_lang", "s_text")
            .mapInArrow(_feature_rows, "lang string, buckets binary, frequencies binary")
            .collect())
    rows = [r for r in rows if r["buckets"]]
    labels = np.array([r["lang"] for r in rows], dtype=object)
    matrix = SparseRows.of([(r["buckets"], r["frequencies"]) for r in rows], WIDTH)
    del rows
    family = families_of(labels.tolist())
    families = np.array([family[lang] for lang in labels], dtype=object)
    return LanguageModel(
        fit_machines(matrix, families),
        {name: fit_machines(matrix.take(families == name), labels[families == name])
         for name in sorted(set(families.tolist()))})


def language_of(text: Column, model: LanguageModel) -> Column:
    """A struct of language and score, worked out in Arrow batches."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    def run(texts: pa.Array) -> pa.Array:
        found = [model.predict(t) for t in texts.to_pylist()]
        return pa.array([{"lang_pred": a, "score": b} for a, b in found], type=kind)

    return F.arrow_udf(run, "struct<lang_pred:string,score:double>")(text.cast("string"))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the checksum of the key as text falls into one fold; a null key does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def language_table(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Per document: ``held_out``, ``lang_pred``, ``score``; learned from the rest only."""
    model = fit_languages(docs.where(~held_out(F.col("doc_id"), 3, 1)), per_language)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       held_out(F.col("doc_id"), 3, 1).alias("held_out"),
                       language_of(F.col("text"), model).alias("found")).select(
        "doc_id", "held_out", "found.*")
