"""Source divergence audit: how each source's words differ from its language's.

Terms are counted once per (language, source), combined before they are shuffled;
a language keeps the terms of at least ``least_docs`` of its documents. The
divergence of two counts depends on the counts alone, so it is worked out per
count cell, not per term:

* ``term``: a group's terms fall into cells (group count, language count). Each
  cell gets its value once, cells of equal value are merged, and the highest
  values are taken until their multiplicities reach the ranks asked for. Only
  the cells of those values are expanded into terms, in UTF-8 order.
* ``pair``: the sum over all kept terms is taken as if the two sources shared no
  term (cells of each source against the other's zero), and corrected by the
  terms that both have. Those are met in blocks of terms of bounded size; a block
  gives one partial sum per pair of sources, however many terms they share.

Counts enter as decimals, so no product overflows; shares are at most 10**9 + 1.

Defined cases: null text, language and source are ''; every row is a document, so
repeated rows count as often as they occur; ``doc_id`` and further columns are
not read; a group without terms has the shares of zero counts; a language
without kept terms gives pairs of value 0 and no term; a language of one source
has no pair; an empty table gives no row. A term of any length stays whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlight.llm.words import as_bytes, sections
from wardlight.session import settled

# A term in lower-cased UTF-8: letters a-z and whatever is not ASCII.
_TERM_BYTES = re.compile(rb"[a-z\x80-\xFF]+")
# Scale of a share and what is added to each count.
SCALE, PRIOR = 1_000_000_000, 2
# Different (language, source, term) that a task holds before it hands its counts on.
HELD_TERMS = 200_000
# Rows (term, source) that a block of terms holds on average.
BLOCK_ROWS = 1 << 15


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's documents, handed on whenever enough different terms are held."""
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def counts():
        for (lang, source), (n, docs) in found.items():
            size = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()).take(pa.array(np.zeros(size, np.int64))),
                 pa.array([source], pa.string()).take(pa.array(np.zeros(size, np.int64))),
                 pa.array(list(n), pa.binary()).cast(pa.string()),
                 pa.array(list(n.values()), pa.int64()),
                 pa.array([docs[term] for term in n], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        langs, sources = (batch.column(i).to_pylist() for i in (0, 1))
        for lang, source, text in zip(langs, sources, as_bytes(batch.column(2), lower=True)):
            n, docs = found.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            own: set[bytes] = set()
            for part in sections(text):
                terms = _TERM_BYTES.findall(part)
                n.update(terms)
                own.update(terms)
            docs.update(own)
            held += len(n) - before
            if held >= HELD_TERMS:
                yield from counts()
                found.clear()
                held = 0
    yield from counts()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, occurrences ``n`` and documents ``docs`` that hold it.

    Tasks combine before they shuffle: a hot source sends each of its terms about once a task.
    """
    read = docs.select(*(F.coalesce(F.col(name), F.lit("")).alias(name)
                         for name in ("lang", "source", "text")))
    parts = read.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms))``, exactly."""
    def wide(value):
        return value.cast("decimal(19,0)")

    above = (wide(count) + F.lit(PRIOR)) * F.lit(SCALE).cast("decimal(10,0)")
    below = wide(total) + wide(terms) * F.lit(PRIOR)
    return F.lit(1) + F.call_function("div", above, below)


def _value(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _joint_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One correction per block of terms and pair of sources that share terms there.

    Rows come sorted by (lang, block); a block is held at a time, as one sorted run of
    term numbers per source.
    """
    names = ["lang", "source", "item", "value"]
    place, rows = None, []

    def sums():
        table = pa.Table.from_batches(rows)
        if table.num_rows == 0:
            return
        terms = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        p, zero = (table.column(c).to_numpy() for c in ("p", "zero"))
        coded = table.column("source").combine_chunks().dictionary_encode()
        codes, sources = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        order = np.lexsort((terms, codes))
        terms, p, zero, codes = terms[order], p[order], zero[order], codes[order]
        ends = np.searchsorted(codes, np.arange(len(sources) + 1))
        out = []
        for a in range(len(sources)):
            mine = slice(ends[a], ends[a + 1])
            for b in range(a + 1, len(sources)):
                other = slice(ends[b], ends[b + 1])
                _, i, j = np.intersect1d(terms[mine], terms[other], assume_unique=True,
                                         return_indices=True)
                if not len(i):
                    continue
                x, y, x0, y0 = p[mine][i], p[other][j], zero[mine][i], zero[other][j]
                gain = (_values(x, y) - _values(x, y0) - _values(x0, y) + _values(x0, y0)).sum()
                out += [(sources[a], sources[b], int(gain)), (sources[b], sources[a], int(gain))]
        if out:
            own, item, gain = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([place[0]] * len(out), pa.string()), pa.array(own, pa.string()),
                 pa.array(item, pa.string()), pa.array(gain, pa.int64())], names=names)

    for batch in batches:
        block = [batch.column("lang").to_pylist(), batch.column("block").to_pylist()]
        keys = list(zip(*block))
        begin = 0
        for at in range(1, len(keys) + 1):
            if at == len(keys) or keys[at] != keys[begin]:
                if keys[begin] != place and rows:
                    yield from sums()
                    rows.clear()
                place = keys[begin]
                rows.append(batch.slice(begin, at - begin))
                begin = at
    if rows:
        yield from sums()


def _values(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The divergence of shares; squares of shares stay below 2**60."""
    return (p - q) * (p - q) // (p + q)


def divergence(docs: DataFrame, least_docs: int = 10, ranks: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``; see the module."""
    counts = settled(term_counts(docs), "term-counts")
    kept = settled(counts.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
        .select("lang", "term", "lang_n"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    rows = settled(counts.join(kept, ["lang", "term"]).select(
        "lang", "source", "term", "n", "lang_n"), "kept-counts")
    # One row per group, those without terms included, with its total and its share of no occurrence.
    seen = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    totals = rows.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("own_terms"))
    groups = settled(
        seen.join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        .select("lang", "source", *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
                                    for c in ("terms", "lang_total", "total", "own_terms")))
        .withColumn("zero", F.when(F.col("terms") > 0, _share(
            F.lit(0), F.col("total"), F.col("terms")))), "groups")
    cells = settled(
        rows.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("size"))
        .join(groups, ["lang", "source"])
        .withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))
        .select("lang", "source", "n", "lang_n", "size", "p",
                _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")), "count-cells")
    return _term_part(rows, cells, ranks).unionByName(_pair_part(rows, groups, cells))


def _term_part(rows: DataFrame, cells: DataFrame, ranks: int) -> DataFrame:
    """The ``ranks`` terms of each group that are most above their language's share."""
    group = Window.partitionBy("lang", "source")
    above = cells.where(F.col("p") > F.col("q")).select(
        "lang", "source", "n", "lang_n", "size", _value(F.col("p"), F.col("q")).alias("value"))
    merged = above.groupBy("lang", "source", "value").agg(F.sum("size").alias("size"))
    # Each value stands for a term at least, so the first ``ranks`` values reach far enough.
    high = merged.withColumn("place", F.row_number().over(group.orderBy(F.desc("value")))).where(
        F.col("place") <= ranks)
    before = F.sum("size").over(group.orderBy(F.desc("value")).rowsBetween(
        Window.unboundedPreceding, -1))
    reached = high.withColumn("before", F.coalesce(before, F.lit(0))).where(
        F.col("before") < ranks).select("lang", "source", "value")
    chosen = above.join(reached, ["lang", "source", "value"]).select(
        "lang", "source", "n", "lang_n", "value")
    terms = rows.join(chosen, ["lang", "source", "n", "lang_n"])
    order = group.orderBy(F.desc("value"), "term")
    return (terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    "value", "rank"))


def _pair_part(rows: DataFrame, groups: DataFrame, cells: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language with the sum over all its kept terms."""
    own = groups.select("lang", "source", "zero", "terms", "own_terms")
    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("item_zero"),
                          F.col("own_terms").alias("item_terms"))
    pairs = own.join(other, "lang").where(F.col("source") != F.col("item"))
    zero = F.coalesce(_value(F.col("zero"), F.col("item_zero")), F.lit(0))
    neither = pairs.select("lang", "source", "item", (
        zero * (F.col("terms") - F.col("own_terms") - F.col("item_terms"))).alias("value"))
    # A source's terms against the other's zero: one row per different share, not per term.
    shares = cells.groupBy("lang", "source", "p").agg(F.sum("size").alias("size"))
    alone = shares.join(other, "lang").where(F.col("source") != F.col("item")).groupBy(
        "lang", "source", "item").agg(
        F.sum(_value(F.col("p"), F.col("item_zero")) * F.col("size")).alias("value"))
    swapped = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    met = (rows.join(groups.select("lang", "source", "total", "terms", "zero"), ["lang", "source"])
           .select("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"), "source", "term",
                   _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "zero")
           .repartition("lang", "block").sortWithinPartitions("lang", "block"))
    joint = met.mapInArrow(_joint_sums, "lang string, source string, item string, value bigint")
    summed = (neither.unionByName(alone).unionByName(swapped).unionByName(joint)
              .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                         F.row_number().over(order).alias("rank"))
