"""Similarity join of word-shingle sets by parity sketches.

The universe of shingles is cut by hash into parts. In a part, a set is sketched
by parity bits: every shingle flips one of 64, so the Hamming distance of two
sketches never exceeds the sets' symmetric difference. Sets of a size band that
are similar enough differ in at most ``d`` shingles; with ``d + 1`` parts, one
part at least is equal in both (pigeonhole). So equal part sketches, widened by
an exclusive-or checksum of the part's shingles, are the join key.

1. Equal sets are one class, represented by the smallest document.
2. Representatives emit their parts' keys; keys that occur once go no further.
3. Members of a key are compared with its smallest member, and linked ones joined
   into components. Only keys whose members still lie in several components need
   more: there, members of different components are compared within bounded
   blocks by folded sketches. A block whose members have few partners on average gives
   all of them at once; others give each member's nearest, in rounds of growing reach. If
   a block still had more than the widest reach, a last round without any compares
   everything that is left, so no link is lost, and a large group of near copies
   never becomes all its pairs.
4. Candidate pairs are cut by size and by sketch distance, then verified on the
   whole shingle sets.

Empty parts, and at high similarity parts of one shingle, say little. A few more
parts than the pigeonhole needs are made, and a set that has no more such parts
than that skips them: equal parts agree on being poor, so a similar pair still
meets.

Defined cases: null text or text without words has the empty set and links with
nothing; fewer words than a shingle make one shingle of all; rows with one
``doc_id`` are one document; a null ``doc_id`` links nothing and takes the
component of an equal text, else null; an empty table gives an empty result;
further columns are ignored. Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

import functools
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardlight.llm.graph import components, with_few
from wardlight.llm.quality import joined, text_words
from wardlight.llm.words import as_bytes, hand_back, mixed
from wardlight.session import settled

# Similarity in percent, and words of a shingle.
SIMILARITY, WORDS = 90, 3
# Members that one block compares, and how many partners a member meets per round, on average
# or, where that is too few, at most.
BLOCK = 1024
REACH = (8, 64, 512, BLOCK)
_BAND = 1.5
# So many words of a sketch are folded into one for the first comparison.
_FOLDED_WORDS = 5
_BAND_BITS = 7


@functools.cache
def band_edges(percent: int) -> list[int]:
    """Sizes at which bands begin; smaller sets link only if they are equal."""
    edge = -(-percent // (100 - percent))
    edges = [edge]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, int(edges[-1] * _BAND)))
    return edges[:1 << _BAND_BITS]


def poor_size(percent: int) -> int:
    """A part with at most this many shingles is poor.

    Parts hold about percent / (100 - percent) shingles: where that is few, single
    shingles are common and have to count, and only empty parts are poor.
    """
    return 1 if percent >= 8 * (100 - percent) else 0


@functools.cache
def band_shape(band: int, percent: int) -> tuple[int, int]:
    """Parts of a band, and how many poor ones a set may skip.

    The smaller set of a pair has at most ``edge - 1`` shingles; a similar one
    differs from it in at most that times (100 - percent) / percent. The spare
    parts exceed the poor ones that sets of the band have by chance.
    """
    largest = band_edges(percent)[band + 1] - 1
    apart = largest * (100 - percent) // percent
    spare = apart // (16 if poor_size(percent) else 5)
    return apart + 1 + spare, spare


def bands_of(size: int, percent: int) -> list[int]:
    """The bands a set takes part in: its own, and its smallest partner's."""
    edges = band_edges(percent)
    own = bisect_right(edges, size) - 1
    lower = bisect_right(edges, -(-size * percent // 100)) - 1
    return [b for b in sorted({own, lower}) if b >= 0]


def shingle_set(data: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a lower-cased text."""
    hashes = text_words(data)
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    count = len(hashes) - width + 1
    grams = joined(*(hashes[i:i + count] for i in range(width)))
    grams.sort()
    return grams[np.append(True, grams[1:] != grams[:-1])]


def part_sketches(shingles: np.ndarray, band: int, percent: int
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per part: parity bits, checksum, and number of shingles.

    Parts are equal ranges of the hashes, so a sorted set is cut, not sorted again.
    """
    parts, _ = band_shape(band, percent)
    width = (1 << 64) // parts
    edges = np.arange(parts, dtype=np.uint64) * np.uint64(width)
    starts = np.searchsorted(shingles, edges)
    sizes = np.diff(np.append(starts, len(shingles)))
    held = sizes > 0
    parity = np.zeros(parts, dtype=np.uint64)
    checks = np.zeros(parts, dtype=np.uint64)
    spread = mixed(shingles)
    parity[held] = np.bitwise_xor.reduceat(
        np.uint64(1) << (spread >> np.uint64(58)), starts[held])
    checks[held] = np.bitwise_xor.reduceat(spread, starts[held])
    return parity, checks, sizes


def part_keys(shingles: np.ndarray, percent: int = SIMILARITY) -> np.ndarray:
    """Join keys of a set over all its bands; a key's low bits name the band."""
    found = []
    for band in bands_of(len(shingles), percent):
        parity, checks, sizes = part_sketches(shingles, band, percent)
        rich = sizes > poor_size(percent)
        if (~rich).sum() > band_shape(band, percent)[1]:
            rich[:] = True
        place = np.flatnonzero(rich).astype(np.uint64)
        keys = joined(parity[rich], checks[rich], place, sizes[rich].astype(np.uint64))
        found.append((keys >> np.uint64(_BAND_BITS) << np.uint64(_BAND_BITS)) | np.uint64(band))
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def folded(parity: np.ndarray) -> np.ndarray:
    """A shorter sketch of the same shingles: words laid over each other by exclusive or.

    It is still a parity sketch, so its Hamming distance still bounds the symmetric
    difference from below, and it sees all shingles where some of the words would miss most.
    """
    width = max(2, len(parity) // _FOLDED_WORDS)
    padded = np.zeros(-(-len(parity) // width) * width, dtype=np.uint64)
    padded[:len(parity)] = parity
    return np.bitwise_xor.reduce(padded.reshape(-1, width), axis=0)


_FEATURES = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, part_keys array<bigint>"


def _feature_rows(percent: int, words: int):
    def run(batches):
        for batch in batches:
            sizes, first, second, keys = [], [], [], []
            for text in as_bytes(batch.column(1), lower=True):
                shingles = shingle_set(text or b"", words)
                sizes.append(len(shingles))
                first.append(int(shingles.sum(dtype=np.uint64).view(np.int64)))
                second.append(int(np.bitwise_xor.reduce(mixed(shingles)).view(np.int64))
                              if len(shingles) else 0)
                keys.append(part_keys(shingles, percent).view(np.int64))
            ends = np.cumsum([0, *map(len, keys)])
            flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(second, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                names=["doc_id", "n_shingles", "set_a", "set_b", "part_keys"])
        hand_back()

    return run


def _sketch_rows(percent: int, words: int):
    """Per band of a document its set's size and parity bits, whole and folded."""
    def run(batches):
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1), lower=True)):
                shingles = shingle_set(text or b"", words)
                for band in bands_of(len(shingles), percent):
                    parity, _, _ = part_sketches(shingles, band, percent)
                    rows.append((doc, band, len(shingles), parity.tobytes(),
                                 folded(parity).tobytes()))
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                names=["doc", "band", "size", "sketch", "folded"])
        hand_back()

    return run


_SKETCHES = "doc bigint, band int, size bigint, sketch binary, folded binary"


def _set_rows(words: int):
    """Whole shingle sets."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(
                    [shingle_set(t or b"", words).tobytes()
                     for t in as_bytes(batch.column(1), lower=True)], pa.binary())],
                names=["doc", "shingles"])

    return run


def _once(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Settled ``rows`` with one row per key. Wide rows are shuffled only if a document is repeated."""
    held = settled(rows, label)
    if held.select(*keys).distinct().count() == held.count():
        return held
    return settled(held.dropDuplicates(keys), label)


def most_apart(size_a, size_b, percent: int):
    """Largest symmetric difference of two similar sets of these sizes."""
    return (size_a + size_b) * (100 - percent) // (100 + percent)


def _close_sketches(percent: int):
    def run(batches):
        for batch in batches:
            size_a, size_b = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            limit = most_apart(size_a, size_b, percent)
            near = np.array([int(np.bitwise_count(
                np.frombuffer(x, np.uint64) ^ np.frombuffer(y, np.uint64)).sum()) for x, y in zip(
                batch.column(4).to_pylist(), batch.column(6).to_pylist())], dtype=np.int64)
            chosen = pa.array(near <= limit)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(chosen) for i in (0, 1, 2)], names=["a", "b", "band"])

    return run


def _linked(percent: int):
    def run(batches):
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                linked.append(100 * common >= percent * (len(both) - common))
            chosen = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(chosen) for i in (0, 1)], names=["a", "b"])

    return run


def linked_pairs(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, percent: int, words: int
                 ) -> DataFrame:
    """The pairs (``a``, ``b``, ``band``) that are similar: first by sketch, then by set.

    Sets are made of the few texts whose sketches are close to another's.
    """
    def side(name: str) -> DataFrame:
        return sketches.select(F.col("doc").alias(name), "band", F.col("size").alias(f"size_{name}"),
                               F.col("sketch").alias(f"sketch_{name}"))

    close = settled(
        pairs.join(side("a"), ["a", "band"]).join(side("b"), ["b", "band"])
        .select("a", "b", "band", "size_a", "sketch_a", "size_b", "sketch_b")
        .mapInArrow(_close_sketches(percent), "a bigint, b bigint, band int")
        .select("a", "b").distinct(), "parity-close")
    wanted = settled(close.select(F.col("a").alias("doc_id")).unionByName(
        close.select(F.col("b").alias("doc_id"))).distinct(), "parity-wanted")
    sets = _once(with_few(texts, wanted, "doc_id", "left_semi").mapInArrow(
        _set_rows(words), "doc bigint, shingles binary"), ["doc"], "parity-sets")
    return (close.join(sets.select(F.col("doc").alias("a"), F.col("shingles").alias("of_a")), "a")
            .join(sets.select(F.col("doc").alias("b"), F.col("shingles").alias("of_b")), "b")
            .select("a", "b", "of_a", "of_b")
            .mapInArrow(_linked(percent), "a bigint, b bigint"))


_NEAR = "a bigint, b bigint, band int, cut boolean"


_PLACED = ["part_key", "left", "right", "block", "band", "doc", "root", "size", "sketch"]


def near_in_block(docs, roots, sizes, block, sketches, left: int, right: int, percent: int,
                  reach: int | None) -> tuple[list[int], list[int], bool]:
    """Pairs of different components that may be similar, and whether any were left out.

    All are given if they are ``reach`` a member or fewer on average, or if there is no
    reach; else each member's ``reach`` nearest. Members of block ``left`` meet those of
    block ``right``; within one block each pair is met once. ``sketches`` may be folded alike.
    """
    found, out_a, out_b = [], [], []
    others = np.flatnonzero(block == right)
    for i in np.flatnonzero(block == left):
        js = others[roots[others] != roots[i]]
        if left == right:
            js = js[docs[js] > docs[i]]
        limit = most_apart(sizes[js], sizes[i], percent)
        close = np.abs(sizes[js] - sizes[i]) <= limit
        js, limit = js[close], limit[close]
        apart = np.bitwise_count(sketches[js] ^ sketches[i]).sum(axis=1, dtype=np.int64)
        close = apart <= limit
        found.append((i, js[close], apart[close]))
    cut = reach is not None and sum(len(js) for _, js, _ in found) > reach * len(found)
    for i, js, apart in found:
        if cut and len(js) > reach:
            js = js[np.argsort(apart, kind="stable")[:reach]]
        out_a += [int(docs[i])] * len(js)
        out_b += docs[js].tolist()
    return out_a, out_b, cut


def _near_pairs(percent: int, reach: int | None):
    """Reads blocks, sorted one behind the other, and compares each when it is complete.

    Most blocks hold a handful of members, far too few to be a group of a
    grouped call each.
    """
    def run(batches):
        place, held = None, []

        def compared():
            docs, roots, sizes, block = (np.concatenate([h[i] for h in held]) for i in range(4))
            sketches = np.frombuffer(b"".join(s for h in held for s in h[4]), np.uint64).reshape(
                len(docs), -1)
            a, b, cut = near_in_block(docs, roots, sizes, block, sketches, place[1], place[2],
                                      percent, reach)
            return [(min(x, y), max(x, y), held[0][5], cut) for x, y in zip(a, b)]

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(8)]
            key, left, right, block, band, docs, roots, sizes = columns
            sketches = batch.column(8).to_pylist()
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
            edges = np.append(np.flatnonzero(new), len(key)).tolist()
            rows = []
            for begin, end in zip(edges[:-1], edges[1:]):
                here = (int(key[begin]), int(left[begin]), int(right[begin]))
                if here != place:
                    if held:
                        rows += compared()
                    place, held = here, []
                held.append((docs[begin:end], roots[begin:end], sizes[begin:end],
                             block[begin:end], sketches[begin:end], int(band[begin])))
            yield _pair_batch(rows)
        if held:
            yield _pair_batch(compared())
            held = []
        hand_back()

    return run


def _pair_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=["a", "b", "band", "cut"])


def block_rows(band: int, percent: int) -> int:
    """Members of one block: fewer where sketches are long, so a block holds some 8 MB of them."""
    return min(BLOCK, max(16, (1 << 20) // band_shape(band, percent)[0]))


def _open_pairs(members: DataFrame, roots: DataFrame, sketches: DataFrame, percent: int,
                reach: int | None) -> DataFrame:
    """Candidate pairs of keys whose members lie in several components, block by block."""
    rooted = (members.join(roots, F.col("doc") == F.col("node"), "left")
              .select("part_key", "doc", F.coalesce("root", "doc").alias("root")))
    band = F.col("part_key").bitwiseAND((1 << _BAND_BITS) - 1).cast("int")
    rows = F.element_at(F.array(*(F.lit(block_rows(b, percent)) for b in range(
        len(band_edges(percent)) - 1))), band + 1)
    several = (rooted.groupBy("part_key").agg(
        F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("n"))
        .where(F.col("r0") != F.col("r1"))
        .select("part_key", F.ceil(F.col("n") / rows).cast("int").alias("blocks")))
    placed = (rooted.join(several, "part_key")
              .withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
              .withColumn("band", band)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("part_key", F.least("block", "other").alias("left"),
                      F.greatest("block", "other").alias("right"), "block", "band", "doc", "root"))
    # Folded sketches part almost all pairs; the whole one is compared when a pair is verified.
    short = sketches.select("doc", "band", "size", F.col("folded").alias("sketch"))
    return (placed.join(short, ["doc", "band"])
            .select(*_PLACED).repartition("part_key", "left", "right")
            .sortWithinPartitions("part_key", "left", "right")
            .mapInArrow(_near_pairs(percent, reach), _NEAR))


def similarity_classes(docs: DataFrame, percent: int = SIMILARITY, words: int = WORDS
                       ) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles`` and ``component_id``."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    features = settled(texts.mapInArrow(_feature_rows(percent, words), _FEATURES), "parity-features")
    classes = (features.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
               .groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("doc")))
    classes = settled(classes, "parity-classes")
    # Keys move only once they are known to be shared, so the list of representatives comes to them.
    speakers = classes.select(F.col("doc").alias("doc_id"))
    keyed = with_few(features.select("doc_id", "part_keys"), speakers, "doc_id", "left_semi").select(
        F.explode("part_keys").alias("part_key"), F.col("doc_id").alias("doc"))
    # A count alone is the smallest row to shuffle; most keys occur once.
    shared = settled(keyed.groupBy("part_key").count().where(F.col("count") > 1)
                     .select("part_key"), "parity-shared")
    members = settled(with_few(keyed, shared, "part_key", "left_semi").distinct(),
                      "parity-members")
    roots = _roots(members, texts, percent, words)
    of_class = (classes.join(roots, F.col("doc") == F.col("node"), "left")
                .select("set_a", "set_b", "n_shingles", F.coalesce("root", "doc").alias("root")))
    return (features.select("doc_id", "n_shingles", "set_a", "set_b")
            .join(of_class, ["set_a", "set_b", "n_shingles"], "left")
            .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id")))


def _roots(members: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """Component roots (``node``, ``root``) of the representatives that share a key."""
    wanted = settled(members.select(F.col("doc").alias("doc_id")).distinct(), "parity-wanted")
    sketches = _once(with_few(texts, wanted, "doc_id", "left_semi").mapInArrow(
        _sketch_rows(percent, words), _SKETCHES), ["doc", "band"], "parity-sketches")
    band = F.col("part_key").bitwiseAND((1 << _BAND_BITS) - 1).cast("int").alias("band")
    first = members.groupBy("part_key").agg(F.min("doc").alias("a"))
    pairs = (members.join(first, "part_key").where(F.col("doc") != F.col("a"))
             .select("a", F.col("doc").alias("b"), band).distinct())
    roots = components(linked_pairs(pairs, sketches, texts, percent, words))
    for reach in (*REACH, None):
        open_pairs = settled(_open_pairs(members, roots, sketches, percent, reach), "parity-open")
        if open_pairs.isEmpty():
            break
        whole = open_pairs.where("cut").isEmpty()
        more = settled(linked_pairs(open_pairs.select("a", "b", "band").distinct(), sketches, texts,
                                    percent, words), "parity-links")
        if not more.isEmpty():
            # A member on its root says all that its earlier links did.
            roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
                               .unionByName(more))
        if whole:
            break
    return roots


def one_of_each(docs: DataFrame, percent: int = SIMILARITY, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component."""
    classes = similarity_classes(docs, percent, words)
    gone = settled(classes.where(F.col("doc_id") != F.col("component_id"))
                   .select(F.col("doc_id").alias("parity_gone")).distinct(), "parity-gone")
    # The row travels in one column, so that no name of its own can clash.
    keyed = docs.select(F.struct("*").alias("parity_row"), F.col("doc_id").cast("bigint").alias("parity_gone"))
    return with_few(keyed, gone, "parity_gone", "left_anti").select(
        *(F.col(f"parity_row.`{c}`").alias(c) for c in docs.columns))
