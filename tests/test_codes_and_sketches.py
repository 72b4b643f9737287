"""Merging counts and indexed look-ups against plain ones."""

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wardlight.operators import codes as C
from wardlight.operators import sketches as S
from wardlight.sources.versioned import VersionedTable
from wardlight.streaming import adt


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# ---- distinct patients -------------------------------------------------

@pytest.fixture(scope="module")
def stays(spark):
    return spark.range(60_000).select(
        F.concat(F.lit("e"), "id").alias("encounter_id"),
        F.concat(F.lit("p"), F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("patient_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("discharge_date"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("F"), F.col("id") % 3)).alias("facility"))


def test_sketches_stay_within_the_stated_error_at_every_level(stays):
    cells = S.patient_sketches(stays)
    for by in (("discharge_month", "facility"), ("discharge_month",), ("facility",), ()):
        exact = {tuple(r[c] for c in by): r.n for r in stays.withColumn(
            "discharge_month", F.date_format("discharge_date", "yyyy-MM")).groupBy(*by).agg(
            F.count_distinct("patient_id").alias("n")).collect()}
        for r in S.estimated_patients(cells, *by).collect():
            assert abs(r.estimated_patients - exact[tuple(r[c] for c in by)]) <= S.SKETCH_BOUND * exact[
                tuple(r[c] for c in by)]


def test_stored_sketches_take_batches_in_any_cut_and_replays(spark, stays, tmp_path):
    table = VersionedTable.create(S.patient_sketches(stays.limit(0)), str(tmp_path / "s"), "cell", 4)
    for n in (0, 1, 2, 2, 1):
        S.add_stays(table, stays.where(F.crc32("encounter_id") % 3 == n), batch=("stays", n))
    whole = {(r.discharge_month, r.facility): (r.stays, r.n) for r in S.patient_sketches(stays).select(
        "discharge_month", "facility", "stays", F.hll_sketch_estimate("patients").alias("n")).collect()}
    got = {(r.discharge_month, r.facility): (r.stays, r.n) for r in table.read().select(
        "discharge_month", "facility", "stays", F.hll_sketch_estimate("patients").alias("n")).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in whole.items()}
    assert all(abs(got[k][1] - whole[k][1]) <= 0.02 * whole[k][1] for k in whole)


# ---- frequent items ----------------------------------------------------

@given(st.integers(0, 10 ** 6), st.integers(1, 30), st.integers(1, 6))
@settings(deadline=None, max_examples=12)
def test_a_summary_leaves_no_frequent_item_out(spark, seed, most, parts):
    rng = random.Random(seed)
    items = [f"i{int(rng.paretovariate(0.7))}" if rng.random() < 0.8 else f"r{rng.randrange(400)}" for _ in range(600)]
    held = None
    for n in range(parts):
        rows = spark.createDataFrame([(x,) for x in items[n::parts]], "item string").coalesce(1)
        new = S.reduced(S.counted(rows), most)
        held = new if held is None else S.merged(held, new, most)
    rows = held.collect()
    head = next(r for r in rows if r.item is None)
    true = Counter(items)
    assert head.total == len(items) and head.lost <= len(items) / (most + 1) and len(rows) <= most + 1
    for r in rows:
        if r.item is not None:
            assert true[r.item] - head.lost <= r.n <= true[r.item]
    share = 1 / (most + 1)
    named = {r.item for r in S.frequent(held, share).collect()}
    assert {x for x, n in true.items() if n > share * len(items)} <= named


def test_frequent_items_of_a_stream_with_a_replay(spark, tmp_path):
    words = ["hot"] * 300 + [f"w{i}" for i in range(500)] + ["warm"] * 60 + [None] * 9
    random.Random(1).shuffle(words)
    rows = spark.createDataFrame([(w,) for w in words], "word string")
    rows.repartition(4).write.parquet(str(tmp_path / "f"))
    feed = adt.read_feed(spark, str(tmp_path / "f"), rows.schema, files_per_batch=1)
    for _ in range(2):
        table = S.run_summary(feed, F.col("word"), str(tmp_path / "t"), str(tmp_path / "c"), most=30)
    head = table.read().where("item is null").first()
    assert head.total == 860 and head.lost <= 860 / 31
    named = S.frequent(table.read(), 0.05)
    exact = S.exactly_frequent(rows.select(F.col("word").alias("item")), named, 0.05)
    assert {(r.item, r.times) for r in exact.collect()} == {("hot", 300), ("warm", 60)}
    table.replace(lambda own: own.limit(0), batch=("summary", 0))
    assert table.read().where("item is null").first().total == 860


def test_nothing_seen(spark):
    none = spark.createDataFrame([], "item string")
    summary = S.reduced(S.counted(none), 5)
    assert [tuple(r) for r in summary.collect()] == [(None, 0, 0, 0)]
    assert S.frequent(summary, 0.5).count() == 0 and S.exactly_frequent(none, none, 0.5).count() == 0


# ---- descriptions ------------------------------------------------------

TEXTS = [("I50.9", "Congestive Heart Failure, unspecified"), ("I50.23", "Acute systolic heart failure"), ("X", "ΟΔΟΣ"),
         ("X", "οδος και"), ("Y", "100% 50_off [a]"), ("Z", ""), ("Z", "ab"), (None, "No code heart"), ("I50.9", None),
         ("T", "İstanbul heartfailure"), ("W", "aaaa"), ("E", "\U0001f600 end heart")]


@pytest.fixture(scope="module")
def described(spark):
    return spark.createDataFrame([r for i, r in enumerate(TEXTS) for _ in range(1 + i % 3)],
                                 "icd10_code string, description string")


def scan(diagnoses, literal, blind):
    held = (F.lower("description").contains(F.lower(F.lit(literal))) if blind
            else F.col("description").contains(literal))
    return {tuple(r) for r in diagnoses.where(held).groupBy("icd10_code", "description").count().collect()}


@pytest.mark.parametrize("buckets", [1, 16])
def test_search_equals_the_scan_for_any_literal(spark, described, tmp_path, buckets):
    index = C.DescriptionIndex.build(described, str(tmp_path / "i"), buckets)
    pieces = {t[a:a + n] for _, t in TEXTS if t for n in (1, 2, 3, 6, 40) for a in range(0, len(t), 5)}
    for literal in [*sorted(pieces)[::3], "", "HEART", "Οδός", "ος", "ΟΣ", "0% 5", "_", "nowhere at all", "aaa", "aaaaa"]:
        for blind in (True, False):
            assert {tuple(r) for r in index.search(literal, blind).collect()} == scan(described, literal, blind), literal


def test_a_search_opens_postings_and_no_diagnoses(spark, small, tmp_path):
    index = C.DescriptionIndex.build(small.diagnoses, str(tmp_path / "i"), 256)
    opened = index.candidates("fibrillation").inputFiles()
    assert opened and not [f for f in opened if "lineitem" in f]
    assert len([f for f in opened if "/texts/" in f]) < len(index.texts.read().inputFiles())


def test_new_diagnoses_are_counted_once(spark, described, tmp_path):
    index = C.DescriptionIndex.build(described.limit(0), str(tmp_path / "i"), 8)
    halves = [described.where("icd10_code like 'I%'"), described.where("icd10_code is null or icd10_code not like 'I%'")]
    for n in (0, 1, 0, 1):
        index.add(halves[n], batch=("new", n)) if n or not index.texts.manifest().batches else None
    index.add(spark.createDataFrame([("N", "Renal failure"), ("X", "ΟΔΟΣ")], described.schema), batch=("new", 2))
    whole = described.unionByName(spark.createDataFrame([("N", "Renal failure"), ("X", "ΟΔΟΣ")], described.schema))
    for literal in ("failure", "ΟΔΟΣ"):
        assert {tuple(r) for r in index.search(literal).collect()} == scan(whole, literal, True)


# ---- code groups -------------------------------------------------------

@given(st.lists(st.text("AB1.", max_size=5), max_size=12), st.lists(st.text("AB1.", max_size=4), max_size=8))
@settings(deadline=None, max_examples=12)
def test_groups_equal_the_theta_join(spark, codes, prefixes):
    rows = spark.createDataFrame([(c,) for c in [*codes, None]], "icd10_code string")
    groups = spark.createDataFrame([(p, f"g{i}") for i, p in enumerate([*prefixes, None])], "prefix string, label string")
    got = sorted((r.icd10_code, r.prefix, r.label) for r in C.in_code_groups(rows, groups).collect())
    assert got == sorted((c, p, f"g{i}") for c in set(codes) for i, p in enumerate(prefixes) if c.startswith(p))


def test_many_groups_are_met_on_equality(spark, small):
    groups = spark.range(5000).select(F.concat(F.lit("I"), F.col("id")).alias("prefix"), F.lit("x").alias("label"))
    text = plan(C.in_code_groups(small.diagnoses, groups))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)
