"""The bucketed helpers against plain windows, with one key holding most rows."""

import random

import pytest
from pyspark.sql import Window, functions as F

from wardlight.operators import readmit, sampling
from wardlight.operators.ordering import distributed_row_number, ranked


@pytest.fixture
def skewed(spark):
    draw = random.Random(5)
    rows = [("hot" if draw.random() < 0.5 else draw.choice(["a", "b", None]),
             draw.choice([None, *range(12)]), f"id{n:05d}") for n in range(3000)]
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "k string, v int, id string")


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_row_number_equals_window(skewed, levels):
    cuts = {"b1": F.floor(F.col("v") / 3), "b2": F.col("v"), "b3": F.substring("id", 1, 4)}
    buckets = dict(list(cuts.items())[:levels])
    got = distributed_row_number(skewed, "n", ["k"], [F.col("v"), F.col("id")], buckets)
    plain = skewed.withColumn(
        "n", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")).cast("bigint"))
    assert got.columns == plain.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("limit", [0, 1, 37, 2999, 3000, 9000])
def test_first_n_are_exact(skewed, limit):
    rows = skewed.where("v IS NOT NULL")
    got = distributed_row_number(rows, "n", [], [F.col("v"), F.col("id")], {"b": F.col("v")}, at_most=limit)
    expected = rows.orderBy("v", "id").limit(limit)
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in expected.collect())


@pytest.mark.parametrize("within", [None, ["k"]])
def test_ranks_equal_a_window(skewed, within):
    plain = skewed.withColumn("n", F.row_number().over(
        Window.partitionBy(*within or [F.lit(0)]).orderBy("v", "id")).cast("bigint"))
    got = ranked(skewed, "n", [F.col("v"), F.col("id")], within, parts=7)
    assert got.columns == plain.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("key", ["lpad(cast(id AS string), 6, '0')", "lpad(cast(id AS string), 10, '0')",
                                 "md5(cast(id AS string))"])
def test_ranks_of_equal_scores_hold_for_any_ids(spark, key):
    total = 200_000
    rows = spark.range(total).selectExpr(f"'patient-' || {key} AS id", "0.5D AS score")
    order = [F.desc("score"), F.col("id")]
    largest = (rows.repartitionByRange(16, *order).groupBy(F.spark_partition_id()).count()
               .agg(F.max("count")).first()[0])
    assert largest < total / 5
    got = ranked(rows, "place", order, parts=16)
    wrong = got.withColumn("before", F.lag("id").over(
        Window.partitionBy(F.floor(F.col("place") / 1000)).orderBy("place"))).where("before >= id")
    assert wrong.count() == 0
    assert got.agg(F.min("place"), F.max("place"), F.count_distinct("place")).first() == (
        1, total, total)


def test_encounter_sequence_of_a_crowded_patient(clinic, stay):
    stays = [stay(f"{n:04d}", "hot", -(n % 40), 1) for n in range(400)]
    stays += [stay(f"x{n}", f"p{n}", -n, 1) for n in range(20)]
    got = readmit.encounter_sequence(clinic(encounters=stays)).collect()
    mine = sorted((r.admission_date, r.encounter_id) for r in got if r.patient_id == "hot")
    assert {r.encounter_id: r.enc_num for r in got if r.patient_id == "hot"} == {
        e: n for n, (_, e) in enumerate(mine, start=1)}
    assert {r.total_encs for r in got if r.patient_id == "hot"} == {400} and len(got) == 420


def test_samples(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("key"))
    one = sampling.sample_n(rows, "key", 100, "s")
    again = sampling.sample_n(rows.repartition(7), "key", 100, "s")
    first = {r.key for r in one.collect()}
    assert len(first) == 100 and first == {r.key for r in again.collect()}
    rest = {r.key for r in sampling.sample_rest(rows, one, "key", 950, "t").collect()}
    assert len(rest) == 900 and not rest & first


def test_weights_and_marks(spark):
    rows = spark.range(20000).select(F.col("id").cast("string").alias("key"), (F.col("id") < 20).alias("new"))
    shares = {r.g: r.n / 20000 for r in sampling.weighted_bucket(
        rows, "key", {"a": 70, "b": 20, "c": 10}, "w", "g").groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert abs(shares["a"] - 0.7) < 0.02 and abs(shares["c"] - 0.1) < 0.02
    marked = sampling.mark_first_n(rows, "key", 32, F.col("new"), "m", "flag").where("flag").collect()
    assert len(marked) == 32 and sum(r.new for r in marked) == 20
