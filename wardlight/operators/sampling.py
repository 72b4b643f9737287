"""Repeatable sampling and bucketing by hash draws.

A draw depends on the seed and the key alone, so a rerun, a lost executor or
another partitioning gives the same sample.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from wardlight.functions.columns import hash_draw, uniform_draw
from wardlight.operators.ordering import distributed_row_number

# A draw has 32 bits; its leading 16 cut the keys into even buckets.
_BUCKET_WIDTH = 1 << 16


def _draw_bucket() -> Column:
    return F.floor(F.col("__draw") / _BUCKET_WIDTH)


def sample_n(rows: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), without replacement; ``key`` is unique.

    Only buckets of draws that start within the first ``n`` are sorted.
    """
    drawn = rows.withColumn("__draw", hash_draw(seed, F.col(key)))
    return distributed_row_number(
        drawn, "__place", [], [F.col("__draw"), F.col(key)], {"__bucket": _draw_bucket()},
        at_most=n).drop("__place", "__draw")


def sample_rest(rows: DataFrame, taken: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """``n`` further rows from those not yet taken."""
    return sample_n(rows.join(taken.select(key), key, "left_anti"), key, n, seed)


def weighted_bucket(rows: DataFrame, key: str, weights: dict[str, int], seed: str,
                    name: str) -> DataFrame:
    """Assign each row a category with the given weights."""
    total = sum(weights.values())
    labels = list(weights)
    draw = uniform_draw(seed, F.col(key)) * total
    choice = F
    for label, upto in zip(labels[:-1], accumulate(weights.values())):
        choice = choice.when(draw < upto, label)
    return rows.withColumn(name, choice.otherwise(labels[-1]))


def mark_first_n(rows: DataFrame, key: str, n: int, prefer: Column, seed: str,
                 name: str) -> DataFrame:
    """Flag ``n`` rows, preferred ones first, drawn at random within equals.

    Only the ``n`` chosen keys are joined back.
    """
    drawn = rows.select(key, (~prefer).cast("int").alias("__late"),
                        hash_draw(seed, F.col(key)).alias("__draw"))
    chosen = distributed_row_number(
        drawn, "__place", [], [F.col("__late"), F.col("__draw"), F.col(key)],
        {"__group": F.col("__late"), "__bucket": _draw_bucket()}, at_most=n)
    return (rows.join(chosen.select(key, F.lit(True).alias(name)), key, "left")
            .withColumn(name, F.coalesce(name, F.lit(False))))


def score_histogram(scores: DataFrame, bins: int = 10) -> DataFrame:
    """Scores per category and tenth."""
    return (scores.groupBy("risk_category",
                           F.width_bucket("risk_score", F.lit(0.0), F.lit(1.0), F.lit(bins))
                           .cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("patients"),
                 F.min("risk_score").alias("lowest"), F.max("risk_score").alias("highest")))
