"""Ids of the mapped test tables, in both engines."""

import duckdb
import pytest

from wardlight.sources.fixtures import MAPPING

KEYS = [0, 8, 999_998, 999_999, 1_234_566, 12_345_660, 99_999_998, 99_999_999, 999_999_999]


@pytest.mark.parametrize("table, column, key", [
    ("patients", "patient_id", "c_custkey"), ("patients", "mrn", "c_custkey"),
    ("encounters", "encounter_id", "o_orderkey"), ("care_coordinators", "coordinator_id", "s_suppkey")])
def test_ids_stay_unique_for_large_keys(spark, table, column, key):
    expression = next(e for e, c in MAPPING[table][2] if c == column)
    ours = [r[0] for r in spark.createDataFrame([(k,) for k in KEYS], f"{key} bigint")
            .selectExpr(f"{expression} AS x").collect()]
    rows = ", ".join(f"({k}::BIGINT)" for k in KEYS)
    theirs = [r[0] for r in duckdb.sql(
        f"SELECT {expression} AS x FROM (VALUES {rows}) v({key})").fetchall()]
    assert ours == theirs and len(set(ours)) == len(KEYS)
