"""Raw lines of several sources: accepted, quarantined, drifting, and read once more."""

import datetime as dt

from pyspark.sql import functions as F

from wardlight.sources import ingest as I

JSON = I.Source("ehr", "id bigint, day date, name string", required=("id",), aliases={"name": ("label", "title")})
CSV = I.Source("claims", "id bigint, day date, paid double", required=("id", "day"), fmt="csv",
               fields=("id", "day", "paid"))


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def outcome(rows):
    return {r.line: r.reason for r in rows.collect()}


def test_json_lines(spark):
    good = ['{"id": 1, "day": "2024-02-29", "name": "a"}', '{"id": 2}', '{"id": "3", "title": "t", "label": null}']
    bad = {'{"id": 4, "na': "unreadable", "": "unreadable", "[1, 2]": "unreadable", '{"day": "2024-01-01"}': "missing id",
           '{"id": 5, "day": "2024-02-30"}': "bad day", '{"id": "x"}': "bad id"}
    rows = I.parsed(lines(spark, *good, *bad, None), JSON)
    got = outcome(rows)
    assert got == {**dict.fromkeys(good), **bad, None: "unreadable"}
    assert sorted(map(tuple, I.accepted(rows).collect()), key=str) == [
        (1, dt.date(2024, 2, 29), "a"), (2, None, None), (3, None, "t")]
    assert I.quarantined(rows).count() == len(bad) + 1


def test_csv_lines(spark):
    good = ["1,2024-01-01,2.5", "2,2024-01-02,", '"3",2024-01-03,1e3']
    bad = {"4,2024-01-04": "unreadable", "5,2024-01-05,1,extra": "unreadable", "6,soon,1": "bad day",
           ",2024-01-07,1": "missing id", "8,2024-01-08,much": "bad paid"}
    rows = I.parsed(lines(spark, *good, *bad), CSV)
    assert outcome(rows) == {**dict.fromkeys(good), **bad}
    assert [r.paid for r in I.accepted(rows).orderBy("id").collect()] == [2.5, None, 1000.0]


def test_unknown_fields_are_drift_not_loss(spark):
    rows = I.parsed(lines(spark, '{"id": 1, "ward": "7b", "bed": {"n": 1}}', '{"id": 2, "label": "x"}'), JSON)
    assert {r.row.id: sorted(r.unknown) for r in rows.collect()} == {1: ["bed", "ward"], 2: []}
    counts = I.outcome_counts(rows).collect()
    assert [(r.outcome, r.lines, r.drifted) for r in counts] == [("accepted", 2, 1)]


def test_counts_add_up_and_a_rerun_leaves_one_result(spark, tmp_path):
    feeds = [(JSON, lines(spark, '{"id": 1}', '{"id"', "x", '{"id": 1}')), (CSV, lines(spark, "1,2024-01-01,1", "2"))]
    for _ in range(2):
        counts = I.ingest(feeds, str(tmp_path / "in"))
    read = {r.source: r.n for r in counts.groupBy("source").agg(F.sum("lines").alias("n")).collect()}
    assert read == {"ehr": 4, "claims": 2}
    kept = spark.read.parquet(str(tmp_path / "in" / "ehr")).count()
    aside = spark.read.parquet(str(tmp_path / "in" / "quarantine"))
    assert kept == 2 and {(r.source, r.line) for r in aside.collect()} == {
        ("ehr", '{"id"'), ("ehr", "x"), ("claims", "2")}


def test_quarantine_is_parsed_anew_once_a_renamed_field_is_known(spark):
    rows = I.parsed(lines(spark, '{"number": 9}', '{"id": 1}', "{"), JSON)
    wider = I.Source("ehr", JSON.schema, required=("id",), aliases={"id": ("number",)})
    again = I.replayed(I.quarantined(rows), wider)
    assert [r.id for r in I.accepted(again).collect()] == [9] and I.quarantined(again).count() == 1


def test_streams_take_the_same_path(spark, tmp_path):
    lines(spark, '{"id": 1}', "{").coalesce(1).write.text(str(tmp_path / "raw"))
    stream = I.parsed(spark.readStream.text(str(tmp_path / "raw")), JSON).select("source", "line", "reason")
    query = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert outcome(spark.read.parquet(str(tmp_path / "out"))) == {'{"id": 1}': None, "{": "unreadable"}
