import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from wardlight.operators.priority import priority_scores
from wardlight.session import settled
from wardlight.streaming import adt

START = dt.datetime(2024, 1, 1)


@pytest.fixture
def feed(spark, tmp_path):
    """Writes each list of messages as a later file and streams them in order."""
    def build(*batches):
        for n, messages in enumerate(batches):
            (spark.createDataFrame([(i, START + dt.timedelta(hours=h), p, "admit", 0.0) for i, h, p in messages],
                                   "event_id long, ts timestamp, patient_id string, adt_type string, value double")
             .coalesce(1).write.mode("append").parquet(str(tmp_path / "feed")))
        schema = spark.read.parquet(str(tmp_path / "feed")).schema
        return adt.read_feed(spark, str(tmp_path / "feed"), schema, files_per_batch=1)

    return build


def test_days_close_and_late_messages_drop(spark, feed):
    stream = feed([(1, 1, "p"), (2, 30, "p")], [(3, 60, "p")], [(4, 2, "p"), (5, 61, "p")])
    got = {r.day.day: r.messages for r in adt.drained(spark, adt.daily_counts(stream), "t").collect()}
    assert got == {1: 1, 2: 1}


def test_repeats_drop_across_batches(spark, feed):
    stream = feed([(1, 1, "p"), (1, 1, "p"), (2, 1, "p")], [(2, 1, "p"), (3, 1, "p")])
    got = adt.drained(spark, adt.deduplicated(stream), "t")
    assert sorted(r.event_id for r in got.collect()) == [1, 2, 3]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_days_do_not_depend_on_the_session_zone(spark, tmp_path, zone):
    rows = spark.sql("SELECT id AS event_id, TIMESTAMP_NTZ'2024-03-08 00:30:00.25'"
                     " + make_dt_interval(0, cast(id AS int) * 5) AS ts, 'admit' AS adt_type FROM range(30)")
    rows.write.parquet(str(tmp_path / "feed"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        feed = adt.read_feed(spark, str(tmp_path / "feed"), rows.schema)
        final = adt.drained(spark, adt.daily_counts(feed), "zone")
        got = {str(r.day): r.messages for r in final.collect()}
        rest = {str(r.day): r.messages for r in adt.closing_counts(
            spark.read.parquet(str(tmp_path / "feed")), final).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    days = [str((dt.datetime(2024, 3, 8, 0, 30) + dt.timedelta(hours=5 * n)).date()) for n in range(30)]
    counts = {d: days.count(d) for d in days}
    last = max(days)
    assert got == {d: n for d, n in counts.items() if d != last} and rest == {last: counts[last]}


def test_json_feed(spark, tmp_path):
    rows = spark.createDataFrame([(1, START, "p"), (2, START, "q")],
                                 "event_id long, ts timestamp, patient_id string")
    rows.write.json(str(tmp_path / "feed"))
    feed = adt.read_feed(spark, str(tmp_path / "feed"), rows.schema, fmt="json")
    assert sorted(r.event_id for r in adt.drained(spark, feed, "json").collect()) == [1, 2]


def test_enrichment_keeps_unknown_patients(spark, feed, small, tmp_path):
    stream = feed([(1, 1, "patient-000001"), (2, 1, "nobody")], [(3, 2, "patient-000002")])
    adt.run_enriched(stream, small, str(tmp_path / "e"), str(tmp_path / "p"))
    got = {r.event_id: r for r in spark.read.parquet(str(tmp_path / "e")).collect()}
    assert got[1].mrn and got[3].mrn and got[2].mrn is None and len(got) == 3


def test_a_batch_shuffles_no_history(spark, small):
    """The history is filtered by broadcast lists where it is read; joins on it shuffle nothing."""
    touched = settled(spark.createDataFrame([("patient-000001",)], "patient_id string"), "touched")
    share = adt.share_of(small, touched)
    def shape(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    for frame in (share.diagnoses, share.patients, share.risk_scores, share.sdoh):
        assert "SortMergeJoin" not in shape(frame) and "Exchange hashpartitioning" not in shape(frame)
    message = spark.createDataFrame([(1, START, "patient-000001", "admit")],
                                    "event_id long, ts timestamp, patient_id string, adt_type string")
    text = shape(adt.enriched(message, small))
    assert len(re.findall(r"BroadcastHashJoin .*LeftSemi", text)) == 2
    assert not re.search(r"(SortMerge|ShuffledHash)Join .*LeftSemi", text)


def test_compaction_keeps_the_newest_scores(spark, feed, small, tmp_path):
    batches = [[(n, n, f"patient-00000{1 + n % 3}")] for n in range(7)]
    path = str(tmp_path / "s")
    adt.run_incremental(feed(*batches), small, path, str(tmp_path / "c"), compact_every=3)
    assert adt.versions(spark, path) == [5, 6]
    wanted = [f"patient-00000{n}" for n in (1, 2, 3)]
    full = priority_scores(small).where(F.col("patient_id").isin(wanted))
    assert sorted(map(repr, adt.current_scores(spark, path).collect())) == sorted(
        map(repr, full.collect()))


def test_incremental_scores_equal_full_and_replays_are_harmless(spark, feed, small, tmp_path):
    stream = feed([(1, 1, "patient-000001"), (2, 1, "patient-000002")], [(3, 2, "patient-000001")])
    adt.run_incremental(stream, small, str(tmp_path / "s"), str(tmp_path / "c"))
    batch = spark.createDataFrame([("patient-000001",)], "patient_id string")
    adt.score_touched(small, str(tmp_path / "s"))(batch, 1)
    current = adt.current_scores(spark, str(tmp_path / "s"))
    full = priority_scores(small).where(F.col("patient_id").isin("patient-000001", "patient-000002"))
    assert sorted(map(repr, current.collect())) == sorted(map(repr, full.collect()))
    adt.compact_scores(spark, str(tmp_path / "s"), str(tmp_path / "whole"))
    assert spark.read.parquet(str(tmp_path / "whole")).count() == 2


def test_days_are_corrected_and_replays_change_nothing(spark, feed, tmp_path):
    stream = feed([(1, 1, "p"), (2, 30, "p")], [(3, 60, "p"), (4, 2, "p")], [(5, 3, "p")])
    for _ in range(2):
        # The second time nothing is new.
        table = adt.corrected_days(stream, str(tmp_path / "d"), str(tmp_path / "c"))
        got = {r.day.day: r.messages for r in table.read().collect()}
        assert got == {1: 3, 2: 1, 3: 1}
    seen = [{r.day.day: r.messages for r in table.read(v).collect()} for v in table.versions()]
    assert {1: 1, 2: 1} in seen and {1: 2, 2: 1, 3: 1} in seen
    table.merge(table.read().withColumn("messages", F.lit(99)), batch=("days", 1))
    assert {r.day.day: r.messages for r in table.read().collect()} == {1: 3, 2: 1, 3: 1}


def test_a_feed_replayed_after_a_restart_adds_nothing(spark, feed, tmp_path):
    stream = feed([(1, 1, "p"), (1, 1, "p"), (2, 900, "p")], [(1, 1, "p"), (3, 1, "p"), (None, 1, "p")])
    for run in ("a", "b"):
        adt.run_once_each(stream, str(tmp_path / "o"), str(tmp_path / run), str(tmp_path / "seen"))
        assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [1, 2, 3]


def test_a_batch_that_failed_before_its_ids_were_entered_is_written_again(spark, feed, tmp_path, monkeypatch):
    from wardlight.sources.versioned import VersionedTable

    stream = feed([(1, 1, "p")], [(2, 1, "p"), (1, 1, "p")])
    args = (stream, str(tmp_path / "o"), str(tmp_path / "c"), str(tmp_path / "seen"))
    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, "append", lambda *_, **__: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception):
            adt.run_once_each(*args)
    adt.run_once_each(*args)
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [1, 2]


@pytest.fixture
def scored(spark, tmp_path):
    """Messages and score updates as two streams of files, and the same rows as a batch."""
    def build(*batches):
        for asked, updates in batches:
            (spark.createDataFrame([(i, START + dt.timedelta(hours=h), p, "admit") for i, h, p in asked],
                                   "event_id long, ts timestamp, patient_id string, adt_type string")
             .coalesce(1).write.mode("append").parquet(str(tmp_path / "m")))
            (spark.createDataFrame([(p, START + dt.timedelta(hours=h), i, s) for i, h, p, s in updates],
                                   "patient_id string, updated timestamp, update_id long, risk_score double")
             .coalesce(1).write.mode("append").parquet(str(tmp_path / "u")))
        frames = [spark.read.parquet(str(tmp_path / n)) for n in "mu"]
        streams = [adt.read_feed(spark, str(tmp_path / n), f.schema, files_per_batch=1)
                   for n, f in zip("mu", frames)]
        return streams, frames

    return build


def test_the_latest_update_counts_even_if_it_is_late(spark, scored):
    streams, frames = scored(
        ([(1, 10, "p"), (2, 10, "q")], [(1, 2, "p", 0.1), (2, 9, "p", 0.2), (3, 11, "p", 0.9)]),
        # Late by less than the lateness: it still comes before message 1 is given.
        ([(3, 10, "p")], [(4, 9.5, "p", 0.3)]),
        ([(4, 60, "p"), (5, 61, "q")], [(5, 60, "z", 0.0)]),
        ([(6, 90, "p")], [(6, 90, "z", 0.0)]))
    got = {r.event_id: r.risk_score for r in adt.drained(
        spark, adt.with_latest_update(*streams, "24 hours", "2 hours"), "asof").collect()}
    assert got[1] == got[3] == 0.3 and got[2] is None and got[4] is None and 6 not in got
    batch = {r.event_id: r.risk_score for r in adt.latest_update_of(*frames, "24 hours").collect()}
    assert {k: batch[k] for k in got} == got and len(batch) == 6


def test_latest_updates_over_days_ties_and_nulls(spark):
    rows = [(1, 50, "p"), (2, 50, None), (3, 0, "p"), (4, 30, "hot"), (5, 100, "hot")]
    asked = spark.createDataFrame([(i, START + dt.timedelta(hours=h), p, "admit") for i, h, p in rows],
                                  "event_id long, ts timestamp, patient_id string, adt_type string")
    updates = spark.createDataFrame(
        [(p, START + dt.timedelta(hours=h), i, s) for i, h, p, s in
         [(1, 1, "p", 0.1), (2, 20, "p", 0.2), (3, 20, "p", 0.4), (4, 1, None, 0.9), (5, 30, "hot", 0.5)]],
        "patient_id string, updated timestamp, update_id long, risk_score double")
    got = {r.event_id: r.risk_score for r in adt.latest_update_of(asked, updates, "48 hours").collect()}
    assert got == {1: 0.4, 2: None, 3: None, 4: 0.5, 5: None}
    assert adt.latest_update_of(asked, updates.limit(0), "48 hours").where("risk_score is not null").isEmpty()


def test_risk_merge_reads_only_touched_buckets_and_replays(spark, feed, tmp_path):
    from wardlight.sources.versioned import VersionedTable

    base = spark.createDataFrame([(f"p{i}", 0.9, 0, None) for i in range(50)],
                                 "patient_id string, risk_score double, messages bigint, last_message timestamp")
    table = VersionedTable.create(base, str(tmp_path / "r"), "patient_id", 64)
    stream = feed([(i, 1, "p1") for i in range(7)], [(9, 2, "new"), (10, 2, None)])
    before = table.manifest().folders
    adt.run_risk_merge(stream, table, str(tmp_path / "c"))
    adt.run_risk_merge(stream, table, str(tmp_path / "c"))
    rows = {r.patient_id: (r.risk_score, r.messages) for r in table.read().collect()}
    assert rows["p1"] == (1.0, 7) and rows["new"] == (0.02, 1) and rows["p2"] == (0.9, 0) and len(rows) == 51
    changed = [b for b, f in table.manifest().folders.items() if before.get(b) != f]
    assert len(changed) <= 2
