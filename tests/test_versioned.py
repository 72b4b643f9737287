"""Versioned tables: snapshots, merges, replays, failures between the steps, and what a read opens."""

import pytest
from pyspark.sql import functions as F

from wardlight.session import settled
from wardlight.sources import versioned as V
from wardlight.sources.history import BucketedHistory
from wardlight.sources.versioned import Conflict, VersionedTable


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.lit("a").alias("t"))
    return VersionedTable.create(rows, str(tmp_path / "t"), "k", 8)


def updates(spark, *rows):
    return spark.createDataFrame(list(rows), "k bigint, v bigint, t string")


def content(frame):
    return {r.k: (r.v, r.t) for r in frame.collect()}


START = {k: (2 * k, "a") for k in range(40)}


def test_a_merge_updates_inserts_and_leaves_the_rest(spark, table):
    table.merge(updates(spark, (3, 100, "b"), (77, 1, None)))
    assert content(table.read()) == {**START, 3: (100, "b"), 77: (1, None)}
    assert content(table.read(version=0)) == START


def test_expressions_see_the_stored_and_the_new_row(spark, table):
    table.merge(updates(spark, (3, 100, "b"), (77, 1, "c")), inserted={"v": -F.col("new.v")},
                matched={"v": F.col("old.v") + F.col("new.v"), "t": F.col("old.t")})
    assert content(table.read()) == {**START, 3: (106, "a"), 77: (-1, "c")}


def test_columns_that_an_update_lacks(spark, table):
    table.merge(updates(spark, (3, 100, "b"), (77, 1, "c")).select("k", "t"))
    assert content(table.read()) == {**START, 3: (6, "b"), 77: (None, "c")}


def test_deletes(spark, table):
    table.merge(updates(spark, (3, None, None), (4, 5, "x"), (50, None, None)),
                delete=F.col("new.v").isNull())
    left = {k: v for k, v in START.items() if k != 3}
    assert content(table.read()) == {**left, 4: (5, "x"), 50: (None, None)}


def test_only_touched_buckets_are_rewritten_and_read(spark, table):
    before = table.manifest()
    one = updates(spark, (3, 0, "z"))
    touched = table.buckets_of(one)
    assert len(touched) == 1
    table.merge(one)
    after = table.manifest()
    assert {b for b in after.folders if after.folders[b] != before.folders[b]} == set(touched)
    opened = table.read(buckets=touched).inputFiles()
    assert opened and all(f"__bucket={touched[0]}/" in f for f in opened)
    assert len(opened) < len(table.read().inputFiles())
    assert content(table.read_keys(one)) == {3: (0, "z")}
    assert set(table.read_keys(one).inputFiles()) == set(opened)


def test_a_replayed_batch_is_skipped(spark, table):
    add = {"v": F.col("old.v") + F.col("new.v")}
    assert table.merge(updates(spark, (1, 5, "a")), add, batch=("feed", 0)) == 1
    assert table.merge(updates(spark, (1, 5, "a")), add, batch=("feed", 0)) == 1
    assert table.merge(updates(spark, (1, 5, "a")), add, batch=("feed", 1)) == 2
    assert table.merge(updates(spark, (1, 5, "a")), add, batch=("other", 0)) == 3
    assert content(table.read())[1] == (17, "a")


def test_a_failure_between_write_and_swap_leaves_the_old_version(spark, table, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, "_publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.merge(updates(spark, (1, 5, "b")), batch=("feed", 0))
    assert table.versions() == [0] and content(table.read()) == START
    table.merge(updates(spark, (1, 5, "b")), batch=("feed", 0))
    assert content(table.read()) == {**START, 1: (5, "b")}
    # What the failed commit wrote is named by no version and goes with the old ones.
    assert table.vacuum(keep=1) == 1 and content(table.read()) == {**START, 1: (5, "b")}


def test_a_draft_that_was_never_put_in_place_is_no_version(spark, table, tmp_path):
    (tmp_path / "t" / "manifests" / ".left.draft").write_text('{"version": 9')
    assert table.versions() == [0] and content(table.read()) == START


def test_two_writers_of_one_version(spark, table):
    base = table.manifest()
    table.merge(updates(spark, (1, 5, "b")))
    with pytest.raises(Conflict):
        table._publish(V.Manifest(base.version + 1, base.key, base.buckets, base.schema, base.folders))
    assert content(table.read())[1] == (5, "b")


def test_a_writer_that_comes_second_merges_anew(spark, table, monkeypatch):
    plain, rivals = VersionedTable._committed, [updates(spark, (2, 9, "rival"))]

    def late(self, *rest):
        if rivals:
            monkeypatch.setattr(VersionedTable, "_committed", plain)
            VersionedTable(spark, self.path).merge(rivals.pop())
        return plain(self, *rest)

    monkeypatch.setattr(VersionedTable, "_committed", late)
    assert table.merge(updates(spark, (2, 1, "late")), {"v": F.col("old.v") + F.col("new.v")}) == 2
    assert content(table.read())[2] == (10, "late")


def test_replaced_by_its_own_query(spark, table):
    table.replace(lambda own: own.where("k < 10").withColumn("twice", F.col("v") * 2).drop("t"))
    assert table.read().columns == ["k", "v", "twice"]
    assert {r.k: r.twice for r in table.read().collect()} == {k: 4 * k for k in range(10)}
    assert content(table.read(version=0)) == START
    with pytest.raises(ValueError):
        table.replace(lambda own: own.select("v"))


def test_appends_keep_rows_of_one_key_and_are_compacted(spark, table):
    for n in range(3):
        table.append(updates(spark, (1, n, "more"), (1, n, "more")), batch=("a", n))
    table.append(updates(spark, (1, 2, "more")), batch=("a", 2))
    assert table.read().where("k = 1").count() == 7
    hot = table.buckets_of(updates(spark, (1, 0, "")))[0]
    assert len(table.manifest().folders[hot]) == 4
    table.compact()
    assert len(table.manifest().folders[hot]) == 1 and table.read().where("k = 1").count() == 7


def test_wrong_keys_are_refused(spark, table):
    for rows in ([(1, 1, "a"), (1, 2, "b")], [(None, 1, "a")]):
        with pytest.raises(ValueError):
            table.merge(updates(spark, *rows))
    with pytest.raises(ValueError):
        VersionedTable.create(table.read(), table.path, "k")
    with pytest.raises(ValueError):
        VersionedTable(spark, table.path + "-none").read()


def test_empty_tables_and_batches(spark, tmp_path):
    table = VersionedTable.create(updates(spark), str(tmp_path / "e"), "k", 4)
    assert table.read().count() == 0
    table.merge(updates(spark))
    assert table.read().count() == 0
    table.merge(updates(spark, (5, 1, "a")))
    assert content(table.read()) == {5: (1, "a")}
    table.merge(updates(spark, (5, 1, "a")), delete=F.lit(True))
    assert table.read().count() == 0


def test_a_hot_key_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(4000).select(F.lit(7).cast("bigint").alias("k"), F.col("id").alias("v"))
        table = VersionedTable.create(rows, str(tmp_path / "h"), "k", 8)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(table.read().inputFiles()) > 1 and table.read().count() == 4000


def test_the_history_of_few_patients_opens_few_files(spark, small, tmp_path):
    history = BucketedHistory.build(small, str(tmp_path / "h"), 32)
    counts = []
    for n in (1, 8, 150):
        some = settled(small.patients.orderBy("patient_id").limit(n).select("patient_id"), "touched")
        share = history.share(some)
        buckets = len(history.buckets_of(some))
        for name in ("encounters", "diagnoses", "risk_scores"):
            opened = {f.split("__bucket=")[1].split("/")[0]
                      for f in share.table(name).inputFiles() if "__bucket=" in f}
            assert 0 < len(opened) <= buckets
        counts.append(len([f for f in share.encounters.inputFiles() if "__bucket=" in f]))
        own = small.encounters.join(some, "patient_id", "left_semi")
        assert sorted(map(repr, share.encounters.select(*own.columns).collect())) == sorted(map(repr, own.collect()))
    assert counts[0] < counts[1] < counts[2] <= len(history.whole().encounters.inputFiles())


def test_history_takes_new_rows_and_scores(spark, small, tmp_path):
    history = BucketedHistory.build(small, str(tmp_path / "h"), 8)
    one = small.encounters.limit(1)
    history.add("encounters", one, batch=("stays", 0))
    history.add("encounters", one, batch=("stays", 0))
    assert history.whole().encounters.count() == small.encounters.count() + 1
    scores = small.risk_scores.limit(3).withColumn("risk_score", F.lit(0.5))
    history.set_scores(scores)
    assert history.whole().risk_scores.where("risk_score = 0.5").count() >= 3
    assert history.whole().diagnoses.columns == small.diagnoses.columns
    assert history.whole().diagnoses.count() == small.diagnoses.count()
