"""The pipeline's stages in a row, each against its plain version."""

from collections import Counter

import pyarrow.parquet as pq
import pytest

import brute
import corpus_pipeline
from wardlight.llm.quality import quality_table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def rows(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "lines", "near_duplicates", "mixing", "packing"]
    for name in ("quality", "lines", "near_duplicates", "mixing"):
        assert stages[name].dtypes == stages["documents"].dtypes


def test_quality_keeps_good_labels(spark, stages):
    judged = quality_table(stages["documents"], spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert {d for d, _ in rows(stages["quality"])} == {
        r.doc_id for r in judged.collect() if r.kept}
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SMALL}/labels.parquet").to_pylist()}
    kept = {d for d, _ in rows(stages["quality"])}
    failed = {d for d, t in rows(stages["documents"]) if brute.quality_counts(t)["base_failed"]}
    good = {d for d, q in labels.items() if q} - failed
    assert len(good & kept) >= 0.97 * len(good)
    assert not {d for d, q in labels.items() if not q} & kept


def test_lines(stages):
    want = {d: t for d, (_, _, t) in brute.clean_lines(rows(stages["quality"])).items()}
    assert dict(rows(stages["lines"])) == want


def test_near_duplicates(stages):
    classes = brute.similar(rows(stages["lines"]), percent=80, width=5)
    assert {d for d, _ in rows(stages["near_duplicates"])} == {
        d for d, (_, c) in classes.items() if d == c}


def test_mixing(stages):
    before = {r.doc_id: r for r in stages["near_duplicates"].collect()}
    size = {d: len(brute.words(r.text)) for d, r in before.items()}
    total = Counter()
    for d, r in before.items():
        total[r.source] += size[d]
    target = brute.targets(dict(total))
    taken = Counter()
    for d, n in Counter(d for d, _ in rows(stages["mixing"])).items():
        assert 1 <= n <= 3
        taken[before[d].source] += n * size[d]
    largest = max(size.values())
    assert all(abs(taken[s] - target[s]) <= max(50, largest / 10) for s in total)


def test_packing_and_run(spark, stages):
    packed = stages["packing"].collect()
    tokens = Counter()
    for r in packed:
        tokens[r.doc_id] += r.length
    copies = Counter(d for d, _ in rows(stages["mixing"]))
    whole = {r.doc_id: r.doc_tokens for r in packed}
    assert tokens == Counter({d: n * whole[d] for d, n in copies.items()})
    again = corpus_pipeline.run(spark, SMALL).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert Counter(map(key, again)) == Counter(map(key, packed))
