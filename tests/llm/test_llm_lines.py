import random

import brute
from llm_fixtures import documents, edges  # noqa: F401
from pyspark.sql import functions as F
from wardlight.llm import linededup as L


def answer(frame):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in frame.collect()}


def plain(rows):
    return {d: (n, k, brute.digest(t)) for d, (n, k, t) in brute.clean_lines(rows).items()}


def corpus(n, seed=3):
    rng = random.Random(seed)
    shared = [f"A shared line number {i}" for i in range(15)] + ["short", "ünïcödé äö", "          "]
    rows = []
    for doc in rng.sample(range(1000), n):
        lines = [rng.choice(shared) if rng.random() < 0.5 else f"own line {doc} {i} of it"
                 for i in range(rng.randrange(12))]
        rows.append((doc, "\n".join(rng.choice([s, f"\t{s} ", s.upper()]) for s in lines)))
    return rows


def test_table_equals_brute_force(spark, documents, edges):
    rows = corpus(60) + [r[:2] for r in edges if r[0] is not None]
    rows += [(2000, "A SHARED line number 3\n" * 4), (2001, None)]
    assert answer(L.line_table(documents(*rows))) == plain(rows)


def test_rows_without_key_and_repeated_rows(spark, documents):
    frame = documents((5, "the very same line\nother"), (5, "the very same line\nother"),
                      (None, "the very same line"), (None, "the very same line"))
    got = L.line_table(frame).collect()
    assert [r.n_dropped for r in got] == [0, 0, 0, 0]


def test_empty_table(spark, documents):
    assert L.line_table(documents()).count() == 0


def test_clean_documents_keep_columns_and_null_texts(spark, documents):
    cleaned = L.clean_documents(documents((2, "a line that repeats\nx"), (1, "A line that repeats"),
                                          (3, None)))
    assert cleaned.columns == documents().columns
    assert {r.doc_id: r.text for r in cleaned.collect()} == {
        1: "A line that repeats", 2: "x", 3: None}


def tables(index):
    counts = {(r.key_a, r.key_b): (r.n_references, r.first_doc, r.last_doc)
              for r in index.counts.collect()}
    return counts, sorted(map(tuple, index.references.collect()))


def test_adding_and_removing_equals_a_new_index(spark, documents):
    rows = corpus(50)
    first, second = rows[:30], rows[30:]
    index = L.add_documents(L.index_lines(documents(*first)), documents(*second))
    assert tables(index) == tables(L.index_lines(documents(*rows)))
    cleaned = {r.line_doc: r.line_text for r in L.clean_rows(documents(*rows), index).collect()}
    assert cleaned == {d: t for d, (_, _, t) in brute.clean_lines(rows).items()}

    gone = {d for d, _ in rows[::3]}
    rest = [r for r in rows if r[0] not in gone]
    index = L.remove_documents(index, spark.createDataFrame([(d,) for d in gone], "doc_id bigint"))
    assert tables(index) == tables(L.index_lines(documents(*rest)))
    cleaned = {r.line_doc: r.line_text for r in L.clean_rows(documents(*rest), index).collect()}
    assert cleaned == {d: t for d, (_, _, t) in brute.clean_lines(rest).items()}


def test_filters_outgrown_are_built_anew(spark, documents, monkeypatch):
    monkeypatch.setattr(L, "SHARD_KEYS", 8)
    few = [(1, "a line of no interest"), (2, "a line of no interest")]
    many = [(d, "\n".join(f"shared line {i} of many" for i in range(3000))) for d in (3, 4)]
    index = L.add_documents(L.index_lines(documents(*few)), documents(*many))
    assert index.shards > 1
    cleaned = L.clean_rows(documents(*few, *many), index)
    assert {r.line_doc: r.n_dropped for r in cleaned.collect()} == {1: 0, 2: 1, 3: 0, 4: 3000}


def test_most_references_stop_at_the_filter(spark, documents):
    rows = [(d, "\n".join(f"line {i} of document {d} alone" for i in range(200)))
            for d in range(10)] + [(d, "one line that two share") for d in (50, 51)]
    index = L.index_lines(documents(*rows))
    hits = L.maybe_repeated(index.references, index)
    assert 2 <= hits.count() < 20
    assert hits.where(F.col("doc_id") >= 50).count() == 2
