"""The pipeline, stage by stage, against plain versions; and the SQL counterparts of the queries."""

from __future__ import annotations

import brute
import duckdb
import pytest

import corpus_pipeline
from trackline.llm.queries import QUERIES, SQL


def by_id(frame):
    return sorted((row.doc_id, row.text) for row in frame.select("doc_id", "text").collect())


def test_stages(spark, sf_dir, docs, texts, labels):
    stages = dict(corpus_pipeline.STAGES)
    known = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]

    kept = stages["quality rules"](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    good = {row[0] for row in brute.quality(texts, known) if row[-1]}
    assert by_id(kept) == [(i, t) for i, t in texts if i in good]

    lines = stages["line dedup"](spark, kept, sf_dir)
    assert lines.columns == docs.columns and lines.filter("n_chars <> length(text)").count() == 0
    expected = sorted((i, t) for i, _, _, t in brute.deduped([(i, t) for i, t in texts if i in good]))
    assert by_id(lines) == expected

    single = stages["near dedup"](spark, lines, sf_dir)
    assert single.columns == docs.columns
    classes = brute.classes(expected)
    expected = [(i, t) for i, t in expected if classes[i] == i]
    assert by_id(single) == expected

    clean = stages["decontamination"](spark, single, sf_dir)
    assert clean.columns == docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    sizes = {i: len(brute.plain(t)) for i, t in items}
    leaks = set()
    for i, text in expected:  # alignment only where most of an item's words occur at all
        own = set(brute.plain(text))
        near = [(j, t) for j, t in items if sum(w in own for w in brute.plain(t)) >= 0.5 * sizes[j]]
        leaks |= {d for d, _ in brute.leaks([(i, text)], near)}
    found = by_id(clean)
    assert {i for i, _ in expected} - {i for i, _ in found} == leaks and len(leaks) > 0

    mix = stages["mixing"](spark, clean, sf_dir)
    assert mix.columns == [*docs.columns, "repetition"]
    assert {row.repetition for row in mix.select("repetition").distinct().collect()} <= {1, 2}
    total = sum(len(brute.words(t)) for _, t in found)
    assert abs(sum(len(brute.words(row.text)) for row in mix.collect()) - 1.5 * total) < 0.1 * total


def test_empty_input(spark, no_docs, sf_dir):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_odd_documents(spark, odd_docs, sf_dir):
    """Each stage on its own has a defined result for odd rows; together they carry every column through."""
    stages = dict(corpus_pipeline.STAGES)

    def ids(frame):
        return sorted((row.doc_id for row in frame.collect()), key=str)

    every = ids(odd_docs)
    assert ids(stages["quality rules"](spark, odd_docs, sf_dir)) == sorted([7, 7, *range(10, 16)], key=str)
    lines = stages["line dedup"](spark, odd_docs, sf_dir)
    assert ids(lines) == every and {r.doc_id: r.text for r in lines.collect()}[1] is None
    assert ids(stages["near dedup"](spark, odd_docs, sf_dir)) == sorted([None, 1, 2, 3, 4, 6, 7, 10], key=str)
    assert ids(stages["decontamination"](spark, odd_docs, sf_dir)) == every
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.columns == [*odd_docs.columns, "repetition"]
    assert {row.doc_id for row in docs.collect()} <= {7, *range(10, 16)} and docs.filter("size <> 'given'").count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_match(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "conversations", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    frame = QUERIES[name](spark, sf_dir)
    order = sorted(frame.columns)
    ours = sorted((tuple(row) for row in frame.select(*order).collect()), key=str)
    theirs = con.execute(f"SELECT {', '.join(order)} FROM ({SQL[name]})").fetchall()
    assert ours == sorted(theirs, key=str)


def test_every_operator_has_its_query():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
