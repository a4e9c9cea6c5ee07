"""Near duplicates (4) and line dedup (6)."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from trackline.llm import op4_dart_minhash as op4
from trackline.llm import op6_line_dedup as op6
from trackline.llm.common import mixed
from trackline.llm.components import components
from trackline.llm.cuckoo import CuckooFilter


def changed(words, edits, rng):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_signatures_agree_as_often_as_texts_do():
    rng = np.random.default_rng(1)
    elements = mixed(np.arange(1, 300).astype(np.uint64))
    a = rng.uniform(0.05, 30, 299)
    b = a * rng.uniform(0.5, 1.5, 299)
    expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    agree = op4.dart_signature(elements, a, 4000) == op4.dart_signature(elements, b, 4000)
    assert abs(agree.mean() - expected) < 0.03
    assert op4.dart_signature(elements[:0], a[:0], 10) is None


def test_exact_similarity_is_weighted():
    a, b = "x y z w v " * 4, "x y z w v " * 3 + "other words in here"
    found = op4.similarity(op4.occurrences(op4.text_runs(a, 5)), op4.occurrences(op4.text_runs(b, 5)))
    assert found == pytest.approx(brute.similarity(brute.runs(a), brute.runs(b)))


def test_classes_equal_brute_force(docs, texts):
    found = {row.doc_id: row.class_id for row in op4.near_duplicates(docs).collect()}
    assert found == brute.classes(texts)


@pytest.mark.parametrize("paired", [2, 32])
def test_large_group_of_near_copies(spark, monkeypatch, paired):
    """Copies at every distance of one text: no link may be lost, by pairs nor by blocks."""
    monkeypatch.setattr(op4, "PAIRED", paired)
    monkeypatch.setattr(op4, "BLOCK", 8)
    rng = random.Random(3)
    words = [f"w{rng.randrange(400)}" for _ in range(150)]
    rows = [(k, changed(words, rng.randrange(12), rng)) for k in range(90)]
    rows += [(100 + k, " ".join(f"o{rng.randrange(400)}" for _ in range(80))) for k in range(10)]
    found = {row.doc_id: row.class_id for row in op4.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute.classes(rows)


def test_near_duplicate_edges(odd_docs, no_docs):
    found = sorted((tuple(row) for row in op4.near_duplicates(odd_docs).collect()), key=str)
    classes = dict(found)
    assert len(found) == 14 and {classes[i] for i in (1, 2, 3)} == {1, 2, 3}
    assert classes[7] == 7 and found.count((7, 7)) == 2 and classes[None] is not None
    assert op4.near_duplicates(no_docs).count() == 0 and op4.one_of_each(no_docs).count() == 0
    stay = op4.one_of_each(odd_docs)
    assert stay.columns == odd_docs.columns
    ids = [row.doc_id for row in stay.collect()]
    assert ids.count(7) == 1 and {1, 2, 3, None} <= set(ids)
    assert {i for i in ids if i is not None} == {c for i, c in found if i is not None}


def test_texts_of_one_id_are_one_document(spark):
    """An id with two texts joins the classes of both, in any order of the rows, and one row of it stays."""
    rng = random.Random(6)
    words = [[f"{c}{rng.randrange(300)}" for _ in range(120)] for c in "abcd"]
    rows = [(1, " ".join(words[0])), (1, " ".join(words[1])), (2, changed(words[1], 2, rng)), (3, changed(words[0], 2, rng)),
            (4, " ".join(words[2])), (4, " ".join(words[2])), (5, changed(words[2], 2, rng)), (6, " ".join(words[3])),
            (0, " ".join(words[3])), (6, "something else that is short"), (None, changed(words[3], 2, rng))]
    expected = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 0, 0: 0, None: 0}
    for order in (rows, rows[::-1], rng.sample(rows, len(rows))):
        docs = spark.createDataFrame(order, "doc_id long, text string")
        found = [(r.doc_id, r.class_id) for r in op4.near_duplicates(docs).collect()]
        assert len(found) == len(rows) and dict(found) == expected and set(found) == set(expected.items())
        stay = sorted(tuple(r) for r in op4.one_of_each(docs).collect())
        assert [i for i, _ in stay] == [0, 1, 4] and stay[1][1] in (rows[0][1], rows[1][1])
        assert order is rows or stay == kept_before
        kept_before = stay


def test_one_of_each_keeps_the_first(docs, texts):
    assert {row.doc_id for row in op4.one_of_each(docs).collect()} == set(brute.classes(texts).values())


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(200, k) for k in range(201, 240)] + [(300, 300), (310, 305)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {k: 0 for k in range(61)} | {k: 200 for k in range(200, 240)} | {310: 305, 305: 305}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_cuckoo_filter_holds_and_forgets():
    keys = np.random.default_rng(0).integers(-2 ** 62, 2 ** 62, 5000)
    found = CuckooFilter.of(keys[:4000])
    assert found.holds(keys[:4000]).all() and found.holds(keys[4000:]).mean() < 0.01
    found.delete_all(keys[:2000])
    again = CuckooFilter.from_bytes(found.to_bytes())
    assert again.holds(keys[2000:4000]).all() and again.holds(keys[:2000]).mean() < 0.01
    assert not CuckooFilter.of(keys[:0]).holds(keys).any()


def kept(frame):
    return sorted((row.doc_id, row.n_lines, row.n_dropped, row.text or "") for row in frame.collect())


def test_lines_equal_brute_force(docs, texts):
    assert kept(op6.dedup_lines(docs)) == sorted(brute.deduped(texts))


def test_deleting_reverses_inserting(spark, texts, monkeypatch):
    monkeypatch.setattr(op6, "SHARD_KEYS", 3)
    line = "  A line of more than FORTY characters shared by many documents"
    first = [(i, f"{text}\n{line}" if i % 3 == 0 else text) for i, text in texts[:80]]
    second = [(i, f"{text}\n{line.upper()}\nalso this line is to be found in all documents of the second part")
              for i, text in texts[80:110]]
    a, b = (spark.createDataFrame(rows, "doc_id long, text string") for rows in (first, second))
    one = op6.insert(op6.empty_state(spark), a)
    both = op6.insert(one, b)
    assert kept(op6.drop_lines(both, a.unionByName(b))) == sorted(brute.deduped(first + second))
    back = op6.delete(both, b)
    assert kept(op6.drop_lines(back, a)) == sorted(brute.deduped(first))
    assert sorted(map(tuple, back.counts.select("high", "low", "n_docs", "last_doc").collect())) == sorted(
        map(tuple, one.counts.select("high", "low", "n_docs", "last_doc").collect()))


def test_shards_follow_a_later_large_insert(spark, monkeypatch):
    monkeypatch.setattr(op6, "SHARD_KEYS", 3)
    monkeypatch.setattr(op6, "COMPACT_EVERY", 3)
    lines = [f"line number {k} of the many that all the later documents share" for k in range(300)]
    first = [(i, "\n".join(lines[:4])) for i in range(6)]
    second = [(10 + i, "\n".join([*lines, f"a line that only document {10 + i} of the second part holds"]))
              for i in range(6)]
    a, b = (spark.createDataFrame(rows, "doc_id long, text string") for rows in (first, second))
    small = op6.insert(op6.empty_state(spark), a)
    large = op6.insert(small, b)
    assert small.shards == 2 and large.shards == 100 and large.n_common == 300 and large.filters.count() > 90
    assert kept(op6.drop_lines(large, a.unionByName(b))) == sorted(brute.deduped(first + second))
    state = large
    for _ in range(2):  # through a compaction and back
        state = op6.insert(op6.delete(state, b), b)
    assert state.generations == 3 and state.refs.count() < 3 * large.refs.count()  # 6 steps, one compaction
    assert op6._compacted(state).refs.count() == large.refs.count()
    back = op6.delete(state, b)
    assert back.n_common == 4
    assert kept(op6.drop_lines(back, a)) == sorted(brute.deduped(first))
    assert sorted(map(tuple, back.counts.collect())) == sorted(map(tuple, small.counts.collect()))


def test_line_edges(odd_docs, no_docs):
    found = op6.dedup_lines(odd_docs)
    assert found.columns == [*odd_docs.columns, "_n_lines", "n_dropped"]
    rows = {row.doc_id: row for row in found.collect()}
    assert found.count() == 14 and rows[1].text is None and (rows[1]["_n_lines"], rows[1].n_dropped) == (1, 0)
    assert rows[2].text == "" and rows[3]["_n_lines"] == 2
    assert [rows[10 + k].n_dropped for k in range(6)] == [1, 1, 1, 1, 1, 0]
    assert rows[15].text.startswith("a line") and rows[10].text == "its own 0" and rows[10]["n_lines"] == "given"
    assert op6.dedup_lines(no_docs).count() == 0
