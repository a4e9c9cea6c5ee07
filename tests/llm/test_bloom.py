"""Exact dedup by two passes over a Bloom filter (12)."""

from __future__ import annotations

import re
from collections import defaultdict

import brute
import numpy as np
import pandas as pd
import pytest

from trackline.llm import op12_bloom_dedup as op12


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[plain(text)].append((i, text or ""))
    out = []
    for key, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(i, keep, len(members), brute.sha256(key)) for i, _ in members]
    return sorted(out, key=str)


def found(frame):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in frame.collect()), key=str)


def test_filter_finds_every_repeat():
    rng = np.random.default_rng(0)
    hashes = rng.integers(-2 ** 62, 2 ** 62, 20_000)
    size, rounds = op12.filter_size(20_000)
    assert rounds == 1
    parts = [op12._part(np.append(chunk, hashes[:50]), size).to_pandas() for chunk in np.array_split(hashes[50:], 5)]
    bits = np.zeros(size // 8, np.uint8)
    for segment in range(size // op12.SEGMENT):
        own = [p[p.segment == segment] for p in parts]
        merged = op12._merged(pd.concat(own))
        bits[segment * 8192:(segment + 1) * 8192] = np.frombuffer(merged.bits.iloc[0], np.uint8)
    at = op12.positions(hashes, size)
    twice = ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)
    assert twice[:50].all() and twice[50:].mean() < 0.02


@pytest.mark.parametrize("most, hot", [(2 ** 30, 1000), (2 ** 16, 1000), (2 ** 16, 2)])
def test_duplicates_equal_brute_force(spark, texts, monkeypatch, most, hot):
    """Also in several rounds, and where hardly a group counts as hot."""
    monkeypatch.setattr(op12, "MOST_POSITIONS", most)
    monkeypatch.setattr(op12, "POSITIONS", 16 if most > 2 ** 16 else 600)
    monkeypatch.setattr(op12, "HOT", hot)
    rows = texts + [(10_000 + k, "one and the same" + " " * (k % 7)) for k in range(400)] + [(20_000, None), (20_001, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert op12.filter_size(len(rows))[1] == (1 if most > 2 ** 16 else 8)
    marked = op12.exact_duplicates(docs)
    assert found(marked) == expected(rows)
    stay = {row.doc_id for row in marked.filter("kept").collect()}
    assert stay == {keep for _, keep, _, _ in expected(rows)}
    assert sorted(r.doc_id for r in op12.kept_documents(docs).collect()) == sorted(stay)


def test_only_possible_repeats_are_shuffled(spark, texts):
    """Rows that stand alone reach the result without an exchange."""
    unique = list({plain(text): (i, text) for i, text in texts}.values())
    names = op12._Names(spark.range(1).withColumn("text", op12.F.lit("")))
    docs = spark.createDataFrame(unique, "doc_id long, text string")
    alone, met = op12._decided(op12._measured(docs, names, "doc_id", "text"), names, len(unique))
    assert met.count() <= len(unique) * 0.02 and alone.count() >= len(unique) * 0.98
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()


def test_edges(odd_docs, no_docs):
    marked = op12.exact_duplicates(odd_docs)
    rows = marked.collect()
    assert marked.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and len(rows) == 14
    by_id = defaultdict(list)
    for row in rows:
        by_id[row.doc_id].append(row)
    assert {by_id[i][0].keep_id for i in (1, 2, 3)} == {3} and by_id[1][0].group_size == 3
    assert sorted(row.kept for row in by_id[7]) == [False, True] and by_id[7][0].group_size == 2
    assert by_id[None][0].kept and by_id[6][0].kept
    stay = op12.kept_documents(odd_docs)
    assert stay.columns == odd_docs.columns
    assert sorted((r.doc_id for r in stay.collect()), key=str) == sorted([3, 4, None, 6, 7, *range(10, 16)], key=str)
    assert op12.exact_duplicates(no_docs).count() == 0 and op12.kept_documents(no_docs).count() == 0


def test_repeated_ids_and_ties(spark):
    """Equal ids with other spacing, and unknown ids: one row of each group stays whatever the order of rows."""
    rows = [(1, "a b"), (1, "ab "), (None, "a\tb"), (2, "ab"), (None, "x"), (None, "x"), (5, "y y"), (4, "yy ")]
    once = [found(op12.exact_duplicates(spark.createDataFrame(part, "doc_id long, text string")))
            for part in (rows, rows[::-1])]
    assert once[0] == once[1] == expected(rows)
    stay = [sorted(map(str, op12.kept_documents(spark.createDataFrame(part, "doc_id long, text string")).collect()))
            for part in (rows, rows[::-1])]
    assert stay[0] == stay[1] and len(stay[0]) == 3
