"""Ranked search over a tree of documents (13)."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from trackline.llm import op13_fp_tree_search as op13

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, top=10):
    """(item, rank, doc, score) of every item by scoring every document."""
    counts = [(i, Counter(terms(text))) for i, text in docs]
    sizes = [sum(c.values()) for _, c in counts]
    many, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * many + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        own, found = set(terms(text)), []
        for (i, c), n in zip(counts, sizes, strict=True):
            m = 10 + 90 * n * many // total if total else 10
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, k, None if unknown else i, -s) for k, (s, unknown, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def found(frame):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect()), key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(items, "item_id long, text string"))


def test_terms_are_those_of_the_contract():
    text = "Ab_c'D éÉ​x 9-Z\x7fq[k]{w} " + "".join(map(chr, range(1, 0x180)))
    assert [t.decode() for t in op13.terms(text.encode())] == terms(text)


def grown(rng, docs, words):
    """A tree and its vectors as dictionaries."""
    vectors = [{int(t): int(rng.integers(1, 6)) for t in np.unique((words * rng.random(rng.integers(1, 30)) ** 3).astype(int))}
               for _ in range(docs)]
    entries = [(k, t, tf) for k, v in enumerate(vectors) for t, tf in sorted(v.items())]
    row, rank, tf = (np.array(c, np.int64) for c in zip(*entries, strict=True))
    m = rng.integers(10, 400, docs)
    return op13.Tree(row, rank, tf, m, words), vectors, m


@pytest.mark.parametrize("words", [6, 60, 400])
def test_tree_shares_paths_and_bounds_hold(words):
    rng = np.random.default_rng(words)
    tree, vectors, m = grown(rng, 1500, words)
    order = [sorted(vectors[k]) for k in tree.rows]
    assert order == sorted(order) and sorted(tree.rows.tolist()) == list(range(1500))
    leaves = sorted(r for k, r in enumerate(tree.ranges) if k not in tree.children)
    assert leaves[0][0] == 0 and leaves[-1][1] == 1500 and all(a[1] == b[0] for a, b in zip(leaves, leaves[1:]))
    assert len(tree.ranges) <= 4 * 1500 / op13.LEAF + 1
    weights = rng.integers(0, 5000, words)
    scores = tree.docs.scores(0, 1500, weights)
    assert scores.tolist() == [sum(int(weights[t]) * (10 ** 9 * tf // (1000 * tf + 8 * int(m[k])))
                                   for t, tf in vectors[k].items()) for k in tree.rows]
    bounds = tree.bounds.scores(0, len(tree.ranges), weights)
    assert all(bounds[k] >= scores[a:b].max() for k, (a, b) in enumerate(tree.ranges))


def test_subtrees_are_left_out(monkeypatch):
    """A search for one rare term reads few documents, and still finds the best."""
    tree, vectors, _ = grown(np.random.default_rng(1), 4000, 300)
    read = []
    plain = op13.Vectors.scores
    monkeypatch.setattr(op13.Vectors, "scores", lambda self, low, high, w: (
        read.append(high - low) if self is tree.docs else None, plain(self, low, high, w))[1])
    weights = np.zeros(300, np.int64)
    weights[[3, 290]] = [10, 9000]
    best = op13.Best(10)
    best.ids = list(range(4000))
    tree.search(weights, best)
    assert sum(read) < 3000
    expected = sorted((-int(s), False, int(k)) for s, k in zip(plain(tree.docs, 0, 4000, weights), tree.rows, strict=True))
    assert best.rows == expected[:10]


@pytest.mark.parametrize("settings", [{}, {"TREE_DOCS": 40, "LEAF": 2}, {"BLOCK_CHARS": 500, "LEAF": 8, "DEALT": 2}])
def test_results_equal_brute_force(spark, docs, texts, sf_dir, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(op13, name, value)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert found(op13.search(docs.repartition(3), benchmark)) == brute(texts, items)


def test_ties_repeats_and_frequent_terms(spark):
    """Equal scores rank by id, also among hundreds of copies; a term of every document weighs little or nothing."""
    rng = random.Random(2)
    docs = [(k, "the same words here") for k in range(300, 0, -1)] + [(5, "the same words here"), (None, "the same words here")]
    docs += [(1000 + k, "the " + " ".join(rng.choice(["alpha", "beta", "Gamma"]) for _ in range(k % 9))) for k in range(50)]
    items = [(1, "SAME"), (2, "the"), (3, "alpha gamma gamma"), (3, "beta"), (None, "words alpha"), (4, "nowhere")]
    assert found(op13.search(*frames(spark, docs, items))) == brute(docs, items)


def test_edges(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "long WORD more id"), (2, None), (3, ""), (4, "+-*/")], "item_id long, text string")
    items = items.selectExpr("*", "'x' AS rank", "1 AS score", "2 AS doc_id", "'y' AS number")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    expected = brute(docs, [(1, "long WORD more id")])
    assert found(op13.search(odd_docs.withColumnRenamed("size", "score"), items)) == expected
    assert {row[2] for row in expected} >= {6, 7, None}
    assert op13.search(no_docs, items).count() == 0 and op13.search(odd_docs, items.limit(0)).count() == 0
    assert op13.search(odd_docs, items.filter("item_id > 1")).count() == 0


def test_large_counts_do_not_overflow():
    model = op13.Model(10 ** 12, 10 ** 15, np.zeros(1, np.int64), np.zeros(1, np.int64))
    assert model.factors(np.array([5, 10 ** 7])).tolist() == [10 + 90 * n * 10 ** 12 // 10 ** 15 for n in (5, 10 ** 7)]
