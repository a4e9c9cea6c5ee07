"""Importance resampling (1) and quality rules (10)."""

from __future__ import annotations

import math

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from trackline.llm import ngram_models as models
from trackline.llm import op1_importance as op1
from trackline.llm import op10_quality_rules as op10
from trackline.llm.common import Words, shingles


def rows_of(frame, *columns):
    return sorted((tuple(row) for row in frame.select(*columns).collect()), key=str)


def test_words_follow_the_contract():
    text = "été  \x0b naïve word\x0c end"
    found = Words(text)
    assert [text[a:b] for a, b in zip(found.starts, found.ends, strict=True)] == brute.words(text)
    assert found.small_numbers(257, 2147483647).tolist() == [brute.bucket(w) for w in brute.words(text)]
    both = Words("a b", None, "", "b a")
    assert both.counts.tolist() == [2, 0, 0, 2] and both.text.tolist() == [0, 0, 3, 3]
    assert both.numbers()[0] == both.numbers()[3] and len(set(both.numbers().tolist())) == 2
    assert len(shingles(Words("one two").numbers(), 5)) == 1 and not len(shingles(Words("").numbers(), 5))


def test_quality_equals_brute_force(docs, labels, texts):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    expected = brute.quality(texts, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert rows_of(op10.score_quality(docs, labels), *columns) == sorted(expected, key=str)
    assert any(not failed and not kept for *_, failed, kept in expected)  # the method rejects some


@pytest.mark.parametrize("size, given", [("0.001", None), ("0.01", None), ("0.1", 300), ("0.1", None)])
def test_quality_tells_good_from_bad_at_every_size(spark, size, given):
    """Documents past the base rules: bad ones go, good ones stay, however many labels there are."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf{size}/{name}.parquet") for name in ("documents", "labels"))
    known = labels if given is None else labels.orderBy(F.md5(F.col("doc_id").cast("string"))).limit(given)
    scored = op10.score_quality(docs, known).filter("NOT base_failed").join(labels.filter("toxic = 0"), "doc_id")
    share = dict(map(tuple, scored.groupBy("quality").agg(F.avg(F.col("kept").cast("double"))).collect()))
    assert share[1] >= 0.99 and share[0] <= 0.2, share


def test_trusted_documents_are_judged_without_themselves(spark, docs, texts, labels):
    known = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    models = brute.Models(texts, known)
    rows = op10.score_quality(docs, labels).collect()
    plain = dict(texts)
    assert all(math.isclose(r.log_ratio, models.score(plain[r.doc_id], r.doc_id in models.good), abs_tol=1e-9) for r in rows)
    alone = spark.createDataFrame([(min(models.good), 1, 0)], "doc_id long, quality int, toxic int")
    own = op10.score_quality(docs, alone).filter(F.col("doc_id") == min(models.good)).first()
    assert own.log_ratio == 0.0 and own.kept != own.base_failed


def test_quality_edges(odd_docs, no_docs, labels, spark):
    found = {row.doc_id: row for row in op10.score_quality(odd_docs, labels).collect()}
    assert len(found) == 13 and op10.score_quality(odd_docs, labels).count() == 14
    for i in (1, 2, 3):
        assert (found[i].n_words, found[i].base_failed, found[i].kept, found[i].log_ratio) == (0, True, False, 0.0)
    assert found[6].n_words == 140_000 and found[6].base_failed
    assert found[None].n_words == 11 and not found[None].base_failed
    assert op10.score_quality(no_docs, labels).count() == 0
    kept = op10.kept_documents(odd_docs, labels.limit(0), threshold=-100.0)
    assert kept.columns == odd_docs.columns and kept.filter("kept <> 'given'").count() == 0
    assert kept.filter("doc_id = 7").count() == 2


def test_resampling_equals_brute_force(docs, labels, texts):
    models = brute.Models(texts, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    rows = op1.resample(docs, labels, k=50).collect()
    weight = {i: models.score(t) * op1.LENGTH if brute.words(t) else op1.NEVER for i, t in texts}
    assert all(math.isclose(row.log_weight, weight[row.doc_id], abs_tol=1e-6) for row in rows)
    kept = {row.doc_id for row in rows if row.kept}
    assert kept == {row.doc_id for row in sorted(rows, key=lambda r: -r.score)[:50]}
    again = op1.resample(docs.repartition(7), labels, k=50)
    assert {row.doc_id for row in again.filter("kept").collect()} == kept


def test_noise_is_gumbel(spark, labels):
    frame = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same words for all").alias("text"))
    noise = np.array([row.score - row.log_weight for row in op1.resample(frame, labels, k=1).collect()])
    assert abs(noise.mean() - 0.5772) < 0.07 and abs(noise.std() - 1.2825) < 0.07


@pytest.mark.parametrize("k", [1, 5, 37, 99, 100, 101])
def test_kth_largest(spark, k):
    values = [(-1) ** i * i ** 13 % (2 ** 63) - 2 ** 62 for i in range(100)]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    expected = None if k >= 100 else sorted(values, reverse=True)[k - 1]
    assert op1.kth_largest(frame, "v", k) == expected


def test_resampling_edges(odd_docs, no_docs, labels):
    found = op1.resample(odd_docs, labels, k=10).collect()
    assert len(found) == 14 and {row.log_weight for row in found if row.doc_id in (1, 2, 3)} == {op1.NEVER}
    assert not any(row.kept for row in found if row.doc_id in (1, 2, 3)) and sum(row.kept for row in found) == 10
    assert op1.resample(no_docs, labels).count() == 0
    assert op1.resample(odd_docs, labels.limit(0)).filter("NOT kept").count() == 0


def test_models_count_every_labelled_document(spark):
    """More trusted documents than the sample once held: all of their words are counted."""
    many = 25_000
    docs = spark.range(many + 100).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("w"), "id").alias("text"))
    labels = spark.range(many).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    counts = models.gram_counts(docs, models.target_sample(labels, F.col("quality") == 1))
    assert counts.agg(F.sum("raw"), F.sum("target")).first()[:] == (3 * (many + 100), 3 * many)


def test_quality_is_the_same_when_ids_are_joined_by_a_shuffle(docs, labels, monkeypatch):
    columns = ["doc_id", "n_words", "log_ratio", "kept"]
    copied = rows_of(op10.score_quality(docs, labels), *columns)
    monkeypatch.setattr(models, "COPIED_IDS", 3)
    assert rows_of(op10.score_quality(docs, labels), *columns) == copied


@pytest.mark.parametrize("many", [1, 2, 99, 100, 101, 700])
def test_the_threshold_is_found_by_counts(spark, many):
    scores = [math.sin(i * i) * 10.0 ** (i % 7 - 3) for i in range(many)]
    frame = spark.createDataFrame([(s, False) for s in scores] + [(99.0, True)], "log_ratio double, base_failed boolean")
    low, middle = (sorted(scores)[-(-many * share // 100) - 1] for share in (1, 50))
    assert op10.fitted_threshold(frame) == middle - op10.MARGIN * (middle - low)
