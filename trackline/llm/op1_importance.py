"""Importance resampling: hashed n-gram models of target and raw text, their ratio as weight, Gumbel top-k as sample."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm.common import Words, arrow_map, kth_largest, ordered, table, text_groups, unit, written
from trackline.llm.ngram_models import BUCKETS, GramModels, gram_counts, target_sample

#: Texts are weighed as if each held so many n-grams, so that length alone neither wins nor loses.
LENGTH = 200
SEED = 42
#: Log weight of a text without words: it is taken only when all others are.
NEVER = -1e6


def _weigh(batches: Iterator[pa.RecordBatch], models: GramModels, length: int) -> Iterator[pa.RecordBatch]:
    ratios = models.ratios()
    for batch in batches:
        parts = []
        for _, texts in text_groups(batch.column(1).to_pylist()):
            total, grams = models.sums(Words(*texts), ratios)
            parts.append(np.where(grams > 0, total / np.maximum(grams, 1) * length, NEVER))
        weight = np.concatenate(parts)
        score = weight - np.log(-np.log(batch.column(2).to_numpy()))  # plus standard Gumbel noise
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weight), pa.array(score), pa.array(ordered(score))],
                                         names=["doc_id", "log_weight", "score", "place"])


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, *, seed: int = SEED, length: int = LENGTH,
             buckets: int = BUCKETS, target_docs: int | None = None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, log_weight, score, kept) for every row of `docs`: `kept` marks k rows, sampled without replacement with
    chances in proportion to the importance weights.

    The weight is the ratio of a document's likelihoods under the target model (all documents labelled quality 1 and not
    toxic; `target_docs` of them if that is given) and the raw model (all documents). The k largest sums of log weight and seeded
    Gumbel noise are the sample. Without `k`, it is the labels' share of quality 1, carried over to all rows.

    Null and empty texts weigh next to nothing. The noise depends on id and text, so reruns agree, and rows equal in
    both share their score; if such rows tie for the last place all of them are kept. A null id is an id of its own.
    Without labels all weights are equal and all rows are kept. An empty table gives no rows. Other columns play no part.
    """
    good = F.col("quality") == 1
    sample = target_sample(labels, good & F.coalesce(F.col("toxic") == 0, F.lit(True)), target_docs)
    models = GramModels.of(gram_counts(docs, sample.withColumnRenamed("doc_id", id_col), id_col, text_col, buckets),
                           buckets)
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                        unit(F.lit(seed), F.col(id_col), F.col(text_col)).alias("u"))
    schema = f"doc_id {kind}, log_weight double, score double, place long"
    weighed = written(arrow_map(texts, _weigh, schema, models, length), "importance")
    if k is None:
        share = labels.agg(F.avg(good.cast("double"))).first()[0]
        k = round(weighed.count() * (1.0 if share is None else share))
    last = kth_largest(weighed, "place", k) if k else 2 ** 63 - 1
    kept = F.lit(True) if last is None else F.col("place") >= last
    return weighed.select("doc_id", "log_weight", "score", kept.alias("kept"))


def op1_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
