"""Hashed n-gram models: multinomials over hashed single words and word pairs of target and raw text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.llm.common import Words, arrow_map, fresh, text_groups, written

#: Words are read as digits to BASE modulo PRIME, so that SQL can work out the same numbers.
BASE, PRIME, PAIR = 257, 2_147_483_647, 31
#: Size of both models. It bounds what the driver holds: two counts per bucket.
BUCKETS = 65_536
#: Labelled documents up to which the SQL fits the target model; the operators take all of them.
TARGET_DOCS = 20_000
#: Most ids of labelled documents that are copied to the readers of the texts; one long each.
COPIED_IDS = 1_000_000
#: Weight of the raw model in the target model, as a share of the target sample's n-grams: it is alike at every size.
MIX = 0.1


def grams(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket, and the text, of every word and of every pair of neighbouring words of one text."""
    numbers, pairs = words.small_numbers(BASE, PRIME), words.runs(2)
    return (np.concatenate([numbers, numbers[pairs] * PAIR + numbers[pairs + 1]]) % buckets,
            np.concatenate([words.text, words.text[pairs]]))


def target_sample(labels: DataFrame, good: Column, most: int | None = None, id_col: str = "doc_id") -> DataFrame:
    """The ids of all documents labelled good; with `most` only so many, chosen by the MD5 of the id."""
    ids = labels.filter(good & F.col(id_col).isNotNull()).select(id_col).distinct()
    return ids if most is None else ids.orderBy(F.md5(F.col(id_col).cast("string")), id_col).limit(most)


def marked(docs: DataFrame, sample: DataFrame, flag: str, id_col: str = "doc_id") -> DataFrame:
    """`docs` with a column `flag`: whether the id is one of the sample's.

    Up to COPIED_IDS ids go to the texts, which then stay where they are. More are joined in one shuffle of the texts, and the
    rows are written, as they are read more than once.
    """
    known = f"{flag}_id"
    ids = sample.select(F.col(id_col).alias(known)).distinct()
    many = ids.limit(COPIED_IDS + 1).count() > COPIED_IDS
    found = docs.join(ids if many else F.broadcast(ids), F.col(id_col) == F.col(known), "left")
    found = found.withColumn(flag, F.col(known).isNotNull()).drop(known)
    return written(found, "marked") if many else found


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for batch in batches:
        good = np.array([bool(flag) for flag in batch.column(1).to_pylist()])
        for first, texts in text_groups(batch.column(0).to_pylist()):
            found, text = grams(Words(*texts), buckets)
            raw += np.bincount(found, minlength=buckets)
            target += np.bincount(found[good[first + text]], minlength=buckets)
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])],
                                     names=["bucket", "raw", "target"])


def gram_counts(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                buckets: int = BUCKETS) -> DataFrame:
    """Rows (bucket, raw, target): counts over all documents, and over those whose id is in the sample."""
    flag = fresh(docs, "in_target")
    return marked_counts(marked(docs.select(id_col, text_col), sample, flag, id_col), flag, text_col, buckets)


def marked_counts(texts: DataFrame, flag: str, text_col: str, buckets: int = BUCKETS) -> DataFrame:
    """The same over the rows of `marked`."""
    parts = arrow_map(texts.select(text_col, flag), _count, "bucket long, raw long, target long", buckets)
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


@dataclass(frozen=True)
class GramModels:
    """Shares of the buckets in the raw text, and counts in the target sample."""

    share: np.ndarray
    target: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame, buckets: int = BUCKETS) -> GramModels:
        """Raw counts are smoothed by one. The driver receives one row per bucket, however large the corpus is."""
        raw, target = np.ones(buckets), np.zeros(buckets)
        for row in counts.collect():
            raw[row.bucket] += row.raw
            target[row.bucket] += row.target
        return cls(raw / raw.sum(), target)

    def ratios(self) -> np.ndarray:
        """log(target share / raw share) per bucket; all 0 where nothing is known of the target."""
        total = self.target.sum()
        if not total:
            return np.zeros(len(self.share))
        return np.log((self.target + MIX * self.share * total) / ((1 + MIX) * total)) - np.log(self.share)

    def sums(self, words: Words, ratios: np.ndarray, trusted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each text the sum of the ratios over its words and pairs, and their number.

        A trusted text is judged as if it were not in the target sample, so its score compares with those of others.
        """
        size = len(words.counts)
        found, text = grams(words, len(ratios))
        many = np.bincount(text, minlength=size)
        value = ratios[found]
        if trusted is not None and trusted.any():
            own = np.flatnonzero(trusted[text])
            _, place, times = np.unique(text[own] * len(ratios) + found[own], return_inverse=True, return_counts=True)
            left, total = self.target[found[own]] - times[place], self.target.sum() - many[text[own]]
            share = self.share[found[own]]
            with np.errstate(divide="ignore", invalid="ignore"):
                alone = np.log((left + MIX * share * total) / ((1 + MIX) * total)) - np.log(share)
            value[own] = np.where(total > 0, alone, 0.0)
        return np.bincount(text, value, size), many
