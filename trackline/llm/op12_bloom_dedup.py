"""Exact dedup by two passes over a Bloom filter: only rows whose hash may occur twice are shuffled.

The first pass counts, for every position of a Bloom filter, whether it was hit once or more often. A hash whose positions
were all hit more often may be repeated; one that misses a single position certainly is not. The second pass tests every
row: those that are not repeated pass straight through, the others meet by the SHA-256 of their text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm.common import SPACE, arrow_map, fresh, mixed, scratch_dir, table, written

#: Positions of the filter per row, and how many of them a hash hits: about one row in 200 is tested again for nothing.
POSITIONS, HITS = 16, 3
#: Positions of the largest filter (128 MB as bits). More rows are taken in several rounds, each a slice of the hashes.
MOST_POSITIONS = 2 ** 30
#: Positions that travel together; a place in such a segment takes two bytes.
SEGMENT = 65_536
#: Hashes a task holds before it hands its part of the filter on.
FLUSH = 1_000_000
#: A group of more than one in HOT of the shuffled rows is hot; there are fewer than HOT of them.
HOT = 1_000


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def filter_size(rows: int) -> tuple[int, int]:
    """Positions of the filter, a power of two, and the number of rounds."""
    wanted = max(SEGMENT, 1 << max(0, rows * POSITIONS - 1).bit_length())
    most = max(SEGMENT, MOST_POSITIONS)
    return min(wanted, most), -(-wanted // most)


def positions(hashes: np.ndarray, size: int) -> np.ndarray:
    """The HITS positions of each hash, one row for each hit."""
    seeds = np.arange(1, HITS + 1, dtype=np.uint64)[:, None] * np.uint64(0xD6E8FEB86659FD93)
    return mixed(hashes.astype(np.int64).view(np.uint64)[None, :] ^ seeds) & np.uint64(size - 1)


def _packed(places: np.ndarray, segments: np.ndarray) -> pa.Array:
    """For each segment the places in it, two bytes each, from sorted positions."""
    cuts = np.searchsorted(places >> np.uint64(16), np.append(segments, segments[-1] + np.uint64(1)))
    data = (places & np.uint64(SEGMENT - 1)).astype("<u2")
    return pa.Array.from_buffers(pa.binary(), len(segments),
                                 [None, pa.py_buffer((cuts * 2).astype(np.int32)), pa.py_buffer(data)])


def _part(hashes: np.ndarray, size: int) -> pa.RecordBatch:
    places, hits = np.unique(positions(hashes, size), return_counts=True)
    segments = np.unique(places >> np.uint64(16))
    return pa.RecordBatch.from_arrays(
        [pa.array(segments.astype(np.int32)), _packed(places[hits == 1], segments), _packed(places[hits > 1], segments)],
        names=["segment", "once", "more"])


def _parts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch.column(0).to_numpy(zero_copy_only=False))
        rows += batch.num_rows
        if rows >= FLUSH:
            yield _part(np.concatenate(held), size)
            held, rows = [], 0
    if rows:
        yield _part(np.concatenate(held), size)


def _merged(parts: pd.DataFrame) -> pd.DataFrame:
    """One segment: the places that were hit more than once, in one task or in two, as bits."""
    once = np.bincount(np.frombuffer(b"".join(parts["once"]), "<u2"), minlength=SEGMENT)
    once[np.frombuffer(b"".join(parts["more"]), "<u2")] = 2
    return pd.DataFrame({"segment": parts["segment"].iloc[:1], "bits": [np.packbits(once > 1, bitorder="little").tobytes()]})


def repeat_filter(hashes: DataFrame, size: int) -> np.ndarray:
    """The bits of the positions that were hit more than once by the only column of `hashes`, a long.

    What a task knows travels as two bytes per position, so the exchange moves about six bytes per row. The driver
    receives the bits, at most MOST_POSITIONS of them.
    """
    parts = arrow_map(hashes, _parts, "segment int, once binary, more binary", size)
    bits = np.zeros(size // 8, np.uint8)
    for row in parts.groupBy("segment").applyInPandas(_merged, "segment int, bits binary").collect():
        at = row.segment * SEGMENT // 8
        bits[at:at + SEGMENT // 8] = np.frombuffer(row.bits, np.uint8)
    return bits


def may_repeat(spark: SparkSession, bits: np.ndarray):
    """A column function: whether a hash may occur more than once. The bits are copied to every executor."""
    size, known = len(bits) * 8, spark.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def test(hashes: pd.Series) -> pd.Series:
        at = positions(hashes.to_numpy(), size)
        return pd.Series(((known.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0))

    return test


def _slices(rows: DataFrame, hash_col: str, rounds: int) -> list[DataFrame]:
    """The rows by slices of the hash; more than one are written once, without a shuffle, to be read one by one."""
    if rounds == 1:
        return [rows]
    spark, part = rows.sparkSession, fresh(rows, "slice")
    path = f"{scratch_dir(spark)}/slices-{uuid.uuid4().hex}"
    cut = rows.withColumn(part, F.pmod(F.xxhash64(hash_col, F.lit(1)), F.lit(rounds)).cast("int"))
    cut.write.partitionBy(part).parquet(path)
    read = spark.read.schema(cut.schema).parquet(path)
    return [read.filter(F.col(part) == k).drop(part) for k in range(rounds)]


class _Names:
    """Columns beside those of the input, under names it does not use."""

    def __init__(self, frame: DataFrame):
        for name in ("sha", "size", "rank", "hash", "twice", "row", "best", "count", "key"):
            setattr(self, name, fresh(frame, f"_d_{name}"))


def _measured(docs: DataFrame, names: _Names, id_col: str, text_col: str) -> DataFrame:
    """Adds the SHA-256 of the normalised text, the size of the original, and what orders rows of one size."""
    known = docs.withColumn(names.sha, F.sha2(normalised(F.col(text_col)), 256))
    return known.withColumns({
        names.hash: F.xxhash64(names.sha),
        names.size: F.coalesce(F.length(text_col), F.lit(0)).cast("long"),
        # larger is better: the smallest id (unknown ones last), then a fixed choice between texts and other columns
        names.rank: F.struct(F.bitwise_not(F.col(id_col).cast("long")).alias("id"),
                             F.xxhash64(text_col).alias("text"), F.xxhash64(*docs.columns).alias("all")),
    })


def _decided(rows: DataFrame, names: _Names, n_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows that certainly stand alone, and those that may not, with the best row (`best`) and the size of their group.

    The second kind is written once, so that a row keeps its number. Counts are combined before the shuffle. A hot
    group meets its rows by a broadcast of fewer than HOT groups; no other group holds more than one in HOT of the rows.
    """
    spark, (size, rounds) = rows.sparkSession, filter_size(n_rows)
    alone, maybe = [], []
    for piece in _slices(rows, names.hash, rounds):
        test = may_repeat(spark, repeat_filter(piece.select(names.hash), size))
        tested = piece.withColumn(names.twice, test(F.col(names.hash)))
        alone.append(tested.filter(~F.col(names.twice)).drop(names.twice))
        maybe.append(tested.filter(names.twice).drop(names.twice))
    met = written(reduce(DataFrame.unionByName, maybe).withColumn(names.row, F.monotonically_increasing_id()), "maybe")
    place = F.struct(names.size, names.rank, F.bitwise_not(names.row).alias("row"))
    groups = written(met.groupBy(names.sha).agg(F.max(place).alias(names.best), F.count(F.lit(1)).alias(names.count)),
                     "groups").withColumnRenamed(names.sha, names.key)
    most = met.count() / HOT
    hot = F.broadcast(groups.filter(F.col(names.count) > most))
    others = groups.filter(F.col(names.count) <= most)
    same = F.col(names.sha) == F.col(names.key)
    joined = met.join(hot, same).unionByName(met.join(hot, same, "left_anti").join(others, same))
    return reduce(DataFrame.unionByName, alone), joined


def exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: its id, keep_id, group_size, kept, and text_sha256 of the normalised text.

    Texts are equal when they are identical without white space; null counts as empty. Of equal texts the row with most
    characters stays, then the smallest id (a null id comes last), then a fixed choice by the text and the other
    columns, and of rows that agree in everything any one; so every group keeps one row, also where ids repeat.
    The filter grows with the rows up to MOST_POSITIONS; beyond that the hashes are cut into slices, one after the
    other, so memory stays bounded and no row is left out. An empty table gives no rows. Texts of any length are read
    once and hashed whole; nothing of them is shuffled. Other columns, whatever their names, only settle ties.
    """
    names = _Names(docs)
    thin = [F.col(id_col), *(F.col(n) for n in (names.sha, names.hash, names.size, names.rank))]
    rows = written(_measured(docs, names, id_col, text_col).select(*thin), "hashes")
    alone, met = _decided(rows, names, rows.count())
    own = F.bitwise_not(F.col(f"{names.best}.{names.rank}.id")).cast(docs.schema[id_col].dataType)
    return alone.select(id_col, F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                        F.lit(True).alias("kept"), F.col(names.sha).alias("text_sha256")).unionByName(
        met.select(id_col, own.alias("keep_id"), F.col(names.count).alias("group_size"),
                   (F.bitwise_not(F.col(names.row)) == F.col(f"{names.best}.row")).alias("kept"),
                   F.col(names.sha).alias("text_sha256")))


def kept_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, all columns; see `exact_duplicates`. Only rows that may be repeated are shuffled."""
    names = _Names(docs)
    alone, met = _decided(_measured(docs, names, id_col, text_col), names, docs.count())
    stay = met.filter(F.bitwise_not(F.col(names.row)) == F.col(f"{names.best}.row"))
    return alone.select(*docs.columns).unionByName(stay.select(*docs.columns))


def op12_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


SQL = r"""
WITH hashed AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), placed AS (
  SELECT doc_id, text_sha256, first_value(doc_id) OVER same AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM hashed WINDOW same AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM placed
"""
