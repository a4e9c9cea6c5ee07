"""Helpers the operators share: tables in the shared folder, words and their hashes, Arrow batches."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.session import shared_dir

#: Characters between words, everywhere in this package.
SPACE = " \t\n\x0b\x0c\r"
#: Whether each code point below 0xC0 ends a plain word; the last entry stands for all from 0xC0 on.
PUNCTUATION = np.array([not chr(c).isalnum() for c in range(0xC0)] + [False])
#: Bits of the sort key that one pass of the search for the k-th largest settles.
DIGIT = 16
_SCRATCH: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """This session's folder for intermediate tables, inside the folder all executors share.

    It goes away when the driver ends; `clear_scratch` removes it sooner.
    """
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        atexit.register(clear_scratch, spark)
    return _SCRATCH[app]


def clear_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this session; frames built on them can't be read afterwards."""
    try:
        folder = _SCRATCH.pop(spark.sparkContext.applicationId, None)
        if folder:
            jvm = spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception as gone:  # at exit the JVM may have ended before
        del gone


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: its lineage is cut and a lost executor costs nothing."""
    spark = frame.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def unit(*columns: Column) -> Column:
    """A repeatable number strictly between 0 and 1 for each value of the columns (nulls included)."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 53))


def ordered(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles; it is its own inverse on their bits."""
    bits = values.view(np.int64)
    return bits ^ ((bits >> np.int64(63)) & np.int64(2 ** 63 - 1))


def kth_largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a long column; None if there are at most k rows."""
    return None if rows.count() <= k else at_place(rows, column, k)


def at_place(rows: DataFrame, column: str, k: int) -> int:
    """The k-th largest value of a long column with at least k rows.

    Each pass counts the rows by the next DIGIT bits, so the driver gets at most 2**DIGIT counts and nothing is sorted.
    """
    value, shift = F.col(column), 64
    found, left = 0, k
    while shift > 0:
        shift -= DIGIT
        digit = F.shiftright(value, shift) if shift == 64 - DIGIT else F.shiftright(value, shift).bitwiseAND(
            F.lit(2 ** DIGIT - 1))
        inside = rows if shift == 64 - DIGIT else rows.filter(F.shiftright(value, shift + DIGIT) == found)
        counts = sorted((row for row in inside.groupBy(digit.alias("digit")).count().collect()),
                        key=lambda row: -row["digit"])
        for row in counts:
            if row["count"] >= left:
                found = (found << DIGIT) + row["digit"]
                break
            left -= row["count"]
    return found


def powers(base: int, count: int, prime: int | None = None) -> np.ndarray:
    """base**0 .. base**(count-1), modulo 2**64 or a prime below 2**31."""
    if prime is None:
        steps = np.full(count, base, np.uint64)
        steps[:1] = 1
        return np.multiply.accumulate(steps)
    known = np.ones(1, np.uint64)
    while len(known) < count:
        ahead = np.uint64(pow(base, len(known), prime))
        known = np.concatenate([known, known * ahead % np.uint64(prime)])
    return known[:count]


class Words:
    """The words of some whole texts as arrays: where each starts and ends, whose it is, and a number for it.

    Words are runs of characters outside SPACE; null and empty texts have none. The texts are laid out one after
    the other, so that short ones share the array operations. Plain words are in lower case and also end at
    punctuation.
    """

    def __init__(self, *texts: str | None, plain: bool = False):
        texts = [(t or "").lower() if plain else t or "" for t in texts]
        self.codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        if plain:
            gap = PUNCTUATION[np.minimum(self.codes, 0xC0)] | ((self.codes >= 0x2000) & (self.codes <= 0x206F))
        else:
            gap = (self.codes == 32) | ((self.codes >= 9) & (self.codes <= 13))
        flips = np.flatnonzero(np.diff(gap, prepend=True, append=True))
        self.starts, self.ends = flips[::2], flips[1::2]
        self.inside = ~gap
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.counts = np.diff(np.searchsorted(self.starts, ends), prepend=0)
        self.text = np.repeat(np.arange(len(texts)), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def runs(self, size: int) -> np.ndarray:
        """Positions at which `size` words of one text begin."""
        at = np.arange(max(0, len(self) - size + 1))
        return at[self.text[at] == self.text[at + size - 1]]

    def _laid_out(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words' characters in a row, each one's distance from its word's end, and where words begin."""
        lengths = self.ends - self.starts
        till = np.cumsum(lengths)
        return self.codes[self.inside], np.repeat(till, lengths) - np.arange(1, till[-1] + 1), till - lengths

    def numbers(self) -> np.ndarray:
        """64 bits for each word; other words almost never share them."""
        if not len(self):
            return np.zeros(0, np.uint64)
        chars, back, begin = self._laid_out()
        weight = powers(0x9E3779B97F4A7C15, int(back.max()) + 1)
        return mixed(np.add.reduceat((chars + np.uint64(1)) * weight[back], begin))

    def small_numbers(self, base: int, prime: int) -> np.ndarray:
        """Each word's code points as digits to `base`, modulo a prime: a number SQL can work out too."""
        if not len(self):
            return np.zeros(0, np.int64)
        chars, back, begin = self._laid_out()
        weight = powers(base, int(back.max()) + 1, prime)
        return (np.add.reduceat(chars * weight[back] % np.uint64(prime), begin) % np.uint64(prime)).astype(np.int64)


def mixed(numbers: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    with np.errstate(over="ignore"):
        x = numbers ^ (numbers >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(numbers: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit number per run of `size` words; a shorter text is one run of all its words."""
    if not len(numbers):
        return numbers
    size = min(size, len(numbers))
    count = len(numbers) - size + 1
    runs = np.full(count, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            runs = runs * np.uint64(0x9E3779B97F4A7C15) + numbers[k:k + count]
    return mixed(runs)


def rows_in(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that a batch of long texts stays small in Python."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_groups(texts: list[str | None], chars: int = 100_000) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of neighbouring texts of about `chars` characters, each with the place of its first; no text is cut."""
    first, size = 0, 0
    for at, text in enumerate(texts):
        if at > first and size + len(text or "") > chars:
            yield first, texts[first:at]
            first, size = at, 0
        size += len(text or "")
    if len(texts) > first:
        yield first, texts[first:]


def arrow_map(frame: DataFrame, function, schema: str, *given) -> DataFrame:
    """mapInArrow over small batches; `function(batches, *given)` yields record batches."""
    return frame.mapInArrow(partial(_run, function, given), schema)


def _run(function, given: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from function(rows_in(batches), *given)
