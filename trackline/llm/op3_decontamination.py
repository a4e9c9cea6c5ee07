"""Benchmark decontamination: rare n-gram seeds join passages to test items, Smith-Waterman alignment scores them.

Words are compared in lower case, without punctuation. The n-grams are pairs of neighbouring words of an item; a text
holds one where the two words stand side by side or with one word between. A passage whose score reaches `least` holds
at least `needed` of them within `reach` words, wherever its edits are: between two matched words stands nothing or one
word (a pair), two words or more (cost 2), or an item's word was changed or left out (cost 1, and never matched).

A pass over all documents counts how many hold each pair. Pairs in more than RARE of the documents are no seeds, the
commonest first, up to half of those an item needs; the item then needs so many fewer of the rest. So what is joined is
rare, and still no copy is lost: an item without enough rare pairs keeps the rarest of its common ones, and pairs no
document holds never take the place of others. The join is by equality of seeds, in the task that reads the text, as
the items of a block are of bounded size. Where few seeds lie close together nothing is aligned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm.common import Words, arrow_map, mixed, shingles, table, text_groups, written

#: Scores of the alignment, per word (`needed` and `reach` rest on them); a passage counts from this share of the item's best possible score on.
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
#: So many words of an item in a row are a leak, however long the item is.
RUN = 20
#: Items of fewer words than this count only where they stand whole, in a row.
SHORT = 4
#: Pairs that more than this share of the documents hold, or that stand at more places of items than COMMON, are no
#: seeds, up to half of those an item needs.
RARE = 0.001
COMMON = 64
#: Characters of test items that a task holds at a time; larger benchmarks take several passes.
BLOCK_CHARS = 8 << 20
_FILTER = np.uint64((1 << 20) - 1)


def needed(sizes: np.ndarray, least: float) -> np.ndarray:
    """The fewest pairs that a passage of score `least` shares with an item of that many words.

    Of m matched words, m - 1 - b - c pairs are left by b gaps with an item's word in them and c with two words or more
    put in. The score allows b + 2 c <= 2 m - 2 least size, and b <= size - m; the least over all m is this.
    """
    return np.ceil(sizes * (4 * least - 1) / 3 - 1 - 1e-9).astype(np.int64)


def pairs(numbers: np.ndarray, apart: int) -> np.ndarray:
    """A number for each two words that stand `apart` words from each other."""
    return mixed(numbers[:-apart] * np.uint64(0x9E3779B97F4A7C15) + numbers[apart:])


@dataclass(frozen=True)
class Seeds:
    """Numbers of n-grams: seed k occurs in the items owner[first[k]:first[k + 1]], once for each of its places."""

    numbers: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    maybe: np.ndarray

    @classmethod
    def of(cls, numbers: list[np.ndarray], owners: np.ndarray) -> Seeds:
        """From the n-grams of some items, and these items."""
        owner = np.repeat(owners, [len(own) for own in numbers])
        return cls.at(np.concatenate([np.zeros(0, np.uint64), *numbers]), owner)

    @classmethod
    def at(cls, numbers: np.ndarray, owner: np.ndarray) -> Seeds:
        order = np.lexsort((owner, numbers))
        seeds, first = np.unique(numbers[order], return_index=True)
        maybe = np.zeros(int(_FILTER) + 1, bool)
        maybe[(seeds & _FILTER).astype(np.int64)] = True
        return cls(seeds, np.append(first, len(numbers)), owner[order].astype(np.int64), maybe)

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in `grams` that are seeds, and which."""
        at = np.flatnonzero(self.maybe[(grams & _FILTER).astype(np.int64)])
        if not len(at) or not len(self.numbers):
            return at[:0], at[:0]
        seed = np.minimum(np.searchsorted(self.numbers, grams[at]), len(self.numbers) - 1)
        real = self.numbers[seed] == grams[at]
        return at[real], seed[real]

    def joined(self, spots: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, spot) for every place of items that holds a seed found at a spot."""
        span = np.diff(self.first)[found]
        entry = np.repeat(self.first[found], span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
        return self.owner[entry], np.repeat(spots, span)


@dataclass(frozen=True)
class Items:
    """Test items as word numbers, and their seeds. A passage of item i holds at least need[i] of `pairs` within
    reach[i] words; where that is below one, every document is looked at. `runs` are the runs of RUN words of items of
    which these are too small a share, `whole` the items of fewer than SHORT words by their size."""

    ids: list
    words: list[np.ndarray]
    need: np.ndarray
    reach: np.ndarray
    pairs: Seeds
    runs: Seeds
    whole: dict[int, Seeds]

    @classmethod
    def of(cls, ids: list, texts: list[str | None], least: float) -> Items:
        words = [Words(text, plain=True).numbers() for text in texts]
        sizes = np.array([len(own) for own in words], np.int64)
        need, reach = needed(sizes, least), np.ceil(sizes * (3 - 2 * least)).astype(np.int64)

        def seeds(which: np.ndarray, grams) -> Seeds:
            owners = np.flatnonzero(which)
            return Seeds.of([grams(words[k]) for k in owners], owners)

        whole = {n: seeds(sizes == n, lambda own: shingles(own, len(own))) for n in range(1, SHORT) if (sizes == n).any()}
        return cls(ids, words, need, reach, seeds((sizes >= SHORT) & (need > 0), lambda own: pairs(own, 1)),
                   seeds((sizes >= SHORT) & (sizes * least > RUN), lambda own: shingles(own, RUN)), whole)

    def rarest(self, held: np.ndarray, docs: int) -> Items:
        """The same items with rare seeds, as `held` of `docs` documents hold each pair."""
        times = np.diff(self.pairs.first)
        which, owner = np.repeat(np.arange(len(times)), times), self.pairs.owner
        order = np.lexsort((which, -(held * times)[which], owner))
        which, owner = which[order], owner[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        common = (held[which] > RARE * docs) | (times[which] > COMMON)
        out = common & (rank < self.need[owner] // 2)
        return replace(self, need=self.need - np.bincount(owner[out], minlength=len(self.need)),
                       pairs=Seeds.at(self.pairs.numbers[which[~out]], owner[~out]))


def pair_hits(words: Words, numbers: np.ndarray, seeds: Seeds) -> tuple[np.ndarray, np.ndarray]:
    """Where pairs that are seeds begin, and which they are."""
    spots, found = [], []
    for apart in (1, 2):
        at = words.runs(apart + 1)
        hits, which = seeds.hits(pairs(numbers, apart)[at])
        spots.append(at[hits])
        found.append(which)
    return np.concatenate(spots), np.concatenate(found)


def run_hits(words: Words, numbers: np.ndarray, size: int, seeds: Seeds) -> tuple[np.ndarray, np.ndarray]:
    """(item, place) where runs of `size` words that are seeds begin."""
    at = words.runs(size)
    if not len(at) or not len(seeds.numbers):
        return at[:0], at[:0]
    hits, which = seeds.hits(shingles(numbers, size)[at])
    return seeds.joined(at[hits], which)


def alignment(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word arrays, and the passage's last aligned word."""
    row, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    slope = -GAP * np.arange(len(passage) + 1)
    for word in item:
        cell = np.maximum(row[:-1] + np.where(passage == word, MATCH, MISMATCH), row[1:] + GAP)
        row = np.concatenate([[0], np.maximum(cell, 0)])
        row = np.maximum.accumulate(row + slope) - slope  # gaps in the item, of any length
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at - 1
    return best, end


def stretches(words: Words, numbers: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int, bool]]:
    """(text, item, first word, word behind the last, whether a run of RUN words is in it) of all stretches that may
    hold a passage, by text and item."""
    item, at = items.pairs.joined(*pair_hits(words, numbers, items.pairs))
    text = words.text[at]
    order = np.lexsort((at, item, text))
    item, at, text = item[order], at[order], text[order]
    last = np.arange(len(at)) + items.need[item] - 1
    inside = np.flatnonzero(last < len(at))
    last = last[inside]
    near = ((item[last] == item[inside]) & (text[last] == text[inside])
            & (at[last] - at[inside] <= items.reach[item[inside]]))
    inside, last = inside[near], last[near]
    run_item, run_at = run_hits(words, numbers, RUN, items.runs)
    low = np.concatenate([at[last], run_at])
    high = np.concatenate([at[inside] + 1, run_at + RUN])
    item = np.concatenate([item[inside], run_item])
    text = np.concatenate([text[inside], words.text[run_at]])
    sure = np.arange(len(item)) >= len(inside)
    bounds = np.concatenate([[0], np.cumsum(words.counts)])
    low, high = np.maximum(low - items.reach[item], bounds[text]), np.minimum(high + items.reach[item], bounds[text + 1])
    order = np.lexsort((low, item, text))
    low, high, item, text, sure = (x[order] for x in (low, high, item, text, sure))
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1])
    # the furthest end so far, within each text and item
    ahead = (np.cumsum(new) - 1) * (len(words) + 1)
    end = np.maximum.accumulate(high + ahead)
    new[1:] |= (low + ahead)[1:] > end[:-1]
    begin = np.flatnonzero(new)
    if len(begin):
        end = (end - ahead)[np.append(begin[1:], len(item)) - 1]
        sure = np.logical_or.reduceat(sure, begin)
        yield from zip(*(x.tolist() for x in (text[begin], item[begin], low[begin], end, sure)), strict=True)


def found_in(texts: list[str | None], items: Items, least: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item, score, first word, last word) over some whole texts."""
    words = Words(*texts, plain=True)
    numbers = words.numbers()
    bounds = np.concatenate([[0], np.cumsum(words.counts)])
    for size, seeds in items.whole.items():
        item, at = run_hits(words, numbers, size, seeds)
        text = words.text[at]
        order = np.lexsort((at, item, text))
        for (k, i), own in groupby(order.tolist(), key=lambda x: (int(text[x]), int(item[x]))):
            low = int(at[next(own)] - bounds[k])
            yield k, i, 1.0, low, low + size - 1
    # items without a pair that a passage must hold are looked for in whole texts
    everywhere = [k for k, own in enumerate(items.words) if len(own) >= SHORT and items.need[k] < 1]
    places = chain(stretches(words, numbers, items), (
        (k, item, int(bounds[k]), int(bounds[k + 1]), False)
        for k in range(len(texts)) if words.counts[k] for item in everywhere))
    for (k, item), own in groupby(places, key=lambda place: place[:2]):
        target = items.words[item]
        best, certain = (0, 0, 0), False
        for _, _, low, high, sure in own:
            passage = numbers[low:high]
            certain |= sure
            if not sure and int(np.isin(target, passage).sum()) < least * len(target):
                continue  # even if all its words found here were aligned the score would be too low
            score, end = alignment(target, passage)
            if score > best[0]:
                _, back = alignment(target[::-1], passage[:end + 1][::-1])
                best = (score, low + end - back, low + end)
        score = best[0] / (MATCH * len(target))
        if best[0] and (certain or score >= least):
            yield k, item, score, best[1] - int(bounds[k]), best[2] - int(bounds[k])


def _held(batches: Iterator[pa.RecordBatch], seeds: Seeds) -> Iterator[pa.RecordBatch]:
    """(seed, documents that hold it) over a task; the last seed counts all documents."""
    held = np.zeros(len(seeds.numbers) + 1, np.int64)
    for batch in batches:
        held[-1] += batch.num_rows
        for _, texts in text_groups(batch.column(0).to_pylist()):
            words = Words(*texts, plain=True)
            spots, found = pair_hits(words, words.numbers(), seeds)
            once = np.unique(words.text[spots] * len(held) + found)
            held += np.bincount(once % len(held), minlength=len(held))
    at = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at], pa.int64())], names=["seed", "held"])


def _leaks(batches: Iterator[pa.RecordBatch], items: Items, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        ids = batch.column(0).to_pylist()
        for first, texts in text_groups(batch.column(1).to_pylist()):
            rows += [(ids[first + k], items.ids[item], score, low, high)
                     for k, item, score, low, high in found_in(texts, items, least)]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)],
                                         names=["doc_id", "item_id", "score", "first_word", "last_word"])


def _clean(batches: Iterator[pa.RecordBatch], items: Items, least: float, text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.ones(batch.num_rows, bool)
        for first, texts in text_groups(batch.column(text_at).to_pylist()):
            for k, *_ in found_in(texts, items, least):
                keep[first + k] = False
        yield batch.filter(pa.array(keep))


def _texts_of_leaks(batches: Iterator[pa.RecordBatch], items: Items, least: float) -> Iterator[pa.RecordBatch]:
    """The rows, without their text in the last column, whose text holds a passage."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for first, texts in text_groups(batch.column(batch.num_columns - 1).to_pylist()):
            for k, *_ in found_in(texts, items, least):
                keep[first + k] = True
        yield batch.select(range(batch.num_columns - 1)).filter(pa.array(keep))


def n_blocks(benchmark: DataFrame) -> int:
    chars = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    return -(-chars // BLOCK_CHARS)


def item_blocks(texts: DataFrame, benchmark: DataFrame, least: float) -> Iterator[Items]:
    """The test items with their rare seeds, block by block; each is of bounded size and fits a task and the driver.

    `texts` has one column, the documents' text; it is read once per block, to count the documents that hold each pair.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text"))
    blocks = n_blocks(benchmark)
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id", "item_text")
        rows = rows.collect()
        found = Items.of([row.item_id for row in rows], [row.item_text for row in rows], least)
        held = np.zeros(len(found.pairs.numbers) + 1, np.int64)
        counts = arrow_map(texts, _held, "seed long, held long", found.pairs)
        counts = counts.groupBy("seed").agg(F.sum("held").alias("held")).toArrow()
        held[counts["seed"].to_numpy()] = counts["held"].to_numpy()
        yield found.rarest(held[:-1], int(held[-1]))


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word): every document that holds a passage similar to a test item.

    The score is the best local alignment's share of the item's own score, from `least` to 1; it may be lower where RUN
    words of a long item stand in a row, and is then that of the best passage near such a run. The words are counted
    from 0 in the document without punctuation. Documents are read twice per block of items and never shuffled.

    Null and empty texts and items hold no words and match nothing. An item of fewer than SHORT words must stand in the
    document whole, in a row. Rows with equal ids or texts are each looked at; equal items each count. A null id stays null. Empty tables give no rows. Other columns play no part.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, score double, first_word long, last_word long"
    found = docs.sparkSession.createDataFrame([], schema)
    for items in item_blocks(texts.select("text"), benchmark, least):
        found = found.unionByName(arrow_map(texts, _leaks, schema, items, least))
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, least: float = THRESHOLD,
                   text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that hold no passage similar to a test item; see `leaks`.

    Where the items fit one block, no row is shuffled. Otherwise each block tells the hashes of the texts with a passage
    in a pass of its own, and the rows of these texts go in one join.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    text_at = docs.columns.index(text_col)
    rows = docs.toDF(*names)
    text = F.col(names[text_at])
    blocks = item_blocks(rows.select(text), benchmark, least)
    if n_blocks(benchmark) < 2:
        schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True))
        for items in blocks:
            rows = arrow_map(rows, _clean, schema, items, least, text_at)
        return rows.toDF(*docs.columns)
    known = rows.filter(text.isNotNull()).select(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), text)
    found = [arrow_map(known, _texts_of_leaks, "h1 long, h2 long", items, least) for items in blocks]
    gone = found[0]
    for more in found[1:]:
        gone = gone.unionByName(more)
    gone = written(gone.distinct(), "leaks")
    same = (F.xxhash64(text) == gone.h1) & (F.xxhash64(F.lit(1), text) == gone.h2)
    return rows.join(gone, same, "left_anti").toDF(*docs.columns)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
