"""Ranked search over a tree of documents that share paths of frequent terms, by branch and bound.

A document is reduced to the items' terms it holds, the most frequent term first. Documents in the order of these vectors
form an FP-tree: those with the same first terms share a path. Every node knows the largest frequency of each term below
it and the smallest length factor m, which bound every score below it. An item's search goes down the tree, the most
promising child first, and leaves out whatever can't reach its worst result so far.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackline.llm.common import arrow_map, table

#: Results per item.
TOP = 10
#: Most characters of items that are searched for in one pass over the documents; more items take more passes.
BLOCK_CHARS = 2_000_000
#: A tree holds at most this many documents, and about this many (document, term) entries.
TREE_DOCS, TREE_ENTRIES = 16_384, 4_000_000
#: Neighbouring documents below this number are not divided further.
LEAF = 64
#: Parts into which an item's candidates are dealt before the last ranking.
DEALT = 64
#: Scale of the weights, and the length factor in hundredths with its share for length.
WEIGHT, SCALE, BASE, SLOPE, SATURATION = 1_000, 1_000_000_000, 10, 90, 8
#: What ends a term becomes a blank, A-Z become a-z; bytes of characters above U+007F stay.
FOLD = bytes(ord(chr(c).lower()) if chr(c).isalnum() else 0x20 for c in range(0x80)) + bytes(range(0x80, 0x100))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a whole text in UTF-8."""
    return (text or b"").translate(FOLD).split()


@dataclass(frozen=True)
class Items:
    """The items of one block: ids, the terms of each (once) as numbers, and all their terms."""

    ids: list
    own: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @classmethod
    def of(cls, rows: list) -> Items:
        vocabulary: dict[bytes, int] = {}
        own = [np.array(sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms(text)}), np.int64)
               for _, text in rows]
        return cls([i for i, _ in rows], own, vocabulary)


def restricted(texts: list[bytes | None], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, ...]:
    """Number of terms of each text, and sorted entries (text, term, frequency) of the vocabulary's terms."""
    sizes, places, known = np.zeros(len(texts), np.int64), [], len(vocabulary)
    for at, text in enumerate(texts):
        own = terms(text)
        sizes[at] = len(own)
        if own:
            held = np.fromiter(map(lambda t: vocabulary.get(t, -1), own), np.int64, len(own))
            places.append(held[held >= 0] + at * known)
    found, tf = np.unique(np.concatenate(places), return_counts=True) if places else (np.zeros(0, np.int64),) * 2
    return sizes, *np.divmod(found, max(known, 1)), tf


def _tally(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    docs, total, held = 0, 0, np.zeros(len(vocabulary), np.int64)
    for batch in batches:
        sizes, _, term, _ = restricted(batch.column(0).to_pylist(), vocabulary)
        docs += int((sizes > 0).sum())
        total += int(sizes.sum())
        held += np.bincount(term, minlength=len(held))
    seen = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *seen.tolist()], pa.int64()),
                                      pa.array([docs, total, *held[seen].tolist()], pa.int64())], names=["term", "n"])


@dataclass(frozen=True)
class Model:
    """Counts over all documents: those with a term (N), all their terms (L), and per term its documents and weight."""

    docs: int
    total: int
    df: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, texts: DataFrame, vocabulary: dict[bytes, int]) -> Model:
        """One pass; a task hands on one count per term, and the driver receives one per term of the block."""
        parts = arrow_map(texts.select("_text"), _tally, "term long, n long", vocabulary)
        counts = {row.term: row.n for row in parts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        docs, df = counts.get(-2, 0), np.array([counts.get(t, 0) for t in range(len(vocabulary))], np.int64)
        weights = [math.floor(WEIGHT * math.log((2 * docs + 2) / (2 * n + 1))) if n else 0 for n in df.tolist()]
        return cls(docs, counts.get(-1, 0), df, np.array(weights, np.int64))

    def factors(self, sizes: np.ndarray) -> np.ndarray:
        """The length factor m of documents with that many terms."""
        if not self.total:
            return np.full(len(sizes), BASE, np.int64)
        if int(sizes.max(initial=0)) * SLOPE * self.docs < 2 ** 63:
            return BASE + SLOPE * sizes * self.docs // self.total
        return np.array([BASE + SLOPE * n * self.docs // self.total for n in sizes.tolist()], np.int64)


class Vectors:
    """Sparse rows of (term, tf) with a length factor each: documents, or bounds of documents."""

    def __init__(self, starts: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray):
        self.starts, self.term, self.m = starts, term, m
        self.part = SCALE * tf // (WEIGHT * tf + SATURATION * np.repeat(m, np.diff(starts)))

    def scores(self, low: int, high: int, weights: np.ndarray) -> np.ndarray:
        """Scores of the rows low .. high - 1; every row has an entry."""
        first, last = self.starts[low], self.starts[high]
        return np.add.reduceat(weights[self.term[first:last]] * self.part[first:last], self.starts[low:high] - first)


class Tree:
    """An FP-tree over documents in the order of their vectors. Nodes are ranges of documents; siblings lie side by side.

    `docs` are the vectors of the documents, `bounds` those of the nodes: per term the largest frequency below, and
    the smallest m. Children are the groups that share one more term; neighbouring small ones make one leaf, and a path
    that leaves out fewer than LEAF documents is one edge.
    """

    def __init__(self, row: np.ndarray, rank: np.ndarray, tf: np.ndarray, m: np.ndarray, known: int):
        # entries come sorted by (row, rank); the rows with entries are ordered by their ranks
        rows, first = np.unique(row, return_index=True)
        ends = np.append(first[1:], len(row))
        keys = rank.astype(">u4").tobytes()
        order = sorted(range(len(rows)), key=lambda k: keys[4 * first[k]:4 * ends[k]])
        self.rows = rows[order]
        self.length = (ends - first)[order]
        starts = np.append(0, np.cumsum(self.length))
        at = np.arange(len(row)) + np.repeat(first[order] - starts[:-1], self.length)
        self.docs = Vectors(starts, rank[at], tf[at], m[self.rows])
        self._tf, self.known = tf[at], known
        self._divide()

    def _children(self, low: int, high: int, depth: int) -> list[tuple[int, int, int]]:
        """(low, high, depth) of each part of a range whose documents share `depth` terms."""
        left, right = [], []
        while True:
            ended = self.length[low:high] <= depth
            here = self.docs.starts[low:high] + depth
            terms = np.where(ended, -1, self.docs.term[np.minimum(here, len(self.docs.term) - 1)])
            cuts = [low, *(low + 1 + np.flatnonzero(np.diff(terms))).tolist(), high]
            parts = list(zip(cuts, cuts[1:], strict=False))
            a, b = max(parts, key=lambda p: p[1] - p[0])
            if (high - low) - (b - a) + sum(y - x for x, y in left + right) >= LEAF or self.length[a] <= depth:
                break
            left += [p for p in parts if p[1] <= a]
            right = [p for p in parts if p[0] >= b] + right
            low, high, depth = a, b, depth + 1
        out: list[tuple[int, int, int]] = []
        for a, b in left + parts + right:
            if out and out[-1][2] < 0 and b - a < LEAF and out[-1][1] - out[-1][0] < LEAF:
                out[-1] = (out[-1][0], b, -1)
            else:  # what is small, or ends here, is a leaf
                out.append((a, b, -1 if b - a < LEAF or self.length[a] <= depth else depth + 1))
        return out

    def _divide(self) -> None:
        nodes, self.children = [(0, len(self.rows), 0)], {}
        for at, (low, high, depth) in enumerate(nodes):  # grows while it is read: siblings in a row
            if depth >= 0 and high - low >= LEAF:
                parts = self._children(low, high, depth)
                if len(parts) > 1:
                    self.children[at] = (len(nodes), len(nodes) + len(parts))
                    nodes += parts
        self.ranges = [(low, high) for low, high, _ in nodes]
        tops = [None] * len(nodes)
        for at in range(len(nodes) - 1, -1, -1):
            most, (low, high) = np.zeros(self.known, np.int64), self.ranges[at]
            if at in self.children:
                for child in range(*self.children[at]):
                    most[tops[child][0]] = np.maximum(most[tops[child][0]], tops[child][1])
            else:
                span = slice(self.docs.starts[low], self.docs.starts[high])
                np.maximum.at(most, self.docs.term[span], self._tf[span])
            term = np.flatnonzero(most)
            tops[at] = (term, most[term])
        starts = np.append(0, np.cumsum([len(term) for term, _ in tops]))
        m = np.array([self.docs.m[low:high].min() for low, high in self.ranges], np.int64)
        self.bounds = Vectors(starts, np.concatenate([t for t, _ in tops]), np.concatenate([f for _, f in tops]), m)

    def search(self, weights: np.ndarray, best: Best) -> None:
        """Depth first; a subtree whose bound is below the worst of a full result is left out."""
        stack = [(0, None)]
        while stack:
            node, bound = stack.pop()
            if bound is not None and bound < best.least:
                continue
            if node not in self.children:
                low, high = self.ranges[node]
                best.offer(self.docs.scores(low, high, weights), self.rows[low:high])
                continue
            first, last = self.children[node]
            bounds = self.bounds.scores(first, last, weights)
            for k in np.argsort(bounds, kind="stable").tolist():  # the best one lies on top
                if bounds[k] >= best.least:
                    stack.append((first + k, bounds[k]))


class Best:
    """An item's best documents so far: score falling, then id rising, unknown ids last."""

    def __init__(self, top: int):
        self.top, self.least, self.rows = top, 1, []
        self.ids: list = []

    def offer(self, scores: np.ndarray, rows: np.ndarray) -> None:
        found = np.flatnonzero(scores >= self.least)
        if len(found):
            own = [(-int(scores[k]), i is None, i or 0) for k in found for i in (self.ids[rows[k]],)]
            self.rows = sorted(self.rows + own)[:self.top]
            if len(self.rows) == self.top:
                self.least = max(1, -self.rows[-1][0])


def trees(batches: Iterator[pa.RecordBatch], items: Items, model: Model) -> Iterator[tuple[list, Tree]]:
    """The documents of a task as trees of bounded size, each with the ids of its rows."""
    order = np.argsort(-model.df, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    ids, parts, entries = [], [], 0

    def grown() -> tuple[list, Tree]:
        sizes, row, number, tf = (np.concatenate(columns) for columns in zip(*parts, strict=True))
        placed = np.lexsort((number, row))
        return ids, Tree(row[placed], number[placed], tf[placed], model.factors(sizes), len(items.vocabulary))

    for batch in batches:
        sizes, row, term, tf = restricted(batch.column(1).to_pylist(), items.vocabulary)
        parts.append((sizes, row + len(ids), rank[term], tf))
        ids += batch.column(0).to_pylist()
        entries += len(term)
        if len(ids) >= TREE_DOCS or entries >= TREE_ENTRIES:
            if entries:
                yield grown()
            ids, parts, entries = [], [], 0
    if entries:
        yield grown()


def _search(batches: Iterator[pa.RecordBatch], items: Items, model: Model, top: int) -> Iterator[pa.RecordBatch]:
    order = np.argsort(-model.df, kind="stable")
    best, weights = [Best(top) for _ in items.ids], []
    for own in items.own:
        held = np.zeros(len(order), np.int64)
        held[own] = model.weights[own]
        weights.append(held[order])
    for ids, tree in trees(batches, items, model):
        for mine, weight in zip(best, weights, strict=True):
            if weight.any():
                mine.ids = ids
                tree.search(weight, mine)
    rows = [(k, None if unknown else i, -score) for k, mine in enumerate(best) for score, unknown, i in mine.rows]
    yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows, strict=True)]
                                     if rows else [pa.array([], pa.int64())] * 3, names=["item", "doc", "score"])


def _best(found: DataFrame, top: int, *groups: str) -> DataFrame:
    place = Window.partitionBy(*groups).orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)


def _blocks(items: DataFrame, item_id: str, text_col: str) -> Iterator[list]:
    """The items, read one partition at a time, in blocks of about BLOCK_CHARS characters."""
    block, chars = [], 0
    for row in items.select(F.col(item_id).alias("id"), F.col(text_col).cast("binary").alias("text")).toLocalIterator():
        block.append((row.id, bytes(row.text) if row.text is not None else None))
        chars += len(block[-1][1] or b"")
        if chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP, id_col: str = "doc_id", item_id: str = "item_id",
           text_col: str = "text") -> DataFrame:
    """Rows (item id, rank, doc id, score): for each item its `top` documents with a score above 0.

    Equal scores rank by rising id; a null id comes last. Each row of either table counts on its own, so a repeated
    document can hold several ranks and a repeated item id is ranked for each of its rows. Null or empty texts have no
    terms: such documents are never found and such items find nothing. Two passes over the documents for each block of
    items: one counts, one searches. A task holds one tree of bounded size; of its rows only its `top` per item leave
    it, so texts are never shuffled, however long they are. Empty tables give no rows. Other columns play no part.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    result = spark.createDataFrame([], f"`{item_id}` {items.schema[item_id].dataType.simpleString()}, "
                                       f"rank int, `{id_col}` {kind}, score long")
    for rows in _blocks(items, item_id, text_col):
        block = Items.of(rows)
        model = Model.of(texts, block.vocabulary)
        found = arrow_map(texts, _search, "item long, doc long, score long", block, model, top)
        dealt = F.pmod(F.xxhash64("doc", "score"), F.lit(DEALT))
        ranked = _best(_best(found.withColumn("part", dealt), top, "item", "part").drop("rank"), top, "item")
        names = spark.createDataFrame(list(enumerate(block.ids)), f"number long, `{item_id}` "
                                      f"{items.schema[item_id].dataType.simpleString()}")
        result = result.unionByName(ranked.join(F.broadcast(names), F.col("item") == F.col("number")).select(
            item_id, "rank", F.col("doc").cast(kind).alias(id_col), "score"))
    return result


def op13_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = rf"""
WITH found AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), sizes AS (SELECT doc_id, count(*) AS n FROM found GROUP BY doc_id
), totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes
), entries AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, floor({WEIGHT} * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM entries, totals GROUP BY term
), scored AS (
  SELECT item_id, doc_id, sum(w * (({SCALE} * tf) // ({WEIGHT} * tf + {SATURATION} *
         ({BASE} + ({SLOPE} * n * docs) // total))))::BIGINT AS score
  FROM wanted JOIN entries USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
  GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank,
         doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
