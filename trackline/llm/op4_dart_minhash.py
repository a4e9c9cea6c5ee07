"""Near duplicates by DartMinHash: weighted signatures, banded joining, exact checks, connected classes.

Darts are hashed onto the plane of weight and rank of every element. A document keeps the darts that fall below its
element's weight, each dart belongs to one coordinate, and the earliest per coordinate is the signature: two
documents agree in a coordinate with the probability of their weighted Jaccard similarity. Elements are runs of
five words, weighted by how often the document holds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm.common import Words, arrow_map, fresh, mixed, shingles, table, text_groups, written
from trackline.llm.components import components

WORDS, SIMILARITY = 5, 0.8
#: Two texts of similarity 0.8 share no band of the signature with a chance of (1 - 0.8**ROWS)**BANDS = 2.6e-5.
BANDS, ROWS = 20, 4
#: Band buckets up to this size are compared member by member, where their members are not linked yet; larger ones in
#: blocks of BLOCK documents, inside tasks.
PAIRED, BLOCK = 32, 64


def thrown(cells: np.ndarray, low: np.ndarray, width: np.ndarray, weight: np.ndarray, limit: np.ndarray,
           row: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For every row and coordinate the earliest dart below the row's limit, and its rank (infinite if there is none).

    A cell is a stretch [low, low + width) of an element's weight axis. Its darts come in the order of their rank,
    with exponential gaps, all drawn from hashes, so every document that covers the cell sees the same darts.
    """
    darts, ranks, owners, rank, step = [], [], [], np.zeros(len(cells)), np.uint64(0)
    with np.errstate(over="ignore"):
        while len(cells):
            step += np.uint64(0x9E3779B97F4A7C15)
            dart = mixed(cells + step)
            rank = rank - np.log(((dart >> np.uint64(11)) + 0.5) / 2.0 ** 53) / width
            live = np.flatnonzero(rank <= limit)
            cells, low, width, weight, limit, row, rank, dart = (
                x[live] for x in (cells, low, width, weight, limit, row, rank, dart))
            height = (mixed(dart ^ np.uint64(0xA5A5A5A5)) >> np.uint64(11)) / 2.0 ** 53
            inside = np.flatnonzero(low + height * width < weight)
            darts.append(dart[inside])
            ranks.append(rank[inside])
            owners.append(row[inside])
    signature, first = np.zeros(rows * size, np.uint64), np.full(rows * size, np.inf)
    if darts:
        dart, rank, owner = map(np.concatenate, (darts, ranks, owners))
        order = np.argsort(-rank)  # of several assignments to a place the last one, the earliest dart, stays
        place = owner * size + (mixed(dart ^ np.uint64(0x5A5A5A5A)) % np.uint64(size)).astype(np.int64)
        signature[place[order]], first[place[order]] = dart[order], rank[order]
    return signature.reshape(rows, size), first.reshape(rows, size)


def dart_signatures(elements: np.ndarray, weights: np.ndarray, row: np.ndarray, rows: int, size: int) -> np.ndarray:
    """(rows, size) coordinates; row says whose each element is. An element occurs once per row at most and has a
    positive weight; the coordinates of a row without elements are 0."""
    levels = np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64)  # cells [0, 1), [1, 2), [2, 4), [4, 8), ...
    owner = np.repeat(np.arange(len(elements)), levels + 1)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(levels + 1) - levels - 1, levels + 1)
    width = 2.0 ** np.maximum(level - 1, 0)
    low = np.where(level == 0, 0.0, width)
    with np.errstate(over="ignore"):
        cells = elements[owner] + mixed(level.astype(np.uint64) + np.uint64(1))
    weight, row_of = weights[owner], row[owner]
    total = np.bincount(row, weights, rows)
    limit = (size * np.log(size) + 3 * size) / np.where(total > 0, total, 1)
    signature = np.zeros((rows, size), np.uint64)
    wanted = total > 0
    while wanted.any():
        own = np.flatnonzero(wanted[row_of])
        found, first = thrown(cells[own], low[own], width[own], weight[own], limit[row_of[own]], row_of[own], rows, size)
        full = wanted & np.isfinite(first).all(axis=1)
        signature[full] = found[full]
        wanted &= ~full
        limit *= 2
    return signature


def dart_signature(elements: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray | None:
    """The coordinates for one set of weighted elements; None without elements."""
    rows = np.zeros(len(elements), np.int64)
    return dart_signatures(elements, weights, rows, 1, size)[0] if len(elements) else None


def weighted(runs: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs per text, how often each occurs, and the text."""
    order = np.lexsort((runs, text))
    runs, text = runs[order], text[order]
    first = np.flatnonzero(np.concatenate([[True], (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])])[:len(runs)])
    return runs[first], np.diff(np.append(first, len(runs))).astype(np.float64), text[first]


def occurrences(runs: np.ndarray) -> np.ndarray:
    """The sorted runs with a number per repetition, so that sets of these have the weighted similarity."""
    runs = np.sort(runs)
    first = np.concatenate([[True], runs[1:] != runs[:-1]])
    at = np.arange(len(runs))
    repeat = at - np.maximum.accumulate(np.where(first, at, 0))
    with np.errstate(over="ignore"):
        return np.sort(mixed(runs + mixed(repeat.astype(np.uint64))))


def text_runs(text: str | None, words: int) -> np.ndarray:
    return shingles(Words(text).numbers(), words)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Of two results of `occurrences`."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / max(1, len(a) + len(b) - shared)


def texts_runs(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `size` words of every text, and whose they are; a shorter text with words is one run."""
    held = Words(*texts)
    numbers = held.numbers()
    at = held.runs(size)
    found, text = shingles(numbers, size)[at] if len(at) else numbers[:0], held.text[at]
    short = np.flatnonzero((held.counts > 0) & (held.counts < size))
    begin = np.cumsum(held.counts) - held.counts
    extra = [shingles(numbers[begin[k]:begin[k] + held.counts[k]], size) for k in short]
    return np.concatenate([found, *extra]), np.concatenate([text, short])


def _sketch(batches: Iterator[pa.RecordBatch], words: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    band = mixed(np.arange(1, bands + 1).astype(np.uint64))
    for batch in batches:
        found = []
        for _, texts in text_groups(batch.column(2).to_pylist()):
            elements, weights, text = weighted(*texts_runs(texts, words))
            signatures = dart_signatures(elements, weights, text, len(texts), bands * rows)
            keys = np.tile(band, (len(texts), 1))
            with np.errstate(over="ignore"):
                for part in signatures.reshape(len(texts), bands, rows).transpose(2, 0, 1):
                    keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + part)
            has = np.bincount(text, minlength=len(texts)) > 0
            found += [key if own else None for key, own in zip(keys.view(np.int64), has, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.int64()))],
                                         names=["doc_id", "copy", "bands"])


def _checked(batches: Iterator[pa.RecordBatch], words: int, least: float) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) that are similar enough; rows of one `a` mostly follow each other, so its text is kept at hand."""
    held, own = None, None
    for batch in batches:
        found = []
        for a, b, first, second in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held != a:
                held, own = a, occurrences(text_runs(first, words))
            if similarity(own, occurrences(text_runs(second, words))) >= least:
                found.append((a, b))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)],
                                         names=["a", "b"])


def similar_pairs(pairs: DataFrame, texts: DataFrame, words: int, least: float) -> DataFrame:
    """Those of the pairs (a, b) whose whole texts are similar enough.

    Two joins bring the texts; a node with very many pairs is split by Spark, as a join needs no whole key.
    """
    first = texts.select(F.col("node").alias("a"), F.col("text").alias("first"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("second"))
    met = pairs.join(second, "b").join(first, "a").select("a", "b", "first", "second")
    return arrow_map(met, _checked, "a long, b long", words, least)


def _block(rows: pd.DataFrame, words: int, least: float) -> pd.DataFrame:
    """Links between the loose and the other documents of a block: one per loose document and component."""
    loose, rest = rows[rows["loose"]], rows[~rows["loose"]]
    sets = [[occurrences(text_runs(text, words)) for text in part["text"]] for part in (loose, rest)]
    sizes = [np.array([len(x) for x in part]) for part in sets]
    known = np.unique(np.concatenate(sets[0])) if sets[0] else np.zeros(0, np.uint64)
    shared = np.zeros((len(loose), len(rest)))
    placed = []
    for part in sets:
        at = [np.searchsorted(known, x) for x in part]
        held = [i[known[np.minimum(i, len(known) - 1)] == x] if len(known) else i[:0]
                for i, x in zip(at, part, strict=True)]
        placed.append((np.concatenate([np.full(len(x), k) for k, x in enumerate(held)] or [np.zeros(0, int)]),
                       np.concatenate(held or [np.zeros(0, int)])))
    for start in range(0, len(known), 8192):  # which document holds which of these runs, as two small matrices
        grids = []
        for (document, run), part in zip(placed, sets, strict=True):
            chosen = (run >= start) & (run < start + 8192)
            grid = np.zeros((len(part), 8192), np.float32)
            grid[document[chosen], run[chosen] - start] = 1
            grids.append(grid)
        shared += grids[0] @ grids[1].T
    union = sizes[0][:, None] + sizes[1][None, :] - shared
    i, j = np.nonzero(shared >= least * np.maximum(union, 1))
    links = pd.DataFrame({"a": loose["node"].to_numpy()[i], "b": rest["node"].to_numpy()[j],
                          "group": rest["component"].to_numpy()[j]})
    return links[links["a"] != links["b"]].drop_duplicates(["a", "group"])[["a", "b"]]


def hot_links(members: DataFrame, texts: DataFrame, words: int, least: float) -> DataFrame:
    """Further links inside large buckets; members are (key, node, leader, component), texts (node, text).

    Buckets that share documents form one set. Its documents outside the set's largest component are loose; they
    meet all documents of the set in blocks of BLOCK by BLOCK. Pairs are counted by matrix products inside a task
    and never become rows; only links do, one per loose document, block and component.
    """
    sets = components(members.select(F.col("leader").alias("a"), F.col("node").alias("b")), "hot-sets")
    own = written(members.select("node", "component").distinct().join(sets.withColumnRenamed("component", "set"),
                                                                      "node"), "hot-nodes")
    sizes = own.groupBy("set", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("set").agg(F.sum("n").alias("n"), F.max("n").alias("most"),
                                       F.max_by("component", "n").alias("main"))
    blocks = largest.filter("n > most").select(
        "set", "main", F.ceil(F.col("n") / BLOCK).cast("long").alias("across"),
        F.ceil((F.col("n") - F.col("most")) / BLOCK).cast("long").alias("down"))
    placed = own.join(blocks, "set")
    spread = F.xxhash64("node")
    loose = placed.filter("component <> main").select(
        "set", F.pmod(spread, "down").alias("down"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)).alias("across"),
        "node", "component", F.lit(True).alias("loose"))
    rest = placed.select(
        "set", F.explode(F.sequence(F.lit(0).cast("long"), F.col("down") - 1)).alias("down"),
        F.pmod(spread, "across").alias("across"), "node", "component", F.lit(False).alias("loose"))
    rows = loose.unionByName(rest).join(texts, "node")
    return rows.groupBy("set", "down", "across").applyInPandas(lambda block: _block(block, words, least),
                                                               "a long, b long")


def classes(docs: DataFrame, words: int = WORDS, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
            id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, copy, node) for every row with words, and (node, class_id) for every node with a link.

    Equal texts have one `copy` (their MD5) and one node, the smallest id (see `_apart` for ids of several texts). Every node lies in one bucket per band.
    First all members of a bucket are compared with its smallest node. Where members then still belong to different
    components, these are compared too, by pairs in small buckets and by blocks in large ones, so that no link
    between members of a bucket is passed over.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.md5(text_col)).alias("copy"),
                        F.col(text_col).alias("text"))
    sketched = written(arrow_map(texts, _sketch, "doc_id long, copy binary, bands array<long>", words, bands, rows)
                       .filter("bands IS NOT NULL"), "dart-sketches")
    nodes = sketched.groupBy("copy").agg(
        F.coalesce(F.min("doc_id"), F.xxhash64("copy")).alias("node"), F.first("bands").alias("bands"))
    nodes, same = _apart(sketched, written(nodes, "dart-nodes"))
    buckets = nodes.select("node", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(buckets.join(shared, "key"), "dart-members")
    wanted = members.select("node").distinct()
    if same is None:
        own = texts.select(F.coalesce("doc_id", F.xxhash64("copy")).alias("node"), "text").join(wanted, "node")
    else:  # an id may stand for several texts: rows are found by their text
        own = texts.join(nodes.join(wanted, "node").select("copy", "node"), "copy").select("node", "text")
    own = written(own.groupBy("node").agg(F.first("text").alias("text")), "dart-texts")
    first = members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = similar_pairs(first, own, words, least)
    links = written(links if same is None else links.unionByName(same), "dart-links")
    joined = components(links, "dart-components")
    known = members.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = written(known, "dart-known")
    split = known.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter(
        "low < high").select("key")
    open_ones = written(known.join(split, "key", "left_semi"), "dart-open")
    small = open_ones.filter(F.col("n") <= PAIRED).select("key", "node", "leader", "component")
    other = small.select("key", F.col("node").alias("b"), F.col("component").alias("other"))
    pairs = small.join(other, "key").filter("node < b AND component <> other AND node <> leader")
    pairs = pairs.select(F.col("node").alias("a"), "b").distinct()
    more = similar_pairs(pairs, own, words, least).unionByName(
        hot_links(open_ones.filter(F.col("n") > PAIRED), own, words, least))
    more = written(more, "dart-more-links")
    stars = joined.select(F.col("component").alias("a"), F.col("node").alias("b"))
    found = joined if more.isEmpty() else components(stars.unionByName(more), "dart-classes")
    placed = sketched.select("doc_id", "copy").join(nodes.select("copy", "node"), "copy")
    if same is None:
        return placed, found.withColumnRenamed("component", "class_id")
    names = placed.join(found, "node").groupBy("component").agg(F.min("doc_id").alias("least"))
    named = found.join(written(names, "dart-names"), "component")
    return placed, named.select("node", F.coalesce("least", "component").alias("class_id"))


def _apart(sketched: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Nodes of their own for different texts whose smallest id is the same, and links between the texts of each id.

    Where no id stands for more than one text the nodes stay as they are, and there are no such links.
    """
    known = sketched.filter(F.col("doc_id").isNotNull())
    several = known.groupBy("doc_id").agg(F.min("copy").alias("one"), F.max("copy").alias("other")).filter(
        "one <> other").select("doc_id")
    if several.isEmpty():
        return nodes, None
    first = nodes.groupBy("node").agg(F.min("copy").alias("first"))
    nodes = nodes.join(first, "node").withColumn("node", F.when(F.col("copy") == F.col("first"), F.col("node")).otherwise(
        F.xxhash64("copy"))).drop("first")
    nodes = written(nodes, "dart-nodes")
    texts = written(known.join(several, "doc_id").select("doc_id", "copy").distinct().join(
        nodes.select("copy", "node"), "copy").select("doc_id", "node"), "dart-ids")
    leader = texts.groupBy("doc_id").agg(F.min("node").alias("a"))
    same = texts.join(leader, "doc_id").filter("node <> a").select("a", F.col("node").alias("b"))
    return nodes, same


def near_duplicates(docs: DataFrame, words: int = WORDS, least: float = SIMILARITY, bands: int = BANDS,
                    rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id) for every row of `docs`; the class is named after its smallest id.

    Two documents are linked if the weighted Jaccard similarity of their runs of `words` words is at least `least`;
    classes are the connected documents. Equal texts are always in one class. A text of fewer words than a run is a
    single run. Null, empty and blank texts have no words and are each a class of their own. Rows with an equal id
    count as one document, so texts of one id are in one class whatever they say. A null id gets its class like any other row; where all ids of equal texts are null, a
    hash of the text stands for them. An empty table gives no rows. Other columns play no part.
    """
    placed, found = classes(docs, words, least, bands, rows, id_col, text_col)
    named = placed.join(found, "node", "left").select("doc_id", F.coalesce("class_id", "node").alias("class_id"))
    blank = docs.filter(F.col(text_col).isNull() | ~F.col(text_col).rlike(r"[^\x20\x09-\x0D]"))
    blank = blank.select(F.col(id_col).cast("long").alias("doc_id"))
    return named.unionByName(blank.withColumn("class_id", F.col("doc_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of `docs`, all columns, of which one stays per class: that with the smallest id.

    Rows without words all stay. Of repeated rows of an id one stays; where they differ, one with the text of the smallest
    MD5 among those that no smaller id holds.
    """
    placed, found = classes(docs, id_col=id_col, text_col=text_col, **settings)
    kept = placed.select("copy", "node").distinct().join(found, "node", "left")
    kept = kept.filter(F.col("class_id").isNull() | (F.col("class_id") == F.col("node")))
    copy, node = fresh(docs, "__copy"), fresh(docs, "__node")
    kept = kept.select(F.col("copy").alias(copy), F.col("node").alias(node))
    rows = docs.withColumn(copy, F.unhex(F.md5(text_col))).join(kept, copy, "left")
    words = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    first = F.col(node).isNotNull() & (F.col(id_col).isNull() & (F.col(node) == F.xxhash64(copy))
                                       | (F.col(id_col) == F.col(node)))
    blank, chosen = rows.filter(~words), rows.filter(words & first)
    repeated = docs.filter(words).groupBy(F.coalesce(F.col(id_col), F.xxhash64(text_col))).count().filter("count > 1")
    if not repeated.isEmpty():  # texts are only sorted out by id where there is need
        chosen = chosen.dropDuplicates([node])
    return blank.unionByName(chosen).drop(copy, node)


def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
