"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Only DataFrame operations. Sources are rows of a small table that is itself ranked, summed and joined by Spark;
documents are never gathered by source, as one source may hold a third of them.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackline.llm.common import fresh, table, unit, written
from trackline.session import BROADCAST_ROWS, bounded_broadcast

WEIGHTS = (5, 2, 1)
#: The mix's size as a share of the corpus, in percent; and the most often a source may be repeated.
PERCENT, EPOCHS = 150, 2
SEED = 42
#: Bins a source's documents fall into at each step of the search for the last one taken.
BINS = 4096


def word_count(text: Column) -> Column:
    """Words of the text; null has none."""
    words = F.split(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")
    return F.when(F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False)), F.size(words)).otherwise(0).cast("long")


def _source_key(column: str) -> Column:
    """A key that is never null, as joins pass over nulls."""
    return F.coalesce(F.concat(F.lit("s"), F.col(column).cast("string")), F.lit("null"))


def ranked(sources: DataFrame, column: str) -> DataFrame:
    """The rows with their place, from 0, in the order of the column, nulls last.

    Rows are dealt by ranges; only the number of rows per range goes through one window.
    """
    dealt = sources.repartitionByRange(F.col(column).asc_nulls_last()).withColumn("__part", F.spark_partition_id())
    dealt = written(dealt, "mix-ranges")
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__start"))
    own = F.row_number().over(W.partitionBy("__part").orderBy(F.col(column).asc_nulls_last()))
    return (dealt.join(starts, "__part").withColumn("place", own - 1 + F.col("__start"))
            .drop("__part", "__start"))


def water_filled(sources: DataFrame, percent: int = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """Sources (source, source_size, weight) with a target: their share of `percent` % of all sizes by weight, at
    most `epochs` times their own size; what exceeds a cap goes to the others by weight, until none is above.

    Each step sums up the sources that are still open, so it brings one row to the driver. All sums are of whole
    numbers; the level is exact until the final division, and reruns agree to the last bit.
    """
    open_ones = written(sources.withColumn("target", F.lit(None).cast("double")), "mix-sources")
    total = open_ones.agg(F.sum("source_size")).first()[0] or 0
    rest = Fraction(total * percent, 100)
    while True:
        weight = open_ones.filter("target IS NULL").agg(F.sum("weight")).first()[0] or 0
        if not weight:
            return open_ones
        cap = F.lit(epochs) * F.col("source_size")
        # cap < rest * weight / weights, in whole numbers
        over = F.col("target").isNull() & (cap.cast("decimal(28,0)") * F.lit(weight * rest.denominator)
                                           < F.col("weight").cast("decimal(9,0)") * F.lit(rest.numerator))
        gone = open_ones.filter(over).agg(F.sum(cap)).first()[0]
        if gone is None:
            share = F.lit(float(rest)) * F.col("weight") / F.lit(float(weight))
            return open_ones.withColumn("target", F.coalesce("target", share))
        rest -= gone
        open_ones = written(open_ones.withColumn("target", F.when(over, cap.cast("double")).otherwise(
            F.col("target"))), "mix-sources")


def _first_ones(rows: DataFrame, small: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The keys of the first rows of every source, in the order of u, whose sizes together are at most `wanted`.

    Two histograms of BINS bins find the bins that hold the last document; only that last bin's documents are put
    in order. The histograms are summed before the shuffle, so a source with many documents is no hot group.
    """
    last = W.partitionBy("source_key").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)

    def border(rows: DataFrame, bin_: Column) -> DataFrame:
        """Per source the first bin at which the sizes pass what is wanted, and the sizes before it."""
        sizes = rows.groupBy("source_key", bin_.alias("bin"), "wanted").agg(F.sum("size").alias("size"))
        before = F.coalesce(F.sum("size").over(last), F.lit(0))
        passed = sizes.withColumn("before", before).filter(F.col("before") + F.col("size") > F.col("wanted"))
        return passed.groupBy("source_key").agg(F.min("bin").alias("border"), F.min_by("before", "bin").alias("upto"))

    first, second = F.floor(F.col("u") * BINS), F.floor(F.col("u") * BINS * BINS) % BINS
    one = written(border(rows, first), "mix-bins")
    rows = rows.join(small(one), "source_key", "left")
    inside = rows.filter(first == F.col("border")).withColumn("wanted", F.col("wanted") - F.col("upto")).drop(
        "border", "upto")
    two = written(border(inside, second).withColumnsRenamed({"border": "border2", "upto": "upto2"}), "mix-bins")
    rows = rows.join(small(two), "source_key", "left")
    sure = F.col("border").isNull() | (first < F.col("border")) | (
        (first == F.col("border")) & (F.col("border2").isNull() | (second < F.col("border2"))))
    edge = rows.filter((first == F.col("border")) & (second == F.col("border2")))
    upto = F.coalesce(F.sum("size").over(W.partitionBy("source_key").orderBy("u", "row_key", "size")
                                         .rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    edge = edge.withColumn("before", upto + F.col("upto") + F.col("upto2"))
    edge = edge.filter(F.col("before") + F.col("size") <= F.col("wanted"))
    return written(rows.filter(sure).select("row_key").unionByName(edge.select("row_key")).distinct(), "mix-taken")


def _cut(docs: DataFrame, limits: DataFrame, sources: int) -> DataFrame:
    """For every source the documents of the fractional repetition: in the order of a seeded number, as many as fit
    into the source's remaining size; the same again with those that fit into what is left, until none does; and then
    one more where that comes nearer.

    A document that does not fit is passed over and what is left is less than it, so each step leaves about half of
    what the one before left. Only documents of less than twice that size are read again.
    """
    small = partial(bounded_broadcast, rows=sources)  # all these tables have one row per source
    rows = docs.select("row_key", "source_key", "size", "u").join(small(limits), "source_key")
    taken, step = None, _first_ones(rows, small)
    while taken is None or not step.isEmpty():
        taken = step if taken is None else taken.unionByName(step)
        marked = rows.join(step.withColumn("in", F.lit(1)), "row_key", "left")
        left = marked.groupBy("source_key", "wanted").agg(F.sum(F.when(F.col("in") == 1, F.col("size"))).alias("sum"))
        left = written(left.select("source_key", (F.col("wanted") - F.coalesce("sum", F.lit(0))).alias("wanted")),
                       "mix-left")
        open_ones = marked.filter("in IS NULL AND size > 0").drop("in", "wanted").join(small(left), "source_key")
        rows = written(open_ones.filter("size < 2 * wanted"), "mix-open")
        step = _first_ones(rows.filter("size <= wanted"), small)
    nearest = F.min_by("row_key", F.struct("size", "row_key"))
    return written(taken.unionByName(rows.groupBy("source_key").agg(nearest.alias("row_key")).select("row_key")),
                   "mix-taken")


def _told_apart(rows: DataFrame, seed: int) -> DataFrame:
    """Rows equal in id and text get keys and numbers of their own; the table is only written again if there are any."""
    twice = rows.groupBy("row_key").count().filter("count > 1").select("row_key", F.lit(True).alias("twice"))
    if twice.isEmpty():
        return rows
    place = (F.lit(seed), F.col("row_key"), F.col("place"))
    found = rows.join(twice, "row_key", "left")
    return written(found.withColumns({
        "u": F.when(F.col("twice"), unit(*place)).otherwise(F.col("u")),
        "row_key": F.when(F.col("twice"), F.xxhash64(*place)).otherwise(F.col("row_key"))}).drop("twice"), "mix-documents")


def mixed_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS,
                  seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, repeats, taken) for every row of `docs`.

    `size` is the text's number of words. Sources by code point, null last, weigh `weights`, repeating. A document is
    taken whole, floor(target / source_size) times and, for the fractional part, once more if it is among the first
    of its source in the order of a seeded hash of id and text; those that fit then fill the gap to the target until
    none does, and a last one goes past it where that is nearer. `taken` is size times repeats.

    Null and empty texts have size 0 and take no words. Repeated rows are rows of their own: those equal in id and text
    are told apart by their place in the table, so some may be taken and others left. A null id is an id of its own. A
    source of size 0 has target 0. An empty table gives no rows. Other columns play no part.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       word_count(F.col(text_col)).alias("size"), F.xxhash64(F.lit(seed), id_col, text_col).alias(
                           "row_key"), unit(F.lit(seed), F.col(id_col), F.col(text_col)).alias("u"))
    key = _source_key("source").alias("source_key")
    rows = _told_apart(written(rows.select("*", key, F.col("row_key").alias("own_key"),
                                           F.monotonically_increasing_id().alias("place")), "mix-documents"), seed)
    sources = rows.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    cycle = F.pmod(F.col("place"), F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*map(F.lit, weights)), cycle + 1).cast("long")
    filled = water_filled(ranked(sources, "source").withColumn("weight", weight), percent, epochs)
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    filled = written(filled.select("source_key", "source_size", "target", whole.alias("whole"),
                                   (F.col("target") - whole * F.col("source_size")).alias("wanted")), "mix-targets")
    count = filled.count()
    more = _cut(rows, filled.filter("wanted > 0").select("source_key", "wanted"), count)
    more = more.distinct().withColumn("more", F.lit(1))
    found = rows.join(bounded_broadcast(filled, rows=count), "source_key").join(more, "row_key", "left")
    repeats = (F.col("whole") + F.coalesce("more", F.lit(0))).alias("repeats")
    return found.select("doc_id", "source", "size", "source_size", "target", repeats, "own_key").withColumn(
        "taken", (F.col("size") * F.col("repeats")).cast("long"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    seed: int = SEED, **settings) -> DataFrame:
    """The rows of `docs` in the mix, each as often as it is taken, with all columns and `repetition` from 1 on.

    Texts do not move: a source's documents are taken in the order of their key, so its number of repetitions and the place
    where it changes say how often each is taken, but for a few that are copied to the tasks (shuffled, where there are many).
    """
    name, key, times, extra, own, usual = (fresh(docs, n) for n in (
        "repetition", "__own_key", "__repeats", "__extra", "__source_key", "__usual"))
    taken = mixed_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed, **settings)
    taken = written(taken.select(_source_key("source").alias(own), F.col("own_key").alias(key), "repeats"), "mix-repeats")
    # Per source the fewest repeats and the first place at which they occur: whatever comes before has one more.
    place = F.shiftrightunsigned(key, 11)
    usually = taken.groupBy(own).agg(F.min(F.struct(F.col("repeats").alias("least"), place.alias("place"))).alias(usual))
    usually = written(usually, "mix-usual")
    few = usually.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    expected = (F.col(usual)["least"] + F.when(place < F.col(usual)["place"], 1).otherwise(0)).cast("int") if few else F.lit(0)

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(usually), own) if few else rows

    # Texts are joined with the few that this does not tell: what filled the gap to the target, and rows equal in id and text,
    # which are taken `least` times each; what some of these are taken beyond that, one of them stands for.
    odd = placed(taken).groupBy(key).agg(F.min("repeats").alias("least"), F.sum("repeats").alias("sum"),
                                         F.count(F.lit(1)).alias("n"), F.min(expected).alias("expected"))
    odd = written(odd.filter("n > 1 OR sum <> expected").select(
        key, F.col("least").cast("int").alias(times),
        (F.col("sum") - F.col("least") * F.col("n")).cast("int").alias(extra)), "mix-odd")
    rows = docs.withColumns({key: F.xxhash64(F.lit(seed), id_col, text_col), own: _source_key(source_col)})
    out = placed(rows).join(bounded_broadcast(odd.drop(extra)), key, "left")
    out = out.withColumn(times, F.coalesce(times, expected)).filter(F.col(times) > 0).withColumn(
        name, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns, name)
    more = odd.filter(F.col(extra) > 0)
    if more.isEmpty():
        return out
    first = rows.join(bounded_broadcast(more), key).dropDuplicates([key])
    return out.unionByName(first.withColumn(name, F.explode(F.sequence(
        F.col(times) + 1, F.col(times) + F.col(extra)))).select(*docs.columns, name))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
