"""Line dedup: sharded cuckoo filters in front of exact reference counts, reversible by deleting documents.

The state is three tables. `refs` is a log: one row (key, doc_id, step) per distinct long line of a document, step
+1 when the document is inserted and -1 when it is deleted. `counts` is exact: per key the number of documents that
hold it and the largest id among them. `filters` has one cuckoo filter per shard, over the keys that at least
`min_docs` documents hold; a later insert or delete only touches the keys that cross this line. Inserts and deletes are appended as
generations: the log and the counts are written as a whole only every COMPACT_EVERY of them, and the shards are laid
out anew when the keys have outgrown them twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm.common import arrow_map, fresh, table, written
from trackline.llm.cuckoo import CuckooFilter
from trackline.session import bounded_broadcast

MIN_CHARS, MIN_DOCS = 40, 5
#: Keys a shard is planned for; above twice as many on average, all filters are built anew over more shards.
SHARD_KEYS = 50_000
#: Inserts and deletes after which the appended tables are written as one.
COMPACT_EVERY = 16
#: Lines that meet one copy of a filter in one group; a shard with more lines gets more copies of its filter.
GROUP_LINES = 50_000
KEY = ["high", "low"]


@dataclass(frozen=True)
class LineState:
    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    min_chars: int
    n_common: int = 0
    generations: int = 0


def line_key(line: str, min_chars: int) -> bytes | None:
    """128 bits for a line of at least `min_chars` code points after ASCII space is stripped and A-Z lowered."""
    key = line.strip(" \t\n\x0b\x0c\r")
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None  # bytes.lower() is ASCII


def _keys(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = {line_key(line, min_chars) for line in (text or "").split("\n")} - {None}
            ids += [doc] * len(found)
            keys += found
        halves = np.frombuffer(b"".join(keys), ">i8").reshape(-1, 2).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.types[0]), pa.array(halves[:, 0]),
                                          pa.array(halves[:, 1])], names=["doc_id", *KEY])


def line_refs(docs: DataFrame, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, high, low), one row per distinct long line of each row."""
    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(id_col, text_col), _keys, f"doc_id {kind}, high long, low long", min_chars)


def _shard(shards: int):
    return F.pmod(F.col("low"), F.lit(shards))


def _counted(refs: DataFrame) -> DataFrame:
    """Documents per key and the largest id, from the log; a document counts while its steps sum above zero."""
    live = refs.groupBy(*KEY, "doc_id").agg(F.sum("step").alias("step")).filter("step > 0")
    return live.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))


def _built(shard: tuple, keys: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"shard": [shard[0]], "filter": [CuckooFilter.of(keys["high"].to_numpy()).to_bytes()]})


def _changed(shard: tuple, old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
    """The shard's filter with keys that left deleted and keys that came inserted."""
    held = keys.loc[keys["held"], "high"].to_numpy()
    came, left = keys.loc[keys["came"], "high"].to_numpy(), keys.loc[keys["left"], "high"].to_numpy()
    if not len(old):
        found = CuckooFilter.of(came)
    else:
        found = CuckooFilter.from_bytes(old["filter"].iloc[0])
        found.delete_all(left)
        if not found.insert_all(came):
            found = CuckooFilter.of(np.concatenate([held, came]))
    return pd.DataFrame({"shard": [shard[0]], "filter": [found.to_bytes()]})


def empty_state(spark: SparkSession, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                id_type: str = "bigint") -> LineState:
    refs = spark.createDataFrame([], f"doc_id {id_type}, high long, low long, step int")
    counts = spark.createDataFrame([], f"high long, low long, n_docs long, last_doc {id_type}")
    return LineState(refs, counts, spark.createDataFrame([], "shard long, filter binary"), 0, min_docs, min_chars)


def _sharded(state: LineState, n_common: int) -> LineState:
    """Every filter built anew from the counts, with as many shards as their common keys need."""
    shards = max(1, -(-n_common // SHARD_KEYS))
    keys = state.counts.filter(F.col("n_docs") >= state.min_docs).select(_shard(shards).alias("shard"), "high")
    filters = keys.groupBy("shard").applyInPandas(_built, "shard long, filter binary")
    return replace(state, filters=written(filters, "line-filters"), shards=shards, n_common=n_common)


def _compacted(state: LineState) -> LineState:
    """The same state with one log and one table of counts; steps that undo each other leave the log."""
    refs = state.refs.groupBy("doc_id", *KEY).agg(F.sum("step").cast("int").alias("step")).filter("step <> 0")
    return replace(state, refs=written(refs, "line-refs"), counts=written(state.counts, "line-counts"), generations=1)


def _moved(state: LineState, docs: DataFrame, step: int, id_col: str, text_col: str) -> LineState:
    refs = line_refs(docs, state.min_chars, id_col, text_col).withColumn("step", F.lit(step))
    new = written(refs, "line-refs")
    if not state.shards and step > 0:  # nothing held yet: count, then build every shard once
        counts = written(_counted(new), "line-counts")
        n_common = counts.filter(F.col("n_docs") >= state.min_docs).count()
        return _sharded(replace(state, refs=new, counts=counts, generations=1), n_common)
    touched = new.select(*KEY).distinct()
    log = state.refs.unionByName(new)
    now = touched.join(_counted(log.join(touched, KEY, "left_semi")), KEY, "left").select(
        *KEY, F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs"), "last_doc")
    now = written(now, "line-counts")
    before = state.counts.select(*KEY, F.col("n_docs").alias("before"))
    common = F.col("n_docs") >= state.min_docs
    was = F.coalesce(F.col("before"), F.lit(0)) >= state.min_docs
    both = now.join(before, KEY, "left")
    moves = both.select(*KEY, (common & ~was).alias("came"), (was & ~common).alias("left"), F.lit(False).alias("held"))
    changed = written(moves.filter("came or left"), "line-moves")
    came, left = changed.agg(F.count_if("came"), F.count_if("left")).first()
    n_common = state.n_common + came - left
    rest = state.counts.join(bounded_broadcast(now.select(*KEY)), KEY, "left_anti")
    after = replace(state, refs=log, counts=rest.unionByName(now.filter("n_docs > 0")),
                    n_common=n_common, generations=state.generations + 1)
    after = _compacted(after) if after.generations > COMPACT_EVERY else after
    shards = max(1, state.shards)
    if n_common > 2 * SHARD_KEYS * shards:
        return _sharded(after, n_common)
    changed = changed.withColumn("shard", _shard(shards))
    still = rest.filter(common).select(*KEY).unionByName(both.filter(common & was).select(*KEY))
    still = still.withColumn("shard", _shard(shards)).join(changed.select("shard").distinct(), "shard", "left_semi")
    keys = changed.unionByName(still.select(*KEY, F.lit(False).alias("came"), F.lit(False).alias("left"),
                                            F.lit(True).alias("held"), "shard"))
    filters = state.filters.groupBy("shard").cogroup(keys.groupBy("shard"))
    filters = filters.applyInPandas(_changed, "shard long, filter binary")
    return replace(after, filters=written(filters, "line-filters"), shards=shards)


def insert(state: LineState, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineState:
    """The state with these documents counted too."""
    return _moved(state, docs, 1, id_col, text_col)


def delete(state: LineState, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineState:
    """The state as if these documents, inserted before with the same texts, had never been inserted."""
    return _moved(state, docs, -1, id_col, text_col)


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines whose shard's filter may hold them. Rows come sorted by shard, each shard's filter before its lines."""
    shard, found = None, None
    for batch in batches:
        shards, lines = batch.column(0).to_numpy(zero_copy_only=False), batch.column(5).to_numpy(zero_copy_only=False)
        keep = np.zeros(batch.num_rows, bool)
        borders = np.flatnonzero(np.diff(shards, prepend=shards[0] - 1 if len(shards) else 0))
        for start, end in zip(borders, [*borders[1:], batch.num_rows], strict=True):
            if not lines[start]:
                found = CuckooFilter.from_bytes(batch.column(4)[int(start)].as_py())
                shard, start = shards[start], start + 1
            if found is not None and start < end and shards[start] == shard:
                keep[start:end] = found.holds(batch.column(2).slice(start, end - start).to_numpy())
        kept = batch.filter(pa.array(keep & lines))  # further copies of the filter in hand are no lines
        yield pa.RecordBatch.from_arrays(kept.columns[1:4], names=kept.schema.names[1:4])


def drops(state: LineState, refs: DataFrame) -> DataFrame:
    """(doc_id, high, low) of the lines to drop: those in at least min_docs documents, of which this isn't the last.

    Each line meets the filter of its shard: both are dealt by shard and by a salt, under which every filter has a
    copy, so a frequent line does not land in one task. What passes is checked against the exact counts.
    """
    shard = _shard(max(1, state.shards)).alias("shard")
    groups = state.counts.groupBy(shard).agg(F.ceil(F.sum("n_docs") / GROUP_LINES).cast("long").alias("groups"))
    groups = groups.join(state.filters.select("shard"), "shard", "left_semi")
    groups = bounded_broadcast(groups, rows=state.shards)  # one row per shard
    lines = refs.select(shard, "doc_id", *KEY).join(groups, "shard").select(
        "shard", F.pmod(F.xxhash64("doc_id", "high"), "groups").alias("salt"), "doc_id", *KEY,
        F.lit(None).cast("binary").alias("filter"), F.lit(True).alias("is_line"))
    copies = state.filters.join(groups, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("salt"),
        F.lit(None).cast(refs.schema["doc_id"].dataType).alias("doc_id"), F.lit(0).cast("long").alias("high"),
        F.lit(0).cast("long").alias("low"), "filter", F.lit(False).alias("is_line"))
    dealt = lines.unionByName(copies).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "is_line")
    kind = refs.schema["doc_id"].dataType.simpleString()
    passed = dealt.select("shard", "doc_id", *KEY, "filter", "is_line").mapInArrow(
        _probe, f"doc_id {kind}, high long, low long")
    common = state.counts.filter(F.col("n_docs") >= state.min_docs)
    return passed.join(common, KEY).filter(~F.col("doc_id").eqNullSafe(F.col("last_doc"))).select("doc_id", *KEY)


def _rebuild(batches: Iterator[pa.RecordBatch], text_at: int, min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts, dropped = [], [], []
        for text, keys in zip(batch.column(text_at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(),
                              strict=True):
            lines = (text or "").split("\n")
            gone = {key["high"].to_bytes(8, "big", signed=True) + key["low"].to_bytes(8, "big", signed=True)
                    for key in keys or ()}
            kept = [line for line in lines if line_key(line, min_chars) not in gone] if gone else lines
            texts.append("\n".join(kept) if gone else text)
            counts.append(len(lines))
            dropped.append(len(lines) - len(kept))
        columns = batch.columns[:-1]
        columns[text_at] = pa.array(texts, batch.schema.types[text_at])
        yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())],
                                         names=[*batch.schema.names[:-1], "n_lines", "n_dropped"])


def drop_lines(state: LineState, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               refs: DataFrame | None = None) -> DataFrame:
    """All rows and columns of `docs`, the text without dropped lines, and the counts n_lines and n_dropped.

    Null or empty text is one empty line and stays as it is. Whether a line goes depends on its key and on the
    row's id alone, so rows with equal ids keep and lose the same lines. A null id counts as a document and as the
    smallest id; if no other document holds a key, its line stays. An empty table gives an empty table. If `docs`
    has columns n_lines or n_dropped of its own, the new ones get a leading underscore. `refs` are the rows'
    `line_refs`, if they are at hand.
    """
    given = docs.columns
    names = [f"c{i}" for i in range(len(given))]
    text_at = given.index(text_col)
    id_name = names[given.index(id_col)]
    gone = drops(state, refs or line_refs(docs, state.min_chars, id_col, text_col))
    gone = gone.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("gone"))
    rows = docs.toDF(*names)
    rows = rows.join(gone, rows[id_name].eqNullSafe(gone["doc_id"]), "left").drop("doc_id")
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True))
    kept = arrow_map(rows, _rebuild, f"{schema}, n_lines long, n_dropped long", text_at, state.min_chars)
    return kept.toDF(*given, fresh(docs, "n_lines"), fresh(docs, "n_dropped"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Insert every document into an empty state, then drop its common lines; see `drop_lines` for the result."""
    kind = docs.schema[id_col].dataType.simpleString()
    state = insert(empty_state(docs.sparkSession, min_docs, min_chars, kind), docs, id_col, text_col)
    return drop_lines(state, docs, id_col, text_col, state.refs.drop("step"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


SQL = f"""
WITH lines AS (
  SELECT doc_id, line, pos,
         translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), common AS (
  SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= {MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
), marked AS (
  SELECT lines.*, common.key IS NOT NULL AND doc_id <> last_doc AS dropped FROM lines LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
