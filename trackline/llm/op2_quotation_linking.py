"""Quotation linking: quoted passages are told by their level, hashed sentence by sentence and joined to the message
that said them first; messages come in reply order and without quotes. Only DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackline.llm.common import table, written

PREFIX = r"^[ \t>]*>"
#: A line like this introduces the quoted line that follows it.
INTRODUCES = r"(wrote|schrieb|crit|escribi.)[^\n]*:[ \t\r]*$"
SENTENCE_END = r"[.!?]+\s"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, PREFIX, 0), r"[^>]", ""))


def _content(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, PREFIX, ""))


def sentences(text: Column) -> Column:
    """Normalised sentences: lower case, letters and digits only; how lines are broken does not count."""
    parts = F.split(F.regexp_replace(text, r"\s+", " "), SENTENCE_END)
    plain = F.transform(parts, lambda p: F.trim(F.regexp_replace(F.lower(p), r"[^\p{L}\p{N}]+", " ")))
    return F.array_distinct(F.filter(plain, lambda p: p != ""))


def parsed(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, passages): text without quoted lines and their introductions, and the passages,
    runs of lines of one level, as (level, passage)."""
    lines = messages.select("conv_id", "turn", "role", F.col("text").alias("whole"),
                            F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    lines = lines.withColumn("levels", F.transform("lines", _level))
    # the level of the next line decides whether a line introduces a quotation
    after = F.concat(F.slice("levels", F.lit(2), F.size("levels")), F.array(F.lit(0)))
    lines = lines.withColumn("marks", F.arrays_zip(F.col("lines").alias("line"), F.col("levels").alias("level"),
                                                   after.alias("after")))
    quoted = F.exists("levels", lambda level: level > 0)
    own = F.filter("marks", lambda m: (m["level"] == 0) & ~(m["line"].rlike(INTRODUCES) & (m["after"] > 0)))
    own = F.btrim(F.array_join(F.transform(own, lambda m: m["line"]), "\n"), F.lit(" \t\n\r"))
    levels = F.array_distinct(F.filter("levels", lambda level: level > 0))
    runs = F.flatten(F.transform(levels, lambda level: F.transform(
        F.split(F.array_join(F.transform("marks", lambda m: F.when(m["level"] == level, _content(m["line"]))
                                         .otherwise(F.lit("\n"))), " "), "\n"),
        lambda passage: F.struct(level.alias("level"), passage.alias("passage")))))
    runs = F.filter(runs, lambda run: F.size(sentences(run["passage"])) > 0)
    return lines.select("conv_id", "turn", "role", F.when(quoted, own).otherwise(F.col("whole")).alias("text"),
                        F.when(quoted, runs).otherwise(F.filter(runs, lambda run: F.lit(False))).alias("passages"))


def reply_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, n_linked) of the messages with a quoted passage whose origin is known.

    A sentence's origin is the first message of the conversation with it among its own text; only origins before the
    quoting message count. The parent is the message from which most sentences of level 1 come, of several the latest.
    Sentences are reduced to one row per conversation and hash before the join, so a frequent one makes no pairs.
    """
    passages = messages.select("conv_id", "turn", F.posexplode("passages").alias("number", "run"))
    units = passages.select("conv_id", "turn", "number", "run.level",
                            F.explode(sentences(F.col("run.passage"))).alias("unit"))
    units = units.withColumn("hash", F.md5("unit")).drop("unit")
    said = messages.select("conv_id", F.col("turn").alias("origin"), F.explode(sentences(F.col("text"))).alias("unit"))
    said = said.select("conv_id", "origin", F.md5("unit").alias("hash"))
    said = said.join(units.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi")
    said = said.groupBy("conv_id", "hash").agg(F.min("origin").alias("origin"))
    met = units.join(said, ["conv_id", "hash"]).filter("origin < turn")
    counts = met.groupBy("conv_id", "turn", "origin").agg(
        F.sum(F.when(F.col("level") == 1, 1).otherwise(0)).alias("n"))
    parents = counts.filter("n > 0").groupBy("conv_id", "turn").agg(
        F.max_by("origin", F.struct("n", "origin")).alias("parent_turn"))
    linked = met.groupBy("conv_id", "turn").agg(F.countDistinct("number").alias("n_linked"))
    return linked.join(parents, ["conv_id", "turn"], "left")


def reply_roots(links: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth): from every message with a parent to the top of its thread, doubling the step
    each round."""
    now = links.filter("parent_turn IS NOT NULL").select("conv_id", "turn", F.col("parent_turn").alias("root_turn"),
                                                         F.lit(1).cast("long").alias("depth"))
    now = written(now, "reply-roots")
    while True:
        up = now.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("up"),
                        F.col("depth").alias("more"))
        further = now.join(up, ["conv_id", "root_turn"], "left")
        if further.filter("up IS NOT NULL").isEmpty():
            return now
        now = written(further.select("conv_id", "turn", F.coalesce("up", "root_turn").alias("root_turn"),
                                     (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "reply-roots")


def placed(rows: DataFrame) -> DataFrame:
    """The rows with their place in the conversation, from 1, by (root_turn, turn, role, text).

    Rows are dealt by ranges of that order, so a long conversation is spread over tasks; only one count per range
    and conversation is added up.
    """
    order = [F.col(c).asc_nulls_last() for c in ("conv_id", "root_turn", "turn", "role", "text")]
    dealt = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "reply-ranges")
    before = F.sum("rows").over(W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = dealt.groupBy("part", "conv_id").agg(F.count(F.lit(1)).alias("rows")).select(
        F.col("part").alias("part_"), F.col("conv_id").alias("conv_"), F.coalesce(before, F.lit(0)).alias("start"))
    own = F.row_number().over(W.partitionBy("part", "conv_id").orderBy(*order[1:]))
    met = dealt.join(starts, (F.col("part") == F.col("part_")) & F.col("conv_id").eqNullSafe(F.col("conv_")))
    return met.withColumn("place", own + F.col("start")).drop("part", "part_", "conv_", "start")


def linked_conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: (conv_id, turn, role, parent_turn, root_turn, depth, place, n_passages, n_linked, text).

    `text` is without quoted lines; a message without any stays as it is. `parent_turn` is the message it answers,
    null if its quotations are of unknown origin or it has none; `root_turn` is the top of its thread and `depth`
    the steps to there. `place` numbers a conversation's messages in reply order: thread by thread, each in the
    order of turns, so a message never comes before the one it answers.

    A null text has no lines and stays null. Messages with a null conversation or turn are never linked and come
    last. Rows of the same conversation and turn share their quotations' links. An empty table gives no rows. Other
    columns play no part.
    """
    rows = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                           F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = written(parsed(rows), "messages")
    links = written(reply_links(rows), "reply-links")
    roots = reply_roots(links)
    found = rows.join(links, ["conv_id", "turn"], "left").join(roots, ["conv_id", "turn"], "left")
    return placed(found.select(
        "conv_id", "turn", "role", "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), F.size("passages").cast("long").alias("n_passages"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "text")).withColumn(
            "place", F.col("place").cast("long"))


def op2_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_conversations(table(spark, sf_dir, "conversations"))


def _sql_sentences(text: str) -> str:
    return (f"list_distinct(list_filter(list_transform(regexp_split_to_array(regexp_replace({text}, '\\s+', ' ', 'g'), "
            f"'{SENTENCE_END}'), lambda p: trim(regexp_replace(lower(p), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))), "
            "lambda p: p <> ''))")


SQL = f"""
WITH RECURSIVE numbered AS (SELECT *, row_number() OVER () AS row FROM conversations
), split AS (
  SELECT row, conv_id, turn, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT *, string_split(coalesce(text, ''), chr(10)) AS parts FROM numbered)
), levelled AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '{PREFIX}'), '[^>]', '', 'g')) AS level FROM split
), looked AS (
  SELECT *, coalesce(lead(level) OVER (PARTITION BY row ORDER BY pos), 0) AS after,
         pos - row_number() OVER (PARTITION BY row, level ORDER BY pos) AS run FROM levelled
), own AS (
  SELECT row, bool_or(level > 0) AS quoted, trim(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (
           WHERE level = 0 AND NOT (regexp_matches(line, '{INTRODUCES}') AND after > 0)), ''),
           ' ' || chr(9) || chr(10) || chr(13)) AS kept
  FROM looked GROUP BY row
), messages AS (
  SELECT row, conv_id, turn, role, CASE WHEN quoted THEN kept ELSE text END AS text
  FROM numbered JOIN own USING (row)
), runs AS (
  SELECT row, conv_id, turn, level, run,
         string_agg(trim(regexp_replace(line, '{PREFIX}', '')), ' ' ORDER BY pos) AS passage
  FROM looked WHERE level > 0 GROUP BY ALL
), passages AS (
  SELECT * FROM (SELECT *, {_sql_sentences('passage')} AS units FROM runs) WHERE len(units) > 0
), said AS (
  SELECT conv_id, unit, min(turn) AS origin
  FROM (SELECT conv_id, turn, unnest({_sql_sentences("coalesce(text, '')")}) AS unit FROM messages)
  GROUP BY ALL
), met AS (
  SELECT conv_id, turn, level, run, origin
  FROM (SELECT conv_id, turn, level, run, unnest(units) AS unit FROM passages) JOIN said USING (conv_id, unit)
  WHERE origin < turn
), parents AS (
  SELECT conv_id, turn, arg_max(origin, (n, origin)) AS parent_turn
  FROM (SELECT conv_id, turn, origin, count(*) AS n FROM met WHERE level = 1 GROUP BY ALL) GROUP BY ALL
), linked AS (SELECT conv_id, turn, count(DISTINCT (level, run)) AS n_linked FROM met GROUP BY ALL
), walk AS (
  SELECT conv_id, turn, parent_turn AS root_turn, 1 AS depth FROM parents
  UNION ALL
  SELECT walk.conv_id, walk.turn, parents.parent_turn, depth + 1
  FROM walk JOIN parents ON parents.conv_id = walk.conv_id AND parents.turn = walk.root_turn
), roots AS (SELECT conv_id, turn, arg_max(root_turn, depth) AS root_turn, max(depth) AS depth FROM walk GROUP BY ALL
), counted AS (SELECT row, count(*) AS n_passages FROM passages GROUP BY row
), found AS (
  SELECT m.conv_id, m.turn, role, parent_turn, coalesce(root_turn, m.turn) AS root_turn, coalesce(depth, 0) AS depth,
         coalesce(n_passages, 0) AS n_passages, coalesce(n_linked, 0) AS n_linked, text
  FROM messages m LEFT JOIN counted USING (row) LEFT JOIN parents USING (conv_id, turn)
  LEFT JOIN linked USING (conv_id, turn) LEFT JOIN roots USING (conv_id, turn)
)
SELECT conv_id, turn, role, parent_turn, root_turn, depth::BIGINT AS depth, n_passages::BIGINT AS n_passages,
       n_linked::BIGINT AS n_linked, text, row_number() OVER (PARTITION BY conv_id ORDER BY root_turn NULLS LAST,
         turn NULLS LAST, role NULLS LAST, text NULLS LAST) AS place
FROM found
"""
