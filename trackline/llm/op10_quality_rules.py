"""Quality rules: a hashed n-gram log-likelihood ratio between trusted and raw text, with plain text counts.

The threshold comes from the trusted documents themselves, each judged as if it were not in the sample: from the median of
their scores down to their lowest percent, and by MARGIN further. So the verdict means the same at every sample size.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm.common import SPACE, Words, arrow_map, at_place, ordered, shingles, table, text_groups, written
from trackline.llm.ngram_models import (BASE, BUCKETS, MIX, PAIR, PRIME, TARGET_DOCS, GramModels, marked, marked_counts,
                                        target_sample)

#: The share of trusted documents whose scores count as low, and how far below the median the threshold lies, as a
#: multiple of the way to that share.
LOW, MARGIN = 0.01, 1.25
#: Scores this close to the threshold are at it: sums in another order differ by less.
ROUNDING = 1e-9
MIN_WORDS, MAX_REPEATED, WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "log_ratio double, base_failed boolean, kept boolean")


def repeated_words(words: Words, window: int = WINDOW) -> np.ndarray:
    """For each text its words inside windows of `window` words that it holds twice or more, the first included."""
    at = words.runs(window)
    size = len(words.counts)
    if not len(at):
        return np.zeros(size, np.int64)
    run = shingles(words.numbers(), window)[at]
    with np.errstate(over="ignore"):
        run = run + words.text[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)  # the same in two texts is no repeat
    order = np.argsort(run)
    same = np.flatnonzero(run[order][1:] == run[order][:-1])
    starts = at[np.unique(np.concatenate([order[same], order[same + 1]]))]
    cover = np.zeros(len(words) + 1, np.int64)
    cover[starts] += 1
    cover[starts + window] -= 1
    return np.bincount(words.text[np.cumsum(cover)[:-1] > 0], minlength=size)


def line_repeats(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


def scores(texts: list[str | None], trusted: np.ndarray, models: GramModels, ratios: np.ndarray,
           threshold: float) -> list[np.ndarray | list]:
    """The result columns of some texts, in the order of the schema."""
    words, known = Words(*texts), [text or "" for text in texts]
    total, grams = models.sums(words, ratios, trusted)
    score = total / np.maximum(grams, 1)
    repeated = repeated_words(words)
    failed = (words.counts < MIN_WORDS) | (100 * repeated > MAX_REPEATED * words.counts)
    chars = np.bincount(words.text, words.ends - words.starts, len(texts)).astype(np.int64)
    return [words.counts, chars, [sum(map(text.count, SYMBOLS)) for text in known],
            [line_repeats(text) for text in known], repeated, score, failed, ~failed & (score >= threshold - ROUNDING)]


def _score(batches: Iterator[pa.RecordBatch], models: GramModels, threshold: float, column: str, flag: str,
           schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    ratios = models.ratios()
    for batch in batches:
        trusted = np.array([bool(own) for own in batch.column(flag).to_pylist()])
        parts = [scores(texts, trusted[first:first + len(texts)], models, ratios, threshold)
                 for first, texts in text_groups(batch.column(column).to_pylist())]
        columns = [pa.array(np.concatenate(part), kind)
                   for part, kind in zip(zip(*parts, strict=True), schema.types, strict=True)]
        kept = [batch.column(name) for name in batch.schema.names if name != flag]
        yield pa.RecordBatch.from_arrays([*kept, *columns],
                                         names=[*(n for n in batch.schema.names if n != flag), *schema.names])


_RESULT = pa.schema([(name, pa.int64()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                      "n_repeat_words")]
                    + [("log_ratio", pa.float64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(ordered(batch.column(0).to_numpy()))], names=["place"])


def fitted_threshold(scored: DataFrame) -> float:
    """The threshold from the scores of trusted documents that pass the base rules; none rejects nothing.

    The two scores are found by counts of their bits (see `at_place`), so no task holds them all.
    """
    places = written(arrow_map(scored.filter("NOT base_failed").select("log_ratio"), _places, "place long"), "trusted")
    many = places.count()
    if not many:
        return -np.inf
    found = [at_place(places, "place", many - ceil(Fraction(str(share)) * many) + 1) for share in (LOW, 0.5)]
    low, middle = (float(ordered(np.array([place])).view(np.float64)[0]) for place in found)
    return middle - MARGIN * (middle - low)


def _scored(docs: DataFrame, labels: DataFrame, threshold: float | None, buckets: int, target_docs: int | None, id_col: str,
            text_col: str) -> DataFrame:
    """`docs` with its columns named c0, c1, ..., so that none can clash with those of the result, which follow."""
    sample = target_sample(labels, (F.col("quality") == 1) & F.coalesce(F.col("toxic") == 0, F.lit(True)),
                           target_docs)
    names = [f"c{i}" for i in range(len(docs.columns))]
    given = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True))
    known, text = f"c{docs.columns.index(id_col)}", f"c{docs.columns.index(text_col)}"
    rows = marked(docs.toDF(*names), sample.withColumnRenamed("doc_id", known), "trusted", known)
    models = GramModels.of(marked_counts(rows, "trusted", text, buckets), buckets)

    def judged(rows: DataFrame, least: float) -> DataFrame:
        return arrow_map(rows, _score, f"{given}, {SCHEMA}", models, least, text, "trusted", _RESULT)

    if threshold is None:
        threshold = fitted_threshold(judged(rows.filter("trusted"), -np.inf))
    return judged(rows, threshold)


def score_quality(docs: DataFrame, labels: DataFrame, *, threshold: float | None = None, buckets: int = BUCKETS,
                  target_docs: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: its id, the counts, the mean log ratio and the verdict.

    The raw model counts every document, the target model all that are labelled quality 1 and not toxic (`target_docs` of
    them, chosen by the hash of the id, if that is given). Both are of fixed size, so the driver's part does not
    grow. Scoring is one pass; texts are shuffled only where more than COPIED_IDS are trusted (see `marked`). Without `threshold` one more pass scores
    the trusted documents alone (see `fitted_threshold`).

    Null or empty text has no words: log ratio 0, base_failed, not kept. Rows with equal ids or texts are scored
    each on its own, each trusted one without itself. Rows with a null id are scored but never trusted. Without trusted
    documents, or with a single one, all ratios of interest are 0 and only the base rules reject. Texts of any length
    are scored whole. An empty table gives no rows. Other columns, whatever their names, play no part.
    """
    given = docs.select(id_col, text_col)
    scored = _scored(given, labels, threshold, buckets, target_docs, id_col, text_col)
    return scored.select(F.col("c0").alias(id_col), *_RESULT.names)


def kept_documents(docs: DataFrame, labels: DataFrame, *, threshold: float | None = None, buckets: int = BUCKETS,
                   target_docs: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, with a positive verdict; see `score_quality`."""
    scored = _scored(docs, labels, threshold, buckets, target_docs, id_col, text_col).filter("kept")
    return scored.select(*(F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.drop("log_ratio")


SQL = f"""
WITH words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents)
), vocabulary AS (
  SELECT w, list_reduce(list_transform(string_split(w, ''), lambda c: unicode(c)::BIGINT),
                        lambda a, c: (a * {BASE} + c) % {PRIME}) % {PRIME} AS h
  FROM (SELECT DISTINCT w FROM words)
), placed AS (
  SELECT doc_id, pos, w, h, lead(h) OVER p AS after, lead(w, 1) OVER p AS w1, lead(w, 2) OVER p AS w2,
         lead(w, 3) OVER p AS w3, lead(w, 4) OVER p AS w4
  FROM words JOIN vocabulary USING (w) WINDOW p AS (PARTITION BY doc_id ORDER BY pos)
), grams AS (
  SELECT doc_id, h % {BUCKETS} AS bucket FROM placed
  UNION ALL SELECT doc_id, (h * {PAIR} + after) % {BUCKETS} FROM placed WHERE after IS NOT NULL
), trusted AS (
  SELECT DISTINCT doc_id FROM (
    SELECT doc_id FROM (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND coalesce(toxic, 0) = 0
                        AND doc_id IS NOT NULL)
    ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT {TARGET_DOCS})
), counts AS (
  SELECT bucket, count(*) AS raw, count(*) FILTER (WHERE trusted.doc_id IS NOT NULL) AS target
  FROM grams LEFT JOIN trusted USING (doc_id) GROUP BY bucket
), totals AS (SELECT sum(raw) + {BUCKETS} AS raws, sum(target)::DOUBLE AS targets FROM counts
), shares AS (SELECT bucket, target, targets, (raw + 1) / raws::DOUBLE AS share FROM counts, totals
), own AS (
  SELECT doc_id, bucket, count(*) AS times, trusted.doc_id IS NOT NULL AS known
  FROM grams LEFT JOIN trusted USING (doc_id) GROUP BY ALL
), lengths_of AS (SELECT doc_id, sum(times) AS many FROM own GROUP BY doc_id
), scores AS (
  SELECT doc_id, any_value(known) AS known, sum(times * CASE WHEN rest > 0 THEN
           ln((target - CASE WHEN known THEN times ELSE 0 END + {MIX} * share * rest) / ({1 + MIX} * rest)) - ln(share)
           ELSE 0 END) / any_value(many) AS score
  FROM (SELECT *, targets - CASE WHEN known THEN many ELSE 0 END AS rest
        FROM own JOIN shares USING (bucket) JOIN lengths_of USING (doc_id))
  GROUP BY doc_id
), runs AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, w, w1, w2, w3, w4) > 1 AS twice FROM placed
  WHERE w4 IS NOT NULL
), covered AS (
  SELECT doc_id, count(DISTINCT pos + k) AS n_repeat_words
  FROM runs, (SELECT unnest(range({WINDOW})) AS k) WHERE twice GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), lengths AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars FROM words GROUP BY doc_id
), result AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(score, 0) AS score, coalesce(known, FALSE) AS known
  FROM documents LEFT JOIN lengths USING (doc_id) LEFT JOIN lines USING (doc_id)
  LEFT JOIN covered USING (doc_id) LEFT JOIN scores USING (doc_id)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM result
), ranked AS (
  SELECT score, row_number() OVER (ORDER BY score) AS place, count(*) OVER () AS many
  FROM judged WHERE known AND NOT base_failed
), threshold AS (
  SELECT middle - {MARGIN} * (middle - low) AS least
  FROM (SELECT min(score) FILTER (WHERE place >= {LOW} * many) AS low,
               min(score) FILTER (WHERE place >= 0.5 * many) AS middle FROM ranked)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND (least IS NULL OR score >= least - {ROUNDING}) AS kept
FROM judged, threshold
"""
