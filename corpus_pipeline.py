"""From documents to a training mix: quality rules, line dedup, near dedup, decontamination, mixing of sources.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame; `run` writes
each result to the shared folder as Parquet and reads it again for the next stage. All stages but the last return
the columns of documents.

All stages take null in any column, empty and very long texts, repeated rows, ties, empty tables and further columns,
whatever their names; these are carried through. An empty table stays empty. Each stage says below what becomes of odd rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm.common import table, written
from trackline.llm.op3_decontamination import decontaminated
from trackline.llm.op4_dart_minhash import one_of_each
from trackline.llm.op5_mixing import mixed_documents
from trackline.llm.op6_line_dedup import dedup_lines
from trackline.llm.op10_quality_rules import kept_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the n-gram models keep; rejected ones go.

    Null, empty and blank texts have fewer than MIN_WORDS words and go. Repeated rows are judged alike, each on its own;
    a null id only keeps a row out of the trusted sample. A score at the threshold is kept.
    """
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many share; the last document that holds one keeps it.

    Null texts stay null, empty ones empty; a text that loses all its lines becomes empty. n_chars follows the text. Rows of
    one id count as one document for the number of holders, and each keeps or loses its lines by that id.
    """
    kept = dedup_lines(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    That with the smallest id stays; rows without words all stay, as they resemble nothing. Rows of one id are one
    document, of which one row stays. Texts shorter than a run of words are compared as a whole.
    """
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts hold none and stay, as do all where the benchmark is empty or its texts are null. Repeated rows are
    judged alike, null ids play no part, a score at the threshold is a leak.
    """
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken, with the number of the repetition in a further column.

    A null source is a source of its own and comes last. Null and empty texts have no words and are taken as often as their
    source is whole. Rows equal in id and text may be taken in part; ties of the seeded order are settled by the row.
    """
    return mixed_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SQL can express neither the signatures of near dedup nor the alignments of decontamination; the tests compare
#: every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
