"""The package's registered queries, and their counterparts in SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trackline.llm import op1_importance as op1
from trackline.llm import op2_quotation_linking as op2
from trackline.llm import op3_decontamination as op3
from trackline.llm import op4_dart_minhash as op4
from trackline.llm import op5_mixing as op5
from trackline.llm import op6_line_dedup as op6
from trackline.llm import op7_warc as op7
from trackline.llm import op8_license_rules as op8
from trackline.llm import op9_secret_crf as op9
from trackline.llm import op10_quality_rules as op10
from trackline.llm import op11_qd_whitening as op11
from trackline.llm import op12_bloom_dedup as op12
from trackline.llm import op13_fp_tree_search as op13

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_importance": op1.op1_importance,
    "op2_quotation_linking": op2.op2_quotation_linking,
    "op3_decontamination": op3.op3_decontamination,
    "op4_dart_minhash": op4.op4_dart_minhash,
    "op5_mixing": op5.op5_mixing,
    "op6_line_dedup": op6.op6_line_dedup,
    "op7_warc": op7.op7_warc,
    "op8_license_rules": op8.op8_license_rules,
    "op9_secret_crf": op9.op9_secret_crf,
    "op10_quality_rules": op10.op10_quality_rules,
    "op11_qd_whitening": op11.op11_qd_whitening,
    "op12_bloom_dedup": op12.op12_bloom_dedup,
    "op13_fp_tree_search": op13.op13_fp_tree_search,
}

SQL: dict[str, str] = {
    "op2_quotation_linking": op2.SQL,
    "op6_line_dedup": op6.SQL,
    "op7_warc": op7.SQL,
    "op8_license_rules": op8.SQL,
    "op10_quality_rules": op10.SQL,
    "op12_bloom_dedup": op12.SQL,
    "op13_fp_tree_search": op13.SQL,
}
