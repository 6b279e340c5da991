"""The registered queries of the subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .bpe import encode_documents
from .common import table
from .decontaminate import contaminated
from .html_trees import extract_pages
from .importance import resample
from .langid import identify
from .line_dedup import dedup_lines
from .maxent_lm import score_texts
from .near_dedup import near_groups
from .packing import pack
from .perplexity_rules import judge
from .pii_crf import find
from .quality_crf import classify
from .spelling import variants
from .sql import OP12, OP13


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), words=3, percent=85)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), window=4096, end_id=2)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), max_words=1, buckets=10000, percent=10, least_words=20, seed=2024)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"), least=5, occurrences=3, ratio=2, noise=97)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_near_dedup": op2_near_dedup,
    "op3_lm_score": op3_lm_score,
    "op4_decontamination": op4_decontamination,
    "op5_bpe": op5_bpe,
    "op6_pii": op6_pii,
    "op7_langid": op7_langid,
    "op8_html": op8_html,
    "op9_quality_rules": op9_quality_rules,
    "op10_line_dedup": op10_line_dedup,
    "op11_packing": op11_packing,
    "op12_resampling": op12_resampling,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {"op12_resampling": OP12, "op13_spelling": OP13}
