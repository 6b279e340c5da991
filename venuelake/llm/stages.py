"""The stages of corpus_pipeline: each applies one operator to the documents it is given.

Columns other than those of documents are left out. Rows are never dropped for a NULL in any column; a stage only
drops what its operator decides against.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_documents
from .common import table
from .decontaminate import clean
from .line_dedup import dedup_lines
from .near_dedup import near_groups
from .quality_crf import classify

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field doesn't reject."""
    return classify(docs, table(spark, sf_dir, "labels"), keep=("text", "lang", "source", "n_chars")).where("predicted = 1").select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines and with n_chars anew; those of which no word is left go."""
    out = dedup_lines(docs, keep=("lang", "source", "n_chars"), purpose="pipeline-lines")
    gone = (F.col("n_removed") > 0) & ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    return out.where(~F.coalesce(gone, F.lit(False))).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    out = near_groups(docs, purpose="pipeline-near").where("not kept").select("doc_id").distinct()
    return docs.select(COLUMNS).join(out, "doc_id", "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return clean(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The encoding of each document."""
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
