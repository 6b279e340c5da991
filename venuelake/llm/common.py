"""Shared helpers: reading tables, staging in the shared folder, and Arrow batches cut to a bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelake.session import shared_dir

#: Bytes of text handled at once inside a task. A single longer text is handled alone.
CHUNK_BYTES = 2 << 20
#: Rows of an Arrow batch between the JVM and Python.
BATCH_ROWS = 512
#: Whether the shuffle files of an execution are deleted when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Rows of an Arrow batch are bounded, so a task holds few texts at once, long ones included."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written once to the shared folder and read back: later jobs neither recompute nor depend on executors.

    Nothing reads the shuffle files of the write again, so they go when it ends instead of when the driver next collects garbage.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def fold(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(modulus)


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with at most ``limit`` bytes of text (or one row), and the texts as UTF-8; NULL is empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = [x or b"" for x in batch.column(text).cast(pa.binary()).to_pylist()]
        first, size = 0, 0
        for i, x in enumerate(texts):
            if i > first and size + len(x) > limit:
                yield batch.slice(first, i - first), texts[first:i]
                first, size = i, 0
            size += len(x)
        yield batch.slice(first), texts[first:]


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def strings(values) -> pa.Array:
    return pa.array(values, type=pa.string())
