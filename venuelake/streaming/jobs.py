"""Incremental feeds as Structured Streaming jobs and their batch counterparts.

Streams land in a change table: each micro-batch is reduced to its newest row per key and
written under its own batch folder, so a replayed batch overwrites itself. Readers take the
newest version per key; a compaction rewrites the change table into a fresh folder. No batch
ever rewrites what earlier batches wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import upsert
from ..operators.windows import latest_per_key
from ..session import shared_dir


def file_stream(spark: SparkSession, path: str, schema, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def write_changes(batch: DataFrame, batch_id: int, path: str, keys: list[str], order: list[Column]) -> None:
    """Newest row per key of one micro-batch, under a folder named by the batch."""
    latest_per_key(batch, keys, order).write.mode("overwrite").parquet(f"{path}/batch={batch_id:09d}")


def run_upsert_stream(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order, mode: str = "append") -> None:
    """Process all available input and stop. ``order`` is a function giving the sort columns."""
    q = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(lambda df, i: write_changes(df, i, path, keys, order())).start()
    )
    q.awaitTermination()


def read_changes(spark: SparkSession, path: str, schema) -> DataFrame:
    """All changes with their batch number."""
    return spark.read.schema(schema).parquet(f"{path}/batch=*").withColumn(
        "batch", F.regexp_extract(F.col("_metadata.file_path"), r"batch=(\d+)", 1).cast("bigint"))


def current_rows(changes: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Newest version per key over all batches; the later batch wins a tie."""
    return latest_per_key(changes, keys, [*order, F.desc("batch")]).drop("batch")


def upsert_latest(spark: SparkSession, source: str, schema, prepare, keys: list[str], order) -> DataFrame:
    """Stream a folder of files into a change table and return the current rows."""
    path = shared_dir(spark, "changes")
    stream = prepare(file_stream(spark, source, schema))
    run_upsert_stream(stream, path, shared_dir(spark, "checkpoint"), keys, order)
    return current_rows(read_changes(spark, path, stream.schema), keys, order())


def run_batches(stream: DataFrame, path: str, checkpoint: str, reduce: Callable[[DataFrame], DataFrame]) -> None:
    """Process all available input; each micro-batch is reduced and written under its own folder, which a replay overwrites."""
    def land(batch: DataFrame, batch_id: int) -> None:
        reduce(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id:09d}")

    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(land).start().awaitTermination()


def windowed_revenue(spark: SparkSession, source: str, schema, prepare, ts: str, amount: str, max_files: int = 1000) -> DataFrame:
    """Hourly totals of the payment feed by event-time windows, late payments included."""
    from .stateful import windowed_revenue as run

    return run(spark, source, schema, prepare, ts, amount, max_files=max_files)


def deduplicated(spark: SparkSession, sources: list[str], schema, key: str, ts: str, max_files: int = 1000) -> DataFrame:
    """Overlapping deliveries read as one stream; of repeats, however late, the one with the newest ``ts`` stays (the earliest batch of equal ones)."""
    path = shared_dir(spark, "dedup")
    s = None
    for src in sources:
        one = file_stream(spark, src, schema, max_files)
        s = one if s is None else s.union(one)
    order = [F.desc(ts), *(F.asc_nulls_last(f.name) for f in schema)]
    run_batches(s, path, shared_dir(spark, "checkpoint"), lambda b: latest_per_key(b, [key], order))
    return latest_per_key(read_changes(spark, path, schema), [key], [*order, F.asc("batch")]).drop("batch")


def feed_changes(spark: SparkSession, source: str, schema, target: DataFrame, key: str, order, kind: str = "change", delete_removed: bool = False, max_files: int = 1000) -> DataFrame:
    """The target after all changes of a feed streamed from files: the newest change per key wins, a later batch a tie.

    ``order`` is a function giving the sort columns, newest first.
    """
    path = shared_dir(spark, "feed")
    run_batches(file_stream(spark, source, schema, max_files), path, shared_dir(spark, "checkpoint"), lambda b: latest_per_key(b, [key], order()))
    return apply_feed_changes(target, current_rows(read_changes(spark, path, schema), [key], order()), key, kind, delete_removed)


def compact(spark: SparkSession, path: str, schema, keys: list[str], order: list[Column]) -> str:
    """The change table in a fresh folder with one row per key, numbered as its last batch, so later batches go on after it."""
    changes = read_changes(spark, path, schema)
    last = changes.agg(F.max("batch")).first()[0]
    fresh = shared_dir(spark, "compacted")
    if last is not None:
        current_rows(changes, keys, order).write.parquet(f"{fresh}/batch={last:09d}")
    return fresh


# --- batch counterparts ---

def save_cursors(state: DataFrame, loaded: DataFrame, feed: str, cursor: str) -> DataFrame:
    """Cursor per feed after a load: the newest loaded position, never moving back."""
    new = loaded.groupBy(F.col(feed).alias("feed")).agg(F.max(cursor).alias("cursor"))
    return upsert(state, new, ["feed"], choose={"cursor": F.greatest("t.cursor", "s.cursor")})


def apply_feed_changes(target: DataFrame, changes: DataFrame, key: str, kind: str = "change", delete_removed: bool = False, order: list[Column] | None = None) -> DataFrame:
    """Added and modified rows merged by key; removed rows only counted unless asked to be deleted."""
    out = upsert(target, changes.filter(F.col(kind).isin("added", "modified")).select(*target.columns), [key], order)
    if delete_removed:
        out = out.join(changes.filter(F.col(kind) == "removed").select(key).distinct(), key, "left_anti")
    return out


def change_counts(changes: DataFrame, kind: str = "change") -> DataFrame:
    return changes.groupBy(kind).agg(F.count("*").alias("n"))


def late_corrections(target: DataFrame, source: DataFrame, key: str, version: str, day: str, days: int, today: str, tie: list[Column]) -> DataFrame:
    """Re-read the last n days and merge them; running it again changes nothing."""
    from ..operators.merge import merge_newest
    again = source.filter(F.col(day) >= F.date_sub(F.lit(today).cast("date"), days))
    return merge_newest(target, again.select(*target.columns), key, version, tie)
