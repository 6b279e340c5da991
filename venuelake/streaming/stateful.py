"""Streams that keep event-time state, with nothing lost to the watermark.

A stateful operator drops what is older than its watermark. So a first query splits its input: each batch is held against
the newest event time of the batches before it, rows that are still on time go on to the stateful query, and late ones
are landed apart for an exact pass. The stateful query reads what was let through in that order, so its watermark is never ahead
of the one that let a row pass. State holds only what the watermark has not passed.

Every batch writes below a folder of its own number, which a replay overwrites.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from ..functions import dates
from ..session import shared_dir
from . import jobs


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition folders ``column=...`` right below ``path``, greatest first; no file is opened."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in files.listStatus(folder)] if files.exists(folder) else []
    return sorted((n.split("=", 1)[1] for n in names if n.startswith(f"{column}=") and not n.endswith("=__HIVE_DEFAULT_PARTITION__")), reverse=True)


def _batches(spark: SparkSession, path: str, schema, before: int | None = None) -> DataFrame:
    """What the batches (those before ``before``) have landed below ``path``."""
    if not partition_values(spark, path, "batch"):
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(0).cast("bigint"))
    rows = spark.read.schema(schema).parquet(f"{path}/batch=*").withColumn("batch", F.regexp_extract(F.col("_metadata.file_path"), r"batch=(\d+)", 1).cast("bigint"))
    return rows if before is None else rows.where(F.col("batch") < before)


def _event_time(ts: str) -> Column:
    """The wall-clock time read as UTC: watermarks need an instant, and hours must not depend on the session's time zone."""
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(`{ts}` AS TIMESTAMP_NTZ)))")


def admit(stream: DataFrame, path: str, checkpoint: str, ts: str, delay: str, until: Callable[[Column], Column]) -> None:
    """Split all available input into ``path``/ontime and ``path``/late; ``path``/seen has the newest event time so far, one row a batch.

    A row is late if what it counts for has ended (``until`` of its event time) by the newest event time of earlier batches less ``delay``,
    or if it has no event time.
    """
    spark = stream.sparkSession

    def land(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            seen = _batches(spark, f"{path}/seen", "newest timestamp_ntz", number).agg(F.max("newest").cast("string").alias("newest")).first().newest if number else None
            mark = F.lit(seen).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
            late = F.coalesce(until(F.col(ts).cast("timestamp_ntz")) <= mark, F.col(ts).isNull())
            batch.where(~late).write.mode("overwrite").parquet(f"{path}/ontime/batch={number:09d}")
            batch.where(late).write.mode("overwrite").parquet(f"{path}/late/batch={number:09d}")
            newest = F.greatest(F.max(F.col(ts).cast("timestamp_ntz")), F.lit(seen).cast("timestamp_ntz"))
            batch.agg(newest.alias("newest")).write.mode("overwrite").parquet(f"{path}/seen/batch={number:09d}")
        finally:
            batch.unpersist()

    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(land).start().awaitTermination()


def ontime_stream(spark: SparkSession, path: str, schema, max_files: int) -> DataFrame:
    """What ``admit`` let through, oldest batch first, so many files at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{path}/ontime/batch=*")


def windowed_revenue(spark: SparkSession, source: str, schema, prepare, ts: str, amount: str, delay: str = "4 hours", max_files: int = 1000, folder: str | None = None) -> DataFrame:
    """Hourly totals kept current from the payment feed, with the business day of each hour.

    ``prepare`` selects valid payments. Hours that may still change are event-time windows in the state; each batch lands the totals of the hours it
    changed. Payments of hours that the watermark has passed are correction sums. Reading takes the newest total of each hour and adds its
    corrections. ``folder`` keeps the state between runs.
    """
    path = folder or shared_dir(spark, "hourly")
    s = prepare(jobs.file_stream(spark, source, schema, max_files))
    hour = lambda t: F.date_trunc("hour", t).cast("timestamp_ntz")
    admit(s, path, f"{path}/checkpoint-admit", ts, delay, lambda t: hour(t) + F.expr("INTERVAL 1 HOUR"))
    on_time = ontime_stream(spark, path, s.schema, max_files).withColumn("_event", _event_time(ts)).withWatermark("_event", delay)
    totals = on_time.groupBy(F.window("_event", "1 hour").alias("w")).agg(F.count("*").alias("txns"), F.sum(amount).alias("revenue"))

    def land(batch: DataFrame, number: int) -> None:
        batch.select(F.expr("timestampadd(HOUR, CAST(unix_seconds(w.start) / 3600 AS INT), TIMESTAMP_NTZ'1970-01-01 00:00:00')").alias("hour_start"), "txns", "revenue").write.mode("overwrite").parquet(f"{path}/hours/batch={number:09d}")

    totals.writeStream.outputMode("update").option("checkpointLocation", f"{path}/checkpoint-hours").trigger(availableNow=True).foreachBatch(land).start().awaitTermination()
    kept = _batches(spark, f"{path}/hours", "hour_start timestamp_ntz, txns bigint, revenue double")
    newest = kept.groupBy("hour_start").agg(F.max_by(F.struct("txns", "revenue"), "batch").alias("t")).select("hour_start", "t.txns", "t.revenue")
    late = _batches(spark, f"{path}/late", s.schema).where(F.col(ts).isNotNull()).groupBy(hour(F.col(ts)).alias("hour_start")).agg(F.count("*").alias("txns"), F.sum(amount).alias("revenue"))
    now = newest.unionByName(late).groupBy("hour_start").agg(F.sum("txns").alias("txns"), F.sum("revenue").alias("revenue"))
    return now.select("hour_start", dates.business_date(F.col("hour_start")).alias("business_date"), "txns", F.round("revenue", 2).alias("revenue"))


def unique_events(spark: SparkSession, sources: list[str], schema, key: str, ts: str, overlap: str = "3 days", max_files: int = 1000, folder: str | None = None) -> DataFrame:
    """Overlapping deliveries of events that never change, each event once.

    Repeats within ``overlap`` of each other are dropped by the state; what comes later is landed apart and checked against the landed
    events of its own days only. Landed events are neither ranked nor shuffled at a read.
    """
    path = folder or shared_dir(spark, "unique")
    s = None
    for src in sources:
        one = jobs.file_stream(spark, src, schema, max_files)
        s = one if s is None else s.union(one)
    admit(s, path, f"{path}/checkpoint-admit", ts, overlap, lambda t: t)
    first = ontime_stream(spark, path, schema, max_files).withColumn("_event", _event_time(ts)).withWatermark("_event", overlap).dropDuplicatesWithinWatermark([key])

    def land(batch: DataFrame, number: int) -> None:
        batch.drop("_event").withColumn("day", F.to_date(ts)).write.mode("overwrite").partitionBy("day").parquet(f"{path}/landed/batch={number:09d}")

    first.writeStream.option("checkpointLocation", f"{path}/checkpoint-landed").trigger(availableNow=True).foreachBatch(land).start().awaitTermination()
    landed = spark.read.schema(_with(schema, "day")).option("basePath", f"{path}/landed").parquet(f"{path}/landed/batch=*").drop("batch")
    late = _batches(spark, f"{path}/late", schema).withColumn("day", F.to_date(ts))
    late = late.groupBy(key, "day").agg(F.min_by(F.struct(*[f.name for f in schema]), "batch").alias("e")).select("e.*", "day")
    known = landed.select(F.col(key).alias("_k"), F.col("day").alias("_d")).join(late.select("day").distinct(), F.col("_d") == F.col("day"), "left_semi")
    new = late.join(known, (F.col(key) == F.col("_k")) & F.col("day").eqNullSafe(F.col("_d")), "left_anti")
    return landed.drop("day").unionByName(new.drop("day"))


def land_with_cursor(stream: DataFrame, path: str, checkpoint: str, feed: str, cursor: str) -> None:
    """Process all available input; each batch lands its rows and then, as its commit, the newest position of each feed in it.

    Both are below the batch's number, so a replay writes the same again and a position never runs ahead of its rows.
    """
    def land(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{path}/rows/batch={number:09d}")
            batch.groupBy(F.col(feed).alias("feed")).agg(F.max(cursor).alias("cursor")).write.mode("overwrite").parquet(f"{path}/cursors/batch={number:09d}")
        finally:
            batch.unpersist()

    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(land).start().awaitTermination()


def cursors(spark: SparkSession, path: str, schema: str, initial: DataFrame | None = None) -> DataFrame:
    """feed and cursor: the newest committed position of each feed, never behind ``initial``."""
    rows = spark.read.schema(schema).parquet(f"{path}/cursors/batch=*")
    rows = rows if initial is None else rows.unionByName(initial.select("feed", "cursor"))
    return rows.groupBy("feed").agg(F.max("cursor").alias("cursor"))


def committed_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """Landed rows of the batches whose cursors are committed."""
    done = spark.read.parquet(f"{path}/cursors/batch=*").select(F.regexp_extract(F.col("_metadata.file_path"), r"batch=(\d+)", 1).cast("bigint").alias("batch")).distinct()
    return _batches(spark, f"{path}/rows", schema).join(done, "batch", "left_semi").drop("batch")


def newest_version(spark: SparkSession, path: str, schema, version: str, day: str):
    """The newest version of a table partitioned by the day of it, as text: read from the newest day that has one."""
    for value in partition_values(spark, path, day):
        found = spark.read.schema(schema).parquet(f"{path}/{day}={value}").agg(F.max(version).cast("string")).first()[0]
        if found is not None:
            return found
    return None


def since_watermark(spark: SparkSession, source: str, target: str, schema, version: str, day: str, overlap: str = "1 day", lookback: str = "90 days", unit: str = "day") -> DataFrame:
    """Source rows from the newest loaded version less an overlap; on a first run, from the newest source row less a lookback.

    Both tables are partitioned by the day of the version (or by the first day of its ``unit``). Folder names and one partition of the target (or source) give the start, and the read is
    pruned to the days from it on; within them row groups go by their statistics.
    """
    seen, less = newest_version(spark, target, schema, version, day), overlap
    if seen is None:
        seen, less = newest_version(spark, source, schema, version, day), lookback
    kind = next(f.dataType for f in schema if f.name == version).simpleString()
    if seen is None:
        return spark.read.schema(_with(schema, day)).parquet(source)
    # A plain literal, so that partitions and row groups are pruned while the read is planned.
    start = F.lit(spark.range(1).select((F.lit(seen).cast(kind) - F.expr(f"INTERVAL {less}")).cast("string").alias("start")).first().start).cast(kind)
    first = start.cast("date") if unit == "day" else F.trunc(start.cast("date"), unit)
    return spark.read.schema(_with(schema, day)).parquet(source).where((F.col(day) >= first) & (F.col(version) >= start))


def _with(schema, day: str):
    return StructType([f for f in schema if f.name != day]).add(day, DateType())
