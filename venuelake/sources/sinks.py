"""Writers. A folder that is being read is never overwritten in place.

New content goes to a fresh staging folder first; replacing whole days then uses dynamic
partition overwrite, which touches only the days written and may be repeated at will.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from . import status


def write_days(df: DataFrame, path: str, day: str = "processing_date") -> None:
    """Replace in ``path`` exactly the days present in ``df``; other days stay untouched.

    The rebalance hint groups rows by day, splits a heavy day over several tasks and merges
    light ones, from the sizes Spark measures.
    """
    (
        df.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(day).parquet(path)
    )


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to a new shared folder and continue from the files: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merge_partitions(spark: SparkSession, path: str, incoming: DataFrame, part: str, merge: Callable[[DataFrame, DataFrame], DataFrame], moving: list[str] | None = None) -> None:
    """Merge ``incoming`` into the table at ``path``, stored by ``part`` (a date or number that both have), touching only the partitions concerned.

    The incoming rows give the partitions; only those are read, handed to ``merge`` (target, incoming) and replaced. If a key
    (``moving``) can change its partition, the partitions that hold incoming keys now are found by a scan of the key columns alone. The merged
    rows are staged before anything is replaced, so a failed run can be repeated. Partition values, not rows, reach the driver.
    """
    incoming = stage(incoming, "incoming")
    table = spark.read.schema(incoming.schema).parquet(path).select(*incoming.columns)
    touched = incoming.select(part).distinct()
    if moving:
        held = table.select(*moving, part).join(incoming.select(*moving).distinct(), moving, "left_semi").select(part)
        touched = touched.union(held).distinct()
    values = [r[0] for r in touched.collect()]
    some = F.col(part).isin([v for v in values if v is not None])
    merged = stage(merge(table.where(some | F.col(part).isNull() if None in values else some), incoming).select(*incoming.columns), "merged")
    write_days(merged, path, part)
    # A partition that lost its last row is not among those written.
    emptied = set(values) - {r[0] for r in merged.select(part).distinct().collect()}
    for value in emptied:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def load_observed(rows: DataFrame, ok: Column, path: str, files: list[str], file: str = "file") -> DataFrame:
    """Write the rows for which ``ok`` holds and return the run log (``status.run_log``), counted while the rows are written.

    ``files`` are the files of the run, also those without rows; rows of other files are counted under a NULL file.
    """
    seen, good = Observation(), F.coalesce(ok, F.lit(False))
    listed = F.coalesce(F.col(file).isin(files), F.lit(False))
    tests = [F.col(file) == f for f in files] + [~listed]
    counts = [F.count_if(t & g).alias(f"{n}{i}") for i, t in enumerate(tests) for n, g in (("rows", good), ("errors", ~good))]
    rows.observe(seen, *counts).where(good).write.mode("errorifexists").parquet(path)
    got = seen.get
    log = [(f, got[f"rows{i}"], got[f"errors{i}"]) for i, f in enumerate([*files, None]) if f is not None or got[f"rows{i}"] + got[f"errors{i}"]]
    return status.run_log(rows.sparkSession.createDataFrame(log, "file string, rows bigint, errors bigint"))


def replace_day_table(base: DataFrame, incoming: DataFrame, day: str = "processing_date") -> DataFrame:
    """Load base days, then replace the incoming days, then read the table back."""
    spark = base.sparkSession
    path = shared_dir(spark, "days")
    write_days(base, path, day)
    write_days(incoming.select(*base.columns), path, day)
    return read_days(spark, path, base, day)


def read_days(spark: SparkSession, path: str, like: DataFrame, day: str) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def round_trip_csv(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(df.sparkSession, purpose)
    df.write.mode("errorifexists").option("header", True).option("emptyValue", "").csv(path)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path).na.fill("")
