"""Run logs, schema drift and table freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def schema_drift(incoming: DataFrame, target: DataFrame, computed: tuple[str, ...] = ("processing_date", "calculated_total")) -> DataFrame:
    """(change, column, filled) rows: columns new in the file and columns gone from it, with the
    number of rows that carry a value. Reported, never blocking."""
    def report(df: DataFrame, other: DataFrame, label: str) -> DataFrame | None:
        cols = sorted(set(df.columns) - set(other.columns) - set(computed))
        if not cols:
            return None
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols])
        return counts.unpivot([], cols, "column", "filled").select(F.lit(label).alias("change"), "column", "filled")

    parts = [p for p in (report(incoming, target, "new"), report(target, incoming, "removed")) if p is not None]
    if not parts:
        return incoming.sparkSession.createDataFrame([], "change string, column string, filled bigint")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def table_status(tables: dict[str, DataFrame], date_cols: dict[str, str]) -> DataFrame:
    """Row count and latest date per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows"), F.max(date_cols[name]).alias("latest")).select(F.lit(name).alias("table"), "rows", "latest")
        out = one if out is None else out.unionByName(one)
    return out


def freshness(status: DataFrame, today: str, stale_days: dict[str, int], default: int = 3) -> DataFrame:
    """Age of the latest date per feed with a stale flag by threshold."""
    limit = F.lit(default)
    for name, days in stale_days.items():
        limit = F.when(F.col("table") == name, F.lit(days)).otherwise(limit)
    age = F.datediff(F.lit(today).cast("date"), F.col("latest"))
    return status.select("table", "latest", age.alias("age_days"), (age > limit).alias("stale"))


def run_counts(rows: DataFrame, ok: Column) -> DataFrame:
    """file, rows and errors of each file from its rows with the test that a row must pass: one scan, one aggregate."""
    good = F.coalesce(ok, F.lit(False))
    return rows.groupBy("file").agg(F.count_if(good).alias("rows"), F.count_if(~good).alias("errors"))


def run_log(counts: DataFrame) -> DataFrame:
    """Status, rows and errors of each file (``file``, ``rows``, ``errors``), with a run row on top."""
    f = counts.withColumn("status", F.when((F.col("rows") > 0) & (F.col("errors") == 0), "success").when(F.col("rows") > 0, "partial").when(F.col("errors") > 0, "error").otherwise("skipped"))
    good, fail = F.count_if(F.col("status") == "success"), F.count_if(F.col("status").isin("error", "partial"))
    run = f.agg(F.sum("rows").alias("rows"), F.sum("errors").alias("errors"), good.alias("g"), fail.alias("b")).select(
        F.lit("(run)").alias("file"), "rows", "errors", F.when(F.col("b") == 0, "success").when(F.col("g") > 0, "partial_success").otherwise("failed").alias("status"))
    return run.unionByName(f.select("file", "rows", "errors", "status"))
