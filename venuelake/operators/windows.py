"""Ranking, trend and share operators.

Picking the first rows per key uses row_number with a bound, which Spark turns into a local
limit before the shuffle, so a key holding a large part of the rows sends only its leaders.
Windows without a partition run only over small aggregates (months, value buckets).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= n)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order. Give a total order for a fixed winner."""
    return top_per_key(df, keys, order, 1, "_rn").drop("_rn")


def running_totals(monthly: DataFrame, order: str, sums: dict[str, str]) -> DataFrame:
    """Cumulative sums over a monthly frame (one row per month)."""
    w = W.orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return monthly.withColumns({out: F.round(F.sum(src).over(w), 2) for out, src in sums.items()})


def last_change(df: DataFrame, key: str, period: str, value: str) -> DataFrame:
    """Per key, the last two periods and the percent change; keys with one period are left out."""
    w = W.partitionBy(key).orderBy(F.desc(period))
    two = top_per_key(df.select(key, period, value), [key], [F.desc(period)], 2)
    paired = two.withColumn("prior", F.lead(value).over(w))
    return (
        paired.filter((F.col("rank") == 1) & F.col("prior").isNotNull())
        .select(key, period, F.col(value).alias("current"), "prior",
                F.when(F.col("prior") > 0, F.round((F.col(value) - F.col("prior")) / F.col("prior") * 100, 1)).alias("change_pct"))
    )


def trend3(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Per key, 'rising' or 'falling' over the last three points (ties count as rising), else ''."""
    last = top_per_key(df, keys, [F.desc(order)], 3)
    w = (last.groupBy(*keys) if keys else last.groupBy()).agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank"), F.col(value).alias("v")))).alias("p"))
    a, b, c = F.get("p", F.lit(2))["v"], F.get("p", F.lit(1))["v"], F.get("p", F.lit(0))["v"]
    return w.select(*keys, F.when((a <= b) & (b <= c), "rising").when((a >= b) & (b >= c), "falling").otherwise("").alias("trend"))


def with_share(df: DataFrame, value: str, name: str = "share_pct", digits: int = 1) -> DataFrame:
    """Row value as percent of the column total; the total is one scalar, not a global window."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn("_total", total).withColumn(
        name, F.round(F.when(F.col("_total") != 0, F.col(value) / F.col("_total") * 100).otherwise(0.0), digits)).drop("_total")


def trailing_mean(daily: DataFrame, keys: list[str], date_col: str, value: str, days: int = 28, weeks: int = 4) -> DataFrame:
    """Sum over the days before each date divided by the number of weeks (a mean, not a median)."""
    day_no = F.datediff(F.col(date_col), F.lit("1970-01-01").cast("date"))
    w = W.partitionBy(*keys).orderBy("_day").rangeBetween(-days, -1)
    return daily.withColumn("_day", day_no).withColumn("trailing_mean", F.sum(value).over(w) / weeks).drop("_day")
