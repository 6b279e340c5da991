"""Aggregation patterns shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_level(df: DataFrame, a: str, b: str, value: str, distinct: str) -> DataFrame:
    """Totals per a and per b in one pass over the (a, b) groups.

    ``additive`` counts sum the per-group distinct counts, as the original report does;
    ``exact`` counts each value once per level.
    """
    pairs = df.groupBy(a, b, distinct).agg(F.sum(value).alias("_v"))
    per = pairs.groupBy(a, b).agg(F.sum("_v").alias("_v"), F.count("*").alias("_n"))

    def level(name: str, col: str) -> DataFrame:
        additive = per.groupBy(F.col(col).alias("key")).agg(F.round(F.sum("_v"), 2).alias("value"), F.sum("_n").alias("additive"))
        exact = pairs.select(F.col(col).alias("key"), distinct).distinct().groupBy("key").agg(F.count("*").alias("exact"))
        return additive.join(exact, "key").select(F.lit(name).alias("level"), F.col("key").cast("string").alias("key"), "value", "additive", "exact")

    return level(a, a).unionByName(level(b, b))


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def top1_of_sums(df: DataFrame, key: str, label: str, value: str) -> DataFrame:
    """Per key, the label with the largest summed value; ties go to the first label."""
    sums = df.groupBy(key, label).agg(F.sum(value).alias("_v"))
    best = sums.groupBy(key).agg(F.min(F.struct((-F.col("_v")).alias("n"), F.col(label).alias("l"))).alias("_b"))
    return best.select(key, F.col("_b.l").alias(label), F.round(-F.col("_b.n"), 2).alias(value))


def with_period_total(monthly: DataFrame, month: str, sums: list[str]) -> DataFrame:
    """Months plus one 'total' row; ratios must be computed afterwards from the sums."""
    return (
        monthly.rollup(month).agg(*[F.sum(c).alias(c) for c in sums])
        .withColumn(month, F.coalesce(F.col(month), F.lit("total")))
    )
