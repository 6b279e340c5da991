"""Exact order statistics without gathering a group in one task.

Values are money, so they are whole cents. For medians rows are first counted by value, which sums in
each task before the shuffle; all later steps run on these counts. The bucket holding the wanted rank is found on
a coarse histogram of them. Equal values are one counted row, so heavy ties cost nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_CENTS = 1 << 16


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


def upper_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """sorted(values)[n // 2] per key."""
    v = df.filter(F.col(value).isNotNull()).select(*keys, _cents(F.col(value)).alias("_c")).groupBy(*keys, "_c").agg(F.count("*").alias("_n"))
    v = v.withColumn("_b", F.floor(F.col("_c") / BUCKET_CENTS))
    hist = v.groupBy(*keys, "_b").agg(F.sum("_n").alias("_n"))
    up = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    allrows = W.partitionBy(*keys)
    pick = (
        hist.withColumn("_before", F.coalesce(F.sum("_n").over(up), F.lit(0)))
        .withColumn("_rank", F.floor(F.sum("_n").over(allrows) / 2))
        .filter((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
        .select(*keys, "_b", (F.col("_rank") - F.col("_before")).alias("_k"))
    )
    inside = v.join(pick, [*keys, "_b"])
    up2 = W.partitionBy(*keys).orderBy("_c").rowsBetween(W.unboundedPreceding, -1)
    return (
        inside.withColumn("_before", F.coalesce(F.sum("_n").over(up2), F.lit(0)))
        .filter((F.col("_before") <= F.col("_k")) & (F.col("_k") < F.col("_before") + F.col("_n")))
        .select(*keys, (F.col("_c") / 100).alias(name))
    )


def top_shares(df: DataFrame, value: str, tops: list[tuple[str, float | int]]) -> DataFrame:
    """(label, members, amount, pct) of the top members by value.

    A float is a share of all members (at least one member), an int a fixed number of members.
    """
    v = df.select(_cents(F.coalesce(F.col(value), F.lit(0.0))).alias("_c")).withColumn("_b", F.floor(F.col("_c") / BUCKET_CENTS))
    hist = v.groupBy("_b").agg(F.count("*").alias("_n"), F.sum("_c").alias("_s"))
    above = W.orderBy(F.desc("_b")).rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    total_n = F.sum("_n").over(everything)
    wanted = F.array(*[
        F.struct(F.lit(label).alias("label"), (F.greatest(F.lit(1), F.floor(F.col("_total_n") * F.lit(t))) if isinstance(t, float)
                                              else F.least(F.lit(t), F.col("_total_n"))).cast("bigint").alias("n"))
        for label, t in tops])
    pick = (
        hist.withColumn("_total_n", total_n).withColumn("_total", F.sum("_s").over(everything))
        .withColumn("_bn", F.coalesce(F.sum("_n").over(above), F.lit(0)))
        .withColumn("_bs", F.coalesce(F.sum("_s").over(above), F.lit(0)))
        .withColumn("_w", F.explode(wanted))
        .filter((F.col("_bn") < F.col("_w.n")) & (F.col("_w.n") <= F.col("_bn") + F.col("_n")))
        .select("_b", "_bn", "_bs", "_total", F.col("_w.label").alias("label"), F.col("_w.n").alias("members"))
    )
    values = v.join(pick.select("_b").distinct(), "_b", "left_semi").groupBy("_b", "_c").agg(F.count("*").alias("_n"))
    higher = W.partitionBy("label").orderBy(F.desc("_c")).rowsBetween(W.unboundedPreceding, -1)
    taken = F.greatest(F.lit(0), F.least(F.col("_n"), F.col("members") - F.col("_bn") - F.col("_before")))
    return (
        values.join(pick, "_b").withColumn("_before", F.coalesce(F.sum("_n").over(higher), F.lit(0)))
        .groupBy("label", "members", "_bs", "_total").agg(F.sum(F.col("_c") * taken).alias("_in"))
        .select("label", "members", ((F.col("_bs") + F.col("_in")) / 100).alias("amount"),
                F.round(F.when(F.col("_total") != 0, (F.col("_bs") + F.col("_in")) / F.col("_total") * 100).otherwise(0.0), 1).alias("pct"))
    )
