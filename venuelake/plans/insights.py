"""Findings as (key, severity, subject, value) rows; texts are left to the caller.

Each set reads the frames of the reports it comments on, so it adds small steps over a few rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Severity of a budget status, and the margin under which the weakest event is critical.
BUDGET_SEVERITY = {"over_budget": "critical", "watch": "warning", "on_track": "info"}
EVENT_MARGIN = 25


def _rows(df: DataFrame, key: Column | str, severity: Column | str, subject: Column | str, value: Column) -> DataFrame:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return df.select(lit(key).alias("key"), lit(severity).alias("severity"), lit(subject).alias("subject"), value.cast("double").alias("value"))


def _severity(status: Column) -> Column:
    out = F
    for name, severity in BUDGET_SEVERITY.items():
        out = out.when(status == name, severity)
    return out.otherwise("good")


def kpi_insights(scorecard: DataFrame, lower_is_better: DataFrame) -> DataFrame:
    """One row per metric: its status, and whether it got better since the prior period. ``lower_is_better``: metric, lower_is_better."""
    s = scorecard.join(lower_is_better.select("metric", "lower_is_better"), "metric")
    better = F.when(F.col("lower_is_better"), F.col("delta") < 0).otherwise(F.col("delta") > 0)
    change = F.when(better, "improved").when(F.col("delta") != 0, "worsened").otherwise("unchanged")
    return _rows(s, F.col("metric"), F.col("status"), change, F.col("value"))


def budget_insights(totals: DataFrame, lines: DataFrame, sublines: DataFrame, target_margin: float) -> DataFrame:
    """The margin, every budget line with its variance, and the sublines that are over or near their target."""
    m = F.col("margin_pct")
    overall = _rows(totals, "overall", F.when(m < 0, "critical").when(m < target_margin, "warning").otherwise("good"), F.col("margin_status"), m)
    main = _rows(lines, F.col("key"), _severity(F.col("status")), F.col("status"), F.col("variance"))
    late = sublines.filter(F.col("status").isin("over_budget", "watch"))
    return overall.unionByName(main).unionByName(_rows(late, F.concat(F.lit("sub_"), "key"), _severity(F.col("status")), F.col("status"), F.col("variance")))


def trend_insights(trends: DataFrame) -> DataFrame:
    """Costs that moved one way over three months (``metric``, ``trend``): a rising share of goods or labor is a warning, a falling labor share good."""
    t = trends.filter(((F.col("metric") == "cogs_pct") & (F.col("trend") == "rising")) | ((F.col("metric") == "labor_pct") & F.col("trend").isin("rising", "falling")))
    return _rows(t, F.concat(F.col("metric"), F.lit("_trend")), F.when(F.col("trend") == "rising", "warning").otherwise("good"), F.col("trend"), F.lit(None))


def budget_details(lines: DataFrame, vendors: DataFrame, n: int = 3) -> DataFrame:
    """Each line with its distance from the target in percentage points and money, and the ``n`` vendors behind it.

    ``lines``: key, status, variance, variance_pct. ``vendors``: key, rank, vendor_normalized, amount. A line under its target names no vendors.
    """
    named = vendors.filter(F.col("rank") <= n).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", F.concat("vendor_normalized", F.lit(" "), F.round("amount").cast("bigint").cast("string")).alias("text")))).alias("v"))
    x = lines.join(named, "key", "left")
    under = F.col("status") == "under_budget"
    return x.select("key", _severity(F.col("status")).alias("severity"), "variance_pct", F.when(F.col("variance") > 0, F.col("variance")).otherwise(0.0).alias("over"),
                    F.when(F.col("variance") < 0, -F.col("variance")).otherwise(0.0).alias("headroom"), F.when(~under, F.array_join(F.transform("v", lambda e: e["text"]), ", ")).alias("vendors"))


def event_insights(roi: DataFrame, unattributed: DataFrame) -> DataFrame:
    """Unmapped costs, the events with the highest and lowest return, the most revenue and the lowest share of costs. Ties go to the first name."""
    events = roi.filter("event <> '(all)'")
    loose = unattributed.agg(F.round(F.sum("amount"), 2).alias("amount"), F.count("*").alias("vendors")).filter("amount > 0")
    costly, earning = events.filter("total_costs > 0"), events.filter("total_costs > 0 AND adj_revenue > 0")
    first = lambda df, order: df.orderBy(*order, "event").limit(1)
    several = costly.agg(F.count("*")).scalar()
    worst = first(costly, [F.asc("roi_pct")]).withColumn("_n", several).filter("_n > 1")
    ratio = F.col("total_costs") / F.col("adj_revenue")
    parts = [
        _rows(loose, "unattributed", "warning", F.col("vendors").cast("string"), F.col("amount")),
        _rows(first(costly, [F.desc("roi_pct")]), "best_roi", "good", F.col("event"), F.col("roi_pct")),
        _rows(worst, "worst_roi", F.when(F.col("margin_pct") < EVENT_MARGIN, "critical").otherwise("warning"), F.col("event"), F.col("roi_pct")),
        _rows(first(events, [F.desc("adj_revenue")]), "top_revenue", "info", F.col("event"), F.col("adj_revenue")),
        _rows(first(earning.withColumn("_r", ratio), [F.asc("_r")]), "most_efficient", "info", F.col("event"), F.round(F.col("_r") * 100, 1)),
    ]
    return reduce(DataFrame.unionByName, parts)
