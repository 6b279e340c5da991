"""Reusable joins. None pairs all rows with all rows; ranges meet on buckets of several sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import latest_per_key


def left_preaggregated(left: DataFrame, right: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """Left join to the right side summed per key; keys without rows get 0."""
    agg = right.groupBy(*keys).agg(*[F.sum(src).alias(out) for out, src in sums.items()])
    out = left.join(agg, keys, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in sums})


def align_periods(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Full outer alignment of two period aggregates; missing numbers become 0."""
    return a.join(b, key, "full_outer").na.fill(0)


#: Numbers of one level of buckets in a bucket of the next.
FAN = 16


def span_buckets(first: Column, last: Column) -> Column:
    """The whole numbers first to last as an array of disjoint buckets (level, number): a bucket of level k holds FAN ** k numbers.

    At most 2 * (FAN - 1) buckets a level, so a span of n numbers has O(log n) of them.
    """
    levels = F.sequence(F.lit(0), F.ceil(F.log(float(FAN), F.greatest(last - first + 1, F.lit(1)).cast("double")) + F.lit(0.5)).cast("int"))

    def of_level(level: Column) -> Column:
        size = F.pow(F.lit(FAN), level).cast("bigint")
        a, b = F.ceil(first / size).cast("bigint"), F.floor((last + 1) / size).cast("bigint")
        up, down = (F.ceil(a / FAN) * FAN).cast("bigint"), (F.floor(b / FAN) * FAN).cast("bigint")
        stop = F.least(b, up)
        numbers = lambda x, y: F.when(x < y, F.sequence(x, y - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(F.concat(numbers(a, stop), numbers(F.greatest(stop, down), b)), lambda n: F.struct(level.alias("level"), n.alias("number")))

    return F.flatten(F.transform(levels, of_level))


def join_spans(points: DataFrame, at: Column, spans: DataFrame, first: Column, last: Column) -> DataFrame:
    """Rows of ``points`` with every span that holds their whole number ``at``: an equi-join on buckets.

    A span is one row for each of its buckets, a point one row for each level that the spans use. Spans with a NULL end or of negative length hold nothing.
    """
    buckets = spans.where(first <= last).withColumn("_b", F.explode(span_buckets(first.cast("bigint"), last.cast("bigint"))))
    used = buckets.agg(F.sort_array(F.collect_set("_b.level"))).scalar()
    leveled = points.withColumn("_at", at.cast("bigint")).withColumn("_level", F.explode(used))
    keyed = leveled.withColumn("_number", F.floor(F.col("_at") / F.pow(F.lit(FAN), F.col("_level"))).cast("bigint"))
    buckets = buckets.withColumns({"_slevel": F.col("_b.level"), "_snumber": F.col("_b.number")}).drop("_b")
    return keyed.join(buckets, (F.col("_level") == F.col("_slevel")) & (F.col("_number") == F.col("_snumber"))).drop("_at", "_level", "_number", "_slevel", "_snumber")


def _day_number(c: Column) -> Column:
    return F.datediff(c, F.lit("1970-01-01").cast("date"))


def week_span_overlap(weeks: DataFrame, spans: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Weeks (by their Monday ``week_start``) with the calendar spans that overlap them."""
    number = lambda day: F.floor((_day_number(day) + 3) / 7)  # noqa: E731  1970-01-01 was a Thursday
    return join_spans(weeks, number(F.col("week_start")), spans, number(F.col(start)), number(F.col(end)))


def rows_in_windows(df: DataFrame, ts: str, windows: DataFrame, start: str = "window_start", end: str = "window_end") -> DataFrame:
    """Rows tagged with the time windows they fall in: a join on buckets of days, then the exact bounds."""
    both = join_spans(df, _day_number(F.to_date(ts)), windows, _day_number(F.to_date(start)), _day_number(F.to_date(end)))
    return both.filter(F.col(ts).between(F.col(start), F.col(end)))


def restrict_to_top(detail: DataFrame, key: str, value: Column, n: int, prefilter: Column | None = None) -> DataFrame:
    """Detail rows of the n keys with the largest summed value."""
    base = detail.filter(prefilter) if prefilter is not None else detail
    top = base.groupBy(key).agg(F.sum(value).alias("_v")).orderBy(F.desc("_v"), F.asc(key)).limit(n).select(key)
    return detail.join(top, key, "left_semi")


def prior_year_best_week(events: DataFrame, weekly: DataFrame) -> DataFrame:
    """Per event, the best week revenue of the same-named event one year before, NULL when none.

    ``events``: name, start_date, end_date. ``weekly``: week_start, revenue.
    """
    e = events.withColumn("year", F.year("start_date"))
    prior = week_span_overlap(weekly, e).groupBy("name", "year").agg(F.max("revenue").alias("historical_revenue"))
    prior = prior.withColumn("year", F.col("year") + 1)
    return e.join(prior, ["name", "year"], "left").select("name", "start_date", "end_date", "historical_revenue")


def primary_role(labor: DataFrame) -> DataFrame:
    """Job title with most hours per employee."""
    hours = (
        labor.filter(F.trim(F.coalesce("job_title", F.lit(""))) != "")
        .groupBy("employee_name", "job_title")
        .agg(F.sum(F.coalesce("regular_hours", F.lit(0.0)) + F.coalesce("overtime_hours", F.lit(0.0))).alias("hours"))
    )
    return latest_per_key(hours, ["employee_name"], [F.desc("hours"), F.asc("job_title")]).select(
        "employee_name", F.col("job_title").alias("primary_role"), "hours")
