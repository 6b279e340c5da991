"""Business day, calendar labels and period parameters."""

from __future__ import annotations

import calendar
import re
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CUTOFF_HOUR = 4


def business_date(ts: Column, cutoff_hour: int = CUTOFF_HOUR) -> Column:
    """Times before the cutoff hour belong to the day before."""
    return F.to_date(ts - F.make_dt_interval(hours=F.lit(cutoff_hour)))


def month_label(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def week_start(d: Column) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", d))


def dow_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def dow_num(d: Column) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(d)


def between_dates(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Inclusive date range. On a date-partitioned table this prunes partitions."""
    return df.filter(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def bracketed_business_range(df: DataFrame, ts: str, load_date: str, start: str, end: str,
                             cutoff_hour: int = CUTOFF_HOUR) -> DataFrame:
    """Business-date range, plus a one-day-wider range on the load date so the scan can prune."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    return df.filter(F.col(load_date).between(F.date_sub(lo, 1), F.date_add(hi, 1))).filter(
        business_date(F.col(ts), cutoff_hour).between(lo, hi))


def layout_shape(layout: str) -> str:
    """A regular expression that every text of the layout fits; others may fit it too."""
    if set(layout) & set("'[]{}#"):
        return ""
    fields = {"yy": r"\d{2}", "yyyy": r"[+-]?\d{4,}"} | dict.fromkeys("M MM d dd H HH h hh m mm s ss".split(), r"-?\d+")
    parts = [m.group() for m in re.finditer(r"([A-Za-z])\1*|[^A-Za-z]", layout)]
    return "(?s)^" + "".join(fields.get(p, ".*") if p[0].isalpha() else re.escape(p) for p in parts) + "$"


def first_timestamp(c: Column, formats: list[str]) -> Column:
    """First format that parses, as a timestamp without zone, else NULL.

    A failed parse costs far more than a good one, so a format is tried only on texts of its shape.
    """
    return F.coalesce(*[F.when(c.rlike(layout_shape(f)), F.try_to_timestamp(c, F.lit(f))) for f in formats]).cast("timestamp_ntz")


def clock_hour(c: Column) -> Column:
    """Hour of a clock text such as '6:05 PM', NULL when it does not parse."""
    return F.hour(F.try_to_timestamp(c, F.lit("h:mm a")))


def clock_minutes(c: Column) -> Column:
    """Minutes after midnight of a clock text."""
    t = F.try_to_timestamp(c, F.lit("h:mm a"))
    return F.hour(t) * 60 + F.minute(t)


def prior_period(start: Column, end: Column) -> tuple[Column, Column]:
    """Same dates one month back when both fall in one month, else one year back; days clamp."""
    one_month = F.trunc(start, "month") == F.trunc(end, "month")
    return (
        F.when(one_month, F.add_months(start, -1)).otherwise(F.add_months(start, -12)),
        F.when(one_month, F.add_months(end, -1)).otherwise(F.add_months(end, -12)),
    )


# --- parameter windows: a handful of calendar dates, computed once on the driver ---

def last_full_week(today: date) -> tuple[date, date]:
    monday = today - timedelta(days=today.weekday() + 7)
    return monday, monday + timedelta(days=6)


def prior_full_week(today: date) -> tuple[date, date]:
    s, e = last_full_week(today)
    return s - timedelta(days=7), e - timedelta(days=7)


def trailing_days(today: date, n: int) -> tuple[date, date]:
    """n days ending yesterday."""
    end = today - timedelta(days=1)
    return end - timedelta(days=n - 1), end


def month_bounds(year: int, month: int) -> tuple[date, date]:
    return date(year, month, 1), date(year, month, calendar.monthrange(year, month)[1])


def trailing_months(today: date, n: int) -> list[tuple[str, date, date]]:
    """The n complete months before this one, oldest first."""
    first = today.year * 12 + today.month - 1 - n
    out = []
    for k in range(first, first + n):
        s, e = month_bounds(k // 12, k % 12 + 1)
        out.append((f"{s:%Y-%m}", s, e))
    return out


def pay_period(today: date, anchor_end: date) -> tuple[date, date]:
    """Latest 14-day period whose last day is not after today; periods end on the anchor grid."""
    end = anchor_end + timedelta(days=14 * ((today - anchor_end).days // 14))
    return end - timedelta(days=13), end


def period_table(spark: SparkSession, periods: list[tuple[str, date, date]]) -> DataFrame:
    """(label, start, end) rows; a few rows at most."""
    return spark.createDataFrame(periods, "label string, start date, end date")


def by_period(df: DataFrame, date_col: str, periods: list[tuple[str, date, date]]) -> DataFrame:
    """Tag each row with every period it falls in, in one scan.

    The labels are built as an array expression and exploded, so a row meets only its own
    periods and the filter on the outer bounds reaches the scan. Periods are report parameters.
    """
    lo, hi = min(p[1] for p in periods), max(p[2] for p in periods)
    d = F.col(date_col)
    hits = F.filter(
        F.array(*[F.when(d.between(F.lit(s), F.lit(e)), F.lit(label)) for label, s, e in periods]),
        lambda x: x.isNotNull(),
    )
    return df.filter(d.between(F.lit(lo), F.lit(hi))).withColumn("label", F.explode(hits))
