"""Safe arithmetic with the zero-denominator rules the reports use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_null(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    return F.try_divide(num, den)


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 or NULL."""
    return F.when(den != 0, num / den).otherwise(F.lit(0.0))


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """Rounded percentage, 0 when den is 0 or NULL."""
    return F.round(ratio_or_zero(num, den) * 100, digits)


def pct_of_positive(num: Column, den: Column, digits: int = 1) -> Column:
    """Rounded percentage of a revenue base; a base of 0 or less counts as 1."""
    return F.round(num / F.when(den > 0, den).otherwise(F.lit(1.0)) * 100, digits)


def pct_change(cur: Column, prior: Column, digits: int = 1) -> Column:
    """Percent change, NULL when prior is 0 or NULL."""
    return F.round(F.when(prior != 0, (cur - prior) / F.abs(prior) * 100), digits)


def money(c: Column) -> Column:
    return F.round(c, 2)


def sum0(c: Column | str) -> Column:
    """Sum, 0 for no rows."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def sum_if(cond: Column, value: Column | str) -> Column:
    """Conditional sum, 0 for no rows."""
    v = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(F.when(cond, v)), F.lit(0.0))


def dec_key(c: Column) -> Column:
    """Money as a join key: rounded decimal, never a raw double."""
    return F.round(c, 2).cast("decimal(18,2)")


def mean_money(amount: Column | str, count: Column) -> Column:
    """Mean of a money column from its sum in whole cents, NULL for no rows."""
    return F.round(F.try_divide(F.round(F.sum(amount) * 100), count)) / 100


def portion(amount: Column, share: float) -> Column:
    """A share of an amount, computed in cents so that halves round the same way everywhere."""
    return F.round(F.round(amount * 100) * F.lit(round(share * 100, 6)) / 100) / 100
