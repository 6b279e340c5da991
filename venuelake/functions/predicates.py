"""Row tests shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment states that count as paid.
VALID_STATUS = ["CAPTURED", "AUTHORIZED", "CAPTURE_IN_PROGRESS"]


def not_voided(c: Column) -> Column:
    """NULL or exactly 'false'."""
    return c.isNull() | (c == "false")


def not_voided_lenient(c: Column) -> Column:
    """NULL or any text other than 'true', ignoring case."""
    return c.isNull() | (F.lower(c) != "true")


def valid_payment(c: Column) -> Column:
    return c.isin(VALID_STATUS)


def nonblank(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")
