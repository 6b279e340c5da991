"""Cleaning of raw text columns: names, types, flags, load date."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dates import first_timestamp

# Accepted date-time layouts, in order of trial.
DATETIME_FORMATS = [
    "M/d/yy h:mm a", "M/d/yyyy h:mm a", "yyyy-MM-dd HH:mm:ss", "M/d/yy", "M/d/yyyy", "yyyy-MM-dd",
]
TRUE_WORDS = ["true", "yes", "1", "y"]
FALSE_WORDS = ["false", "no", "0", "n"]


# What becomes of the characters of a header that has no known name.
_HEADER_CHARS = str.maketrans({" ": "_", "/": "_", "-": "_", ".": "_", "#": "number"})


def clean_name(name: str, known: dict[str, str] | None = None) -> str:
    """Known header to its column name; other headers to lower case letters, digits and underscores."""
    if known and name in known:
        return known[name]
    plain = re.sub(r"[^0-9a-z_]", "", name.lower().translate(_HEADER_CHARS))
    return "_" + plain if plain[:1].isdigit() else plain


def rename_columns(df: DataFrame, known: dict[str, str] | None = None) -> DataFrame:
    return df.toDF(*[clean_name(c, known) for c in df.columns])


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def normalized_datetime_text(c: Column, formats: list[str] | None = None) -> Column:
    """Parsed text as 'yyyy-MM-dd HH:mm:ss'; text that no layout fits is kept."""
    t = first_timestamp(F.trim(c), formats or DATETIME_FORMATS)
    return F.coalesce(F.date_format(t, "yyyy-MM-dd HH:mm:ss"), c)


def to_number(c: Column) -> Column:
    """Double from text with thousands commas, NULL when it is not a number."""
    return F.regexp_replace(F.trim(c), ",", "").try_cast("double")


def to_flag(c: Column) -> Column:
    """Words for yes and no as a nullable boolean."""
    w = F.lower(F.trim(c))
    return F.when(w.isin(TRUE_WORDS), True).when(w.isin(FALSE_WORDS), False)


def type_by_name(df: DataFrame, numeric: set[str], flags: set[str] = frozenset()) -> DataFrame:
    """Cast by column name: numbers, flags, else text; unusable and empty values become NULL."""
    out = []
    for c in df.columns:
        v = F.col(c)
        if c in numeric:
            out.append(to_number(v).alias(c))
        elif c in flags:
            out.append(to_flag(v).alias(c))
        else:
            out.append(blank_to_null(v.cast("string")).alias(c))
    return df.select(*out)


def with_total(df: DataFrame, parts: tuple[str, ...] = ("amount", "tax", "tip", "gratuity"), name: str = "total") -> DataFrame:
    """Row total when all parts exist as columns; NULL if any part is NULL."""
    if not set(parts) <= set(df.columns):
        return df
    total = F.col(parts[0])
    for p in parts[1:]:
        total = total + F.col(p)
    return df.withColumn(name, total)


def load_date_from_path(path: Column) -> Column:
    """Date named by a yyyymmdd folder (or date=yyyy-mm-dd) in a file path."""
    digits = F.regexp_replace(F.regexp_extract(path, r"/(?:[a-z_]+=)?(\d{4}-?\d{2}-?\d{2})/[^/]*$", 1), "-", "")
    return F.to_date(F.try_to_timestamp(digits, F.lit("yyyyMMdd")))


def duration_seconds(c: Column) -> Column:
    """Seconds from texts such as '1 hour and 2 minutes and 3 seconds', '01:02:03' or '02:03'."""
    def part(unit: str) -> Column:
        return F.coalesce(F.regexp_extract(F.lower(c), rf"(\d+)\s*{unit}", 1).try_cast("int"), F.lit(0))
    words = part("hour") * 3600 + part("min") * 60 + part("sec")
    clock = F.split(c, ":")
    n = F.size(clock)
    secs = (
        F.when(n == 3, F.get(clock, F.lit(0)).try_cast("int") * 3600 + F.get(clock, F.lit(1)).try_cast("int") * 60 + F.get(clock, F.lit(2)).try_cast("int"))
        .when(n == 2, F.get(clock, F.lit(0)).try_cast("int") * 60 + F.get(clock, F.lit(1)).try_cast("int"))
    )
    return F.when(c.rlike(r"^\s*\d+(:\d+){1,2}\s*$"), secs).when(F.lower(c).rlike("hour|min|sec"), words)
