"""Text expressions: bank descriptions, phones, names, tags, lists."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Telephone numbers entered in place of a real one.
DUMMY_PHONES = ["", "5555555555", "15555555555"]


def contains_any(c: Column, words: list[str]) -> Column:
    """Case-insensitive substring test against a word list."""
    low = F.lower(c)
    cond = F.lit(False)
    for w in words:
        cond = cond | low.contains(w.lower())
    return cond


def starts_with_any(c: Column, words: list[str]) -> Column:
    low = F.lower(c)
    cond = F.lit(False)
    for w in words:
        cond = cond | low.startswith(w.lower())
    return cond


def whole_word(words: list[str]) -> str:
    """Regex matching any of the words as a whole word."""
    return r"\b(?:" + "|".join(re.escape(w) for w in words) + r")\b"


def normalize_description(c: Column) -> Column:
    """The vendor part of a bank line: payee of a person-to-person transfer, else boilerplate removed.

    Plain prefix and substring tests guard the regular expressions, which most lines never need.
    """
    d = F.trim(c)
    low = F.lower(d)
    payee = F.regexp_extract(d, r'(?i)^zelle\s+payment\s+(?:to|from)\s+(.+?)(?:\s+for\s+.*|\s+conf#.*|[";]+.*)$', 1)
    plain = d
    for prefix, junk in (
        ("ach", r"(?i)^ach\s+(?:debit|credit|hold)\s+"),
        ("purchase", r"(?i)^purchase\s+(?:authorized\s+)?on\s+\d{2}/\d{2}\s+"),
        ("checkcard", r"(?i)^checkcard\s+\d{4}\s+"),
    ):
        plain = F.when(low.startswith(prefix), F.regexp_replace(d, junk, "")).otherwise(plain)
    plain = F.when(F.contains(d, F.lit("ID:")), F.regexp_replace(plain, r"\s+ID:\S*$", "")).otherwise(plain)
    plain = F.when(F.contains(d, F.lit("Conf#")), F.regexp_replace(plain, r"\s+Conf#.*$", "")).otherwise(plain)
    named = F.when(low.startswith("zelle"), F.nullif(F.regexp_replace(F.trim(payee), r'[";]+$', ""), F.lit("")))
    return F.coalesce(named, F.trim(plain))


def wire_party(c: Column) -> Column:
    """Beneficiary or originator named in a wire text, NULL for other texts."""
    bnf = F.trim(F.regexp_extract(c, r"BNF:([^/]+?)\s*ID:", 1))
    orig = F.trim(F.regexp_extract(c, r"ORIG:\d*/([^/]+?)\s*ID:", 1))
    return F.when(F.upper(c).contains("WIRE TYPE:"), F.coalesce(F.nullif(bnf, F.lit("")), F.nullif(orig, F.lit(""))))


def clean_phone(c: Column) -> Column:
    """'+1' and ten digits where possible; dummy numbers become empty."""
    p = F.trim(F.replace(c.cast("string"), F.lit(".0"), F.lit("")))
    ten = F.when((F.length(p) == 11) & p.startswith("1"), F.substring(p, 2, 10)).otherwise(p)
    return (
        F.when(p.isNull() | p.isin(DUMMY_PHONES), F.lit(""))
        .when(F.length(ten) == 10, F.concat(F.lit("+1"), ten))
        .otherwise(ten)
    )


def first_name(c: Column) -> Column:
    return F.coalesce(F.get(F.split(F.trim(c), r"\s+", 2), F.lit(0)), F.lit(""))


def rest_of_name(c: Column) -> Column:
    return F.coalesce(F.get(F.split(F.trim(c), r"\s+", 2), F.lit(1)), F.lit(""))


def first_of_list(c: Column, default: str = "Unknown") -> Column:
    """First entry of a comma list."""
    return F.coalesce(F.nullif(F.trim(F.get(F.split(c, ","), F.lit(0))), F.lit("")), F.lit(default))


def category_section(c: Column) -> Column:
    return F.substring_index(c, "/", 1)


def card_key(digits: Column, card_type: Column) -> Column:
    return F.concat(digits, F.lit("-"), F.coalesce(card_type, F.lit("")))


def int_list(c: Column) -> Column:
    """Whole numbers of a comma list; other entries are dropped."""
    nums = F.transform(F.split(c, ","), lambda x: F.when(F.trim(x).rlike(r"^\d+$"), F.trim(x)).try_cast("bigint"))
    return F.filter(nums, lambda x: x.isNotNull())


def first_line(c: Column) -> Column:
    return F.trim(F.get(F.split(c, "\n"), F.lit(0)))


def digits_only(c: Column) -> Column:
    return F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit(""))
