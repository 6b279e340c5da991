"""Row selections that combine several tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any

SORTS = {
    "date_desc": ("transaction_date DESC", "description"),
    "date_asc": ("transaction_date", "description"),
    "amount_desc": ("abs_amount DESC", "description"),
    "amount_asc": ("abs_amount", "description"),
}


def item_log(items: DataFrame, price_list: DataFrame, owner_words: list[str], prefix: str = "OWNER ") -> DataFrame:
    """Discounted lines, lines of priced items, and prefixed items on an owner's tab.

    The price list joins on the item name (one row per name), so Spark broadcasts it only
    when its measured size allows and shuffles otherwise.
    """
    listed = price_list.select("menu_item").distinct().withColumn("_listed", F.lit(True))
    return (
        items.join(listed, "menu_item", "left")
        .filter(
            (F.col("discount") > 0)
            | F.col("_listed").isNotNull()
            | (F.upper("menu_item").startswith(prefix) & contains_any(F.col("tab_name"), owner_words))
        )
        .drop("_listed")
    )


def search_transactions(bank: DataFrame, status: str | None = None, text: str | None = None, start: str | None = None,
                        end: str | None = None, sort: str = "date_desc") -> DataFrame:
    """Bank lines by category source, text in description or vendor, and date bounds."""
    df = bank
    if status:
        df = df.filter(F.col("category_source") == status)
    if text:
        df = df.filter(contains_any(F.col("description"), [text])
                       | contains_any(F.coalesce("vendor_normalized", F.lit("")), [text]))
    if start:
        df = df.filter(F.col("transaction_date") >= F.lit(start).cast("date"))
    if end:
        df = df.filter(F.col("transaction_date") <= F.lit(end).cast("date"))
    return df.orderBy(*[F.expr(c.removesuffix(" DESC")).desc() if c.endswith(" DESC") else F.expr(c) for c in SORTS[sort]])


def history(df: DataFrame, equals: dict[str, str | None], date_col: str, start: str | None, end: str | None,
            order: list[Column], limit: int = 100) -> DataFrame:
    """Saved records with optional filters; the row limit is clamped to 1..500."""
    for c, v in equals.items():
        if v is not None:
            df = df.filter(F.col(c) == v)
    if start:
        df = df.filter(F.col(date_col) >= F.lit(start).cast("date"))
    if end:
        df = df.filter(F.col(date_col) <= F.lit(end).cast("date"))
    return df.orderBy(*order).limit(max(1, min(limit, 500)))
