"""Merge operators: what the target looks like after incoming rows are applied.

Each returns the new content of the target as a lazy frame; ``sources.sinks`` writes it to a
staging folder and swaps, so a path is never read and overwritten at once. Incoming rows are
deduplicated per key first (a bounded row_number, cut down before the shuffle), then target
and incoming meet in one full outer join on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import dec_key
from .classify import categorize_bank
from .windows import latest_per_key

BANK_KEY = ["transaction_date", "description", "amount_key"]
MANUAL = "manual"


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column] | None = None,
           choose: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """Update matched rows and insert the rest.

    In ``choose`` and ``when`` the two sides are the structs ``t`` and ``s``. ``choose`` gives
    the merged value of a column (default: the incoming one); ``when`` limits which matched
    rows change. Key columns must be free of NULL on the incoming side.
    """
    cols = target.columns
    if order is not None:
        incoming = latest_per_key(incoming, keys, order)
    t = target.select(*[F.col(k).alias(f"_tk_{k}") for k in keys], F.struct(*cols).alias("t"))
    s = incoming.select(*[F.col(k).alias(f"_sk_{k}") for k in keys], F.struct(*cols).alias("s"))
    on = None
    for k in keys:
        c = F.col(f"_tk_{k}") == F.col(f"_sk_{k}")
        on = c if on is None else on & c
    both = t.join(s, on, "full_outer")
    matched = F.col("t").isNotNull() & F.col("s").isNotNull()
    change = matched & (when if when is not None else F.lit(True))
    out = []
    for c in cols:
        new = (choose or {}).get(c, F.col(f"s.{c}"))
        out.append(F.when(F.col("t").isNull(), F.col(f"s.{c}")).when(F.coalesce(change, F.lit(False)), new).otherwise(F.col(f"t.{c}")).alias(c))
    return both.select(*out)


def replace_days(target: DataFrame, incoming: DataFrame, day: str = "processing_date") -> DataFrame:
    """Every day present in the incoming rows is replaced as a whole."""
    return target.join(incoming.select(day).distinct(), day, "left_anti").select(*target.columns).unionByName(incoming.select(*target.columns))


def insert_if_absent(target: DataFrame, incoming: DataFrame, day: str = "processing_date") -> DataFrame:
    """Incoming days are added only where the target has none of that day."""
    fresh = incoming.join(target.select(day).distinct(), day, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def merge_register(target: DataFrame, incoming: DataFrame, order: list[Column], keep_category: bool = False) -> DataFrame:
    """Check register: last row per check wins; optionally an empty incoming category keeps the old one."""
    choose = {"category": F.coalesce(F.nullif(F.col("s.category"), F.lit("")), F.col("t.category"))} if keep_category else None
    return upsert(target, incoming, ["check_number"], order, choose)


def with_bank_key(df: DataFrame) -> DataFrame:
    return df.withColumn("amount_key", dec_key(F.col("amount")))


def _unless_manual(column: str) -> Column:
    return F.when(F.col("t.category_source") == MANUAL, F.col(f"t.{column}")).otherwise(F.col(f"s.{column}"))


def merge_bank_statement(target: DataFrame, incoming: DataFrame, order: list[Column]) -> DataFrame:
    """Statement upload: metadata always refreshed, a manual category is kept."""
    choose = {c: _unless_manual(c) for c in ("category", "category_source", "vendor_normalized")}
    return upsert(with_bank_key(target), with_bank_key(incoming), BANK_KEY, order, choose).drop("amount_key")


def merge_bank_posted(target: DataFrame, incoming: DataFrame, order: list[Column]) -> DataFrame:
    """Posted-only feed: category, vendor and load columns are taken from the feed, all others stay.

    Rows changed by hand, and rows whose category_source is NULL, stay as they are.
    """
    taken = {"category", "category_source", "vendor_normalized", "source_file", "upload_date", "upload_batch_id"}
    choose = {c: F.col(f"t.{c}") for c in target.columns if c not in taken}
    return upsert(with_bank_key(target), with_bank_key(incoming), BANK_KEY, order, choose, F.col("t.category_source") != MANUAL).drop("amount_key")


def merge_bank_fill(target: DataFrame, incoming: DataFrame, order: list[Column]) -> DataFrame:
    """Aggregator feed: fills only a missing category and vendor, never on rows changed by hand."""
    choose = {c: F.col(f"t.{c}") for c in target.columns}
    choose["category"] = F.coalesce("t.category", "s.category")
    choose["vendor_normalized"] = F.coalesce("t.vendor_normalized", "s.vendor_normalized")
    choose["category_source"] = F.coalesce(F.nullif(F.col("t.category_source"), F.lit("")), F.col("s.category_source"))
    choose["source_file"] = F.col("s.source_file")
    when = F.coalesce(F.col("t.category_source"), F.lit("")) != MANUAL
    return upsert(with_bank_key(target), with_bank_key(incoming), BANK_KEY, order, choose, when).drop("amount_key")


def drop_cross_source_twins(bank: DataFrame, is_feed: Column, in_batch: Column | None = None, keys: tuple[str, ...] = ("transaction_date", "vendor_normalized")) -> DataFrame:
    """Remove the one non-feed row that repeats a feed row of the batch just loaded (same date, amount and vendor).

    ``in_batch`` marks the rows of that batch (default: all feed rows). Where two or more non-feed rows share the
    key nothing is removed. Counts per key are aggregated first, so a frequent key is one row in the join.
    """
    b = with_bank_key(bank).withColumns({"_feed": is_feed, "_new": is_feed if in_batch is None else is_feed & in_batch})
    k = [*keys, "amount_key"]
    counts = b.filter(F.col("vendor_normalized").isNotNull()).groupBy(*k).agg(
        F.count_if(F.col("_new")).alias("_fed"), F.count_if(~F.col("_feed")).alias("_other"))
    twins = counts.filter((F.col("_fed") > 0) & (F.col("_other") == 1)).select(*k, F.lit(False).alias("_feed"))
    return b.join(twins, [*k, "_feed"], "left_anti").select(*bank.columns)


def merge_newest(target: DataFrame, incoming: DataFrame, key: str, version: str, tie: list[Column]) -> DataFrame:
    """Newest version per key; an older incoming row never overwrites."""
    newer = F.col(f"s.{version}") >= F.coalesce(F.col(f"t.{version}"), F.col(f"s.{version}"))
    return upsert(target, incoming.filter(F.col(key).isNotNull()), [key], [F.desc_nulls_last(version), *tie], when=newer)


def upsert_rules(rules: DataFrame, incoming: DataFrame, order: list[Column]) -> DataFrame:
    """Keyword rules keyed by the keyword without regard to case."""
    k = lambda d: d.withColumn("_key", F.upper(F.trim("keyword")))
    return upsert(k(rules), k(incoming), ["_key"], order).drop("_key")


def delete_rules(rules: DataFrame, keywords: DataFrame) -> DataFrame:
    gone = keywords.select(F.upper(F.trim("keyword")).alias("_key")).distinct()
    return rules.withColumn("_key", F.upper(F.trim("keyword"))).join(gone, "_key", "left_anti").drop("_key")


def seed_rules(rules: DataFrame, defaults: DataFrame) -> DataFrame:
    """The default rules when the table is empty, else the table as it is."""
    has_rows = rules.limit(1).agg(F.count("*")).scalar()
    return rules.unionByName(defaults.withColumn("_n", has_rows).filter("_n = 0").drop("_n").select(*rules.columns))


def _last_edits(edits: DataFrame, order: list[Column] | None, name: str) -> DataFrame:
    """One edit per line: the first in ``order``, else the one with the greatest category."""
    return latest_per_key(with_bank_key(edits), BANK_KEY, [*(order or []), F.desc("category")]).select(*BANK_KEY, F.col("category").alias(name))


def recategorize(bank: DataFrame, edits: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Manual category edits by (date, description, amount to the cent). Give ``order`` (newest first) where a line may be edited twice."""
    e = _last_edits(edits, order, "_new")
    hit = F.col("_new").isNotNull()
    return (
        with_bank_key(bank).join(e, BANK_KEY, "left")
        .withColumn("category", F.coalesce("_new", "category"))
        .withColumn("category_source", F.when(hit, MANUAL).otherwise(F.col("category_source")))
        .select(*bank.columns)
    )


def recategorize_audit(bank: DataFrame, edits: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """The change log of ``recategorize`` with the same ``order``: one row per changed bank line."""
    e = _last_edits(edits, order, "new_category")
    return with_bank_key(bank).join(e, BANK_KEY).select(
        "transaction_date", "description", "amount", F.col("category").alias("old_category"), "new_category")


def delete_transactions(bank: DataFrame, keys: DataFrame) -> DataFrame:
    """Remove lines by key; an amount of 0 also removes lines whose amount is NULL."""
    zeroed = lambda d: d.withColumn("amount_key", dec_key(F.coalesce("amount", F.lit(0.0))))
    return zeroed(bank).join(zeroed(keys).select(*BANK_KEY).distinct(), BANK_KEY, "left_anti").select(*bank.columns)


def recategorize_checks(bank: DataFrame, rules: DataFrame, register: DataFrame) -> DataFrame:
    """Run the categorizer again on uncategorized paper checks and take what it finds."""
    old = bank.withColumnsRenamed({c: f"_old_{c}" for c in ("category", "category_source", "vendor_normalized")})
    new = categorize_bank(old, rules, register)
    fix = (
        (F.col("_old_category") == "Uncategorized") & F.col("description").rlike(r"(?i)^check\s+\d+")
        & (F.col("category") != "Uncategorized")
    )
    fix = F.coalesce(fix, F.lit(False))
    return new.withColumns({c: F.when(fix, F.col(c)).otherwise(F.col(f"_old_{c}")) for c in ("category", "category_source", "vendor_normalized")}).select(*bank.columns)
