"""Classifiers as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rulebook as rb
from ..functions.text import contains_any, normalize_description, starts_with_any, wire_party
from .rules import case_rules, first_match
from .windows import latest_per_key


# --- bank lines ---

def _line_test(text: Column, words: list[str], pattern: str | None) -> Column:
    """All words, then the pattern: the plain tests come first, so most lines never meet a regular expression."""
    tests = [text.contains(w) for w in words] + ([text.rlike(pattern)] if pattern else [])
    return reduce(and_, tests)


def categorize_bank(bank: DataFrame, rules: DataFrame, register: DataFrame, text_col: str = "description", processor: list[tuple] = rb.PROCESSOR_LINES) -> DataFrame:
    """Adds category, category_source and vendor_normalized.

    Paper checks look up the register; processor lines follow the rows of ``processor``; other lines
    follow the keyword rules on the normalized text, with the wire party preferred as vendor.
    ``rules``: keyword, category, vendor_normalized. Longer keywords are tried first.
    """
    ranked = rules.select(
        F.struct((-F.length("keyword")).alias("n"), F.col("keyword").alias("k")).alias("priority"), "keyword",
        F.col("category").alias("rule_category"), F.col("vendor_normalized").alias("rule_vendor"))
    base = bank.drop("category", "category_source", "vendor_normalized")
    d = F.trim(text_col)
    check_no = F.when(F.lower(d).startswith("check"), F.nullif(F.regexp_extract(d, r"(?i)^check\s+(\d+)$", 1), F.lit("")))
    reg = register.select(
        F.col("check_number").cast("string").alias("_check"), F.col("payee").alias("_payee"),
        F.nullif(F.col("category"), F.lit("")).alias("_reg_category"), F.nullif(F.col("vendor_normalized"), F.lit("")).alias("_reg_vendor"),
    )
    reg = latest_per_key(reg, ["_check"], [F.desc_nulls_last(c) for c in ("_reg_category", "_reg_vendor", "_payee")])
    # With an empty register a paper check is a line like any other.
    check_no = F.when(F.col("_listed") > 0, check_no)
    base_columns = base.columns
    base = base.withColumn("_listed", register.limit(1).agg(F.count("*")).scalar())
    step = base.withColumn("_no", check_no).withColumn("_norm", normalize_description(F.col(text_col)))
    # Lines without a check number get scattered keys that match nothing, so a shuffled join stays even.
    step = step.withColumn("_key", F.coalesce("_no", F.concat(F.lit("-"), F.xxhash64(*base_columns).cast("string"))))
    step = step.join(reg, F.col("_key") == F.col("_check"), "left")
    step = step.withColumn("_rule_text", F.when(F.col("_no").isNotNull(), F.col("_payee")).otherwise(F.col("_norm")))
    step = first_match(step, ranked, "_rule_text", ["rule_category", "rule_vendor"], mode="word")
    desc = F.col(text_col)
    is_check, listed, ruled = F.col("_no").isNotNull(), F.col("_check").isNotNull(), F.col("rule_category").isNotNull()

    def answer(category, source, vendor):
        return F.struct(category.alias("category"), F.lit(source).alias("category_source"), vendor.alias("vendor_normalized"))

    none = F.lit("Uncategorized")
    cases = [
        (is_check & listed & F.col("_reg_category").isNotNull(),
         answer(F.col("_reg_category"), "check_register", F.coalesce("_reg_vendor", "_payee"))),
        (is_check & listed & ruled, answer(F.col("rule_category"), "check_register", F.coalesce("rule_vendor", "_payee"))),
        (is_check & listed, answer(none, "uncategorized", F.coalesce(F.nullif(F.col("_payee"), F.lit("")), desc))),
        (is_check, answer(none, "uncategorized", desc)),
    ]
    # Shared parts become columns of their own, so that each is worked out once per line.
    step = step.withColumns({"_up": F.upper(d), "_wire": wire_party(desc)})
    known = case_rules([(_line_test(F.col("_up"), words, pattern), answer(F.lit(c), "auto", F.lit(v))) for words, pattern, c, v in processor], F.lit(None))
    step = step.withColumn("_processor", F.when(~is_check, known))
    cases.append((F.col("_processor").isNotNull(), F.col("_processor")))
    cases.append((ruled, answer(F.col("rule_category"), "auto", F.coalesce("_wire", "rule_vendor", desc))))
    default = answer(none, "uncategorized", F.coalesce(F.col("_wire"), F.nullif(F.col("_norm"), F.lit("")), desc))
    return step.withColumn("_a", case_rules(cases, default)).select(*base_columns, "_a.*")


# --- bank deposits and expense groups ---

def deposit_type(desc: Column, amount: Column, lines: list[tuple] = rb.DEPOSIT_LINES) -> Column:
    """Kind of the first row of ``lines`` (text, whether it must come first, sign or 0, kind) that fits; NULL if none does."""
    place = lambda text, first: desc.startswith(text) if first else desc.contains(text)
    sign = {1: amount > 0, -1: amount < 0, 0: F.lit(True)}
    return case_rules([(place(text, first) & sign[s], kind) for text, first, s, kind in lines], F.lit(None).cast("string"))


def expense_section(category: Column) -> Column:
    return case_rules([
        (contains_any(category, ["cost of goods", "cogs"]), "cogs"),
        (contains_any(category, ["labor", "payroll"]), "labor"),
        (contains_any(category, ["marketing", "entertainment", "promoter"]), "marketing"),
        (contains_any(category, ["operating", "opex"]), "opex"),
    ], F.lit("other"))


def cost_bucket(category: Column) -> Column:
    low = F.lower(category)
    return case_rules([
        (low.startswith("2.") | contains_any(category, ["cost of goods", "cogs"]), "cogs"),
        (low.startswith("3.") | contains_any(category, ["labor", "payroll"]), "labor"),
        (low.startswith("1.") | low.contains("revenue"), "revenue"),
    ], F.lit("opex"))


def prime_bucket(category: Column) -> Column:
    """Liquor and food cost of goods, other cost of goods (left out of prime), labor, else NULL."""
    low = F.lower(category)
    return case_rules([
        (low.startswith("2.") & low.contains("liquor cogs"), "liquor_cogs"),
        (low.startswith("2.") & low.contains("food cogs"), "food_cogs"),
        (low.startswith("2."), "other_cogs"),
        (low.startswith("3.") | low.contains("labor cost") | low.contains("payroll"), "labor"),
    ])


def sales_bucket(category: Column) -> Column:
    low = F.lower(category)
    return case_rules([
        (low.rlike(rb.LIQUOR_SALES), "liquor"), (low.rlike(rb.FOOD_SALES), "food"), (low.rlike(rb.SHISHA_SALES), "shisha"),
    ], F.lit("other"))


def expense_taxonomy(df: DataFrame, rules: list[tuple[str, str, str, str | None]], feed_map: DataFrame,
                     desc: str = "description", vendor: str = "vendor_normalized", category: str = "category",
                     date_col: str = "transaction_date") -> DataFrame:
    """Adds ``taxonomy``: vendor overrides, then numbered categories kept, then the feed's own
    category mapped by equality, then fallback words, else the category unchanged.

    ``rules`` rows are (kind, regex, target, from_date) with kind 'vendor' or 'fallback'.
    """
    text = F.concat_ws(" ", F.col(vendor), F.col(desc))

    def tests(kind):
        return [
            (text.rlike("(?i)" + rx) & (F.col(date_col) >= F.lit(d).cast("date") if d else F.lit(True)), target)
            for k, rx, target, d in rules if k == kind
        ]
    mapped = df.join(feed_map.select(F.col("feed_category").alias("_f"), F.col("taxonomy").alias("_m")),
                     F.col(category) == F.col("_f"), "left")
    cases = tests("vendor")
    cases.append((F.col(category).rlike(r"^\d+\."), F.col(category)))
    cases.append((F.col("_m").isNotNull(), F.col("_m")))
    cases += tests("fallback")
    return mapped.withColumn("taxonomy", case_rules(cases, F.col(category))).drop("_f", "_m")


# --- discounts ---

def comp_reason(reason: Column) -> Column:
    low = F.lower(reason)
    return case_rules([(low.contains(w), b) for w, b in rb.COMP_REASONS], F.lit("other"))


def comp_item(item: Column) -> Column:
    up = F.upper(F.trim(item))
    return case_rules([
        (up.contains("BIRTHDAY") | up.contains("BDAY"), "programmatic_birthday"),
        (up.contains("WYCLIFF"), "programmatic_standing"),
        (up.startswith("OWNER ") | up.startswith("$"), "owner_discretion"),
        (up.startswith("THURSDAY"), "programmatic_promoter"),
    ])


def comp_tab(tab: Column, owners: list[str], cap_key: Column | None = None) -> Column:
    """Bucket implied by a tab name; ``cap_key`` is the matched cap, if caps apply."""
    t = F.lower(F.trim(tab))
    owner = F.lit(False)
    for o in owners:
        owner = owner | t.startswith(o.lower()) | t.startswith("per " + o.lower())
    cases = [
        (starts_with_any(t, ["spill", "bug", "bottle broke"]) | t.contains("broke"), "recovery"),
        (owner & ~t.contains("tasting"), "owner_discretion"),
        (t.contains("owner tasting"), "owner_discretion"),
        (starts_with_any(t, ["vip -", "vip:", "vip "]), "vip"),
        (contains_any(t, rb.BIRTHDAY_WORDS), "programmatic_birthday"),
        (starts_with_any(t, ["promoter", "promo "]), "programmatic_promoter"),
        (starts_with_any(t, ["tasting", "distributor"]) | t.contains("wycliff"), "programmatic_marketing"),
    ]
    if cap_key is not None:
        cases.append((cap_key.isNotNull(), "programmatic_promoter"))
    return F.when(t != "", case_rules(cases))


def comp_final(tab_bucket: Column, item_bucket: Column, reason_bucket: Column) -> Column:
    return F.coalesce(tab_bucket, item_bucket, reason_bucket)


def match_cap(df: DataFrame, caps: DataFrame, tab: str = "tab_name", date_col: str = "processing_date") -> DataFrame:
    """Adds ``cap_key``: the first cap of that weekday one of whose signals is in the tab name.

    ``caps``: key, dow (Monday = 0), signals array, position.
    """
    signals = caps.select("position", "key", F.col("dow").alias("cap_dow"), F.explode("signals").alias("keyword"))
    out = first_match(df.withColumn("_dow", F.weekday(date_col)), signals, tab, ["key"],
                      priority="position", equal={"cap_dow": "_dow"})
    return out.withColumnRenamed("key", "cap_key").drop("_dow")


def owner_of_tab(tab: Column, owners: list[tuple[str, str]]) -> Column:
    """Owner whose word starts the tab or any word of it; ``owners`` is (word, owner), ordered."""
    t = F.lower(F.trim(tab))
    return case_rules([(F.concat(F.lit(" "), t).contains(" " + w.lower()), o) for w, o in owners])


def is_bottle(item: Column, category: Column, gross: Column) -> Column:
    up = F.upper(item)
    named = up.startswith("BTL ") | up.contains(" BTL") | up.startswith("OWNER ") | up.startswith("THURSDAY ")
    return F.coalesce(contains_any(category, ["liquor", "champagne"]) & (named | (gross >= 100)), F.lit(False))


def is_premium(item: Column) -> Column:
    return F.coalesce(~F.upper(item).startswith("OWNER ") & contains_any(item, rb.PREMIUM_WORDS), F.lit(False))


def with_retail_price(df: DataFrame, prices: DataFrame, aliases: DataFrame, item: str = "menu_item") -> DataFrame:
    """Adds ``retail_price``: the item's own price, else the price of the item it stands for."""
    p = prices.select("menu_item", "retail").groupBy("menu_item").agg(F.max("retail").alias("retail"))
    by_alias = aliases.join(p, aliases["retail_item"] == p["menu_item"]).select(
        aliases["menu_item"].alias("_a"), F.col("retail").alias("_alias_price")).groupBy("_a").agg(F.max("_alias_price").alias("_alias_price"))
    direct = p.select(F.col("menu_item").alias("_p"), F.col("retail").alias("_price"))
    return (
        df.join(direct, F.col(item) == F.col("_p"), "left").join(by_alias, F.col(item) == F.col("_a"), "left")
        .withColumn("retail_price", F.coalesce("_price", "_alias_price")).drop("_p", "_price", "_a", "_alias_price")
    )


# --- guests, time of day, thresholds ---

def guest_segment(visit_days: Column, recency: Column) -> Column:
    return case_rules([
        (recency > 90, "dormant"),
        ((visit_days >= 10) & (recency <= 30), "champions"),
        (visit_days >= 10, "loyal"),
        ((visit_days >= 5) & (recency <= 45), "regulars"),
        ((visit_days >= 3) & (recency > 45), "at_risk"),
        (visit_days >= 2, "returning"),
        (recency <= 30, "new"),
    ], F.lit("dormant"))


def guest_tier(visit_days: Column) -> Column:
    return case_rules([(visit_days >= 10, "Champions"), (visit_days >= 5, "Regulars"), (visit_days >= 2, "Returning")], F.lit("New"))


def guest_tags(segment: Column, spend: Column, visits: Column, house_tag: str = "House Guest") -> Column:
    tags = F.array(
        segment, F.when(spend >= 500, "High Spender").when(spend >= 100, "Medium Spender"),
        F.when(visits >= 5, "Frequent Visitor").when(visits >= 2, "Repeat Visitor"), F.lit(house_tag))
    return F.filter(tags, lambda x: x.isNotNull())


def daypart(hour: Column) -> Column:
    return case_rules([
        (hour.between(17, 22), "Pre-11p"), (hour.isin(23, 0), "Peak (11p-1a)"), (hour.between(1, 3), "Late (1a-close)"),
    ], F.lit("Other"))


def is_service_account(user: Column) -> Column:
    u = F.lower(F.trim(user))
    return F.coalesce(u.contains("example.com") | u.contains("@test") | u.rlike(rb.SYNTHETIC_USER), F.lit(False))


def grade(value: Column, good: Column, watch: Column, lower_is_better: Column) -> Column:
    low = F.when(value <= good, "good").when(value <= watch, "watch").otherwise("critical")
    high = F.when(value >= good, "good").when(value >= watch, "watch").otherwise("critical")
    return F.when(lower_is_better, low).otherwise(high)


def step_grade(value: Column, steps: list[tuple[float, str]], last: str) -> Column:
    """First step whose limit is above the value."""
    return case_rules([(value < limit, label) for limit, label in steps], F.lit(last))


def budget_status_pct(actual: Column, target: Column, maximum: Column) -> Column:
    return case_rules([(actual <= target, "under_budget"), (actual <= target + 2.0, "on_track"), (actual <= maximum, "watch")],
                      F.lit("over_budget"))


def budget_status_ratio(actual: Column, target: Column) -> Column:
    r = F.when(target > 0, actual / target).otherwise(F.when(actual == 0, 0.0).otherwise(2.0))
    return case_rules([(r <= 1.0, "under_budget"), (r <= 1.15, "on_track"), (r <= 1.30, "watch")], F.lit("over_budget"))


def menu_quadrant(popularity: Column, price_index: Column) -> Column:
    return case_rules([
        ((popularity >= 1) & (price_index >= 1), "Star"), (popularity >= 1, "Plowhorse"), (price_index >= 1, "Puzzle"),
    ], F.lit("Dog"))
