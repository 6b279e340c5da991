"""Birthday-package reconciliation between reservations, checks and item rings.

Two order-free passes: first the checks used by all on-check and tab matches, then the
off-book candidates among the rings those left over. Joins are on (date, check number) and
(date, party name); reservations are exploded to their check numbers, so no pair of tables
meets on the date alone except after an aggregate to one row per date and item word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rulebook as rb
from ..functions.numbers import pct
from ..functions.text import contains_any, int_list
from ..sources.sinks import stage

R2 = lambda c: F.round(c, 2)
ONE_CENT = 0.01


def champagne_rings(items: DataFrame, checks: DataFrame) -> DataFrame:
    k = ["check_id", "processing_date"]
    r = items.filter(contains_any(F.col("menu_item"), rb.CHAMPAGNE_WORDS)).select(*k, "item_selection_id", "server", "tab_name", "menu_item", "gross_price", "discount")
    r = r.join(checks.select(*k, "check_number"), k, "left")
    full = (F.col("discount") > 0) & (F.abs(F.col("discount") - F.col("gross_price")) < ONE_CENT)
    name = F.upper(F.trim("menu_item"))
    owner = (name.startswith("OWNER ") | name.startswith("$")) & (F.coalesce("discount", F.lit(0.0)) == 0)
    return r.withColumns({"comped": full, "cost_basis": owner, "bday_tab": F.coalesce(contains_any(F.col("tab_name"), rb.BIRTHDAY_WORDS), F.lit(False)),
                          "party": F.nullif(F.lower(F.regexp_extract(F.trim("tab_name"), rb.PARTY_TAB, 1)), F.lit(""))})


def birthday_reservations(reservations: DataFrame) -> DataFrame:
    r = reservations.filter(F.lower("status_simple").isin("complete", "seated") & (
        F.coalesce(contains_any(F.col("tags_json"), rb.BIRTHDAY_WORDS), F.lit(False)) | F.coalesce(contains_any(F.col("notes"), ["birthday"]), F.lit(False)) | F.coalesce(contains_any(F.col("client_requests"), ["birthday"]), F.lit(False))))
    return r.withColumns({"checks": int_list(F.col("check_numbers")), "registered": F.coalesce(contains_any(F.col("notes"), rb.PACKAGE_WORDS), F.lit(False)), "_dow": F.weekday("date")})


def check_spend(checks: DataFrame, payments: DataFrame) -> DataFrame:
    paid = payments.groupBy("check_id", "processing_date").agg(F.sum("amount").alias("paid"))
    return checks.select("check_id", "processing_date", "check_number").join(paid, ["check_id", "processing_date"], "left").groupBy(F.col("processing_date").alias("date"), "check_number").agg(F.coalesce(F.sum("paid"), F.lit(0.0)).alias("paid"))


def matched_checks(birthdays: DataFrame, rings: DataFrame, program: DataFrame) -> DataFrame:
    """(date, check_number) accounted for: the checks of registered birthday reservations, and all checks
    whose birthday tab names a registered guest on a program day."""
    res = birthdays.filter(F.col("registered") & (F.size("checks") > 0))
    own = res.select("date", F.explode("checks").alias("check_number"))
    named = res.join(program.select(F.col("dow").alias("_dow")), "_dow", "left_semi").select("date", F.lower(F.trim("first_name")).alias("party")).distinct()
    tabbed = rings.join(named, ["date", "party"], "left_semi").filter("check_number IS NOT NULL").select("date", "check_number")
    return own.union(tabbed).distinct()


def reconcile(reservations, items, checks, payments, program: DataFrame, min_spend: float = rb.PACKAGE_MIN_SPEND) -> DataFrame:
    """Delivery status per birthday reservation. ``program``: dow, word, mode."""
    birthdays = stage(birthday_reservations(reservations).select("reservation_id", "date", "first_name", "checks", "registered", "_dow"), "birthdays")
    res = birthdays.join(program.select(F.col("dow").alias("_dow"), "word", "mode"), "_dow", "left")
    rings = stage(champagne_rings(items, checks).withColumnRenamed("processing_date", "date"), "rings")
    ex = res.filter(F.col("registered")).select("reservation_id", "date", "word", "mode", F.posexplode("checks").alias("place", "check_number"))
    hit = F.contains(F.lower("menu_item"), F.col("word"))
    good = hit & F.when(F.col("mode") == "comped", F.col("comped")).when(F.col("mode") == "cost_basis", F.col("cost_basis")).otherwise(F.lit(True))
    # One row per listed check with what it paid and rang, then one per reservation.
    listed = ex.join(check_spend(checks, payments), ["date", "check_number"], "left").join(
        rings.select("date", "check_number", "menu_item", "comped", "cost_basis"), ["date", "check_number"], "left").groupBy("reservation_id", "place").agg(
        F.max("paid").alias("paid"), F.count("menu_item").alias("rings"), F.count_if(F.col("menu_item").isNotNull() & F.coalesce(good, F.lit(False))).alias("good"))
    on_checks = stage(listed.groupBy("reservation_id").agg(R2(F.coalesce(F.sum("paid"), F.lit(0.0))).alias("spend"), F.sum("rings").alias("rings"), F.sum("good").alias("good")), "reservation-checks")
    tabs = rings.filter(F.col("party").isNotNull()).groupBy("date", "party").agg(F.max("tab_name").alias("tab"))
    x = res.withColumn("party", F.lower(F.trim("first_name"))).join(tabs, ["date", "party"], "left").join(on_checks, "reservation_id", "left")
    x = x.na.fill({"spend": 0.0, "rings": 0, "good": 0})
    used = stage(matched_checks(birthdays, rings, program), "used-checks")
    # Pass 2: comped or cost-basis rings on birthday tabs of unused checks, one row per date and item word.
    spare = rings.filter((F.col("comped") | F.col("cost_basis")) & F.col("bday_tab")).join(used, ["date", "check_number"], "left_anti")
    words = program.select("word").distinct().agg(F.collect_list("word")).scalar()
    pool = spare.withColumn("_w", words).withColumn("word", F.explode("_w")).filter(F.contains(F.lower("menu_item"), F.col("word"))).select("date", "word").distinct().withColumn("spare", F.lit(True))
    x = x.join(pool, ["date", "word"], "left")
    enough = F.col("spend") >= min_spend
    status = (
        F.when(~F.col("registered"), "not_eligible").when(F.size("checks") == 0, "no_bridge").when(F.col("word").isNull(), "no_program").when(F.col("tab").isNotNull(), "delivered_attributed")
        .when((F.col("good") > 0) & (F.col("mode") == "cost_basis"), "delivered_cost_basis").when(F.col("good") > 0, "delivered_comped").when(F.col("rings") > 0, "wrong_item")
        .when(F.col("spare") & enough, "delivered_off_book").when(~enough, "sub_minimum").otherwise("not_delivered"))
    return x.select("reservation_id", "date", "first_name", "registered", "spend", "rings", status.alias("status"))


DELIVERED = ["delivered_attributed", "delivered_comped", "delivered_cost_basis", "delivered_off_book"]
NOT_OWED = ["not_eligible", "sub_minimum", "no_bridge", "no_program"]


def status_counts(recon: DataFrame) -> DataFrame:
    return recon.groupBy("status").agg(F.count("*").alias("n"), R2(F.sum("spend")).alias("spend"))


def rates(recon: DataFrame) -> DataFrame:
    owed = ~F.col("status").isin(NOT_OWED)
    g = recon.agg(F.count("*").alias("reservations"), F.count_if(owed).alias("eligible"), F.count_if(owed & F.col("status").isin(DELIVERED)).alias("delivered"), F.count_if(F.col("status") == "delivered_attributed").alias("attributed"))
    return g.withColumns({"delivery_rate": pct(F.col("delivered"), F.col("eligible")), "attributed_rate": pct(F.col("attributed"), F.col("eligible"))})


def ghosts(reservations, items, checks, program: DataFrame, house_words: list[str], house_tabs: list[str]) -> DataFrame:
    """Fully comped rings with no reservation behind them. Tabs that hold one of ``house_words`` or are one of ``house_tabs`` are the house's own."""
    t = F.lower(F.coalesce("tab_name", F.lit("")))
    house = contains_any(t, house_words) | t.isin(house_tabs)
    rings = stage(champagne_rings(items, checks).withColumnRenamed("processing_date", "date"), "rings")
    birthdays = stage(birthday_reservations(reservations).select("date", "first_name", "checks", "registered", "_dow"), "birthdays")
    r = rings.filter(F.col("comped") & F.col("check_number").isNotNull() & ~house)
    return r.join(matched_checks(birthdays, rings, program), ["date", "check_number"], "left_anti").select("date", "check_number", "item_selection_id", "menu_item", "tab_name", "gross_price")


def cost_basis_pattern(items, checks) -> DataFrame:
    r = champagne_rings(items, checks).filter("cost_basis AND bday_tab")
    return r.groupBy("menu_item", "tab_name").agg(F.count("*").alias("n"), R2(F.sum("gross_price")).alias("gross"))
