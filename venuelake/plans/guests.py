"""Guest reports from card payments and named checks.

The guest frame (one row per card) is the only large intermediate; ranks over it go through
value histograms, never through one sorted task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.numbers import mean_money, pct, ratio_or_null, sum_if
from ..functions.predicates import nonblank, valid_payment
from ..functions.text import card_key, clean_phone, first_name, rest_of_name
from ..operators.classify import guest_segment, guest_tags, guest_tier
from ..operators.orderstats import top_shares
from ..operators.windows import latest_per_key

R2 = lambda c: F.round(c, 2)
BANDS = [("1 visit", 1, 1), ("2-3 visits", 2, 3), ("4-6 visits", 4, 6), ("7-12 visits", 7, 12), ("13-25 visits", 13, 25), ("26+ visits", 26, None)]
TOPS = [("Top 5%", 0.05), ("Top 10%", 0.10), ("Top 20%", 0.20), ("Top 50%", 0.50)]


def card_payments(payments: DataFrame, start: str, end: str) -> DataFrame:
    """Valid card payments of the period, newest load per payment, with card key and day."""
    p = payments.filter(valid_payment(F.col("status")) & nonblank(F.col("card_digits"))).withColumn("day", F.to_date("paid_ts"))
    p = dates.between_dates(p, "day", start, end).select("payment_id", "processing_date", "day", "paid_ts", "amount", "tip", "card_digits", "card_type")
    p = latest_per_key(p, ["payment_id"], [F.desc("processing_date"), F.desc("amount")])
    return p.withColumn("card", card_key(F.col("card_digits"), F.col("card_type")))


def rfm(cards: DataFrame, end: str) -> DataFrame:
    g = cards.groupBy("card").agg(
        F.count("*").alias("txn_count"), F.count_distinct("day").alias("visit_days"), R2(F.sum("amount")).alias("total_spend"), mean_money("amount", F.count("*")).alias("avg_per_visit"),
        F.round(ratio_or_null(F.sum("tip"), F.sum("amount")) * 100, 1).alias("tip_pct"), F.min("day").alias("first_seen"), F.max("day").alias("last_seen"))
    g = g.withColumn("recency_days", F.datediff(F.lit(end).cast("date"), F.col("last_seen")))
    return g.withColumn("segment", guest_segment(F.col("visit_days"), F.col("recency_days")))


def guest_kpis(guests: DataFrame) -> DataFrame:
    rep = F.col("visit_days") > 1
    g = guests.agg(
        F.count("*").alias("total_guests"), F.count_if(rep).alias("repeat_guests"), R2(F.sum("total_spend")).alias("total_revenue"), R2(sum_if(rep, "total_spend")).alias("repeat_revenue"),
        F.sum("txn_count").alias("txns"), F.sum(F.when(rep, F.col("visit_days"))).alias("rv"))
    return g.select("total_guests", "repeat_guests", "total_revenue", "repeat_revenue", pct(F.col("repeat_guests"), F.col("total_guests")).alias("repeat_pct"), pct(F.col("repeat_revenue"), F.col("total_revenue")).alias("repeat_rev_pct"),
                    F.round(ratio_or_null(F.col("rv"), F.col("repeat_guests")), 1).alias("avg_visits_repeat"), R2(ratio_or_null(F.col("total_revenue"), F.col("txns"))).alias("avg_spend"), R2(ratio_or_null(F.col("total_revenue"), F.col("total_guests"))).alias("rev_per_guest"))


def _with_totals(groups: DataFrame, guests: DataFrame) -> DataFrame:
    t = guests.agg(F.struct(F.count("*").alias("n"), F.sum("total_spend").alias("r"))).scalar()
    return groups.withColumn("_t", t).withColumns({"pct_guests": pct(F.col("guests"), F.col("_t.n")), "pct_revenue": pct(F.col("revenue"), F.col("_t.r")), "avg_spend": R2(F.col("revenue") / F.col("guests"))}).drop("_t")


def segments(guests: DataFrame) -> DataFrame:
    return _with_totals(guests.groupBy("segment").agg(F.count("*").alias("guests"), R2(F.sum("total_spend")).alias("revenue")), guests)


def frequency_bands(guests: DataFrame) -> DataFrame:
    band = F
    for label, lo, hi in BANDS:
        c = F.col("visit_days") >= lo
        band = band.when(c & (F.col("visit_days") <= hi) if hi else c, F.lit(label))
    return _with_totals(guests.groupBy(band.alias("band")).agg(F.count("*").alias("guests"), R2(F.sum("total_spend")).alias("revenue")), guests)


def concentration(guests: DataFrame) -> DataFrame:
    return top_shares(guests, "total_spend", TOPS)


def top_repeat(guests: DataFrame, n: int = 50) -> DataFrame:
    return guests.filter("visit_days > 1").orderBy(F.desc("visit_days"), F.desc("total_spend"), "card").limit(n)


def monthly_flow(cards: DataFrame) -> DataFrame:
    """Active, new and returning guests and repeat revenue per month.

    Payments are first reduced to one row per card and month; the first month is a second
    small aggregate of that frame.
    """
    m = cards.groupBy("card", dates.month_label(F.col("day")).alias("month")).agg(F.sum("amount").alias("amount"))
    x = m.join(m.groupBy("card").agg(F.min("month").alias("first_month")), "card")
    old = F.col("month") != F.col("first_month")
    g = x.groupBy("month").agg(F.count("*").alias("active_guests"), F.count_if(~old).alias("new_guests"), F.count_if(old).alias("returning_guests"), R2(F.sum("amount")).alias("total_revenue"), R2(sum_if(old, "amount")).alias("repeat_revenue"))
    return g.withColumn("repeat_rev_pct", pct(F.col("repeat_revenue"), F.col("total_revenue")))


def patterns(cards: DataFrame) -> DataFrame:
    """Tier by weekday and hour."""
    tiers = cards.groupBy("card").agg(F.count_distinct("day").alias("d")).select("card", guest_tier(F.col("d")).alias("tier"))
    x = cards.join(tiers, "card")
    return x.groupBy("tier", dates.dow_name(F.col("day")).alias("day_name"), dates.dow_num(F.col("day")).alias("dow_num"), F.hour("paid_ts").alias("hour")).agg(
        F.count("*").alias("txn_count"), R2(F.sum("amount")).alias("revenue"), mean_money("amount", F.count("*")).alias("avg_txn"))


def pattern_by_weekday(patterns_: DataFrame) -> DataFrame:
    """Weekday totals with one transaction column per tier."""
    tiers = ["Champions", "Regulars", "Returning", "New"]
    return patterns_.groupBy("dow_num", "day_name").agg(F.sum("txn_count").alias("txns"), R2(F.sum("revenue")).alias("revenue"), *[
        F.coalesce(F.sum(F.when(F.col("tier") == t, F.col("txn_count"))), F.lit(0)).alias(t.lower() + "_txns") for t in tiers])


def contacts(checks: DataFrame, payments: DataFrame, start: str, end: str) -> DataFrame:
    """Customer totals with a linked card and cleaned contact fields."""
    c = dates.between_dates(checks.filter(F.col("customer_id").isNotNull()), "processing_date", start, end)
    c = latest_per_key(c.select("check_id", "customer_id", "customer", "phone", "email", "total", "processing_date"), ["check_id"], [F.desc("processing_date"), F.desc("total"), *(F.desc_nulls_last(x) for x in ("customer_id", "customer", "phone", "email"))])
    p = dates.between_dates(payments.filter(valid_payment(F.col("status"))).withColumn("day", F.to_date("paid_ts")), "day", start, end)
    p = latest_per_key(p.select("payment_id", "check_id", "card_digits", "card_type", "processing_date"), ["payment_id"], [F.desc("processing_date"), F.desc_nulls_last("card_digits"), F.desc_nulls_last("card_type"), F.desc("check_id")])
    # One row per check before the join, so that several payments do not repeat a check's total.
    p = p.groupBy("check_id").agg(F.max("card_digits").alias("card"), F.max("card_type").alias("ctype"))
    g = c.join(p, "check_id", "left").groupBy("customer_id").agg(
        F.max("customer").alias("name"), F.max("phone").alias("raw_phone"), F.max("email").alias("email"), F.count_distinct("check_id").alias("visits"), R2(F.sum("total")).alias("total_spend"),
        mean_money("total", F.count("*")).alias("avg_check"), F.min("processing_date").alias("first_visit"), F.max("processing_date").alias("last_visit"), F.max("card").alias("linked_card"), F.max("ctype").alias("linked_card_type"))
    g = g.withColumns({"phone": clean_phone(F.col("raw_phone")), "email": F.coalesce(F.trim("email"), F.lit("")), "recency_days": F.datediff(F.lit(end).cast("date"), F.col("last_visit"))}).drop("raw_phone")
    return g.withColumn("segment", guest_segment(F.col("visits"), F.col("recency_days")))


def contact_export(contacts_: DataFrame) -> DataFrame:
    """Rows of the contact file: split name, tags, only guests with an e-mail or phone."""
    c = contacts_.filter((F.col("email") != "") | (F.col("phone") != ""))
    seg = F.initcap(F.replace(F.col("segment"), F.lit("_"), F.lit(" ")))
    return c.select(first_name(F.col("name")).alias("first_name"), rest_of_name(F.col("name")).alias("last_name"), "email", "phone", "visits", "total_spend", "avg_check", "first_visit", "last_visit",
                    seg.alias("segment"), F.array_join(guest_tags(seg, F.col("total_spend"), F.col("visits")), "; ").alias("tags"))
