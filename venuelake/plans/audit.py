"""Loss-prevention audits and staff behavior."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.numbers import pct, sum_if
from ..functions.text import contains_any
from ..operators.classify import is_service_account

R2 = lambda c: F.round(c, 2)
VOID_FORMATS = ["yyyy-MM-dd HH:mm:ss", "M/d/yy h:mm a", "M/d/yyyy h:mm a"]


def _same_person(a: Column, b: Column) -> Column:
    a, b = F.lower(F.trim(a)), F.lower(F.trim(b))
    word = lambda c: F.get(F.split(c, " "), F.lit(0))
    return F.coalesce((a != "") & (b != "") & ((a == b) | F.contains(b, word(a)) | F.contains(a, word(b))), F.lit(False))


def voids(payments: DataFrame) -> DataFrame:
    """Voided payments with self-approval, cash and the seconds until the void (both text layouts are read upstream)."""
    v = payments.filter(F.col("void_user").isNotNull() & (F.col("void_user") != ""))
    return v.select(
        "payment_id", "check_id", "processing_date", "server", "amount", "payment_type", "void_user", "void_approver", _same_person(F.col("server"), F.col("void_user")).alias("self_approved"),
        F.coalesce(contains_any(F.col("payment_type"), ["cash"]), F.lit(False)).alias("is_cash"), F.timestamp_diff("SECOND", F.col("paid_ts"), F.col("void_ts")).alias("secs_to_void"), is_service_account(F.col("void_user")).alias("synthetic_user"))


def void_seconds_from_text(paid: Column, void: Column) -> Column:
    """Seconds between two void texts in any accepted layout."""
    p, v = dates.first_timestamp(paid, VOID_FORMATS), dates.first_timestamp(void, VOID_FORMATS)
    return F.timestamp_diff("SECOND", p, v)


def void_summary(v: DataFrame, fast: int = 120) -> DataFrame:
    tests = {"all": F.lit(True), "cash": F.col("is_cash"), "self_approved": F.col("self_approved"), "fast": F.coalesce(F.col("secs_to_void") < fast, F.lit(False)), "synthetic_user": F.col("synthetic_user")}
    g = v.agg(*[F.struct(F.lit(k).alias("signal"), F.count_if(c).alias("n"), R2(sum_if(c, "amount")).alias("dollars")).alias(k) for k, c in tests.items()])
    return g.select(F.explode(F.array(*tests)).alias("r")).select("r.*")


def approver_pairs(payments: DataFrame, end: str, days: int = 90, min_events: int = 3, min_dollars: float = 500.0, n: int = 20) -> DataFrame:
    e = F.lit(end).cast("date")
    v = payments.filter(F.col("processing_date").between(F.date_sub(e, days), e) & F.col("void_user").isNotNull() & (F.col("void_user") != ""))
    g = v.groupBy(F.coalesce("void_approver", F.lit("")).alias("approver"), F.coalesce("server", F.lit("")).alias("server"), "void_user").agg(F.count("*").alias("events"), R2(F.sum("amount")).alias("dollars"))
    g = g.filter((F.col("events") >= min_events) | (F.col("dollars") >= min_dollars)).orderBy(F.desc("dollars"), "approver", "server", "void_user").limit(n)
    return g.withColumn("synthetic_user", is_service_account(F.col("void_user")))


def reason_item_conflicts(checks: DataFrame, items: DataFrame, floor: float = 75.0, n: int = 20) -> DataFrame:
    """Recovery reasons on items that cannot be spilled or remade, largest first."""
    c = checks.filter((F.col("discount") >= floor) & (contains_any(F.col("reason"), ["spillage", "food quality", "remake"]) | F.lower("reason").rlike("didn.*t like")))
    up = F.upper("menu_item")
    i = items.filter(up.startswith("BTL ") | up.startswith("OWNER ") | up.startswith("$") | (contains_any(F.col("sales_category"), ["liquor"]) & (F.col("gross_price") >= 100)))
    k = ["check_id", "processing_date"]
    x = c.select(*k, "server", "reason", F.col("discount").alias("amount")).join(i.select(*k, "item_selection_id", "menu_item", "sales_category", "tab_name"), k)
    return x.orderBy(F.desc("amount"), "check_id", "item_selection_id", "menu_item").limit(n)


def station_audit(items: DataFrame, station: str) -> DataFrame:
    """Comps, owner items and large voids rung on one pooled station."""
    s = items.filter(F.col("server") == station)
    comp, void = F.col("discount") > 0, F.lower("voided") == "true"
    own = F.upper("menu_item").startswith("OWNER ") & (comp | F.coalesce(void, F.lit(False)))
    return s.agg(F.count_if(comp).alias("comps"), R2(sum_if(comp, "discount")).alias("comp_dollars"), F.count_if(own).alias("owner_rings"), R2(sum_if(own, F.when(comp, F.col("discount")).otherwise(F.col("gross_price")))).alias("owner_dollars"),
                 F.count_if(void & (F.col("gross_price") >= 100)).alias("large_voids"), R2(sum_if(void & (F.col("gross_price") >= 100), "gross_price")).alias("large_void_dollars"))


def station_top_items(items: DataFrame, station: str, n: int = 5) -> DataFrame:
    g = items.filter((F.col("server") == station) & (F.col("discount") > 0)).groupBy("menu_item", "tab_name").agg(F.count("*").alias("n"), R2(F.sum("discount")).alias("dollars"))
    return g.orderBy(F.desc("dollars"), "menu_item", "tab_name").limit(n)


GENERIC_REASON = r"^(manager comp - (check|item)|manager comp - item, manager comp - item)?$"


def behavior(elog: DataFrame, payments: DataFrame, checks: DataFrame, roster: DataFrame, retail_items: list[str], start: str, end: str, round_floor: float = 100.0, round_step: int = 100) -> DataFrame:
    """Per rostered person: round amounts, reason detail, retail mix, self-approval, late share, trend.

    The roster is the small side of every join; each fact table is read once.
    """
    people = roster.select("server")
    d = F.col("discount")
    whole = (d >= round_floor) & (F.abs(d - F.round(d)) < 0.001) & (F.round(d).cast("bigint") % round_step == 0)
    said = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce("reason", F.lit(""))), r"\(100(\.00)?%\)", ""), r"[,\s]+$", ""))
    a = dates.between_dates(elog.filter(d > 0), "processing_date", start, end).join(people, "server").groupBy("server").agg(
        F.count("*").alias("events"), R2(F.sum("discount")).alias("dollars"), F.count_if(whole).alias("round_events"), F.count_if(~said.rlike(GENERIC_REASON)).alias("specific"), R2(sum_if(F.col("menu_item").isin(retail_items), "discount")).alias("retail"))
    v = dates.between_dates(payments.filter(F.col("void_user").isNotNull()), "processing_date", start, end).filter(F.lower("server") == F.lower("void_user")).join(people, "server").groupBy("server").agg(F.count("*").alias("self_approvals"), R2(F.sum("amount")).alias("self_dollars"))
    s = F.lit(start).cast("date")
    now = F.col("processing_date").between(s, F.lit(end).cast("date"))
    m = dates.clock_minutes(F.col("opened_time"))
    c = checks.filter((d > 0) & F.col("processing_date").between(F.date_sub(s, 28), F.lit(end).cast("date"))).join(people, "server").groupBy("server").agg(
        R2(sum_if(now, "discount")).alias("check_dollars"), R2(sum_if(now & ((m >= 1380) | (m < 150)), "discount")).alias("late_dollars"), R2(sum_if(~now, "discount")).alias("before"))
    x = people.join(a, "server", "left").join(v, "server", "left").join(c, "server", "left").na.fill(0)
    base = F.col("before") / 4
    return x.select("server", "events", "dollars", pct(F.col("round_events"), F.col("events")).alias("round_ratio"), pct(F.col("specific"), F.col("events")).alias("specificity_pct"), pct(F.col("retail"), F.col("dollars")).alias("retail_mix_pct"), "self_approvals", "self_dollars",
                    pct(F.col("late_dollars"), F.col("check_dollars")).alias("late_ratio"), F.round(F.when(base > 0, (F.col("check_dollars") - base) / base * 100), 1).alias("trend_vs_mean_pct"))


def shifts_worked(labor, cash, payments, checks, orders, roster: DataFrame) -> DataFrame:
    """Distinct dates per rostered person over six signs of presence, and which signs were seen."""
    names = roster.select(F.lower("server").alias("who"), "server").distinct()
    sig = lambda df, c, src: df.select(F.lower(c).alias("who"), F.col("processing_date").alias("day"), F.lit(src).alias("src"))
    all_ = sig(labor.filter("regular_hours >= 1"), "employee_name", "labor")
    for df, c, src in ((cash, "employee", "cash"), (payments, "void_approver", "void_appr"), (payments, "void_user", "void_user"), (checks, "server", "server"), (orders, "server", "order_srv")):
        all_ = all_.unionByName(sig(df.filter(F.col(c).isNotNull()), c, src))
    g = all_.join(names, "who").groupBy("server", "day", "src").agg(F.lit(1)).groupBy("server").agg(F.count_distinct("day").alias("shifts"), F.array_join(F.sort_array(F.collect_set("src")), ",").alias("sources"))
    x = roster.select("server").join(g, "server", "left")
    return x.select("server", F.coalesce("shifts", F.lit(0)).alias("shifts"), F.coalesce("sources", F.lit("")).alias("sources"),
                    F.when(F.col("shifts").isNull(), "none").when(F.col("sources").contains("labor"), "labor").otherwise("floor_activity").alias("basis"))
