"""Discount (comp) classification, cap enforcement and owner accounting.

Two frames carry everything: the discounted checks with their final bucket, and the item log
with bucket, owner, retail price and collected amount. Every report is one aggregate of one of
them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rulebook as rb
from ..functions import dates
from ..functions.numbers import pct, ratio_or_zero, sum0, sum_if
from ..functions.text import contains_any
from ..operators import classify as cl
from ..operators.filters import item_log
from ..operators.joins import align_periods
from ..operators.orderstats import upper_median
from ..operators.windows import latest_per_key, top_per_key
from ..sources.sinks import stage

R2 = lambda c: F.round(c, 2)


@dataclass
class House:
    """Venue parameters: owners by tab word, caps, prices, aliases, the pooled account, tier-1 bottle price."""

    owners: list[tuple[str, str]]
    caps: DataFrame
    prices: DataFrame
    aliases: DataFrame
    pool: str = "Bottle Manager"
    bottle_retail: float = 350.0
    clawback_share: float = 0.8

    @property
    def owner_words(self) -> list[str]:
        return [w for w, _ in self.owners]


def log(items: DataFrame, house: House) -> DataFrame:
    listed = house.prices.select("menu_item").union(house.aliases.select("menu_item"))
    cols = ["item_selection_id", "check_id", "processing_date", "server", "menu_item", "sales_category", "gross_price", "discount", "tab_name", "voided"]
    return item_log(items.select(*cols), listed, house.owner_words)


def comp_checks(checks: DataFrame, items: DataFrame, house: House, store: bool = False) -> DataFrame:
    """Discounted checks with reason, top signalling item, tab and final bucket (tab, then item, then reason).

    The cap matcher reads its rows twice; with ``store`` they are written first, which pays where the result is wanted whole."""
    b = cl.comp_item(F.col("menu_item"))
    per = log(items, house).groupBy("check_id").agg(
        F.max(F.nullif(F.col("tab_name"), F.lit(""))).alias("tab_name"),
        F.max(F.when(b.isNotNull() & (F.col("discount") > 0), F.struct("discount", "menu_item"))).alias("_top"))
    c = checks.filter(F.col("discount") > 0).select("check_id", "processing_date", "server", "reason", F.col("discount").alias("amount"))
    c = c.join(per, "check_id", "left").withColumn("top_item", F.col("_top.menu_item")).drop("_top")
    c = cl.match_cap(stage(c, "comp-checks") if store else c, house.caps)
    tab = cl.comp_tab(F.col("tab_name"), house.owner_words, F.col("cap_key"))
    return c.withColumns({"reason_bucket": cl.comp_reason(F.col("reason")), "tab_bucket": tab, "item_bucket": cl.comp_item(F.col("top_item"))}).withColumn(
        "bucket", cl.comp_final(F.col("tab_bucket"), F.col("item_bucket"), F.col("reason_bucket")))


def counted(comps: DataFrame) -> DataFrame:
    return comps.filter(~F.col("bucket").isin(rb.EXCLUDED))


def by_bucket(comps: DataFrame, net_sales: Column) -> DataFrame:
    g = counted(comps).groupBy("bucket").agg(F.count("*").alias("n"), R2(F.sum("amount")).alias("total"))
    return g.withColumn("_s", net_sales).withColumn("pct_of_sales", pct(F.col("total"), F.col("_s"), 3)).drop("_s")


def by_server(comps: DataFrame) -> DataFrame:
    """Scores per server; bucket diversity counts the kinds of comp used."""
    b = F.col("bucket")
    g = counted(comps).filter(F.col("server").isNotNull() & (F.col("server") != "")).groupBy("server").agg(
        F.count("*").alias("comp_count"), R2(F.sum("amount")).alias("total"), R2(sum_if(b.isin(rb.DISCRETIONARY), "amount")).alias("discretionary"),
        R2(sum_if(b.startswith("programmatic"), "amount")).alias("programmatic"), R2(sum_if(b == "owner_discretion", "amount")).alias("owner"), R2(sum_if(b == "recovery", "amount")).alias("recovery"))
    used = sum((F.when(F.col(c) > 0, 1).otherwise(0) for c in ("discretionary", "recovery", "owner", "programmatic")), F.lit(0))
    return g.withColumn("diversity", used)


def by_weekday(comps: DataFrame) -> DataFrame:
    return counted(comps).groupBy(dates.dow_name(F.col("processing_date")).alias("day"), "bucket").agg(F.count("*").alias("n"), R2(F.sum("amount")).alias("total"))


def headline(comps: DataFrame, net_sales: Column, blended=(4.0, 5.0), discretionary=(2.0, 3.0), manager=1.0, recovery=0.5) -> DataFrame:
    """Totals against net sales with their grades."""
    b = F.col("bucket")
    g = counted(comps).agg(
        R2(sum0("amount")).alias("total"), R2(sum_if(b.isin(rb.DISCRETIONARY), "amount")).alias("disc"), R2(sum_if(b == "discretionary_manager", "amount")).alias("mgr"),
        R2(sum_if(b == "recovery", "amount")).alias("rec"), R2(sum_if(b.isin(rb.UNCATEGORIZED), "amount")).alias("uncategorized")).withColumn("net_sales", R2(net_sales))
    p = lambda c: ratio_or_zero(F.col(c), F.col("net_sales")) * 100
    steps = lambda v, a, w: F.when(v <= a, "On Target").when(v <= w, "Watch").otherwise("Investigate")
    return g.select("net_sales", "total", "uncategorized", F.round(p("total"), 3).alias("total_pct"), F.round(p("disc"), 3).alias("discretionary_pct"), F.round(p("mgr"), 3).alias("manager_pct"), F.round(p("rec"), 3).alias("recovery_pct"),
                    F.when(p("total") < blended[0], "On Target").when(p("total") < blended[1], "Watch").otherwise("Investigate").alias("grade"), steps(p("disc"), *discretionary).alias("discretionary_grade"),
                    steps(p("mgr"), manager, manager * 1.5).alias("manager_grade"), steps(p("rec"), recovery, recovery * 2).alias("recovery_grade"))


def variance(headline_: DataFrame, targets: DataFrame) -> DataFrame:
    """(metric, actual, target, variance_dollars); ``targets``: metric, target."""
    long = headline_.unpivot(["net_sales"], ["total_pct", "manager_pct", "recovery_pct", "discretionary_pct"], "metric", "actual")
    return long.join(targets, "metric").select("metric", "actual", "target", R2((F.col("actual") - F.col("target")) / 100 * F.col("net_sales")).alias("variance_dollars"))


def mismatches(comps: DataFrame) -> DataFrame:
    """Checks whose final bucket contradicts the reason code, with what overrode it."""
    m = comps.filter((F.col("bucket") != F.col("reason_bucket")) & (F.col("tab_bucket").isNotNull() | F.col("item_bucket").isNotNull()))
    return m.select("check_id", "server", "reason_bucket", F.col("bucket").alias("final_bucket"), F.when(F.col("tab_bucket").isNotNull(), "tab").otherwise("item").alias("override"), "amount")


def flags(comps: DataFrame, pool: str, floor: float = 250.0, factor: float = 1.5) -> DataFrame:
    """Uncategorized checks, and servers far above the median discretionary amount. ``comps`` is read several times: give a stored frame."""
    open_ = comps.filter(F.col("bucket").isin(rb.UNCATEGORIZED)).select(F.lit("uncategorized").alias("flag"), F.col("check_id").cast("string").alias("key"), "server", "amount")
    s = by_server(comps).filter(F.col("server") != pool)
    median = upper_median(s.filter("discretionary > 0"), [], "discretionary").scalar()
    out = s.withColumn("_m", median).filter((F.col("discretionary") > factor * F.col("_m")) & (F.col("discretionary") > floor))
    return open_.unionByName(out.select(F.lit("server_outlier").alias("flag"), F.lit("SERVER_OUTLIER").alias("key"), "server", F.col("discretionary").alias("amount")))


def enriched_log(items: DataFrame, checks: DataFrame, payments: DataFrame, house: House, use_tab: bool = False, store: bool = False) -> DataFrame:
    """Item log with reason, bucket, flags, owner, cap, retail price and what the check collected."""
    l = log(items, house).join(checks.select("check_id", F.when(F.col("discount") > 0, F.col("reason")).alias("reason")), "check_id", "left")
    paid = payments.groupBy("check_id").agg(F.sum("amount").alias("collected"))
    l = l.join(paid, "check_id", "left")
    l = cl.with_retail_price(cl.match_cap(stage(l, "item-log") if store else l, house.caps), house.prices, house.aliases)
    tab = cl.comp_tab(F.col("tab_name"), house.owner_words, F.col("cap_key")) if use_tab else F.lit(None).cast("string")
    l = l.withColumns({"collected": F.coalesce("collected", F.lit(0.0)), "bucket": cl.comp_final(tab, cl.comp_item(F.col("menu_item")), F.coalesce(cl.comp_reason(F.col("reason")), F.lit("other"))),
                       "premium": cl.is_premium(F.col("menu_item")), "bottle": cl.is_bottle(F.col("menu_item"), F.col("sales_category"), F.col("gross_price")),
                       "owner": cl.owner_of_tab(F.col("tab_name"), house.owners)})
    flag = F.array_join(F.filter(F.array(F.when(F.col("premium") & F.col("cap_key").isNotNull(), "Premium under promoter tab"), F.when(F.col("bucket").isin(rb.UNCATEGORIZED), "Uncategorized")), lambda x: x.isNotNull()), " / ")
    return l.withColumn("protocol_flag", F.nullif(flag, F.lit("")))


def top_items(elog: DataFrame, n: int = 10) -> DataFrame:
    g = elog.filter("discount > 0").groupBy("menu_item").agg(F.count("*").alias("n"), R2(F.sum("discount")).alias("total"))
    return g.orderBy(F.desc("total"), "menu_item").limit(n)


def caps(elog: DataFrame, house: House, fallback_event: str | None = None) -> DataFrame:
    """Bottles per capped event against the cap.

    A weekday with one cap takes every bottle of that day; with several, a bottle goes to the
    event its tab names, and an unnamed one to ``fallback_event``. Owner and birthday tabs do
    not count.
    """
    days = house.caps.groupBy(F.col("dow").alias("_dow")).agg(F.count("*").alias("_n"), F.max("key").alias("_only"))
    b = elog.filter((F.col("discount") > 0) & F.col("bottle") & F.col("owner").isNull() & ~F.coalesce(contains_any(F.col("tab_name"), rb.BIRTHDAY_WORDS), F.lit(False)))
    b = b.withColumn("_dow", F.weekday("processing_date")).join(days, "_dow")
    b = b.withColumn("key", F.when(F.col("_n") == 1, F.col("_only")).otherwise(F.coalesce("cap_key", F.lit(fallback_event).cast("string"))))
    g = b.groupBy("key").agg(F.count("*").alias("bottles"), R2(F.sum("discount")).alias("dollars"), F.count_if(F.col("premium")).alias("premium_bottles"), R2(sum_if(F.col("premium"), "discount")).alias("premium_dollars"))
    x = house.caps.select("key", "event", "cap", "cap_type").join(g, "key", "left").na.fill(0)
    x = x.withColumn("excess", F.greatest(F.col("bottles") - F.col("cap"), F.lit(0)))
    return x.withColumns({"over_cap": F.col("bottles") > F.col("cap"), "clawback": R2(F.when(F.col("cap_type") == "external", F.col("excess") * house.clawback_share * house.bottle_retail).otherwise(0.0))})


def premium_movement(elog: DataFrame, prices: DataFrame, aliases: DataFrame) -> DataFrame:
    """Rings of bottles with a price of tier premium, an alias or a premium name: comped, owner paid, other paid, recovered, foregone."""
    known = aliases.select(F.col("menu_item").alias("_a")).union(prices.filter("tier = 'premium'").select("menu_item")).distinct()
    m = elog.join(known, F.col("menu_item") == F.col("_a"), "left").filter(F.col("premium") | F.col("_a").isNotNull())
    comped = F.col("collected") <= 0.01
    own, other = ~comped & F.col("owner").isNotNull(), ~comped & F.col("owner").isNull()
    g = m.groupBy("menu_item").agg(
        F.count("*").alias("rings"), R2(sum0("retail_price")).alias("retail_value"), F.count_if(comped).alias("house_comped"), F.count_if(own).alias("owner_paid"), F.count_if(other).alias("other_paid"),
        R2(sum_if(own, "gross_price") + sum_if(other, F.coalesce("retail_price", "gross_price"))).alias("recovered"))
    return g.withColumn("foregone", R2(F.greatest(F.col("retail_value") - F.col("recovered"), F.lit(0.0))))


def owner_ledger(elog: DataFrame) -> DataFrame:
    """Paid against house-comped per owner, with the number of tabs of each kind."""
    paid = F.col("collected") > 0
    return elog.filter(F.col("owner").isNotNull()).groupBy("owner").agg(
        R2(sum_if(paid, "gross_price")).alias("paid_by_owner"), R2(sum_if(~paid, "gross_price")).alias("comped_at_cost"), R2(sum_if(~paid, F.coalesce("retail_price", F.lit(0.0)))).alias("comped_retail"),
        F.count_distinct(F.when(paid, F.col("check_id"))).alias("tabs_paid"), F.count_distinct(F.when(~paid, F.col("check_id"))).alias("tabs_comped"))


def roster_scores(servers: DataFrame, roster: DataFrame) -> DataFrame:
    """Scorecard per rostered person, with the difference to the upper median of active managers.

    ``roster``: server, role. People without comps score 0.
    """
    r = roster.join(servers, "server", "left").na.fill(0)
    active = r.filter((F.col("role") == "Manager") & (F.col("comp_count") > 0))
    median = upper_median(active, [], "discretionary").scalar()
    return r.withColumn("peer_median", F.coalesce(median, F.lit(0.0))).withColumn("vs_median", R2(F.col("discretionary") - F.col("peer_median")))


def waterfall(comps: DataFrame, roster: DataFrame, pool: str) -> DataFrame:
    """Discretionary dollars by source, with shares."""
    c = counted(comps).join(roster, "server", "left")
    src = F.when(F.col("role") == "Manager", "managers").when(F.col("role") == "Bar Lead", "bar_leads").when(F.col("server") == pool, "pool")
    disc = F.col("bucket").isin(rb.DISCRETIONARY)
    g = c.agg(*[R2(sum_if(disc & (src == s), "amount")).alias(s) for s in ("managers", "bar_leads", "pool")], R2(sum_if(F.col("bucket") == "discretionary_manager", "amount")).alias("_m"), R2(sum_if(F.col("bucket").isin(rb.UNCATEGORIZED), "amount")).alias("uncategorized"))
    g = g.withColumn("other", R2(F.greatest(F.col("_m") - F.col("managers") - F.col("bar_leads") - F.col("pool"), F.lit(0.0)))).drop("_m")
    names = ["managers", "bar_leads", "pool", "other", "uncategorized"]
    g = g.withColumn("_t", sum((F.col(n) for n in names), F.lit(0.0)))
    return g.unpivot(["_t"], names, "source", "amount").select("source", "amount", pct(F.col("amount"), F.col("_t")).alias("share_pct"))


def risk(headline_: DataFrame, cap_rows: DataFrame, premium: DataFrame, limit: float = 500.0, watch: tuple[float, float, float, float] = (5.0, 3.0, 1.0, 1.0)) -> DataFrame:
    """Money at risk and whether the period raises an alert."""
    c = cap_rows.agg(F.struct(R2(F.sum("clawback")).alias("claw"), F.count_if(F.col("over_cap")).alias("n"), F.count_if(F.col("premium_bottles") > 0).alias("p"))).scalar()
    p = premium.agg(F.struct(R2(F.sum("foregone")).alias("f"), F.sum("house_comped").alias("n"))).scalar()
    h = headline_.withColumns({"c": c, "p": p})
    alert = (F.col("total_pct") >= watch[0]) | (F.col("discretionary_pct") >= watch[1]) | (F.col("manager_pct") > watch[2]) | (F.col("recovery_pct") > watch[3]) | (F.col("uncategorized") > limit) | (F.col("c.n") > 0) | (F.col("c.p") > 0)
    return h.select(F.col("p.f").alias("foregone"), F.col("p.n").alias("house_comped"), F.col("c.claw").alias("clawback"), F.col("c.n").alias("cap_breaches"), "uncategorized", alert.alias("alert"))


def owner_residual(comps: DataFrame, ledger: DataFrame) -> DataFrame:
    """Owner-bucket comps that are on no owner's own tab, floored at 0."""
    personal = ledger.agg(sum0(F.col("paid_by_owner") + F.col("comped_at_cost"))).scalar()
    g = counted(comps).agg(R2(sum_if(F.col("bucket") == "owner_discretion", "amount")).alias("owner_comps")).withColumn("personal", R2(personal))
    return g.withColumn("non_personal", R2(F.greatest(F.col("owner_comps") - F.col("personal"), F.lit(0.0))))


def actions(scores: DataFrame, elog: DataFrame, cap_rows: DataFrame, comps: DataFrame, premium: DataFrame, high: float = 500.0, n: int = 3) -> DataFrame:
    """(kind, subject, amount, detail) action list."""
    who = scores.filter((F.col("role") == "Manager") & (F.col("discretionary") >= high)).select("server", "discretionary")
    top = top_per_key(elog.filter("discount > 0").join(who, "server").select("server", "discretionary", "check_id", "menu_item", "discount", "item_selection_id"), ["server"],
                      [F.desc("discount"), F.asc("check_id"), F.asc("item_selection_id"), F.asc("menu_item")], n)
    person = top.groupBy("server", "discretionary").agg(F.sort_array(F.collect_list(F.struct("rank", "check_id"))).alias("t")).select(
        F.lit("discretionary").alias("kind"), F.col("server").alias("subject"), F.col("discretionary").alias("amount"), F.array_join(F.transform("t", lambda x: x["check_id"].cast("string")), ",").alias("detail"))
    none = F.lit("").alias("detail")
    cap = cap_rows.filter("over_cap").select(F.concat(F.lit("cap_"), F.col("cap_type")).alias("kind"), F.col("event").alias("subject"), F.col("clawback").alias("amount"), none)
    open_ = comps.filter(F.col("bucket").isin(rb.UNCATEGORIZED)).agg(R2(F.sum("amount")).alias("amount"), F.count("*").alias("n")).filter("n > 0").select(F.lit("uncategorized").alias("kind"), F.col("n").cast("string").alias("subject"), "amount", none)
    big = premium.filter("house_comped > 0 AND foregone >= 500").orderBy(F.desc("foregone"), "menu_item").limit(n).select(F.lit("foregone").alias("kind"), F.col("menu_item").alias("subject"), F.col("foregone").alias("amount"), none)
    return person.unionByName(cap).unionByName(open_).unionByName(big)


def cogs_drag(elog: DataFrame, rates: DataFrame, default: float) -> DataFrame:
    """Comp dollars times category cost, for comps that are not by intent. ``rates``: sales_category, rate."""
    d = elog.filter((F.col("discount") > 0) & ~F.col("bucket").isin(rb.INTENT_BUCKETS)).join(rates, "sales_category", "left")
    return d.groupBy("sales_category").agg(R2(F.sum("discount")).alias("retail"), (
        F.round(F.round(F.sum("discount") * 100) * F.round(F.coalesce(F.max("rate"), F.lit(default)) * 100, 4) / 100) / 100).alias("drag"))


def dayparts(checks: DataFrame, orders: DataFrame) -> DataFrame:
    c = checks.filter("discount > 0").withColumn("h", dates.clock_hour(F.col("opened_time"))).filter("h IS NOT NULL").groupBy(cl.daypart(F.col("h")).alias("daypart")).agg(R2(F.sum("discount")).alias("comp_dollars"), F.count("*").alias("comp_count"))
    o = orders.groupBy(cl.daypart(F.hour("opened")).alias("daypart")).agg(R2(F.sum("amount")).alias("net_sales"))
    return align_periods(c, o, "daypart")


def weekly_trend(comps: DataFrame, orders: DataFrame, end: str, weeks: int = 4) -> DataFrame:
    """Last n seven-day windows ending at ``end``, in one pass."""
    e = F.lit(end).cast("date")
    idx = lambda c: F.floor(F.datediff(e, F.col(c)) / 7)
    recent = lambda d: d.withColumn("weeks_ago", idx("processing_date")).filter((F.col("weeks_ago") >= 0) & (F.col("weeks_ago") < weeks))
    b = F.col("bucket")
    c = recent(counted(comps)).groupBy("weeks_ago").agg(R2(F.sum("amount")).alias("total"), R2(sum_if(b == "discretionary_manager", "amount")).alias("m"), R2(sum_if(b == "recovery", "amount")).alias("r"))
    o = recent(orders).groupBy("weeks_ago").agg(R2(F.sum("amount")).alias("net_sales"))
    x = o.join(c, "weeks_ago", "left").na.fill(0)
    return x.select("weeks_ago", "net_sales", "total", pct(F.col("m"), F.col("net_sales"), 3).alias("manager_pct"), pct(F.col("r"), F.col("net_sales"), 3).alias("recovery_pct"))
