"""Sales, menu, kitchen and cash reports.

Every report is a lazy frame. Filters and narrow selects come first so they reach the scan,
counts and sums are partial before the shuffle, and totals used as denominators are scalar
subqueries instead of windows over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.numbers import mean_money, pct, pct_change, portion, ratio_or_null, sum0, sum_if
from ..functions.predicates import nonblank, not_voided, not_voided_lenient, valid_payment
from ..functions.text import contains_any, first_of_list
from ..operators.classify import menu_quadrant, step_grade
from ..operators.joins import prior_year_best_week, week_span_overlap
from ..operators.rules import case_rules
from ..operators.windows import latest_per_key, top_per_key

R2 = lambda c: F.round(c, 2)


def is_cash(kind: Column) -> Column:
    return kind.eqNullSafe("Cash") | F.coalesce(kind.contains("CASH"), F.lit(False))


def _kept(orders: DataFrame) -> DataFrame:
    return orders.filter(not_voided(F.col("voided")))


# --- revenue by calendar ---

def revenue_by_dow(payments: DataFrame, ts: str = "paid_ts", void_col: str | None = "void_ts") -> DataFrame:
    """Totals and average night per business weekday over payments that were not voided."""
    p = payments.filter(F.col(ts).isNotNull())
    if void_col:
        p = p.filter(F.col(void_col).isNull())
    bd = dates.business_date(F.col(ts))
    g = p.withColumn("business_date", bd).groupBy(dates.dow_name(F.col("business_date")).alias("day"), dates.dow_num(F.col("business_date")).alias("dow_num")).agg(
        F.count("*").alias("txn_count"), R2(F.sum("amount")).alias("net_sales"), R2(F.sum("tip")).alias("tips"), R2(F.sum("gratuity")).alias("gratuity"),
        R2(F.sum("total")).alias("gross_revenue"), mean_money("total", F.count("*")).alias("avg_check"), F.count_distinct("business_date").alias("num_days"))
    return g.withColumn("avg_daily_revenue", R2(F.col("gross_revenue") / F.greatest(F.col("num_days"), F.lit(1))))


def hourly_profile(payments: DataFrame) -> DataFrame:
    p = payments.filter(F.col("paid_ts").isNotNull() & F.col("void_ts").isNull())
    g = p.groupBy(F.hour("paid_ts").alias("hour")).agg(
        F.count("*").alias("txn_count"), R2(F.sum("total")).alias("gross_revenue"), mean_money("total", F.count("*")).alias("avg_check"),
        F.count_distinct(dates.business_date(F.col("paid_ts"))).alias("num_days"))
    return g.withColumn("avg_daily_revenue", R2(F.col("gross_revenue") / F.greatest(F.col("num_days"), F.lit(1))))


def weekly_revenue(payments: DataFrame) -> DataFrame:
    p = payments.filter(valid_payment(F.col("status")) & F.col("paid_ts").isNotNull())
    return p.groupBy(dates.week_start(dates.business_date(F.col("paid_ts"))).alias("week_start")).agg(
        F.count_distinct("order_id").alias("orders"), R2(F.sum("amount")).alias("revenue"))


def top_weeks(weekly: DataFrame, events: DataFrame, n: int = 20) -> DataFrame:
    """The n best weeks with the names of the events they overlap."""
    top = top_per_key(weekly, [], [F.desc("revenue"), F.asc("week_start")], n)
    names = week_span_overlap(top.select("week_start"), events).groupBy("week_start").agg(
        F.array_join(F.sort_array(F.collect_set("name")), ", ").alias("events"))
    return top.join(names, "week_start", "left").withColumn("events", F.coalesce("events", F.lit("")))


def calendar_kpis(weekly: DataFrame) -> DataFrame:
    """Best month, mean week and peak week. The weekly frame is small (52 rows a year)."""
    months = weekly.groupBy(dates.month_label(F.col("week_start")).alias("month")).agg(R2(F.sum("revenue")).alias("rev"))
    best = months.agg(F.max_by(F.struct("month", "rev"), F.struct("rev", F.col("month")))).scalar()
    peak = F.max_by(F.struct("week_start", "revenue"), F.struct("revenue", "week_start"))
    return (
        weekly.agg(R2(F.avg(F.when(F.col("revenue") > 0, F.col("revenue")))).alias("avg_weekly_revenue"), peak.alias("peak"))
        .withColumn("best", best)
        .select("avg_weekly_revenue", F.col("peak.revenue").alias("peak_week_revenue"), F.col("peak.week_start").alias("peak_week_date"),
                F.col("best.month").alias("best_month"), F.col("best.rev").alias("best_month_revenue"))
    )


def upcoming_events(weekly: DataFrame, events: DataFrame, today: str, n: int = 10) -> DataFrame:
    up = prior_year_best_week(events, weekly).filter(F.col("start_date") >= F.lit(today).cast("date"))
    return up.orderBy("start_date", "name").limit(n)


def event_lift(weekly: DataFrame, events: DataFrame, summer: tuple[str, ...] = ("06", "07")) -> DataFrame:
    """Mean week revenue per event name, and for the summer months, against the overall mean."""
    base = weekly.filter("revenue > 0").agg(F.avg("revenue")).scalar()
    ev = week_span_overlap(weekly.filter("revenue > 0"), events).groupBy(F.col("name").alias("label")).agg(F.avg("revenue").alias("mean"), F.max("revenue").alias("peak"))
    su = weekly.filter(F.date_format("week_start", "MM").isin(*summer)).agg(F.lit("summer").alias("label"), F.avg("revenue").alias("mean"), F.max("revenue").alias("peak"))
    return ev.unionByName(su).withColumn("base", base).select(
        "label", R2("mean").alias("mean_revenue"), "peak", F.round((F.col("mean") - F.col("base")) / F.col("base") * 100, 1).alias("lift_pct"))


# --- servers ---

def server_performance(orders: DataFrame) -> DataFrame:
    o = orders.filter(not_voided_lenient(F.col("voided")) & nonblank(F.col("server")))
    amt, disc = F.sum("amount"), F.sum("discount_amount")
    return o.groupBy("server").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("guest_count").alias("guests"), R2(amt).alias("revenue"), R2(F.sum("tip")).alias("tips"),
        R2(F.sum("gratuity")).alias("gratuity"), R2(disc).alias("discounts"), F.count_if(F.col("discount_amount") > 0).alias("discounted_orders"),
        R2(ratio_or_null(amt, F.count_distinct("order_id"))).alias("avg_check"), R2(ratio_or_null(amt, F.sum("guest_count"))).alias("rev_per_guest"),
        F.round(ratio_or_null(F.sum("tip"), amt) * 100, 1).alias("tip_pct"),
        F.round(ratio_or_null(disc, F.sum(F.col("amount") + F.col("discount_amount"))) * 100, 1).alias("discount_pct"))


def server_profile(payments: DataFrame, by: str) -> DataFrame:
    """Payments per server by business weekday ('dow') or clock hour ('hour')."""
    p = payments.filter(valid_payment(F.col("status")) & nonblank(F.col("server")))
    k = dates.dow_name(dates.business_date(F.col("paid_ts"))) if by == "dow" else F.hour("paid_ts")
    return p.groupBy("server", k.alias(by)).agg(F.count("*").alias("orders"), R2(F.sum("amount")).alias("revenue"), mean_money("amount", F.count("*")).alias("avg_check"))


def server_kpis(servers: DataFrame) -> DataFrame:
    return servers.agg(
        F.count("*").alias("total_servers"), R2(F.sum("revenue") / F.count("*")).alias("avg_revenue_per_server"), F.max("revenue").alias("top_server_revenue"),
        R2(F.sum(F.col("avg_check") * F.col("orders")) / F.greatest(F.sum("orders"), F.lit(1))).alias("avg_check_size"),
        F.round(F.sum("tips") / F.greatest(F.sum("revenue"), F.lit(1.0)) * 100, 1).alias("avg_tip_pct"))


def top_servers(orders: DataFrame, n: int = 15, house_share: float = 0.35) -> DataFrame:
    g = _kept(orders).groupBy(F.coalesce("server", F.lit("Unknown")).alias("server")).agg(
        F.count_distinct("order_id").alias("orders"), R2(sum0("total")).alias("revenue"), R2(sum0("tip")).alias("tips"), R2(sum0("gratuity")).alias("gratuity"))
    return g.orderBy(F.desc("revenue"), "server").limit(n).withColumns({
        "staff_gratuity": portion(F.col("gratuity"), 1 - house_share), "house_gratuity": portion(F.col("gratuity"), house_share)})


def server_flags(orders: DataFrame, payments: DataFrame, min_orders: int = 10, low_tip: float = 6, high_disc: float = 15, high_void: float = 2) -> DataFrame:
    """(flag, server, n, rate) rows for low tips, high discounts and high voids."""
    o = orders.groupBy("server").agg(
        F.count_distinct("order_id").alias("n"), F.round(ratio_or_null(F.sum("tip") * 100, F.sum("amount")), 1).alias("tip"),
        F.round(ratio_or_null(F.sum("discount_amount") * 100, F.sum(F.col("amount") + F.col("discount_amount"))), 1).alias("disc")).filter(F.col("n") >= min_orders)
    v = payments.groupBy("server").agg(
        F.count_distinct("payment_id").alias("n"), F.round(ratio_or_null(F.count_if(F.col("void_ts").isNotNull()) * 100.0, F.count_distinct("payment_id")), 2).alias("rate"))
    both = o.select("server", "n", F.explode(F.array(
        F.struct(F.lit("low_tip").alias("flag"), F.when(F.col("tip") < low_tip, F.col("tip")).alias("rate")),
        F.struct(F.lit("high_discount").alias("flag"), F.when(F.col("disc") > high_disc, F.col("disc")).alias("rate")))).alias("x")).select("x.flag", "server", "n", "x.rate").filter("rate IS NOT NULL")
    voids = v.filter((F.col("n") >= min_orders) & (F.col("rate") > high_void)).select(F.lit("high_void").alias("flag"), "server", "n", "rate")
    return both.unionByName(voids)


def server_tiers(orders, high_check, mid_check, high_disc, mid_disc, low_tip) -> DataFrame:
    """Tier, revenue tier, risk flag, discount impact and composite score per server.

    Ranking runs over one row per server; the count is a scalar.
    """
    g = orders.filter(nonblank(F.col("server"))).groupBy("server").agg(
        F.sum("amount").alias("revenue"), (F.sum("tip") / F.sum("amount") * 100).alias("tp"),
        (F.sum("discount_amount") / F.sum("amount") * 100).alias("dp"), F.avg("amount").alias("mean"))
    r = top_per_key(g, [], [F.desc("revenue"), F.asc("server")], 1 << 30).withColumn("n", g.agg(F.count("*")).scalar())
    rank, n = F.col("rank"), F.col("n")
    return r.select(
        "server", case_rules([(rank * 5 <= n, "Top"), (rank * 2 <= n, "Core")], F.lit("Developing")).alias("server_tier"),
        case_rules([(F.col("mean") >= high_check, "High"), (F.col("mean") >= mid_check, "Medium")], F.lit("Low")).alias("revenue_tier"),
        ((F.col("dp") > high_disc) | (F.col("tp") < low_tip)).alias("risk_flag"),
        case_rules([(F.col("dp") > high_disc, "High"), (F.col("dp") > mid_disc, "Medium")], F.lit("Low")).alias("discount_impact"),
        F.round(0.6 * (n - rank + 1) * 100 / n + 0.4 * F.least(F.col("tp") * 5, F.lit(100.0)), 3).alias("score"))


# --- kitchen ---

def _seconds() -> Column:
    return F.timestamp_diff("SECOND", F.col("fired_ts"), F.col("fulfilled_ts"))


def kitchen_speed(kitchen: DataFrame, by: str) -> DataFrame:
    """Fulfilment seconds by 'station', 'hour', 'cook' or 'week'."""
    k = kitchen.filter(F.col("fired_ts").isNotNull())
    s = _seconds()
    mean = F.round(F.avg(s), 1).alias("avg_sec")
    done = F.count_if(F.col("fulfilled_ts").isNotNull())
    if by == "station":
        return k.filter(nonblank(F.col("station"))).groupBy("station").agg(
            F.count("*").alias("tickets"), done.alias("fulfilled"), mean, F.percentile_approx(s, 0.5, 10000).alias("median_sec"),
            F.min(s).alias("min_sec"), F.max(s).alias("max_sec"), pct(done, F.count("*")).alias("fulfillment_pct"))
    if by == "cook":
        k = k.filter(F.col("fulfilled_ts").isNotNull() & nonblank(F.col("fulfilled_by")))
        return k.groupBy(F.col("fulfilled_by").alias("cook")).agg(F.count("*").alias("tickets"), mean, F.min(s).alias("min_sec"))
    if by == "hour":
        return k.groupBy(F.hour("fired_ts").alias("hour")).agg(F.count("*").alias("tickets"), mean)
    return k.groupBy(dates.week_start(dates.business_date(F.col("fired_ts"))).alias("week")).agg(F.count("*").alias("tickets"), done.alias("fulfilled"), mean)


def kitchen_kpis(stations: DataFrame) -> DataFrame:
    by = lambda f: f(F.col("station"), F.struct("avg_sec", "station"))
    return stations.agg(
        F.sum("tickets").alias("total_tickets"), F.round(F.sum(F.col("avg_sec") * F.col("fulfilled")) / F.greatest(F.sum("fulfilled"), F.lit(1)), 1).alias("avg_fulfillment_sec"),
        by(F.min_by).alias("fastest_station"), by(F.max_by).alias("slowest_station"), pct(F.sum("fulfilled"), F.sum("tickets")).alias("fulfillment_rate"))


def kitchen_ops(kitchen: DataFrame, target: float = 99.0) -> DataFrame:
    """Fulfilment rate in total and by station, with the target check on the total."""
    done = F.count_if(F.col("fulfilled_ts").isNotNull())
    g = kitchen.rollup("station").agg(F.grouping("station").alias("g"), F.count("*").alias("tickets"), done.alias("fulfilled"), pct(done, F.count("*")).alias("rate"))
    return g.select(F.when(F.col("g") == 1, "(all)").otherwise(F.col("station")).alias("station"), "tickets", "fulfilled", "rate",
                    F.when(F.col("g") == 1, F.when(F.col("rate") >= target, "OK").otherwise("FLAG")).alias("status"))


# --- menu ---

def latest_items(items: DataFrame) -> DataFrame:
    """Newest load of every item line; all remaining columns break ties so the winner is fixed."""
    cols = ["item_selection_id", "processing_date", "gross_price", "server", "menu_item", "net_price", "qty"]
    rest = ["sales_category", "menu_group", "service", "check_id", "order_ts", "voided"]
    order = [F.desc("processing_date"), F.desc("gross_price"), F.asc("server"), F.asc("menu_item"), F.desc("net_price"), F.desc("qty")]
    return latest_per_key(items.select(*cols, *rest), ["item_selection_id"], order)


def menu_matrix(items: DataFrame) -> DataFrame:
    """Items with popularity and price index against the mean, and their quadrant."""
    d = latest_items(items).filter(not_voided(F.col("voided")))
    g = d.groupBy(
        F.coalesce("menu_item", F.lit("(unknown)")).alias("menu_item"), F.coalesce("sales_category", F.lit("(uncategorized)")).alias("sales_category"),
        F.coalesce("menu_group", F.lit("(none)")).alias("menu_group")).agg(F.sum("qty").alias("qty_sold"), F.sum("net_price").alias("net")).filter("qty_sold > 0")
    t = g.agg(F.struct(F.sum("qty_sold").alias("q"), F.sum("net").alias("r"), F.count("*").alias("n"))).scalar()
    x = g.withColumn("t", t).withColumn("price", F.col("net") / F.col("qty_sold"))
    x = x.withColumn("popularity_index", R2(F.col("qty_sold") / (F.col("t.q") / F.col("t.n")))).withColumn(
        "profitability_index", R2(F.col("price") / (F.col("t.r") / F.greatest(F.col("t.q"), F.lit(1)))))
    return x.select(
        "menu_item", "sales_category", "menu_group", "qty_sold", R2("net").alias("net_revenue"), R2("price").alias("avg_price"), "popularity_index",
        "profitability_index", menu_quadrant(F.col("popularity_index"), F.col("profitability_index")).alias("classification"),
        F.round(F.col("net") / F.greatest(F.col("t.r"), F.lit(1.0)) * 100, 1).alias("revenue_pct"), F.round(F.col("qty_sold") / F.greatest(F.col("t.q"), F.lit(1)) * 100, 1).alias("qty_pct"))


def menu_totals(matrix: DataFrame, by: str) -> DataFrame:
    """Item count, revenue and quantity per quadrant or category."""
    g = matrix.groupBy(by).agg(F.count("*").alias("items"), R2(F.sum("net_revenue")).alias("revenue"), F.sum("qty_sold").alias("qty"))
    total = matrix.agg(F.sum("net_revenue")).scalar()
    return g.withColumn("_t", total).withColumn("revenue_pct", pct(F.col("revenue"), F.col("_t"))).drop("_t")


def menu_mix_kpis(items: DataFrame) -> DataFrame:
    d = latest_items(items)
    live, void = not_voided(F.col("voided")), F.col("voided") == "true"
    return d.agg(
        R2(sum_if(live, "net_price")).alias("total_revenue"), F.sum(F.when(live, F.col("qty"))).alias("total_items"),
        F.count_distinct(F.when(live, F.col("check_id"))).alias("unique_checks"),
        R2(ratio_or_null(sum_if(live, "net_price"), F.count_distinct(F.when(live, F.col("check_id"))))).alias("avg_check"),
        R2(sum_if(void, "net_price")).alias("void_revenue"), F.sum(F.when(void, F.col("qty"))).alias("void_qty"),
        pct(sum_if(void, "net_price"), sum_if(live, "net_price") + sum_if(void, "net_price"), 2).alias("void_rate"))


def menu_mix_by(items: DataFrame, by: str) -> DataFrame:
    """Quantity, revenue, checks by category, service, business weekday or hour."""
    d = latest_items(items).filter(not_voided(F.col("voided"))).withColumn("business_date", dates.business_date(F.col("order_ts")))
    key = {"category": F.coalesce("sales_category", F.lit("(uncategorized)")), "service": F.coalesce("service", F.lit("(none)")),
           "dow": dates.dow_name(F.col("business_date")), "hour": F.hour("order_ts")}[by]
    g = d.groupBy(key.alias(by)).agg(
        F.sum("qty").alias("items"), R2(F.sum("net_price")).alias("revenue"), F.count_distinct("check_id").alias("checks"), F.count_distinct("business_date").alias("days"))
    return g.withColumn("avg_per_day", R2(F.col("revenue") / F.greatest(F.col("days"), F.lit(1))))


def top_items(items: DataFrame, by: str, n: int = 10, voids: Column | None = None) -> DataFrame:
    live = voids if voids is not None else not_voided(F.col("voided"))
    g = items.filter(live).groupBy("menu_item").agg(F.sum("qty").alias("quantity"), R2(F.sum("net_price")).alias("revenue"))
    return g.orderBy(F.desc(by), "menu_item").limit(n)


def product_mix(items: DataFrame) -> DataFrame:
    c = F.col("sales_category")
    g = items.filter(not_voided(F.col("voided"))).agg(
        sum_if(c == "Liquor", "net_price").alias("liquor"), sum_if(c == "Food", "net_price").alias("food"), sum_if(c == "Hookah", "net_price").alias("hookah"),
        sum0("net_price").alias("total"), sum_if(contains_any(F.col("menu_item"), ["btl"]), "net_price").alias("bottle_service"))
    shares = {f"{k}_pct": pct(F.col(k), F.col("total")) for k in ("liquor", "food", "hookah")}
    return g.withColumns(shares).withColumns({k: R2(k) for k in ("liquor", "food", "hookah", "total", "bottle_service")})


# --- the weekly report ---

def weekly_summary(orders: DataFrame) -> DataFrame:
    return _kept(orders).agg(
        R2(sum0("amount")).alias("total_revenue"), R2(sum0("tax")).alias("total_tax"), R2(sum0("tip")).alias("total_tips"), R2(sum0("gratuity")).alias("total_gratuity"),
        R2(sum0("total")).alias("grand_total"), R2(F.coalesce(F.avg("total"), F.lit(0.0))).alias("avg_check_size"), F.count("*").alias("total_checks"))


def order_metrics(orders: DataFrame) -> DataFrame:
    """Orders, guests and revenue by dining option plus an '(all)' row."""
    o = _kept(orders).withColumn("option", first_of_list(F.col("dining_options")))
    g = o.rollup("option").agg(F.grouping("option").alias("g"), F.count_distinct("order_id").alias("orders"), F.sum("guest_count").alias("guests"), R2(sum0("total")).alias("revenue"))
    return g.select(F.when(F.col("g") == 1, "(all)").otherwise(F.col("option")).alias("option"), "orders", "guests", "revenue")


def daily_vs_prior(orders: DataFrame) -> DataFrame:
    d = _kept(orders).groupBy(F.col("processing_date").alias("day")).agg(R2(F.sum("total")).alias("revenue"), F.count_distinct("order_id").alias("orders"))
    prior = d.select(F.date_add("day", 7).alias("day"), F.col("revenue").alias("prior_revenue"))
    return d.join(prior, "day", "left").withColumns({
        "day_name": dates.dow_name(F.col("day")), "change_pct": pct_change(F.col("revenue"), F.col("prior_revenue"))})


def payment_types(payments: DataFrame) -> DataFrame:
    g = payments.filter(F.col("void_ts").isNull()).groupBy(F.coalesce("payment_type", F.lit("Unknown")).alias("type"))
    return g.agg(F.count("*").alias("n"), R2(F.sum("total")).alias("amount"), R2(F.sum("tip")).alias("tips"))


def week_comparison(orders: DataFrame, start: str) -> DataFrame:
    """A week against the week before and the one 52 weeks ago: one scan, one aggregate."""
    o = _kept(orders)
    s = F.lit(start).cast("date")
    d = F.col("processing_date")
    cur, prior, year = d.between(s, F.date_add(s, 6)), d.between(F.date_sub(s, 7), F.date_sub(s, 1)), d.between(F.date_sub(s, 364), F.date_sub(s, 358))
    cnt = lambda c: F.count_distinct(F.when(c, F.col("order_id")))
    g = o.filter(cur | prior | year).agg(
        sum_if(cur, "total").alias("revenue"), cnt(cur).alias("orders"), F.coalesce(F.sum(F.when(cur, F.col("guest_count"))), F.lit(0)).alias("guests"),
        R2(sum_if(cur, "tip")).alias("tips"), R2(F.coalesce(F.avg(F.when(cur, F.col("total"))), F.lit(0.0))).alias("avg_check"),
        sum_if(prior, "total").alias("prior_revenue"), cnt(prior).alias("prior_orders"), sum_if(year, "total").alias("ly_revenue"), cnt(year).alias("ly_orders"))
    chg = lambda a, b: F.round(F.when(F.col(b) > 0, (F.col(a) - F.col(b)) / F.col(b) * 100).otherwise(0.0), 1)
    return g.withColumns({
        "revenue_pct": chg("revenue", "prior_revenue"), "orders_pct": chg("orders", "prior_orders"), "yoy_pct": chg("revenue", "ly_revenue"),
        "orders_per_day": F.round(F.col("orders") / 7, 1)}).withColumns({c: R2(c) for c in ("revenue", "prior_revenue", "ly_revenue")})


def high_checks(checks: DataFrame, limit: float = 200.0, target: float = 8.0) -> DataFrame:
    g = checks.agg(F.count("*").alias("total_checks"), F.count_if(F.col("total") > limit).alias("high_checks"))
    r = F.col("high_checks") / F.col("total_checks") * 100
    return g.withColumns({"high_check_rate": pct(F.col("high_checks"), F.col("total_checks")), "status": F.when(r >= target, "ON TARGET").otherwise("BELOW TARGET")})


def discount_void(orders: DataFrame, payments: DataFrame) -> DataFrame:
    v = payments.agg(F.struct(F.count_distinct("payment_id").alias("n"), F.count_if(F.col("void_ts").isNotNull()).alias("v"), sum_if(F.col("void_ts").isNotNull(), "total").alias("a"))).scalar()
    g = orders.agg(sum0("discount_amount").alias("d"), sum0(F.col("amount") + F.col("discount_amount")).alias("g")).withColumn("v", v)
    g = g.withColumns({"discount_rate": pct(F.col("d"), F.col("g")), "void_rate": pct(F.col("v.v"), F.col("v.n"), 2)})
    return g.select(R2("d").alias("discounts"), R2("g").alias("gross_sales"), "discount_rate", F.when(F.col("discount_rate") < 5, "OK").otherwise("FLAG - HIGH DISCOUNTS").alias("discount_status"),
                    F.col("v.n").alias("payments"), F.col("v.v").alias("voided_payments"), R2("v.a").alias("voided_amount"), "void_rate",
                    F.when(F.col("void_rate") < 1, "OK").otherwise("FLAG - HIGH VOIDS").alias("void_status"))


def discount_reasons(checks: DataFrame, orders: DataFrame) -> DataFrame:
    r = F.col("reason")
    gross = orders.agg(sum0(F.col("amount") + F.col("discount_amount"))).scalar()
    g = checks.filter(nonblank(r)).agg(
        sum_if(r.contains("Manager Comp"), "discount").alias("manager_comp"), sum_if(r.contains("Open $") | r.contains("Open %"), "discount").alias("open_discount"),
        sum_if(r.contains("Owner Comp"), "discount").alias("owner_comp"), sum_if(r.contains("Birthday"), "discount").alias("birthday_comp"),
        sum_if(r.contains("Spillage") | r.contains("Quality"), "discount").alias("spillage_quality")).withColumn("gross", gross)
    g = g.withColumn("manager_pct", pct(F.col("manager_comp"), F.col("gross"), 2))
    return g.select(*[R2(c).alias(c) for c in ("manager_comp", "open_discount", "owner_comp", "birthday_comp", "spillage_quality")], "manager_pct",
                    F.when(F.col("manager_pct") > 4, "FLAG - EXCEEDS 4%").otherwise("OK").alias("manager_status"),
                    F.when(F.col("open_discount") > 0, "FLAG - SHOULD BE $0").otherwise("OK").alias("open_status"))


def cash_control(payments: DataFrame, cash: DataFrame) -> DataFrame:
    a = F.col("action")
    e = cash.agg(F.struct(F.count_if(a == "NO_SALE").alias("n"), sum_if(a == "CLOSE_OUT_OVERAGE", "amount").alias("o"), sum_if(a == "CLOSE_OUT_SHORTAGE", "amount").alias("s"))).scalar()
    g = payments.agg(F.count_if(is_cash(F.col("payment_type"))).alias("cash_payments"), F.count_distinct("payment_id").alias("total_payments")).withColumn("e", e)
    g = g.withColumns({"cash_pct": pct(F.col("cash_payments"), F.col("total_payments")), "total_variance": F.abs("e.o") + F.abs("e.s")})
    return g.select("cash_payments", "total_payments", "cash_pct", F.when(F.col("cash_pct").between(14, 20), "OK").otherwise("REVIEW").alias("cash_status"),
                    F.col("e.n").alias("no_sale_count"), F.when(F.col("e.n") > 100, "FLAG - HIGH NO_SALE").otherwise("OK").alias("no_sale_status"),
                    R2("e.o").alias("overage"), R2("e.s").alias("shortage"), R2("total_variance").alias("total_variance"),
                    F.when(F.col("total_variance") > 50, "FLAG - HIGH VARIANCE").otherwise("OK").alias("variance_status"))


def cash_handlers(cash: DataFrame, n: int = 10) -> DataFrame:
    a = F.col("action")
    g = cash.groupBy("employee").agg(F.count("*").alias("entries"), R2(sum_if(a == "CASH_COLLECTED", "amount")).alias("cash_collected"),
                                     F.count_if(a == "NO_SALE").alias("no_sales"), F.count_if(a == "PAY_OUT").alias("payouts"))
    return top_per_key(g, [], [F.desc("cash_collected"), F.asc("employee")], n)


def weekly_scorecard(orders, payments, cash, kitchen, exclude_voided: bool = False) -> DataFrame:
    """(metric, value, target, status); voided orders stay in unless asked otherwise."""
    o = _kept(orders) if exclude_voided else orders
    void = payments.agg(pct(F.count_if(F.col("void_ts").isNotNull()), F.count("*"), 2)).scalar()
    no_sale = cash.agg(F.count_if(F.col("action") == "NO_SALE").cast("double")).scalar()
    kit = kitchen.agg(pct(F.count_if(F.col("fulfilled_ts").isNotNull()), F.count("*"))).scalar()
    g = o.agg(R2(sum0("total")).alias("rev"), pct(sum0("discount_amount"), sum0(F.col("amount") + F.col("discount_amount"))).alias("disc"))
    g = g.withColumns({"void": void, "cash": no_sale, "kitchen": kit})
    row = lambda name, c, target, ok, bad: F.struct(F.lit(name).alias("metric"), F.col(c).alias("value"), F.lit(float(target)).alias("target"), F.when(ok, "PASS").otherwise(bad).alias("status"))
    return g.select(F.explode(F.array(
        row("revenue", "rev", 100000, F.col("rev") >= 100000, "BELOW TARGET"), row("discount", "disc", 8, F.col("disc") < 8, "REVIEW"),
        row("void", "void", 1, F.col("void") < 1, "REVIEW"), row("cash", "cash", 100, F.col("cash") <= 100, "REVIEW"),
        row("kitchen", "kitchen", 99, F.col("kitchen") >= 99, "REVIEW"))).alias("r")).select("r.*")


def insights(orders: DataFrame, payments: DataFrame, items: DataFrame, week: str) -> DataFrame:
    """(key, severity, subject, value) findings, one rule set per metric row."""
    comp = week_comparison(orders, week).select("revenue_pct", "orders_pct")
    one = lambda df, key, sev, subject, value: df.select(F.lit(key).alias("key"), sev.alias("severity"), subject.alias("subject"), value.cast("double").alias("value"))
    none = F.lit("")
    growth = one(comp.filter("abs(revenue_pct) > 10"), "revenue_growth", F.when(F.col("revenue_pct") > 0, "good").otherwise("warning"), none, F.col("revenue_pct"))
    check = one(weekly_summary(orders).filter("avg_check_size > 50 OR avg_check_size < 25"), "avg_check", F.when(F.col("avg_check_size") > 50, "good").otherwise("warning"), none, F.col("avg_check_size"))
    dow = _kept(orders).groupBy(dates.dow_name(F.col("processing_date")).alias("d")).agg(R2(F.sum("total")).alias("r"))
    days = dow.agg(F.max_by("d", F.struct("r", "d")).alias("bd"), F.max("r").alias("b"), F.min_by("d", F.struct("r", "d")).alias("wd"), F.min("r").alias("w"))
    best = one(days, "best_day", F.lit("info"), F.col("bd"), F.col("b"))
    worst = one(days, "slow_day", F.when(F.col("w") < F.col("b") * 0.5, "warning").otherwise("info"), F.col("wd"), F.col("w"))
    top = one(top_servers(orders, 1), "top_server", F.lit("info"), F.col("server"), F.col("revenue"))
    s15 = top_servers(orders, 15).agg(F.round(F.sum("tips") / F.sum("revenue") * 100, 1).alias("t"))
    tip = one(s15, "tip_rate", F.when(F.col("t") < 15, "warning").otherwise("info"), none, F.col("t"))
    seller = one(top_items(items, "quantity", 1), "best_seller", F.lit("info"), F.col("menu_item"), F.col("quantity"))
    party = one(_kept(orders).agg((F.sum("guest_count") / F.count_distinct("order_id")).alias("p")), "party_size", F.lit("info"), none, F.round("p", 1))
    cash = one(payment_types(payments).agg(F.round(F.sum(F.when(F.col("type") == "Cash", F.col("amount"))) / F.sum("amount") * 100, 1).alias("c")), "cash_share", F.lit("info"), none, F.col("c"))
    out = growth
    for part in (check, best, worst, top, tip, seller, party, cash):
        out = out.unionByName(part)
    return out


def weekly_insights(orders: DataFrame, payments: DataFrame, items: DataFrame, week: str, managers: list[str] = (), pools: list[str] = (), lead: float = 1.5) -> DataFrame:
    """The findings of ``insights`` and those that compare reports: the kind of the top account, its lead over the mean of the listed servers, the item that
    earns most if it isn't the best seller, the share of dine-in orders where there are both kinds, and growing order numbers.

    ``managers`` and ``pools`` are parts of names, without regard to case; neither is asked to share techniques.
    """
    one = lambda df, key, severity, subject, value: df.select(F.lit(key).alias("key"), F.lit(severity).alias("severity"), subject.alias("subject"), value.cast("double").alias("value"))
    listed = top_servers(orders).agg(F.avg("revenue").alias("mean"), F.count("*").alias("n"))
    first = top_servers(orders, 1).withColumn("_l", listed.select(F.struct("mean", "n")).scalar())
    pooled, manages = contains_any(F.col("server"), list(pools)), contains_any(F.col("server"), list(managers))
    kind = F.when(pooled, "pool").when(manages, "manager").otherwise("server")
    parts = [one(first, "top_account", "info", kind, F.col("revenue")),
             one(first.filter(~pooled & ~manages & (F.col("_l.n") > 1) & (F.col("revenue") > F.col("_l.mean") * lead)), "share_techniques", "info", F.col("server"), F.col("revenue"))]
    sold = items.filter(not_voided(F.col("voided"))).groupBy("menu_item").agg(F.sum("qty").alias("quantity"), R2(F.sum("net_price")).alias("revenue"))
    best = sold.agg(F.min(F.struct((-F.col("quantity")).alias("q"), "menu_item")).alias("s"), F.min(F.struct((-F.col("revenue")).alias("r"), "menu_item")).alias("e"))
    parts.append(one(best.filter(F.col("s.menu_item") != F.col("e.menu_item")), "top_revenue_item", "info", F.col("e.menu_item"), -F.col("e.r")))
    options = order_metrics(orders).withColumn("low", F.lower("option"))
    most = lambda word: F.min(F.when(F.col("low").contains(word), F.struct((-F.col("orders")).alias("n"), F.col("option").alias("option"))))
    shares = options.agg(most("dine").alias("d"), most("take").alias("t"), F.max(F.when(F.col("option") == "(all)", F.col("orders"))).alias("n"))
    parts.append(one(shares.filter("d IS NOT NULL AND t IS NOT NULL AND n > 0"), "dine_in_share", "info", F.col("d.option"), F.round(-F.col("d.n") / F.col("n") * 100, 1)))
    parts.append(one(week_comparison(orders, week).filter("orders > 0 AND orders_pct > 0"), "growing_orders", "info", F.lit(""), F.col("orders_pct")))
    out = insights(orders, payments, items, week)
    for part in parts:
        out = out.unionByName(part)
    return out
