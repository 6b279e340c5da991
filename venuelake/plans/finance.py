"""Profit, cost, budget, prime cost, reconciliation and vendor reports.

All period reports share two frames: revenue per period from orders and expenses per period
from bank debits. Each is one scan and one aggregate whatever the number of periods; the
ratios are taken from the summed parts afterwards.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import rulebook as rb
from ..functions import dates
from ..functions.numbers import mean_money, pct, pct_of_positive, portion, sum0, sum_if
from ..functions.predicates import not_voided, valid_payment
from ..functions.text import card_key, category_section, contains_any
from ..operators import windows
from ..operators.classify import budget_status_pct, budget_status_ratio, cost_bucket, deposit_type, expense_section, grade, prime_bucket, step_grade
from ..operators.joins import align_periods, restrict_to_top
from ..operators.orderstats import top_shares
from ..operators.rules import any_match_sums, first_match
from ..sources.sinks import stage

R2 = lambda c: F.round(c, 2)
COST_GROUPS = {"cogs": rb.COGS_WORDS, "labor_gross": rb.LABOR_WORDS, "marketing": rb.MARKETING_WORDS, "opex": rb.OPEX_WORDS}
CASH_IN_WORDS = (["cash deposit", "cash account transfer"], ["counter credit"])


def debits(bank: DataFrame) -> DataFrame:
    return bank.filter(F.col("transaction_type") == "debit")


def month_of(df: DataFrame, c: str) -> DataFrame:
    return df.withColumn("month", dates.month_label(F.col(c)))


def week_of(df: DataFrame, c: str) -> DataFrame:
    return df.withColumn("week_start", dates.week_start(F.col(c)))


def revenue_by(orders: DataFrame, key: str, retain: float = rb.GRAT_RETAIN) -> DataFrame:
    """Per period: net sales, tips, gratuity, the retained part, what passes to staff, adjusted revenue."""
    g = orders.filter(not_voided(F.col("voided"))).groupBy(key).agg(
        R2(sum0("amount")).alias("net_sales"), R2(sum0("tip")).alias("tips"), R2(sum0("gratuity")).alias("gratuity"), F.count_distinct("order_id").alias("order_count"))
    g = g.withColumns({"grat_retained": portion(F.col("gratuity"), retain), "pass_through": R2(F.col("tips") + portion(F.col("gratuity"), 1 - retain))})
    return g.withColumn("adj_revenue", R2(F.col("net_sales") + F.col("grat_retained")))


def expenses_by(bank: DataFrame, key: str, groups: dict[str, list[str]] | None = None) -> DataFrame:
    """Per period: debit totals of the keyword groups and of all categories outside revenue."""
    g = any_match_sums(debits(bank).withColumn("_nr", F.when(~contains_any(F.col("category"), ["revenue"]), F.lit(" all "))).withColumn(
        "_text", F.concat_ws(" ", F.col("category"), F.col("_nr"))), {**(groups or COST_GROUPS), "total_exp": [" all "]}, "_text", "abs_amount", [key])
    return g.withColumns({c: R2(c) for c in [*(groups or COST_GROUPS), "total_exp"]})


def pnl(orders: DataFrame, bank: DataFrame, key: str, floor: str = "zero") -> DataFrame:
    """Revenue, cost groups, true labor, profit and shares of adjusted revenue per period.

    ``floor`` decides what adjusted expenses become when tips exceed expenses: 'zero', 'gross'
    (keep the unadjusted total) or 'half' (never below half of it).
    """
    return _derive_pnl(align_periods(revenue_by(orders, key), expenses_by(bank, key), key), floor)


def pnl_total(orders: DataFrame, bank: DataFrame, floor: str = "zero") -> DataFrame:
    """The same for all rows at once; the one-row expense side is a scalar, not a join."""
    one = lambda d: d.withColumn("period", F.lit("all"))
    return _derive_pnl(_beside(revenue_by(one(orders), "period"), expenses_by(one(bank), "period").drop("period")), floor)


def _beside(row: DataFrame, other: DataFrame) -> DataFrame:
    """Columns of a one-row frame added to another."""
    return row.withColumn("_o", other.select(F.struct("*")).scalar()).select("*", "_o.*").drop("_o").na.fill(0)


def _derive_pnl(p: DataFrame, floor: str) -> DataFrame:
    raw = F.col("total_exp") - F.col("pass_through")
    adj = {"zero": F.greatest(raw, F.lit(0.0)), "gross": F.when(raw < 0, F.col("total_exp")).otherwise(raw),
           "half": F.greatest(raw, F.col("total_exp") * 0.5)}[floor]
    p = p.withColumns({"labor_true": R2(F.greatest(F.col("labor_gross") - F.col("pass_through"), F.lit(0.0))), "adj_expenses": R2(adj)})
    p = p.withColumn("net_profit", R2(F.col("adj_revenue") - F.col("adj_expenses"))).withColumn("prime_cost", R2(F.col("cogs") + F.col("labor_true")))
    share = lambda c: pct_of_positive(F.col(c), F.col("adj_revenue"))
    return p.withColumns({"cogs_pct": share("cogs"), "labor_pct": share("labor_true"), "prime_pct": share("prime_cost"), "marketing_pct": share("marketing"),
                          "opex_pct": share("opex"), "margin_pct": share("net_profit")})


def labor_kpis(weekly: DataFrame) -> DataFrame:
    worked = F.col("labor_true") > 0
    p = F.when(worked & (F.col("adj_revenue") > 0), F.col("labor_pct"))
    return weekly.agg(
        R2(F.sum("labor_true") / F.greatest(F.count_if(worked), F.lit(1))).alias("avg_weekly_labor"), F.round(F.coalesce(F.avg(p), F.lit(0.0)), 2).alias("avg_labor_pct"),
        F.coalesce(F.min(p), F.lit(0.0)).alias("best_week_pct"), F.coalesce(F.max(p), F.lit(0.0)).alias("worst_week_pct"), R2(F.sum("labor_true")).alias("total_labor_true"))


def labor_vendors(bank: DataFrame) -> DataFrame:
    b = debits(bank).filter(contains_any(F.col("category"), ["labor", "payroll"]))
    return b.groupBy(F.coalesce("vendor_normalized", "description").alias("vendor")).agg(R2(F.sum("abs_amount")).alias("total"), F.count("*").alias("txn_count"))


def cash_collected(payments: DataFrame, key: str) -> DataFrame:
    cash = F.col("payment_type").contains("Cash") | F.col("payment_type").contains("CASH")
    return payments.groupBy(key).agg(R2(sum_if(cash, "total")).alias("cash_collected"), F.count_if(cash).alias("cash_txns"))


def cash_deposited(bank: DataFrame, key: str, categories: list[str], texts: list[str], exact: list[str] = ()) -> DataFrame:
    hit = contains_any(F.col("category"), categories) | contains_any(F.col("description"), texts)
    if exact:
        hit = hit | F.col("category").isin(list(exact))
    return bank.filter((F.col("transaction_type") == "credit") & hit).groupBy(key).agg(R2(sum0("abs_amount")).alias("cash_deposited"))


def monthly_pnl(orders: DataFrame, payments: DataFrame, bank: DataFrame) -> DataFrame:
    """Monthly P&L with the gap between cash rung up and cash deposited."""
    p = pnl(month_of(orders, "processing_date"), month_of(bank, "transaction_date"), "month")
    c = align_periods(cash_collected(month_of(payments, "processing_date"), "month"),
                      cash_deposited(month_of(bank, "transaction_date"), "month", *CASH_IN_WORDS), "month")
    return p.join(c, "month", "left").na.fill(0).withColumn("unreconciled_cash", R2(F.col("cash_collected") - F.col("cash_deposited")))


def profit_summary(orders, payments, bank, cash) -> DataFrame:
    """One row for the period: P&L, cash-adjusted margin and drawer activity."""
    one = lambda d: d.withColumn("period", F.lit("all"))
    p = pnl_total(orders, bank, floor="gross")
    a = F.col("action")
    d = cash.agg(
        R2(sum_if(a == "CASH_COLLECTED", "amount")).alias("drawer_collected"), R2(sum_if(a == "PAY_OUT", F.abs("amount"))).alias("payouts"),
        R2(sum_if(a == "CLOSE_OUT_OVERAGE", "amount")).alias("overages"), R2(sum_if(a == "CLOSE_OUT_SHORTAGE", F.abs("amount"))).alias("shortages"), F.count_if(a == "NO_SALE").alias("no_sale_count"))
    out = _beside(p, cash_collected(one(payments), "period").drop("period"))
    out = _beside(_beside(out, cash_deposited(one(bank), "period", *CASH_IN_WORDS).drop("period")), d)
    out = out.withColumn("undeposited_cash", R2(F.col("cash_collected") - F.col("cash_deposited")))
    out = out.withColumn("cash_adj_profit", R2(F.col("net_profit") + F.col("undeposited_cash")))
    return out.withColumn("cash_adj_margin", pct_of_positive(F.col("cash_adj_profit"), F.col("adj_revenue")))


# --- KPI card ---

KPI_NAMES = ["cogs_pct", "labor_pct", "prime_pct", "margin_pct", "marketing_pct", "opex_pct", "avg_check", "orders_per_day", "void_rate", "discount_rate",
             "rev_per_labor_hour", "repeat_guest_pct", "repeat_rev_pct", "at_risk_pct"]


def kpi_metrics(orders, bank, payments, periods: list[tuple[str, date, date]]) -> DataFrame:
    """14 metrics per labelled period. All periods share one scan of each fact table."""
    o = dates.by_period(orders, "processing_date", periods)
    b = dates.by_period(bank, "transaction_date", periods)
    p = pnl(o, b, "label", floor="gross")
    live = not_voided(F.col("voided"))
    extra = o.groupBy("label").agg(
        F.count_distinct(F.when(live, F.col("processing_date"))).alias("days"), R2(sum_if(live, "discount_amount")).alias("disc"), R2(sum_if(F.col("voided") == "true", F.abs("amount"))).alias("voided_amount"))
    ends = F.create_map(*[F.lit(x) for label, _, e in periods for x in (label, e)])
    y = payments.filter(valid_payment(F.col("status")) & F.col("card_digits").isNotNull()).withColumn("d", F.to_date("paid_ts"))
    y = dates.by_period(y, "d", periods).groupBy("label", card_key(F.col("card_digits"), F.col("card_type")).alias("card")).agg(
        F.count_distinct("d").alias("days"), R2(F.sum("amount")).alias("spend"), F.max("d").alias("last"))
    y = y.withColumn("recency", F.datediff(ends[F.col("label")], F.col("last")))
    rep = F.col("days") >= 2
    guests = y.groupBy("label").agg(
        F.count("*").alias("guests"), F.count_if(rep).alias("repeat"), R2(F.sum("spend")).alias("guest_rev"), R2(sum_if(rep, "spend")).alias("repeat_rev"),
        F.count_if((F.col("days") >= 3) & F.col("recency").between(46, 90)).alias("risk"))
    x = p.join(extra, "label", "left").join(guests, "label", "left").na.fill(0)
    hours = F.col("labor_true") / rb.LABOR_RATE_PER_HOUR
    return x.select(
        "label", "adj_revenue", "net_profit", "cogs_pct", "labor_pct", "prime_pct", "margin_pct", "marketing_pct", "opex_pct",
        R2(F.when(F.col("order_count") > 0, F.col("net_sales") / F.col("order_count")).otherwise(0.0)).alias("avg_check"),
        F.round(F.when(F.col("days") > 0, F.col("order_count") / F.col("days")).otherwise(0.0), 1).alias("orders_per_day"),
        pct(F.col("voided_amount"), F.col("net_sales") + F.col("voided_amount")).alias("void_rate"), pct(F.col("disc"), F.col("net_sales") + F.col("disc")).alias("discount_rate"),
        R2(F.when(F.col("labor_true") > 0, F.col("adj_revenue") / hours).otherwise(0.0)).alias("rev_per_labor_hour"),
        pct(F.col("repeat"), F.col("guests")).alias("repeat_guest_pct"), pct(F.col("repeat_rev"), F.col("guest_rev")).alias("repeat_rev_pct"), pct(F.col("risk"), F.col("guests")).alias("at_risk_pct"))


def kpi_long(metrics: DataFrame) -> DataFrame:
    return metrics.unpivot(["label"], KPI_NAMES, "metric", "value")


def kpi_scorecard(metrics: DataFrame, benchmarks: DataFrame, current: str, prior: str) -> DataFrame:
    """Metric with value, prior, delta and status. ``benchmarks``: metric, good, watch, lower_is_better."""
    m = kpi_long(metrics).groupBy("metric").agg(
        F.max(F.when(F.col("label") == current, F.col("value"))).alias("value"), F.max(F.when(F.col("label") == prior, F.col("value"))).alias("prior"))
    s = m.join(benchmarks, "metric")
    return s.select("metric", "value", "prior", R2(F.col("value") - F.col("prior")).alias("delta"), grade(F.col("value"), F.col("good"), F.col("watch"), F.col("lower_is_better")).alias("status"))


def kpi_health(scorecard: DataFrame) -> DataFrame:
    c = lambda s: F.count_if(F.col("status") == s)
    g = scorecard.agg(c("good").alias("good"), c("watch").alias("watch"), c("critical").alias("critical"), F.count("*").alias("n"))
    return g.select("good", "watch", "critical", F.when(F.col("good") >= F.col("n") / 2, "good").when(F.col("critical") < F.col("n") / 3, "watch").otherwise("critical").alias("health"))


# --- budget ---

def budget_revenue(orders, items, bank, side_stream: list[str]) -> DataFrame:
    """Month revenue parts; the side stream reaches the bank only and is additive."""
    r = revenue_by(month_of(orders, "processing_date"), "month")
    cat = F.col("sales_category")
    i = month_of(items.filter(not_voided(F.col("voided"))), "processing_date").groupBy("month").agg(R2(sum_if(cat == "Food", "net_price")).alias("food"), R2(sum_if(cat == "Liquor", "net_price")).alias("liquor"))
    h = month_of(bank.filter(contains_any(F.col("category"), side_stream) & (F.col("amount") > 0)), "transaction_date").groupBy("month").agg(R2(F.sum("amount")).alias("side_stream"))
    x = r.join(i, "month", "left").join(h, "month", "left").na.fill(0)
    return x.withColumns({"other": R2(F.greatest(F.col("net_sales") - F.col("food") - F.col("liquor"), F.lit(0.0))),
                          "gross_revenue": R2(F.col("net_sales") + F.col("tips") + F.col("gratuity") + F.col("side_stream"))})


def line_actuals(bank: DataFrame, lines: list[tuple[str, list[str]]]) -> DataFrame:
    """(key, actual) of each budget line; one conditional aggregate over the category totals."""
    wide = any_match_sums(debits(bank).groupBy("category").agg(R2(F.sum("abs_amount")).alias("abs_amount")), dict(lines), "category", "abs_amount", [])
    return wide.unpivot([], [k for k, _ in lines], "key", "actual").withColumn("actual", R2("actual"))


def _revenue_scalar(orders: DataFrame) -> Column:
    return revenue_by(orders.withColumn("_all", F.lit(1)), "_all").select(F.struct("adj_revenue", "pass_through")).scalar()


def budget_lines(orders, bank, targets: DataFrame, words: list[tuple[str, list[str]]], labor_key: str = "labor") -> DataFrame:
    """Category actual against its share of revenue. ``targets``: key, target_pct, max_pct."""
    x = line_actuals(bank, words).join(targets, "key").withColumn("r", _revenue_scalar(orders))
    x = x.withColumn("actual", F.when(F.col("key") == labor_key, R2(F.greatest(F.col("actual") - F.col("r.pass_through"), F.lit(0.0)))).otherwise(F.col("actual")))
    x = x.withColumns({"actual_pct": pct_of_positive(F.col("actual"), F.col("r.adj_revenue")), "target_amount": R2(F.col("r.adj_revenue") * F.col("target_pct") / 100)})
    return x.select("key", "actual", "actual_pct", "target_pct", "target_amount", R2(F.col("actual") - F.col("target_amount")).alias("variance"),
                    F.round(F.col("actual_pct") - F.col("target_pct"), 1).alias("variance_pct"), budget_status_pct(F.col("actual_pct"), F.col("target_pct"), F.col("max_pct")).alias("status"))


def budget_sublines(orders, bank, sublines: DataFrame, words: list[tuple[str, list[str]]]) -> DataFrame:
    """Subcategory actual against a share of the parent target or a fixed amount.

    ``sublines``: key, parent_pct, share_pct, fixed_target, informational. Status of a
    fixed-target line follows from its own amount.
    """
    x = line_actuals(bank, words).join(sublines, "key").withColumn("r", _revenue_scalar(orders))
    den = F.col("r.adj_revenue")
    tp = F.when(F.col("informational"), 0.0).when(F.col("fixed_target").isNotNull(), F.round(F.col("fixed_target") / den * 100, 2)).otherwise(F.round(F.col("parent_pct") * F.col("share_pct") / 100, 2))
    x = x.withColumns({"actual_pct": pct_of_positive(F.col("actual"), den, 2), "target_pct": tp})
    x = x.withColumn("target_amount", F.when(F.col("informational"), 0.0).when(F.col("fixed_target").isNotNull(), F.col("fixed_target")).otherwise(R2(den * F.col("target_pct") / 100)))
    return x.select("key", "actual", "actual_pct", "target_pct", "target_amount", F.when(F.col("informational"), 0.0).otherwise(R2(F.col("actual") - F.col("target_amount"))).alias("variance"),
                    F.when(F.col("informational"), "informational").otherwise(budget_status_ratio(F.col("actual"), F.col("target_amount"))).alias("status"))


def budget_history(orders, bank) -> DataFrame:
    p = pnl(month_of(orders, "processing_date"), month_of(bank, "transaction_date"), "month", floor="half")
    return p.select("month", F.round("adj_revenue").alias("revenue"), "cogs_pct", "labor_pct", "marketing_pct", "opex_pct", "margin_pct")


def vendor_totals(bank: DataFrame) -> DataFrame:
    return debits(bank).filter(F.col("vendor_normalized").isNotNull()).groupBy("vendor_normalized", "category").agg(R2(F.sum("abs_amount")).alias("amount"), F.count("*").alias("txns"))


STATUS_ORDER = ["over_budget", "watch", "on_track", "under_budget", "unknown"]


def budget_vendors(bank, lines: DataFrame, group_rules: DataFrame, n: int = 50) -> DataFrame:
    """The n largest vendors tagged with the first matching budget group and its status.

    ``group_rules``: priority, keyword, key. ``lines``: output of ``budget_lines``.
    """
    top = vendor_totals(bank).orderBy(F.desc("amount"), "vendor_normalized", "category").limit(n)
    tagged = first_match(top, group_rules, "category", ["key"]).join(lines.select("key", "status", "variance"), "key", "left")
    x = tagged.select("vendor_normalized", "category", "amount", "txns", F.coalesce("key", F.lit("other")).alias("budget_group"), F.coalesce("status", F.lit("unknown")).alias("budget_status"),
                      F.coalesce("variance", F.lit(0.0)).alias("budget_variance"))
    rank = F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.col("budget_status"))
    return x.withColumn("actionable", F.col("budget_status").isin("over_budget", "watch")).orderBy(rank, F.desc("amount"), "vendor_normalized")


def line_vendors(bank, group_rules: DataFrame, n: int = 5) -> DataFrame:
    """Top vendors of each budget group."""
    tagged = first_match(vendor_totals(bank), group_rules, "category", ["key"]).filter(F.col("key").isNotNull())
    return windows.top_per_key(tagged.select("key", "vendor_normalized", "category", "amount"), ["key"], [F.desc("amount"), F.asc("vendor_normalized"), F.asc("category")], n)


def budget_path(lines: DataFrame, margin: DataFrame, target_margin: float) -> DataFrame:
    """Overspent lines ranked by possible saving, with the margin reached after each."""
    over = lines.filter(F.col("variance") > 0).select("key", F.col("variance").alias("saving"))
    w = W.orderBy(F.desc("saving"), F.asc("key")).rowsBetween(W.unboundedPreceding, 0)
    m = margin.select(F.struct("adj_revenue", "net_profit")).scalar()
    x = over.withColumn("rank", F.row_number().over(W.orderBy(F.desc("saving"), F.asc("key")))).withColumn("m", m).withColumn("cum", R2(F.sum("saving").over(w)))
    after = F.round((F.col("m.net_profit") + F.col("cum")) / F.col("m.adj_revenue") * 100, 2)
    return x.select("rank", "key", "saving", F.col("cum").alias("cumulative_saving"), after.alias("margin_after"), (after >= target_margin).alias("reaches_target"))


def budget_totals(orders, bank, target_margin: float) -> DataFrame:
    p = pnl_total(orders, bank)
    return p.select("adj_revenue", "adj_expenses", "net_profit", "margin_pct", F.when(F.col("margin_pct") >= target_margin, "on_target").otherwise("below_target").alias("margin_status"),
                    R2(F.greatest(F.col("adj_revenue") * target_margin / 100 - F.col("net_profit"), F.lit(0.0))).alias("gap_to_target"))


def drilldown(bank: DataFrame, words: list[str]) -> DataFrame:
    return debits(bank).filter(contains_any(F.col("category"), words)).select("transaction_date", "description", "vendor_normalized", "category", "abs_amount")


# --- recurring events ---

def event_revenue(payments: DataFrame, weekdays: DataFrame, retain: float = rb.GRAT_RETAIN) -> DataFrame:
    """Revenue, tips and nights per weekday event and month, on the business day."""
    p = payments.filter(valid_payment(F.col("status"))).withColumn("bd", dates.business_date(F.col("paid_ts")))
    g = p.groupBy(dates.dow_num(F.col("bd")).alias("dow_num"), dates.month_label(F.col("bd")).alias("month")).agg(
        R2(F.sum("amount")).alias("net_sales"), R2(F.sum("tip")).alias("tips"), R2(F.sum("gratuity")).alias("gratuity"), F.count_distinct("bd").alias("nights"), F.count("*").alias("txns"))
    g = g.join(weekdays, "dow_num").withColumn("grat_retained", portion(F.col("gratuity"), retain))
    return g.withColumn("adj_revenue", R2(F.col("net_sales") + F.col("grat_retained"))).drop("dow_num")


def vendor_event_costs(bank: DataFrame, vendor_map: DataFrame, words: list[str]) -> DataFrame:
    """Costs per vendor and month with the events of the first map keyword in the vendor name."""
    v = month_of(debits(bank).filter(contains_any(F.col("category"), words)), "transaction_date").groupBy(
        F.coalesce("vendor_normalized", F.lit("Unknown")).alias("vendor"), "month").agg(R2(F.sum("abs_amount")).alias("amount"), F.count("*").alias("txns"))
    return first_match(v, vendor_map, "vendor", ["events"])


def split_evenly(costs: DataFrame, amount: str = "amount", events: str = "events") -> DataFrame:
    """Each cost divided by the number of its events, rounded per share as booked."""
    share = F.round(F.round(F.col(amount) * 100) / F.size(events)) / 100
    return costs.filter(F.col(events).isNotNull()).withColumn("event", F.explode(events)).withColumn("share", share)


def event_direct(costs: DataFrame) -> DataFrame:
    return split_evenly(costs).groupBy("event", "month").agg(R2(F.sum("share")).alias("direct_costs"), F.sum("txns").alias("txns"))


def event_unattributed(costs: DataFrame) -> DataFrame:
    return costs.filter(F.col("events").isNull()).groupBy("vendor").agg(R2(F.sum("amount")).alias("amount"), F.sum("txns").alias("txns"))


def allocate_by_revenue(revenue: DataFrame, monthly: DataFrame, value: str, name: str) -> DataFrame:
    """A monthly cost spread over the events by their share of that month's revenue."""
    total = revenue.groupBy("month").agg(F.sum("adj_revenue").alias("_t"))
    x = revenue.select("event", "month", "adj_revenue").join(total, "month").join(monthly, "month")
    return x.select("event", "month", R2(F.when(F.col("_t") > 0, F.col(value) * F.col("adj_revenue") / F.col("_t")).otherwise(0.0)).alias(name))


def allocate_by_pct(monthly: DataFrame, value: Column, shares: DataFrame, name: str) -> DataFrame:
    """A monthly cost spread by fixed weekday shares; ``shares`` holds one row per event."""
    s = shares.agg(F.collect_list(F.struct("event", "pct"))).scalar()
    return monthly.withColumn("_s", s).withColumn("_e", F.explode("_s")).select(F.col("_e.event").alias("event"), "month", R2(value * F.col("_e.pct")).alias(name))


def monthly_cost(bank: DataFrame, words: list[str], name: str) -> DataFrame:
    return month_of(debits(bank).filter(contains_any(F.col("category"), words)), "transaction_date").groupBy("month").agg(R2(F.sum("abs_amount")).alias(name))


def monthly_costs(bank: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Several kinds of monthly cost in one pass over the bank lines."""
    g = any_match_sums(month_of(debits(bank), "transaction_date"), groups, "category", "abs_amount", ["month"])
    return g.withColumns({c: R2(c) for c in groups})


def event_grid(revenue, costs, bank, shares, shared_words, labor_words, ops_words, fixed_labor: float) -> DataFrame:
    """(event, month) with revenue and the four cost kinds. Revenue and the months' costs, a row for each month or event of one, are stored and read again."""
    revenue = stage(revenue, "event-revenue")
    costs_m = monthly_costs(bank, {"shared": shared_words, "gross": labor_words, "ops": ops_words})
    of_month = revenue.groupBy("month").agg(F.sum("adj_revenue").alias("_t"), R2(F.sum(F.col("tips") + F.col("gratuity") - F.col("grat_retained"))).alias("passed"))
    months = stage(costs_m.join(of_month, "month", "full_outer"), "event-months")
    k = ["event", "month"]
    none = F.lit(0.0)
    variable = F.greatest(F.greatest(F.coalesce("gross", none) - F.coalesce("passed", none), none) - fixed_labor, none)
    s = shares.agg(F.collect_list(F.struct("event", "pct"))).scalar()
    spread = months.filter("gross <> 0 OR ops <> 0 OR passed IS NOT NULL").withColumn("_s", s).withColumn("_e", F.explode("_s")).select(
        F.col("_e.event").alias("event"), "month", R2(variable * F.col("_e.pct")).alias("labor_costs"), R2(F.coalesce("ops", none) * F.col("_e.pct")).alias("ops_costs"))
    by_revenue = F.when((F.col("shared") != 0) & (F.col("_t") > 0), F.col("shared") * F.col("adj_revenue") / F.col("_t")).otherwise(none)
    g = revenue.join(months.select("month", "shared", "_t"), "month", "left").select(*k, "net_sales", "adj_revenue", "nights", "txns", R2(by_revenue).alias("shared_costs"))
    g = g.join(event_direct(costs).select(*k, "direct_costs"), k, "full_outer").join(spread, k, "full_outer").na.fill(0)
    g = g.withColumn("total_costs", R2(F.col("direct_costs") + F.col("shared_costs") + F.col("labor_costs") + F.col("ops_costs")))
    g = g.withColumn("net", R2(F.col("adj_revenue") - F.col("total_costs")))
    return g.withColumn("margin_pct", F.round(F.when(F.col("adj_revenue") > 0, F.col("net") / F.col("adj_revenue") * 100).otherwise(0.0), 1))


def event_roi(grid: DataFrame) -> DataFrame:
    """Per event and for all: revenue, costs, net, ROI, margin, per-night values, revenue share."""
    sums = ["net_sales", "adj_revenue", "direct_costs", "shared_costs", "labor_costs", "ops_costs", "nights", "txns"]
    g = grid.rollup("event").agg(*[R2(F.sum(c)).alias(c) for c in sums]).withColumn("event", F.coalesce("event", F.lit("(all)")))
    g = g.withColumn("total_costs", R2(F.col("direct_costs") + F.col("shared_costs") + F.col("labor_costs") + F.col("ops_costs"))).withColumn("net", R2(F.col("adj_revenue") - F.col("total_costs")))
    # The total stands in the rolled-up row itself; the window sees one row per event.
    total = F.max(F.when(F.col("event") == "(all)", F.col("adj_revenue"))).over(W.partitionBy())
    z = lambda n, d, digits=1, f=100: F.round(F.when(F.col(d) > 0, F.col(n) / F.col(d) * f).otherwise(0.0), digits)
    return g.withColumn("_t", total).withColumns({
        "roi_pct": z("net", "total_costs"), "margin_pct": z("net", "adj_revenue"), "avg_nightly": z("adj_revenue", "nights", 2, 1), "cost_per_night": z("total_costs", "nights", 2, 1),
        "revenue_share_pct": z("adj_revenue", "_t")}).drop("_t")


# --- cash and bank ---

def cash_recon(payments: DataFrame, bank: DataFrame) -> DataFrame:
    """POS against bank by month: card and cash differences, running gaps, status."""
    p = month_of(payments.filter(valid_payment(F.col("status"))).withColumn("d", F.to_date("paid_ts")), "d")
    kind = F.col("payment_type")
    pos = p.groupBy("month").agg(
        R2(sum_if(kind == "Credit", "total")).alias("credit_gross"), R2(sum_if(kind == "Credit", "card_fee")).alias("credit_fees"), R2(sum_if(kind == "Cash", "total")).alias("cash_collected"),
        R2(sum_if(~kind.isin("Credit", "Cash"), "total")).alias("other_collected"))
    b = month_of(bank, "transaction_date").withColumn("kind", deposit_type(F.col("description"), F.col("amount"))).filter(F.col("kind").isNotNull())
    k = lambda *names: R2(sum_if(F.col("kind").isin(*names), "amount"))
    dep = b.groupBy("month").agg(k("card_settlement", "processor_deposit", "processor_month_end").alias("card_deposits"), k("platform_fee").alias("platform_fee"), k("counter_credit", "transfer_in").alias("cash_in"))
    x = align_periods(pos, dep, "month")
    x = x.withColumns({"credit_net": R2(F.col("credit_gross") - F.col("credit_fees")), "bank_card_net": R2(F.col("card_deposits") + F.col("platform_fee"))})
    x = x.withColumns({"card_diff": R2(F.col("bank_card_net") - F.col("credit_net")), "cash_gap": R2(F.col("cash_collected") - F.col("cash_in"))})
    x = x.withColumn("card_diff_pct", F.round(F.when(F.col("credit_net") != 0, F.col("card_diff") / F.col("credit_net") * 100).otherwise(0.0), 1))
    x = windows.running_totals(x, "month", {"card_cum_diff": "card_diff", "cash_cum_gap": "cash_gap"})
    a = F.abs("card_diff_pct")
    return x.withColumn("card_status", F.when(a <= 5, "OK").when(a <= 10, "WATCH").otherwise("HIGH"))


def cash_recon_alerts(recon: DataFrame) -> DataFrame:
    zero = recon.filter((F.col("cash_in") == 0) & (F.col("cash_collected") > 0)).select("month", F.lit("zero_cash_deposit").alias("type"), F.col("cash_collected").alias("value"))
    gap = recon.filter((F.abs("card_diff_pct") > 10) & (F.col("credit_net") > 0)).select("month", F.lit("high_card_gap").alias("type"), F.col("card_diff_pct").alias("value"))
    return zero.unionByName(gap)


def cash_recon_totals(recon: DataFrame) -> DataFrame:
    g = recon.agg(R2(F.sum("credit_net")).alias("pos_credit_net"), R2(F.sum("cash_collected")).alias("pos_cash"), R2(F.sum("bank_card_net")).alias("bank_card_net"), R2(F.sum("cash_in")).alias("bank_cash"))
    return g.withColumns({"card_recon_pct": pct(F.col("bank_card_net"), F.col("pos_credit_net")), "cash_deposited_pct": pct(F.col("bank_cash"), F.col("pos_cash")),
                          "undeposited_cash": R2(F.col("pos_cash") - F.col("bank_cash")), "total_card_diff": R2(F.col("bank_card_net") - F.col("pos_credit_net"))})


def cash_undeposited(payments: DataFrame, bank: DataFrame, transfer_texts: list[str]) -> DataFrame:
    """Cash rung up minus three deposit patterns by month."""
    x = align_periods(cash_collected(month_of(payments, "processing_date"), "month"), cash_deposited(
        month_of(bank, "transaction_date"), "month", CASH_IN_WORDS[0], [*CASH_IN_WORDS[1], *transfer_texts], ["TRANSFER_IN_ACCOUNT_TRANSFER"]), "month")
    return x.select("month", "cash_collected", "cash_deposited", R2(F.col("cash_collected") - F.col("cash_deposited")).alias("undeposited"))


def bank_review(bank: DataFrame) -> DataFrame:
    """Counts, totals and latest date by category source, plus an '(all)' row."""
    g = bank.rollup("category_source").agg(F.grouping("category_source").alias("g"), F.count("*").alias("n"), R2(F.sum("abs_amount")).alias("total"), F.max("transaction_date").alias("latest"), F.max("source_file").alias("latest_file"))
    return g.select(F.when(F.col("g") == 1, "(all)").otherwise(F.col("category_source")).alias("category_source"), "n", "total", "latest", "latest_file")


def flash(orders, payments, bank, day: str) -> DataFrame:
    """One day: revenue against the same weekday a week before, expenses by section, cash gap, margins."""
    d = F.lit(day).cast("date")
    now, then = F.col("processing_date") == d, F.col("processing_date") == F.date_sub(d, 7)
    o = orders.filter(not_voided(F.col("voided")) & (now | then))
    sec = debits(bank).filter((F.col("transaction_date") == d) & (F.col("category") != "Uncategorized")).withColumn("s", expense_section(F.col("category")))
    e = sec.agg(F.struct(*[R2(sum_if(F.col("s") == s, "abs_amount")).alias(s) for s in ("cogs", "labor", "marketing", "opex", "other")])).scalar()
    pos = dates.bracketed_business_range(payments, "paid_ts", "processing_date", day, day).filter((F.lower("payment_type") == "cash") & (F.col("status") == "CAPTURED")).agg(R2(sum0("total"))).scalar()
    dep = bank.filter((F.col("transaction_date") == d) & (F.col("amount") > 0) & contains_any(F.col("description"), ["counter credit", "cash deposit"])).agg(R2(sum0("amount"))).scalar()
    g = o.agg(
        R2(sum_if(now, "total")).alias("revenue"), F.count_distinct(F.when(now, F.col("order_id"))).alias("orders"), F.coalesce(F.sum(F.when(now, F.col("guest_count"))), F.lit(0)).alias("guests"),
        R2(sum_if(now, "tip")).alias("tips"), R2(sum_if(now, "gratuity")).alias("gratuity"), R2(sum_if(then, "total")).alias("prior_revenue"))
    g = g.withColumns({"e": e, "cash_collected": pos, "cash_deposited": dep})
    g = g.withColumn("adj_revenue", R2(F.col("revenue") + portion(F.col("gratuity"), rb.GRAT_RETAIN))).withColumn("passed", R2(F.col("tips") + portion(F.col("gratuity"), 1 - rb.GRAT_RETAIN)))
    spent = F.col("e.cogs") + F.col("e.labor") + F.col("e.marketing") + F.col("e.opex") + F.col("e.other")
    return g.select("revenue", "orders", "guests", "prior_revenue", F.round(F.when(F.col("prior_revenue") != 0, (F.col("revenue") - F.col("prior_revenue")) / F.col("prior_revenue") * 100), 1).alias("change_pct"),
                    "e.*", "cash_collected", "cash_deposited", R2(F.col("cash_collected") - F.col("cash_deposited")).alias("cash_gap"), "adj_revenue", pct(F.col("e.cogs"), F.col("adj_revenue")).alias("cogs_pct"),
                    pct(F.greatest(F.col("e.labor") - F.col("passed"), F.lit(0.0)), F.col("adj_revenue")).alias("labor_pct"), pct(F.col("adj_revenue") - R2(spent), F.col("adj_revenue")).alias("net_pct"))


# --- vendors ---

def _vendor_rows(bank: DataFrame) -> DataFrame:
    return debits(bank).filter(F.col("vendor_normalized").isNotNull() & (F.col("vendor_normalized") != "") & (F.col("category") != "Uncategorized"))


def vendor_top(bank: DataFrame, n: int) -> DataFrame:
    g = _vendor_rows(bank).groupBy("vendor_normalized", "category").agg(
        F.count("*").alias("txn_count"), R2(F.sum(F.abs("amount"))).alias("total_spend"), mean_money("abs_amount", F.count("*")).alias("avg_per_txn"), F.min("transaction_date").alias("first_txn"),
        F.max("transaction_date").alias("last_txn"), F.count_distinct(dates.month_label(F.col("transaction_date"))).alias("active_months"))
    return g.orderBy(F.desc("total_spend"), "vendor_normalized", "category").limit(n).withColumn("section", category_section(F.col("category")))


def vendor_trend(bank: DataFrame, n: int = 15) -> DataFrame:
    ok = F.coalesce(F.col("vendor_normalized") != "", F.lit(False)) & (F.col("category") != "Uncategorized")
    b = restrict_to_top(debits(bank), "vendor_normalized", F.col("abs_amount"), n, ok)
    return month_of(b, "transaction_date").groupBy("month", F.col("vendor_normalized").alias("vendor")).agg(R2(F.sum("abs_amount")).alias("spend"), F.count("*").alias("txn_count"))


def vendor_sections(bank: DataFrame) -> DataFrame:
    return debits(bank).filter("category <> 'Uncategorized'").groupBy(category_section(F.col("category")).alias("section")).agg(
        R2(F.sum("abs_amount")).alias("total_spend"), F.count("*").alias("txn_count"), F.count_distinct("vendor_normalized").alias("vendor_count"))


def vendor_concentration(top: DataFrame) -> DataFrame:
    return top_shares(top, "total_spend", [("top_5", 5), ("top_10", 10), ("top_20", 20)])


def vendor_anomalies(trend: DataFrame, rise: float = 25, high: float = 50) -> DataFrame:
    c = windows.last_change(trend, "vendor", "month", "spend")
    raw = (F.col("current") - F.col("prior")) / F.col("prior") * 100
    return c.filter((F.col("prior") > 0) & (raw > rise)).withColumn("severity", F.when(raw > high, "high").otherwise("medium"))


def vendor_kpis(top: DataFrame, sections: DataFrame, anomalies: DataFrame) -> DataFrame:
    a = anomalies.agg(F.struct(F.count("*").alias("n"), F.count_if(F.col("severity") == "high").alias("h"))).scalar()
    s = sections.agg(F.count("*")).scalar()
    g = top.agg(F.count("*").alias("total_vendors"), R2(F.sum("total_spend")).alias("total_spend"), R2(F.sum("total_spend") / F.count("*")).alias("avg_vendor_spend"))
    return g.withColumns({"total_categories": s, "a": a}).select("total_vendors", "total_spend", "avg_vendor_spend", "total_categories", F.col("a.n").alias("anomaly_count"), F.col("a.h").alias("high_anomalies"))


# --- prime cost and statements ---

def prime_cost(orders, bank, periods, side_stream: list[str], adjustments: DataFrame | None = None) -> DataFrame:
    """Revenue parts, cost of goods, labor, prime percentage and grade per labelled period.

    ``adjustments``: month (first day), amount; added where the month start lies in the period.
    """
    r = revenue_by(dates.by_period(orders, "processing_date", periods), "label").select("label", "net_sales", "gratuity", "tips")
    b = dates.by_period(bank, "transaction_date", periods)
    k = F.when(F.col("transaction_type") == "debit", prime_bucket(F.col("category")))
    e = b.groupBy("label").agg(
        R2(sum_if(k == "liquor_cogs", "abs_amount")).alias("liquor_cogs"), R2(sum_if(k == "food_cogs", "abs_amount")).alias("food_cogs"), R2(sum_if(k == "labor", "abs_amount")).alias("labor_total"),
        R2(sum_if(contains_any(F.col("category"), side_stream) & (F.col("amount") > 0), "amount")).alias("side_stream"))
    x = align_periods(r, e, "label")
    if adjustments is not None:
        a = dates.by_period(adjustments, "month", periods).groupBy("label").agg(R2(F.sum("amount")).alias("adjustment"))
        x = x.join(a, "label", "left").na.fill(0)
    else:
        x = x.withColumn("adjustment", F.lit(0.0))
    x = x.withColumns({"gross_revenue": R2(F.col("net_sales") + F.col("gratuity") + F.col("tips") + F.col("side_stream") + F.col("adjustment")),
                       "labor_ex_tips": R2(F.greatest(F.col("labor_total") - F.col("gratuity") - F.col("tips"), F.lit(0.0))), "cogs_total": R2(F.col("liquor_cogs") + F.col("food_cogs"))})
    x = x.withColumns({"prime_cost": R2(F.col("cogs_total") + F.col("labor_total")), "prime_cost_real": R2(F.col("cogs_total") + F.col("labor_ex_tips"))})
    raw = F.when(F.col("gross_revenue") > 0, F.col("prime_cost") / F.col("gross_revenue") * 100).otherwise(0.0)
    x = x.withColumn("grade", step_grade(raw, rb.PRIME_GRADES, "Investigate"))
    return x.withColumns({"prime_pct": F.round(raw, 2), "prime_pct_real": pct(F.col("prime_cost_real"), F.col("gross_revenue"), 2), "labor_pct": pct(F.col("labor_total"), F.col("gross_revenue"), 2)})


def month_adjustment(monthly: DataFrame, adjustments: DataFrame, value: str) -> DataFrame:
    """Manual month amounts added to a monthly value; a month with only an adjustment appears too."""
    a = adjustments.select(dates.month_label(F.col("month")).alias("month"), F.col("amount").alias(value))
    return monthly.select("month", value).unionByName(a).groupBy("month").agg(R2(F.sum(value)).alias(value))


def prime_alert(prime: DataFrame, rolling: str, threshold: float) -> DataFrame:
    """The rolling window's prime % against a threshold and the mean of the other periods."""
    g = prime.agg(F.max(F.when(F.col("label") == rolling, F.col("prime_pct"))).alias("rolling_pct"), R2(F.avg(F.when(F.col("label") != rolling, F.col("prime_pct")))).alias("mean_pct"))
    return g.withColumns({"over_threshold": F.col("rolling_pct") >= threshold, "above_mean": F.col("rolling_pct") > F.col("mean_pct")})


def revenue_by_category(items: DataFrame) -> DataFrame:
    c = F.col("sales_category")
    return month_of(items.filter(not_voided(F.col("voided"))), "processing_date").groupBy("month").agg(
        R2(sum_if(c == "Food", "net_price")).alias("food_rev"), R2(sum_if(c == "Liquor", "net_price")).alias("liquor_rev"), R2(sum0("net_price")).alias("item_total"))


def side_stream_bank(bank: DataFrame, words: list[str]) -> DataFrame:
    return month_of(bank.filter(contains_any(F.col("category"), words) & (F.col("amount") > 0)), "transaction_date").groupBy("month").agg(R2(F.sum("amount")).alias("side_bank"))


def side_stream_pos(items: DataFrame, words: list[str]) -> DataFrame:
    i = items.filter(not_voided(F.col("voided")) & contains_any(F.col("sales_category"), words))
    return month_of(i, "processing_date").groupBy("month").agg(R2(F.sum("net_price")).alias("side_pos"))


def sales_tax(orders: DataFrame) -> DataFrame:
    return month_of(orders.filter(not_voided(F.col("voided"))), "processing_date").groupBy("month").agg(R2(F.sum("tax")).alias("sales_tax"))


def statement_pnl(orders, items, payments, bank, lines: list[tuple[str, str, list[str]]], side_words: list[str], side_pos_words: list[str], transfer_texts: list[str]) -> DataFrame:
    """Statement per month and in total as (month, line, amount).

    ``lines``: (section, line, keywords) of the expense lines; sections are cogs, labor,
    marketing, opex. Category totals may feed several lines, as keywords overlap.
    """
    r = revenue_by(month_of(orders, "processing_date"), "month").select("month", "net_sales", "tips", "gratuity")
    parts = [revenue_by_category(items).drop("item_total"), side_stream_bank(bank, side_words), side_stream_pos(items, side_pos_words), sales_tax(orders),
             cash_undeposited(payments, bank, transfer_texts).select("month", "undeposited")]
    cats = month_of(debits(bank), "transaction_date").groupBy("month", "category").agg(R2(F.sum("abs_amount")).alias("abs_amount"))
    names = [n for _, n, _ in lines]
    parts.append(any_match_sums(cats, {n: w for _, n, w in lines}, "category", "abs_amount", ["month"]))
    x = r
    for p in parts:
        x = x.join(p, "month", "full_outer")
    base = [c for c in x.columns if c != "month"]
    # Ratios and subtotals are derived after the total row is formed from sums.
    x = x.na.fill(0).rollup("month").agg(*[R2(F.sum(c)).alias(c) for c in base]).withColumn("month", F.coalesce("month", F.lit("total")))
    tot = lambda sec: sum((F.col(n) for s, n, _ in lines if s == sec), F.lit(0.0))
    x = x.withColumns({"other_rev": R2(F.greatest(F.col("net_sales") - F.col("food_rev") - F.col("liquor_rev") - F.col("side_pos"), F.lit(0.0))),
                       "total_revenue": R2(F.col("net_sales") + F.col("tips") + F.col("gratuity") + F.col("undeposited") + F.col("sales_tax") + F.col("side_bank")),
                       **{f"total_{s}": R2(tot(s)) for s in ("cogs", "labor", "marketing", "opex")}})
    x = x.withColumn("gross_profit", R2(F.col("total_revenue") - F.col("total_cogs")))
    x = x.withColumn("ebitda", R2(F.col("gross_profit") - F.col("total_labor") - F.col("total_marketing") - F.col("total_opex")))
    x = x.withColumn("ebitda_pct", pct_of_positive(F.col("ebitda"), F.col("total_revenue")))
    return x.unpivot(["month"], [*base, "other_rev", "total_revenue", "total_cogs", "gross_profit", "total_labor", "total_marketing", "total_opex", "ebitda", "ebitda_pct"], "line", "amount")


def addback(statement: DataFrame, adjusted_lines: list[str], further_lines: list[str]) -> DataFrame:
    """Reported, adjusted and fully adjusted EBITDA per period of a statement."""
    pick = lambda names: R2(sum_if(F.col("line").isin(names), "amount"))
    g = statement.groupBy("month").agg(pick(["ebitda"]).alias("reported"), pick(["total_revenue"]).alias("revenue"), pick(adjusted_lines).alias("addbacks"), pick(further_lines).alias("further"))
    g = g.withColumns({"adjusted": R2(F.col("reported") + F.col("addbacks")), "fully_adjusted": R2(F.col("reported") + F.col("addbacks") + F.col("further"))})
    return g.withColumn("fully_adjusted_pct", pct_of_positive(F.col("fully_adjusted"), F.col("revenue")))


# --- quarter review ---

def quarter_facts(orders, items, bank, periods, side_stream: list[str]) -> DataFrame:
    """Revenue and its parts, cost buckets, EBITDA and margin per labelled period."""
    r = revenue_by(dates.by_period(orders, "processing_date", periods), "label").select("label", "net_sales", "tips", "gratuity", "order_count")
    b = dates.by_period(bank, "transaction_date", periods)
    k = F.when(F.col("transaction_type") == "debit", cost_bucket(F.col("category")))
    e = b.groupBy("label").agg(*[R2(sum_if(k == n, "abs_amount")).alias(n) for n in ("cogs", "labor", "opex")],
                               R2(sum_if(contains_any(F.col("category"), side_stream) & (F.col("amount") > 0), "amount")).alias("side_stream"))
    x = align_periods(r, e, "label").withColumn("gross", R2(F.col("net_sales") + F.col("tips") + F.col("gratuity") + F.col("side_stream")))
    x = x.withColumn("ebitda", R2(F.col("gross") - F.col("cogs") - F.col("labor") - F.col("opex")))
    return x.withColumns({"ebitda_pct": pct(F.col("ebitda"), F.col("gross")), "labor_pct": pct(F.col("labor"), F.col("gross")), "cogs_pct": pct(F.col("cogs"), F.col("gross"))})


def quarter_mix(items, periods) -> DataFrame:
    g = dates.by_period(items.filter(not_voided(F.col("voided"))), "processing_date", periods).groupBy("label", "sales_category").agg(R2(F.sum("net_price")).alias("revenue"))
    t = g.groupBy("label").agg(F.sum("revenue").alias("_t"))
    return g.join(t, "label").withColumn("share_pct", pct(F.col("revenue"), F.col("_t"))).drop("_t")


def quarter_expenses(bank, periods, bucket: str | None = None) -> DataFrame:
    g = dates.by_period(debits(bank), "transaction_date", periods).withColumn("bucket", cost_bucket(F.col("category")))
    if bucket:
        g = g.filter(F.col("bucket") == bucket)
    return g.groupBy("label", "bucket", "category").agg(R2(F.sum("abs_amount")).alias("total"))


def quarter_kpis(orders, checks, labor, periods) -> DataFrame:
    c = dates.by_period(checks.select("check_id", "total", "processing_date").dropDuplicates(), "processing_date", periods).groupBy("label").agg(
        F.count("*").alias("checks"), mean_money("total", F.count("*")).alias("avg_check"), F.count_distinct("processing_date").alias("business_days"))
    o = dates.by_period(orders.filter(not_voided(F.col("voided"))), "processing_date", periods).groupBy("label").agg(F.sum("guest_count").alias("covers"), R2(F.sum("amount")).alias("net"))
    h = dates.by_period(labor, "processing_date", periods).groupBy("label").agg(F.sum(F.col("regular_hours") + F.col("overtime_hours")).alias("labor_hours"))
    return c.join(o, "label").join(h, "label").withColumns({"revenue_per_day": R2(F.col("net") / F.col("business_days")), "revenue_per_hour": R2(F.col("net") / F.col("labor_hours"))})


def quarter_staff(items, orders, periods, n: int = 5) -> DataFrame:
    """Top staff by items made and top servers by revenue per period."""
    a = dates.by_period(items.filter(not_voided(F.col("voided"))), "processing_date", periods).groupBy("label", F.col("cook").alias("name")).agg(F.sum("qty").cast("double").alias("value"))
    b = dates.by_period(orders.filter(not_voided(F.col("voided")) & F.col("server").isNotNull()), "processing_date", periods).groupBy("label", F.col("server").alias("name")).agg(R2(F.sum("total")).alias("value"))
    top = lambda d, kind: windows.top_per_key(d, ["label"], [F.desc("value"), F.asc("name")], n).withColumn("kind", F.lit(kind))
    return top(a, "items").unionByName(top(b, "revenue"))


def quarter_cashflow(bank, periods, warn_pct: float = 15.0) -> DataFrame:
    """Top 10 vendors per period with their share of spend and a concentration warning."""
    v = dates.by_period(debits(bank).filter("vendor_normalized IS NOT NULL"), "transaction_date", periods).groupBy("label", "vendor_normalized").agg(R2(F.sum("abs_amount")).alias("total"))
    t = v.groupBy("label").agg(F.sum("total").alias("_t"))
    x = windows.top_per_key(v, ["label"], [F.desc("total"), F.asc("vendor_normalized")], 10).join(t, "label").withColumn("share_pct", pct(F.col("total"), F.col("_t")))
    return x.withColumn("warning", F.col("share_pct") > warn_pct).drop("_t")


def quarter_change(facts: DataFrame, current: str, prior: str, metrics: list[str]) -> DataFrame:
    """Percent change of each metric between two labelled periods, NULL on a zero prior."""
    long = facts.select("label", *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(["label"], metrics, "metric", "value")
    g = long.groupBy("metric").agg(F.max(F.when(F.col("label") == current, F.col("value"))).alias("value"), F.max(F.when(F.col("label") == prior, F.col("value"))).alias("prior"))
    return g.withColumn("change_pct", F.round(F.when(F.col("prior") != 0, (F.col("value") - F.col("prior")) / F.abs("prior") * 100), 1))


# --- gratuity and payouts ---

def gratuity_buckets(orders, roles: DataFrame, house_shares: dict[str, float], pool: str = "Bottle Manager") -> DataFrame:
    """Gratuity by role bucket with the house and the staff share."""
    o = orders.filter(not_voided(F.col("voided"))).join(roles.select(F.col("employee_name").alias("server"), "primary_role"), "server", "left")
    b = F.when(F.col("server") == pool, pool).when(F.col("primary_role").isin("Bartender", "Server"), F.col("primary_role")).otherwise("Other")
    g = o.groupBy(b.alias("bucket")).agg(R2(F.sum("amount")).alias("net_sales"), R2(F.sum("gratuity")).alias("gratuity"), R2(F.sum("tip")).alias("tips"), F.count("*").alias("orders"))
    share = F.create_map(*[F.lit(x) for kv in house_shares.items() for x in kv])[F.col("bucket")]
    g = g.withColumn("house_share", share).withColumn("house", F.round(F.round(F.col("gratuity") * 100) * F.round(F.col("house_share") * 100) / 100) / 100)
    return g.withColumn("staff", R2(F.col("gratuity") - F.col("house")))


def gratuity_scenarios(buckets: DataFrame, target: float, raise_buckets: list[str]) -> DataFrame:
    """House share needed in one bucket, or in all alike, to reach the target share."""
    of = lambda c, b: F.coalesce(F.max(F.when(F.col("bucket") == b, F.col(c))), F.lit(0.0))
    t = buckets.agg(F.sum("gratuity").alias("total"), F.sum("house").alias("current"), *[of("gratuity", b).alias(f"g{i}") for i, b in enumerate(raise_buckets)],
                    *[of("house", b).alias(f"h{i}") for i, b in enumerate(raise_buckets)], *[of("house_share", b).alias(f"s{i}") for i, b in enumerate(raise_buckets)])
    gap = F.col("total") * target - F.col("current")
    pool = sum((F.col(f"g{i}") for i in range(len(raise_buckets))), F.lit(0.0))
    rows = [F.struct(F.lit(f"raise {b}").alias("scenario"), F.lit(b).alias("bucket"), F.when(F.col(f"g{i}") > 0, F.round((F.col(f"h{i}") + gap) / F.col(f"g{i}"), 4)).alias("house_share")) for i, b in enumerate(raise_buckets)]
    rows += [F.struct(F.lit("raise all").alias("scenario"), F.lit(b).alias("bucket"), F.when(F.col(f"g{i}") > 0, F.round(F.col(f"s{i}") + gap / pool, 4)).alias("house_share")) for i, b in enumerate(raise_buckets)]
    return t.select(F.explode(F.array(*rows)).alias("r")).select("r.*").filter("house_share IS NOT NULL")


def payout_sales(items_in_window: DataFrame) -> DataFrame:
    """Category sales per event over item lines already tagged with their event."""
    from ..functions.predicates import not_voided_lenient
    low = F.lower("sales_category")
    i = items_in_window.filter(not_voided_lenient(F.col("voided")))
    s = lambda rx: R2(sum_if(low.rlike(rx), "net_price"))
    return i.groupBy("event").agg(s(rb.LIQUOR_SALES).alias("net_liquor"), s(rb.FOOD_SALES).alias("net_food"), s(rb.SHISHA_SALES).alias("net_shisha"), F.count("*").alias("item_rows"))


def payout(sales: DataFrame, rates: DataFrame) -> DataFrame:
    """Gross, cost of goods, tax, net, expenses, profit and payout per event.

    ``rates``: event, liquor_cogs_pct, food_cogs_pct, tax_pct, expenses, payout_pct.
    """
    x = sales.join(rates, "event")
    x = x.withColumns({"gross": F.col("net_liquor") + F.col("net_food") + F.col("net_shisha"), "cogs": F.col("net_liquor") * F.col("liquor_cogs_pct") + F.col("net_food") * F.col("food_cogs_pct"),
                       "tax": F.col("net_liquor") * F.col("tax_pct")})
    x = x.withColumn("net_sales", F.col("gross") - F.col("cogs") - F.col("tax")).withColumn("net_profit", F.col("net_sales") - F.col("expenses"))
    return x.select("event", *[R2(c).alias(c) for c in ("gross", "cogs", "tax", "net_sales", "expenses", "net_profit")], R2(F.col("net_profit") * F.col("payout_pct")).alias("payout"))
