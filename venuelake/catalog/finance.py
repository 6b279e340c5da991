"""Finance reports with their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import joins
from ..plans import finance as fin
from ..plans import insights as ins
from ..sources import sinks
from .oracle_tables import with_tables
from .registry import ORACLES, QUERIES, query
from .relational import WINDOW_SQL, WINDOWS

_KEPT = "(voided IS NULL OR voided = 'false')"
_RET, _PASS = "round(round({g} * 100) * 35 / 100) / 100", "round(round({g} * 100) * 65 / 100) / 100"


def _like(col, words):
    return "(" + " OR ".join(f"contains(lower({col}), '{w}')" for w in words) + ")"


COGS, LABOR = _like("category", ["cost of goods", "cogs"]), _like("category", ["3. labor", "labor cost", "payroll"])
MKT, OPEX = _like("category", ["marketing", "promotions", "entertainment", "event"]), _like("category", ["operating expenses", "opex"])


def rev_sql(key, src="v_orders"):
    return f"""SELECT *, round(net_sales + grat_retained, 2) AS adj_revenue FROM (SELECT *, {_RET.format(g='gratuity')} AS grat_retained, round(tips + {_PASS.format(g='gratuity')}, 2) AS pass_through FROM (
      SELECT {key} AS k, round(sum(amount), 2) AS net_sales, round(sum(tip), 2) AS tips, round(sum(gratuity), 2) AS gratuity, count(DISTINCT order_id) AS order_count FROM {src} WHERE {_KEPT} GROUP BY 1))"""


def exp_sql(key, src="v_bank"):
    s = lambda c: f"round(coalesce(sum(abs_amount) FILTER ({c}), 0), 2)"
    return f"""SELECT {key} AS k, {s(COGS)} AS cogs, {s(LABOR)} AS labor_gross, {s(MKT)} AS marketing, {s(OPEX)} AS opex, {s("NOT contains(lower(category), 'revenue')")} AS total_exp
      FROM {src} WHERE transaction_type = 'debit' GROUP BY 1"""


_FLOOR = {"zero": "greatest(raw, 0)", "gross": "CASE WHEN raw < 0 THEN total_exp ELSE raw END", "half": "greatest(raw, total_exp * 0.5)"}


def pnl_sql(okey, bkey, key, floor="zero", osrc="v_orders", bsrc="v_bank"):
    pc = lambda c: f"round({c} / CASE WHEN adj_revenue > 0 THEN adj_revenue ELSE 1 END * 100, 1)"
    num = ["net_sales", "tips", "gratuity", "order_count", "grat_retained", "pass_through", "adj_revenue", "cogs", "labor_gross", "marketing", "opex", "total_exp"]
    co = ", ".join(f"coalesce({c}, 0) AS {c}" for c in num)
    return f"""SELECT k AS {key}, {', '.join(num)}, labor_true, adj_expenses, net_profit, prime_cost, {pc('cogs')} AS cogs_pct, {pc('labor_true')} AS labor_pct, {pc('prime_cost')} AS prime_pct,
        {pc('marketing')} AS marketing_pct, {pc('opex')} AS opex_pct, {pc('net_profit')} AS margin_pct
      FROM (SELECT *, round(adj_revenue - adj_expenses, 2) AS net_profit, round(cogs + labor_true, 2) AS prime_cost FROM (SELECT *, round(greatest(labor_gross - pass_through, 0), 2) AS labor_true, round({_FLOOR[floor]}, 2) AS adj_expenses
      FROM (SELECT *, total_exp - pass_through AS raw FROM (SELECT coalesce(r.k, e.k) AS k, {co} FROM ({rev_sql(okey, osrc)}) r FULL OUTER JOIN ({exp_sql(bkey, bsrc)}) e ON r.k = e.k))))"""


OM, BM = "strftime(processing_date, '%Y-%m')", "strftime(transaction_date, '%Y-%m')"
OW, BW = "CAST(date_trunc('week', processing_date) AS DATE)", "CAST(date_trunc('week', transaction_date) AS DATE)"
PNL_M, PNL_W = pnl_sql(OM, BM, "month"), pnl_sql(OW, BW, "week_start")


def monthly(t, floor="zero"):
    return fin.pnl(fin.month_of(t.orders, "processing_date"), fin.month_of(t.bank, "transaction_date"), "month", floor)


# --- labor and P&L ---

@query("rep_labor_analysis", f"SELECT week_start, adj_revenue, labor_gross, labor_true, labor_pct, pass_through, order_count FROM ({PNL_W})")
def _(t):
    p = fin.pnl(fin.week_of(t.orders, "processing_date"), fin.week_of(t.bank, "transaction_date"), "week_start")
    return p.select("week_start", "adj_revenue", "labor_gross", "labor_true", "labor_pct", "pass_through", "order_count")


@query("rep_labor_analysis_monthly", f"SELECT month, adj_revenue, labor_gross, labor_true, labor_pct, cogs, prime_pct FROM ({PNL_M})")
def _(t):
    return monthly(t).select("month", "adj_revenue", "labor_gross", "labor_true", "labor_pct", "cogs", "prime_pct")


@query("rep_labor_analysis_vendors", """
  SELECT coalesce(vendor_normalized, description) AS vendor, round(sum(abs_amount), 2) AS total, count(*) AS txn_count FROM v_bank WHERE transaction_type = 'debit'
    AND (contains(lower(category), 'labor') OR contains(lower(category), 'payroll')) GROUP BY 1""")
def _(t):
    return fin.labor_vendors(t.bank)


@query("rep_labor_analysis_kpis", f"""
  WITH w AS ({PNL_W}), p AS (SELECT CASE WHEN labor_true > 0 AND adj_revenue > 0 THEN labor_pct END AS p, labor_true FROM w)
  SELECT round(sum(labor_true) / greatest(count(*) FILTER (labor_true > 0), 1), 2) AS avg_weekly_labor, round(coalesce(avg(p), 0), 2) AS avg_labor_pct, coalesce(min(p), 0) AS best_week_pct, coalesce(max(p), 0) AS worst_week_pct,
    round(sum(labor_true), 2) AS total_labor_true FROM p""")
def _(t):
    return fin.labor_kpis(fin.pnl(fin.week_of(t.orders, "processing_date"), fin.week_of(t.bank, "transaction_date"), "week_start"))


CASH_TXN = "(contains(payment_type, 'Cash') OR contains(payment_type, 'CASH'))"
DEPOSIT = "transaction_type = 'credit' AND (contains(lower(category), 'cash deposit') OR contains(lower(category), 'cash account transfer') OR contains(lower(description), 'counter credit'))"
CASH_SQL = f"""SELECT coalesce(a.month, b.month) AS month, coalesce(cash_collected, 0) AS cash_collected, coalesce(cash_txns, 0) AS cash_txns, coalesce(cash_deposited, 0) AS cash_deposited FROM
  (SELECT {OM} AS month, round(coalesce(sum(total) FILTER ({CASH_TXN}), 0), 2) AS cash_collected, count(*) FILTER ({CASH_TXN}) AS cash_txns FROM v_payments GROUP BY 1) a
  FULL OUTER JOIN (SELECT {BM} AS month, round(sum(abs_amount), 2) AS cash_deposited FROM v_bank WHERE {DEPOSIT} GROUP BY 1) b ON a.month = b.month"""


@query("rep_monthly_pnl", f"SELECT p.*, coalesce(c.cash_collected, 0) AS cash_collected, coalesce(c.cash_txns, 0) AS cash_txns, coalesce(c.cash_deposited, 0) AS cash_deposited, round(coalesce(c.cash_collected, 0) - coalesce(c.cash_deposited, 0), 2) AS unreconciled_cash FROM ({PNL_M}) p LEFT JOIN ({CASH_SQL}) c ON c.month = p.month")
def _(t):
    return fin.monthly_pnl(t.orders, t.payments, t.bank)


@query("rep_profit_summary", f"""
  SELECT p.*, cash_collected, cash_txns, cash_deposited, drawer_collected, payouts, overages, shortages, no_sale_count, round(cash_collected - cash_deposited, 2) AS undeposited_cash,
    round(net_profit + round(cash_collected - cash_deposited, 2), 2) AS cash_adj_profit, round(round(net_profit + round(cash_collected - cash_deposited, 2), 2) / adj_revenue * 100, 1) AS cash_adj_margin
  FROM ({pnl_sql("'all'", "'all'", 'period', 'gross')}) p, (SELECT round(sum(total) FILTER ({CASH_TXN}), 2) AS cash_collected, count(*) FILTER ({CASH_TXN}) AS cash_txns FROM v_payments),
    (SELECT round(sum(abs_amount), 2) AS cash_deposited FROM v_bank WHERE {DEPOSIT}), (SELECT round(sum(amount) FILTER (action = 'CASH_COLLECTED'), 2) AS drawer_collected, round(sum(abs(amount)) FILTER (action = 'PAY_OUT'), 2) AS payouts,
    round(sum(amount) FILTER (action = 'CLOSE_OUT_OVERAGE'), 2) AS overages, round(sum(abs(amount)) FILTER (action = 'CLOSE_OUT_SHORTAGE'), 2) AS shortages, count(*) FILTER (action = 'NO_SALE') AS no_sale_count FROM v_cash)""")
def _(t):
    return fin.profit_summary(t.orders, t.payments, t.bank, t.cash_entries)


@query("rep_comprehensive", f"""
  SELECT 'month' AS part, month AS key, net_sales AS value FROM ({PNL_M})
  UNION ALL SELECT 'weekday', dayname(CAST(paid_ts - INTERVAL 4 HOUR AS DATE)), round(sum(amount), 2) FROM v_payments WHERE void_ts IS NULL GROUP BY 2
  UNION ALL SELECT 'hour', CAST(CAST(extract(hour FROM paid_ts) AS INT) AS VARCHAR), round(sum(total), 2) FROM v_payments WHERE void_ts IS NULL GROUP BY 2""")
def _(t):
    from ..plans import sales
    m = monthly(t).select(F.lit("month").alias("part"), F.col("month").alias("key"), F.col("net_sales").alias("value"))
    d = sales.revenue_by_dow(t.payments).select(F.lit("weekday").alias("part"), F.col("day").alias("key"), F.col("net_sales").alias("value"))
    h = sales.hourly_profile(t.payments).select(F.lit("hour").alias("part"), F.col("hour").cast("string").alias("key"), F.col("gross_revenue").alias("value"))
    return m.unionByName(d).unionByName(h)


# --- KPI ---

PERIODS = [("current", date(2000, 7, 1), date(2001, 6, 30)), ("prior", date(1999, 7, 1), date(2000, 6, 30))]
TREND = PERIODS + dates.trailing_months(date(2001, 7, 15), 6)


def _periods_sql(periods):
    return "(VALUES " + ", ".join(f"('{n}', DATE '{s}', DATE '{e}')" for n, s, e in periods) + ") AS pp(label, s, e)"


def kpi_sql(periods):
    o = f"(SELECT o.*, label FROM v_orders o JOIN {_periods_sql(periods)} ON processing_date BETWEEN s AND e)"
    b = f"(SELECT b.*, label FROM v_bank b JOIN {_periods_sql(periods)} ON transaction_date BETWEEN s AND e)"
    return f"""SELECT p.label, adj_revenue, net_profit, cogs_pct, labor_pct, prime_pct, margin_pct, marketing_pct, opex_pct, CASE WHEN order_count > 0 THEN round(net_sales / order_count, 2) ELSE 0 END AS avg_check,
      CASE WHEN days > 0 THEN round(order_count / days, 1) ELSE 0 END AS orders_per_day, CASE WHEN net_sales + va <> 0 THEN round(va / (net_sales + va) * 100, 1) ELSE 0 END AS void_rate,
      CASE WHEN net_sales + disc <> 0 THEN round(disc / (net_sales + disc) * 100, 1) ELSE 0 END AS discount_rate, CASE WHEN labor_true > 0 THEN round(adj_revenue / (labor_true / 18), 2) ELSE 0 END AS rev_per_labor_hour,
      CASE WHEN guests > 0 THEN round(rep / guests * 100, 1) ELSE 0 END AS repeat_guest_pct, CASE WHEN grev > 0 THEN round(rrev / grev * 100, 1) ELSE 0 END AS repeat_rev_pct, CASE WHEN guests > 0 THEN round(risk / guests * 100, 1) ELSE 0 END AS at_risk_pct
    FROM ({pnl_sql('label', 'label', 'label', 'gross', o, b)}) p
    JOIN (SELECT label, count(DISTINCT processing_date) FILTER ({_KEPT}) AS days, round(sum(discount_amount) FILTER ({_KEPT}), 2) AS disc, round(coalesce(sum(abs(amount)) FILTER (voided = 'true'), 0), 2) AS va FROM {o} GROUP BY 1) x ON x.label = p.label
    JOIN (SELECT label, count(*) AS guests, count(*) FILTER (days >= 2) AS rep, round(sum(spend), 2) AS grev, round(coalesce(sum(spend) FILTER (days >= 2), 0), 2) AS rrev, count(*) FILTER (days >= 3 AND rec BETWEEN 46 AND 90) AS risk
      FROM (SELECT label, card_digits || '-' || coalesce(card_type, '') AS card, count(DISTINCT CAST(paid_ts AS DATE)) AS days, round(sum(amount), 2) AS spend, any_value(e) - max(CAST(paid_ts AS DATE)) AS rec
        FROM v_payments JOIN {_periods_sql(periods)} ON CAST(paid_ts AS DATE) BETWEEN s AND e WHERE status IN ('CAPTURED', 'AUTHORIZED', 'CAPTURE_IN_PROGRESS') AND card_digits IS NOT NULL GROUP BY 1, 2) GROUP BY 1) g ON g.label = p.label"""


def kpi(t, periods):
    return fin.kpi_metrics(t.orders, t.bank, t.payments, periods)


@query("rep_kpi_metrics", kpi_sql(TREND))
def _(t):
    return kpi(t, TREND)


BENCH = [("cogs_pct", 28.0, 32.0, True), ("labor_pct", 30.0, 35.0, True), ("prime_pct", 60.0, 65.0, True), ("margin_pct", 10.0, 5.0, False), ("avg_check", 240.0, 200.0, False), ("orders_per_day", 40.0, 5.0, False),
         ("void_rate", 2.0, 10.0, True), ("discount_rate", 2.0, 8.0, True), ("repeat_guest_pct", 60.0, 30.0, False), ("at_risk_pct", 5.0, 10.0, True)]
BENCH_SQL = "(VALUES " + ", ".join(f"('{m}', {g}, {w}, {str(l).upper()})" for m, g, w, l in BENCH) + ") AS bb(metric, good, watch, low)"
SCORE = f"""SELECT l.metric, round(l.value, 2) AS value, round(q.value, 2) AS prior, round(l.value - q.value, 2) AS delta,
    CASE WHEN low THEN CASE WHEN l.value <= good THEN 'good' WHEN l.value <= watch THEN 'watch' ELSE 'critical' END ELSE CASE WHEN l.value >= good THEN 'good' WHEN l.value >= watch THEN 'watch' ELSE 'critical' END END AS status
  FROM lng l JOIN lng q ON q.metric = l.metric AND q.label = 'prior' JOIN {BENCH_SQL} ON bb.metric = l.metric WHERE l.label = 'current'"""
LONG = f"kk AS ({kpi_sql(PERIODS)}), lng AS (SELECT label, metric, value FROM (SELECT label, {', '.join(f'{m}::DOUBLE AS {m}' for m, *_ in BENCH)} FROM kk) UNPIVOT (value FOR metric IN ({', '.join(m for m, *_ in BENCH)})))"


def scorecard(t):
    return fin.kpi_scorecard(kpi(t, PERIODS), t.rows(BENCH, "metric string, good double, watch double, lower_is_better boolean"), "current", "prior")


@query("rep_kpi_scorecard", f"WITH {LONG} {SCORE}")
def _(t):
    return scorecard(t)


@query("rep_kpi_scorecard_health", f"""
  WITH {LONG}, s AS ({SCORE}) SELECT count(*) FILTER (status = 'good') AS good, count(*) FILTER (status = 'watch') AS watch, count(*) FILTER (status = 'critical') AS critical,
    CASE WHEN count(*) FILTER (status = 'good') >= count(*) / 2 THEN 'good' WHEN count(*) FILTER (status = 'critical') < count(*) / 3 THEN 'watch' ELSE 'critical' END AS health FROM s""")
def _(t):
    return fin.kpi_health(scorecard(t))


@query("rep_kpi_scorecard_trend", f"""
  WITH k AS ({kpi_sql(TREND)}), l AS (SELECT label, metric, value FROM (SELECT label, cogs_pct, labor_pct, prime_pct, margin_pct, avg_check::DOUBLE AS avg_check FROM k) UNPIVOT (value FOR metric IN (cogs_pct, labor_pct, prime_pct, margin_pct, avg_check)) WHERE label LIKE '2001%'),
  r AS (SELECT *, lag(value) OVER w AS p1, lag(value, 2) OVER w AS p2, row_number() OVER (PARTITION BY metric ORDER BY label DESC) AS rn FROM l WINDOW w AS (PARTITION BY metric ORDER BY label))
  SELECT metric, CASE WHEN p2 <= p1 AND p1 <= value THEN 'rising' WHEN p2 >= p1 AND p1 >= value THEN 'falling' ELSE '' END AS trend FROM r WHERE rn = 1""")
def _(t):
    from ..operators.windows import trend3
    long = fin.kpi_long(kpi(t, TREND)).filter(F.col("label").startswith("2001") & F.col("metric").isin("cogs_pct", "labor_pct", "prime_pct", "margin_pct", "avg_check"))
    return trend3(long, ["metric"], "label", "value")


# --- budget ---

@query("rep_budget_revenue", f"""
  SELECT r.k AS month, net_sales, tips, gratuity, order_count, grat_retained, pass_through, adj_revenue, coalesce(food, 0) AS food, coalesce(liquor, 0) AS liquor, coalesce(ss, 0) AS side_stream,
    round(greatest(net_sales - coalesce(food, 0) - coalesce(liquor, 0), 0), 2) AS other, round(net_sales + tips + gratuity + coalesce(ss, 0), 2) AS gross_revenue
  FROM ({rev_sql(OM)}) r LEFT JOIN (SELECT {OM} AS k, round(coalesce(sum(net_price) FILTER (sales_category = 'Food'), 0), 2) AS food, round(coalesce(sum(net_price) FILTER (sales_category = 'Liquor'), 0), 2) AS liquor FROM v_items WHERE {_KEPT} GROUP BY 1) i ON i.k = r.k
  LEFT JOIN (SELECT {BM} AS k, round(sum(amount), 2) AS ss FROM v_bank WHERE contains(lower(category), 'hookah sales') AND amount > 0 GROUP BY 1) h ON h.k = r.k""")
def _(t):
    return fin.budget_revenue(t.orders, t.items, t.bank, ["hookah sales"])


TARGETS = [("cogs", 20.0, 45.0), ("labor", 30.0, 35.0), ("marketing", 40.0, 41.0), ("opex", 80.0, 90.0)]
WORDS = [("cogs", ["cost of goods", "cogs"]), ("labor", ["3. labor", "labor cost", "payroll"]), ("marketing", ["marketing", "promotions", "entertainment", "event"]), ("opex", ["operating expenses", "opex"])]
_ACT = "SELECT key, round(coalesce(sum(abs_amount), 0), 2) AS actual FROM v_bank JOIN (VALUES {v}) AS w(key, word) ON contains(lower(category), word) WHERE transaction_type = 'debit' GROUP BY 1"


def _act(words):
    # One row per line and category, so overlapping words count a category once.
    v = ", ".join(f"('{k}', '{w}')" for k, ws in words for w in ws)
    keys = ", ".join(f"('{k}')" for k, _ in words)
    return f"""SELECT k.key, round(coalesce(sum(v), 0), 2) AS actual FROM (VALUES {keys}) AS k(key) LEFT JOIN (SELECT DISTINCT key, category, v FROM (SELECT category, sum(abs_amount) AS v FROM v_bank WHERE transaction_type = 'debit' GROUP BY 1)
      JOIN (VALUES {v}) AS w(key, word) ON contains(lower(category), word)) x ON x.key = k.key GROUP BY 1"""


ALLREV = rev_sql("1")
LINES = f"""SELECT key, actual, actual_pct, target_pct, target_amount, round(actual - target_amount, 2) AS variance, round(actual_pct - target_pct, 1) AS variance_pct,
    CASE WHEN actual_pct <= target_pct THEN 'under_budget' WHEN actual_pct <= target_pct + 2 THEN 'on_track' WHEN actual_pct <= max_pct THEN 'watch' ELSE 'over_budget' END AS status
  FROM (SELECT key, actual, target_pct::DOUBLE AS target_pct, max_pct, round(actual / adj_revenue * 100, 1) AS actual_pct, round(adj_revenue * target_pct / 100, 2) AS target_amount FROM (
    SELECT a.key, CASE WHEN a.key = 'labor' THEN round(greatest(actual - pass_through, 0), 2) ELSE actual END AS actual, target_pct, max_pct, adj_revenue FROM ({_act(WORDS)}) a
    JOIN (VALUES {', '.join(str(x) for x in TARGETS)}) AS tt(key, target_pct, max_pct) ON tt.key = a.key, ({ALLREV}) r))"""


def lines(t):
    return fin.budget_lines(t.orders, t.bank, t.rows(TARGETS, "key string, target_pct double, max_pct double"), WORDS)


@query("rep_budget_lines", LINES)
def _(t):
    return lines(t)


SUBS = [("liquor", 20.0, 60.0, None, False), ("promoters", 40.0, 30.0, None, False), ("rent", 80.0, 0.0, 500000.0, False), ("insurance", 80.0, 10.0, None, True)]
SUB_WORDS = [("liquor", ["liquor cogs"]), ("promoters", ["promoter"]), ("rent", ["/rent"]), ("insurance", ["insurance"])]


@query("rep_budget_sublines", f"""
  SELECT key, actual, actual_pct, target_pct, target_amount, CASE WHEN info THEN 0 ELSE round(actual - target_amount, 2) END AS variance, CASE WHEN info THEN 'informational' ELSE
    CASE WHEN rat <= 1 THEN 'under_budget' WHEN rat <= 1.15 THEN 'on_track' WHEN rat <= 1.3 THEN 'watch' ELSE 'over_budget' END END AS status
  FROM (SELECT *, CASE WHEN target_amount > 0 THEN actual / target_amount WHEN actual = 0 THEN 0 ELSE 2 END AS rat FROM (SELECT *, CASE WHEN info THEN 0.0::DOUBLE WHEN fixed IS NOT NULL THEN fixed::DOUBLE ELSE round(adj_revenue * target_pct / 100, 2) END AS target_amount FROM (
    SELECT a.key, actual, info, fixed, adj_revenue, round(actual / adj_revenue * 100, 2) AS actual_pct, CASE WHEN info THEN 0.0::DOUBLE WHEN fixed IS NOT NULL THEN round(fixed::DOUBLE / adj_revenue * 100, 2) ELSE round(parent::DOUBLE * share::DOUBLE / 100, 2) END AS target_pct
    FROM ({_act(SUB_WORDS)}) a JOIN (VALUES {', '.join(f"('{k}', {p}, {s}, {'NULL' if f is None else f}, {str(i).upper()})" for k, p, s, f, i in SUBS)}) AS tt(key, parent, share, fixed, info) ON tt.key = a.key, ({ALLREV}) r)))""")
def _(t):
    s = t.rows(SUBS, "key string, parent_pct double, share_pct double, fixed_target double, informational boolean")
    return fin.budget_sublines(t.orders, t.bank, s, SUB_WORDS)


@query("rep_budget_history", f"SELECT month, round(adj_revenue) AS revenue, cogs_pct, labor_pct, marketing_pct, opex_pct, margin_pct FROM ({pnl_sql(OM, BM, 'month', 'half')})")
def _(t):
    return fin.budget_history(t.orders, t.bank)


GROUP_RULES = [(i, w, k) for i, (k, w) in enumerate((k, w) for k, ws in WORDS for w in ws)]
GR_SQL = "(VALUES " + ", ".join(f"({i}, '{w}', '{k}')" for i, w, k in GROUP_RULES) + ") AS gr(priority, keyword, key)"
VT_SQL = "SELECT vendor_normalized, category, round(sum(abs_amount), 2) AS amount, count(*) AS txns FROM v_bank WHERE transaction_type = 'debit' AND vendor_normalized IS NOT NULL GROUP BY 1, 2"
TAG_SQL = f"SELECT v.*, (SELECT arg_min(key, priority) FROM {GR_SQL} WHERE contains(lower(v.category), keyword)) AS key FROM"


@query("rep_budget_vendors", f"""
  SELECT v.vendor_normalized, v.category, v.amount, v.txns, coalesce(v.key, 'other') AS budget_group, coalesce(l.status, 'unknown') AS budget_status, coalesce(l.variance, 0) AS budget_variance,
    coalesce(l.status, 'unknown') IN ('over_budget', 'watch') AS actionable
  FROM ({TAG_SQL} (SELECT * FROM ({VT_SQL}) ORDER BY amount DESC, vendor_normalized, category LIMIT 50) v) v LEFT JOIN ({LINES}) l ON l.key = v.key""")
def _(t):
    return fin.budget_vendors(t.bank, lines(t), t.rows(GROUP_RULES, "priority int, keyword string, key string"))


@query("rep_budget_lines_vendors", f"""
  SELECT key, vendor_normalized, category, amount, CAST(row_number() OVER (PARTITION BY key ORDER BY amount DESC, vendor_normalized, category) AS INT) AS rank FROM ({TAG_SQL} ({VT_SQL}) v) WHERE key IS NOT NULL QUALIFY rank <= 5""")
def _(t):
    return fin.line_vendors(t.bank, t.rows(GROUP_RULES, "priority int, keyword string, key string"))


@query("rep_budget_totals", f"""
  SELECT adj_revenue, adj_expenses, net_profit, margin_pct, CASE WHEN margin_pct >= 15 THEN 'on_target' ELSE 'below_target' END AS margin_status, round(greatest(adj_revenue * 15 / 100 - net_profit, 0), 2) AS gap_to_target FROM ({pnl_sql("'all'", "'all'", 'period')})""")
def _(t):
    return fin.budget_totals(t.orders, t.bank, 15.0)


@query("rep_budget_totals_path", f"""
  WITH l AS (SELECT key, variance AS saving FROM ({LINES}) WHERE variance > 0), p AS ({pnl_sql("'all'", "'all'", 'period')}),
  c AS (SELECT key, saving, CAST(row_number() OVER w AS INT) AS rank, round(sum(saving) OVER w, 2) AS cumulative_saving FROM l WINDOW w AS (ORDER BY saving DESC, key))
  SELECT rank, key, saving, cumulative_saving, round((net_profit + cumulative_saving) / adj_revenue * 100, 2) AS margin_after, round((net_profit + cumulative_saving) / adj_revenue * 100, 2) >= 15 AS reaches_target FROM c, p""")
def _(t):
    return fin.budget_path(lines(t), fin.budget_totals(t.orders, t.bank, 15.0), 15.0)


@query("rep_budget_drilldown", """
  SELECT transaction_date, description, vendor_normalized, category, abs_amount FROM v_bank WHERE transaction_type = 'debit' AND (contains(lower(category), 'marketing') OR contains(lower(category), 'event'))""")
def _(t):
    return fin.drilldown(t.bank, ["marketing", "event"])


# --- events ---

WEEKDAYS = [(4, "wine"), (6, "live"), (7, "party"), (1, "brunch")]
VENDOR_MAP = [("vendor_1", 1, ["live", "party"]), ("vendor_2", 2, ["brunch"]), ("vendor_12", 3, ["wine"]), ("vendor_5", 4, ["wine", "live", "party"])]
SHARES = [("wine", 0.1), ("live", 0.3), ("party", 0.4), ("brunch", 0.2)]
_VALS = lambda rows: "(VALUES " + ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows) + ")"
EV = f"""ev AS (SELECT event, month, net_sales, tips, gratuity, nights, txns, {_RET.format(g='gratuity')} AS grat_retained, round(net_sales + {_RET.format(g='gratuity')}, 2) AS adj_revenue FROM (
    SELECT w.event, strftime(bd, '%Y-%m') AS month, round(sum(amount), 2) AS net_sales, round(sum(tip), 2) AS tips, round(sum(gratuity), 2) AS gratuity, count(DISTINCT bd) AS nights, count(*) AS txns
    FROM (SELECT *, CAST(paid_ts - INTERVAL 4 HOUR AS DATE) AS bd FROM v_payments WHERE status IN ('CAPTURED', 'AUTHORIZED', 'CAPTURE_IN_PROGRESS')) p JOIN {_VALS(WEEKDAYS)} AS w(dow, event) ON dayofweek(bd) + 1 = w.dow GROUP BY 1, 2)),
  vm AS (SELECT coalesce(vendor_normalized, 'Unknown') AS vendor, {BM} AS month, round(sum(abs_amount), 2) AS amount, count(*) AS txns FROM v_bank WHERE transaction_type = 'debit' AND (contains(lower(category), 'promoter') OR contains(lower(category), 'event')) GROUP BY 1, 2),
  ve AS (SELECT vm.*, CASE WHEN contains(lower(vendor), 'vendor_1') THEN ['live', 'party'] WHEN contains(lower(vendor), 'vendor_2') THEN ['brunch'] WHEN contains(lower(vendor), 'vendor_5') THEN ['wine', 'live', 'party'] END AS events FROM vm),
  sp AS (SELECT vendor, month, unnest(events) AS event, round(round(amount * 100) / len(events)) / 100 AS share, txns FROM ve),
  dc AS (SELECT event, month, round(sum(share), 2) AS direct_costs, CAST(sum(txns) AS BIGINT) AS txns FROM sp GROUP BY 1, 2)"""


def ev_rev(t):
    return fin.event_revenue(t.payments, t.rows(WEEKDAYS, "dow_num int, event string"))


def ev_costs(t):
    return fin.vendor_event_costs(t.bank, t.rows(VENDOR_MAP, "keyword string, priority int, events array<string>"), ["promoter", "event"])


def ev_grid(t, costs=None):
    return fin.event_grid(ev_rev(t), costs if costs is not None else ev_costs(t), t.bank, t.rows(SHARES, "event string, pct double"), ["/rent", "insurance"], ["payroll"], ["security", "contract labor"], 2000.0)


@query("rep_event_revenue", f"WITH {EV} SELECT * FROM ev")
def _(t):
    return ev_rev(t)


@query("rep_event_direct", f"WITH {EV} SELECT * FROM dc")
def _(t):
    return fin.event_direct(ev_costs(t))


@query("rep_event_unattributed", f"WITH {EV} SELECT vendor, round(sum(amount), 2) AS amount, CAST(sum(txns) AS BIGINT) AS txns FROM ve WHERE events IS NULL GROUP BY 1")
def _(t):
    return fin.event_unattributed(ev_costs(t))


@query("op_alloc_split", f"WITH {EV} SELECT vendor, month, event, share FROM sp")
def _(t):
    return fin.split_evenly(ev_costs(t)).select("vendor", "month", "event", "share")


def _mc(words, name):
    return f"(SELECT {BM} AS month, round(sum(abs_amount), 2) AS {name} FROM v_bank WHERE transaction_type = 'debit' AND {_like('category', words)} GROUP BY 1)"


SHARED = f"SELECT ev.event, ev.month, CASE WHEN tt > 0 THEN round(c * adj_revenue / tt, 2) ELSE 0 END AS shared_costs FROM ev JOIN (SELECT month, sum(adj_revenue) AS tt FROM ev GROUP BY 1) q ON q.month = ev.month JOIN {_mc(['/rent', 'insurance'], 'c')} m ON m.month = ev.month"


@query("op_alloc_by_revenue", f"WITH {EV} {SHARED}")
def _(t):
    return fin.allocate_by_revenue(ev_rev(t), fin.monthly_cost(t.bank, ["/rent", "insurance"], "c"), "c", "shared_costs")


LAB = f"""SELECT s.event, month, round(greatest(greatest(gross - passed, 0) - 2000, 0) * s.pct::DOUBLE, 2) AS labor_costs FROM (SELECT coalesce(a.month, b.month) AS month, coalesce(gross, 0) AS gross, coalesce(passed, 0) AS passed
  FROM {_mc(['payroll'], 'gross')} a FULL OUTER JOIN (SELECT month, round(sum(tips + gratuity - grat_retained), 2) AS passed FROM ev GROUP BY 1) b ON a.month = b.month), {_VALS(SHARES)} AS s(event, pct)"""
OPS = f"SELECT s.event, month, round(ops * s.pct::DOUBLE, 2) AS ops_costs FROM {_mc(['security', 'contract labor'], 'ops')}, {_VALS(SHARES)} AS s(event, pct)"


@query("op_alloc_by_pct", f"WITH {EV} {LAB}")
def _(t):
    rev = ev_rev(t)
    passed = rev.groupBy("month").agg(F.round(F.sum(F.col("tips") + F.col("gratuity") - F.col("grat_retained")), 2).alias("passed"))
    m = joins.align_periods(fin.monthly_cost(t.bank, ["payroll"], "gross"), passed, "month")
    variable = F.greatest(F.greatest(F.col("gross") - F.col("passed"), F.lit(0.0)) - 2000.0, F.lit(0.0))
    return fin.allocate_by_pct(m, variable, t.rows(SHARES, "event string, pct double"), "labor_costs")


GRID = f"""{EV}, sh AS ({SHARED}), lb AS ({LAB}), op AS ({OPS}),
  ky AS (SELECT event, month FROM ev UNION SELECT event, month FROM dc UNION SELECT event, month FROM sh UNION SELECT event, month FROM lb UNION SELECT event, month FROM op),
  g0 AS (SELECT ky.event, ky.month, coalesce(net_sales, 0) AS net_sales, coalesce(adj_revenue, 0) AS adj_revenue, coalesce(nights, 0) AS nights, coalesce(ev.txns, 0) AS txns, coalesce(direct_costs, 0) AS direct_costs, coalesce(shared_costs, 0) AS shared_costs,
    coalesce(labor_costs, 0) AS labor_costs, coalesce(ops_costs, 0) AS ops_costs FROM ky LEFT JOIN ev USING (event, month) LEFT JOIN dc USING (event, month) LEFT JOIN sh USING (event, month) LEFT JOIN lb USING (event, month) LEFT JOIN op USING (event, month)),
  gr AS (SELECT *, round(adj_revenue - total_costs, 2) AS net, CASE WHEN adj_revenue > 0 THEN round(round(adj_revenue - total_costs, 2) / adj_revenue * 100, 1) ELSE 0 END AS margin_pct FROM (SELECT *, round(direct_costs + shared_costs + labor_costs + ops_costs, 2) AS total_costs FROM g0))"""


@query("rep_event_trend", f"WITH {GRID} SELECT * FROM gr")
def _(t):
    return ev_grid(t)


@query("rep_event_roi", f"""
  WITH {GRID}, s AS (SELECT coalesce(event, '(all)') AS event, round(sum(net_sales), 2) AS net_sales, round(sum(adj_revenue), 2) AS adj_revenue, round(sum(direct_costs), 2) AS direct_costs, round(sum(shared_costs), 2) AS shared_costs, round(sum(labor_costs), 2) AS labor_costs,
    round(sum(ops_costs), 2) AS ops_costs, CAST(sum(nights) AS BIGINT) AS nights, CAST(sum(txns) AS BIGINT) AS txns FROM gr GROUP BY ROLLUP (event)), u AS (SELECT *, round(direct_costs + shared_costs + labor_costs + ops_costs, 2) AS total_costs FROM s), v AS (SELECT *, round(adj_revenue - total_costs, 2) AS net FROM u)
  SELECT *, CASE WHEN total_costs > 0 THEN round(net / total_costs * 100, 1) ELSE 0 END AS roi_pct, CASE WHEN adj_revenue > 0 THEN round(net / adj_revenue * 100, 1) ELSE 0 END AS margin_pct, CASE WHEN nights > 0 THEN round(adj_revenue / nights, 2) ELSE 0 END AS avg_nightly,
    CASE WHEN nights > 0 THEN round(total_costs / nights, 2) ELSE 0 END AS cost_per_night, round(adj_revenue / (SELECT sum(adj_revenue) FROM gr) * 100, 1) AS revenue_share_pct FROM v""")
def _(t):
    return fin.event_roi(ev_grid(t))


# --- cash and bank ---

DT = """CASE WHEN contains(description, 'NET SETLMT') AND amount > 0 THEN 'card_settlement' WHEN contains(description, 'TOAST DES:DEP') AND amount > 0 THEN 'processor_deposit' WHEN contains(description, 'TOAST DES:EOM') THEN 'processor_month_end'
  WHEN contains(description, 'Counter Credit') AND amount > 0 THEN 'counter_credit' WHEN contains(description, 'Toast, Inc DES:Toast') AND amount < 0 THEN 'platform_fee' WHEN starts_with(description, 'Online Banking transfer from CHK') AND amount > 0 THEN 'transfer_in' END"""
_F = lambda c, v: f"round(coalesce(sum({v}) FILTER ({c}), 0), 2)"
RECON = f"""p AS (SELECT strftime(paid_ts, '%Y-%m') AS month, {_F("payment_type = 'Credit'", 'total')} AS credit_gross, {_F("payment_type = 'Credit'", 'card_fee')} AS credit_fees, {_F("payment_type = 'Cash'", 'total')} AS cash_collected,
    {_F("payment_type NOT IN ('Credit', 'Cash')", 'total')} AS other_collected FROM v_payments WHERE status IN ('CAPTURED', 'AUTHORIZED', 'CAPTURE_IN_PROGRESS') GROUP BY 1),
  d AS (SELECT month, {_F("kind IN ('card_settlement', 'processor_deposit', 'processor_month_end')", 'amount')} AS card_deposits, {_F("kind = 'platform_fee'", 'amount')} AS platform_fee, {_F("kind IN ('counter_credit', 'transfer_in')", 'amount')} AS cash_in
    FROM (SELECT {BM} AS month, amount, {DT} AS kind FROM v_bank) WHERE kind IS NOT NULL GROUP BY 1),
  x AS (SELECT coalesce(p.month, d.month) AS month, coalesce(credit_gross, 0) AS credit_gross, coalesce(credit_fees, 0) AS credit_fees, coalesce(cash_collected, 0) AS cash_collected, coalesce(other_collected, 0) AS other_collected,
    coalesce(card_deposits, 0) AS card_deposits, coalesce(platform_fee, 0) AS platform_fee, coalesce(cash_in, 0) AS cash_in FROM p FULL OUTER JOIN d ON p.month = d.month),
  y AS (SELECT *, round(credit_gross - credit_fees, 2) AS credit_net, round(card_deposits + platform_fee, 2) AS bank_card_net FROM x), z AS (SELECT *, round(bank_card_net - credit_net, 2) AS card_diff, round(cash_collected - cash_in, 2) AS cash_gap FROM y),
  q AS (SELECT *, CASE WHEN credit_net <> 0 THEN round(card_diff / credit_net * 100, 1) ELSE 0 END AS card_diff_pct FROM z),
  rc AS (SELECT *, round(sum(card_diff) OVER (ORDER BY month), 2) AS card_cum_diff, round(sum(cash_gap) OVER (ORDER BY month), 2) AS cash_cum_gap, CASE WHEN abs(card_diff_pct) <= 5 THEN 'OK' WHEN abs(card_diff_pct) <= 10 THEN 'WATCH' ELSE 'HIGH' END AS card_status FROM q)"""


@query("rep_cash_recon", f"WITH {RECON} SELECT * FROM rc")
def _(t):
    return fin.cash_recon(t.payments, t.bank)


@query("rep_cash_recon_alerts", f"""WITH {RECON} SELECT month, 'zero_cash_deposit' AS type, cash_collected AS value FROM rc WHERE cash_in = 0 AND cash_collected > 0
  UNION ALL SELECT month, 'high_card_gap', card_diff_pct FROM rc WHERE abs(card_diff_pct) > 10 AND credit_net > 0""")
def _(t):
    return fin.cash_recon_alerts(fin.cash_recon(t.payments, t.bank))


@query("rep_cash_recon_totals", f"""
  WITH {RECON}, s AS (SELECT round(sum(credit_net), 2) AS pos_credit_net, round(sum(cash_collected), 2) AS pos_cash, round(sum(bank_card_net), 2) AS bank_card_net, round(sum(cash_in), 2) AS bank_cash FROM rc)
  SELECT *, round(bank_card_net / pos_credit_net * 100, 1) AS card_recon_pct, round(bank_cash / pos_cash * 100, 1) AS cash_deposited_pct, round(pos_cash - bank_cash, 2) AS undeposited_cash, round(bank_card_net - pos_credit_net, 2) AS total_card_diff FROM s""")
def _(t):
    return fin.cash_recon_totals(fin.cash_recon(t.payments, t.bank))


UNDEP = f"""SELECT coalesce(a.month, b.month) AS month, coalesce(cash_collected, 0) AS cash_collected, coalesce(cash_deposited, 0) AS cash_deposited, round(coalesce(cash_collected, 0) - coalesce(cash_deposited, 0), 2) AS undeposited FROM
  (SELECT {OM} AS month, round(coalesce(sum(total) FILTER ({CASH_TXN}), 0), 2) AS cash_collected FROM v_payments GROUP BY 1) a FULL OUTER JOIN (SELECT {BM} AS month, round(sum(abs_amount), 2) AS cash_deposited FROM v_bank
  WHERE transaction_type = 'credit' AND (contains(lower(category), 'cash deposit') OR contains(lower(category), 'cash account transfer') OR contains(lower(description), 'counter credit') OR contains(lower(description), 'transfer from chk')) GROUP BY 1) b ON a.month = b.month"""


@query("rep_cash_undeposited", UNDEP)
def _(t):
    return fin.cash_undeposited(t.payments, t.bank, ["transfer from chk"])


@query("rep_bank_review", """
  SELECT coalesce(category_source, '(all)') AS category_source, count(*) AS n, round(sum(abs_amount), 2) AS total, max(transaction_date) AS latest, max(source_file) AS latest_file FROM v_bank GROUP BY ROLLUP (category_source)""")
def _(t):
    return fin.bank_review(t.bank)


_DAY = "1998-06-05"


@query("rep_flash", f"""
  WITH o AS (SELECT round(coalesce(sum(total) FILTER (processing_date = DATE '{_DAY}'), 0), 2) AS revenue, count(DISTINCT order_id) FILTER (processing_date = DATE '{_DAY}') AS orders, CAST(coalesce(sum(guest_count) FILTER (processing_date = DATE '{_DAY}'), 0) AS BIGINT) AS guests,
    round(coalesce(sum(tip) FILTER (processing_date = DATE '{_DAY}'), 0), 2) AS tips, round(coalesce(sum(gratuity) FILTER (processing_date = DATE '{_DAY}'), 0), 2) AS gratuity, round(coalesce(sum(total) FILTER (processing_date = DATE '{_DAY}' - 7), 0), 2) AS prior_revenue FROM v_orders WHERE {_KEPT}),
  s AS (SELECT abs_amount, CASE WHEN {_like('category', ['cost of goods', 'cogs'])} THEN 'cogs' WHEN {_like('category', ['labor', 'payroll'])} THEN 'labor' WHEN {_like('category', ['marketing', 'entertainment', 'promoter'])} THEN 'marketing' WHEN {_like('category', ['operating', 'opex'])} THEN 'opex' ELSE 'other' END AS s
    FROM v_bank WHERE transaction_type = 'debit' AND transaction_date = DATE '{_DAY}' AND category <> 'Uncategorized'),
  e AS (SELECT {', '.join(f"round(coalesce(sum(abs_amount) FILTER (s = '{x}'), 0), 2) AS {x}" for x in ('cogs', 'labor', 'marketing', 'opex', 'other'))} FROM s),
  c AS (SELECT round(coalesce(sum(total), 0), 2) AS cash_collected FROM v_payments WHERE CAST(paid_ts - INTERVAL 4 HOUR AS DATE) = DATE '{_DAY}' AND lower(payment_type) = 'cash' AND status = 'CAPTURED'),
  b AS (SELECT round(coalesce(sum(amount), 0), 2) AS cash_deposited FROM v_bank WHERE transaction_date = DATE '{_DAY}' AND amount > 0 AND {_like('description', ['counter credit', 'cash deposit'])}),
  j AS (SELECT *, round(revenue + {_RET.format(g='gratuity')}, 2) AS adj_revenue, round(tips + {_PASS.format(g='gratuity')}, 2) AS passed FROM o, e, c, b)
  SELECT revenue, orders, guests, prior_revenue, CASE WHEN prior_revenue <> 0 THEN round((revenue - prior_revenue) / prior_revenue * 100, 1) END AS change_pct, cogs, labor, marketing, opex, other, cash_collected, cash_deposited, round(cash_collected - cash_deposited, 2) AS cash_gap,
    adj_revenue, round(cogs / adj_revenue * 100, 1) AS cogs_pct, round(greatest(labor - passed, 0) / adj_revenue * 100, 1) AS labor_pct, round((adj_revenue - round(cogs + labor + marketing + opex + other, 2)) / adj_revenue * 100, 1) AS net_pct FROM j""")
def _(t):
    return fin.flash(t.orders, t.payments, t.bank, _DAY)


# --- vendors ---

_VR = "transaction_type = 'debit' AND vendor_normalized IS NOT NULL AND vendor_normalized <> '' AND category <> 'Uncategorized'"


def vtop_sql(n):
    return f"""SELECT *, split_part(category, '/', 1) AS section FROM (SELECT vendor_normalized, category, count(*) AS txn_count, round(sum(abs(amount)), 2) AS total_spend, round(round(sum(abs_amount) * 100) / count(*)) / 100 AS avg_per_txn, min(transaction_date) AS first_txn,
      max(transaction_date) AS last_txn, count(DISTINCT {BM}) AS active_months FROM v_bank WHERE {_VR} GROUP BY 1, 2 ORDER BY total_spend DESC, vendor_normalized, category LIMIT {n})"""


VTREND = f"""SELECT {BM} AS month, vendor_normalized AS vendor, round(sum(abs_amount), 2) AS spend, count(*) AS txn_count FROM v_bank WHERE transaction_type = 'debit' AND vendor_normalized IN
  (SELECT vendor_normalized FROM (SELECT vendor_normalized, sum(abs_amount) AS v FROM v_bank WHERE {_VR} GROUP BY 1 ORDER BY v DESC, 1 LIMIT 15)) GROUP BY 1, 2"""
VANOM = f"""SELECT vendor, month, current, prior, round((current - prior) / prior * 100, 1) AS change_pct, CASE WHEN (current - prior) / prior * 100 > 50 THEN 'high' ELSE 'medium' END AS severity FROM (
  SELECT vendor, month, spend AS current, lag(spend) OVER (PARTITION BY vendor ORDER BY month) AS prior, row_number() OVER (PARTITION BY vendor ORDER BY month DESC) AS rn FROM ({VTREND})) WHERE rn = 1 AND prior > 0 AND (current - prior) / prior * 100 > 25"""
VSEC = "SELECT split_part(category, '/', 1) AS section, round(sum(abs_amount), 2) AS total_spend, count(*) AS txn_count, count(DISTINCT vendor_normalized) AS vendor_count FROM v_bank WHERE transaction_type = 'debit' AND category <> 'Uncategorized' GROUP BY 1"


@query("rep_vendor_top", vtop_sql(20))
def _(t):
    return fin.vendor_top(t.bank, 20)


@query("rep_vendor_trend", VTREND)
def _(t):
    return fin.vendor_trend(t.bank)


@query("rep_vendor_sections", VSEC)
def _(t):
    return fin.vendor_sections(t.bank)


@query("rep_vendor_concentration", f"""
  WITH v AS ({vtop_sql(50)}), r AS (SELECT total_spend, row_number() OVER (ORDER BY total_spend DESC) AS i, sum(total_spend) OVER () AS s, count(*) OVER () AS n FROM v)
  SELECT label, CAST(least(k, any_value(n)) AS BIGINT) AS members, round(sum(total_spend), 2) AS amount, round(sum(total_spend) / any_value(s) * 100, 1) AS pct FROM r, (VALUES ('top_5', 5), ('top_10', 10), ('top_20', 20)) AS f(label, k) WHERE i <= k GROUP BY label, k""")
def _(t):
    return fin.vendor_concentration(fin.vendor_top(t.bank, 50))


def _until_2000(t):
    return dates.between_dates(t.bank, "transaction_date", "1995-01-01", "2000-12-31")


@query("rep_vendor_anomalies", VANOM.replace("transaction_type = 'debit'", "transaction_date <= DATE '2000-12-31' AND transaction_type = 'debit'"))
def _(t):
    return fin.vendor_anomalies(fin.vendor_trend(_until_2000(t)))


@query("rep_vendor_kpis", f"""
  SELECT count(*) AS total_vendors, round(sum(total_spend), 2) AS total_spend, round(sum(total_spend) / count(*), 2) AS avg_vendor_spend, (SELECT count(*) FROM ({VSEC})) AS total_categories, (SELECT count(*) FROM ({VANOM})) AS anomaly_count,
    (SELECT count(*) FROM ({VANOM}) WHERE severity = 'high') AS high_anomalies FROM ({vtop_sql(50)})""")
def _(t):
    return fin.vendor_kpis(fin.vendor_top(t.bank, 50), fin.vendor_sections(t.bank), fin.vendor_anomalies(fin.vendor_trend(t.bank)))


# --- prime cost and statements ---

PRIME = dates.trailing_months(date(2001, 7, 15), 12) + [("partial", date(2001, 7, 1), date(2001, 7, 15)), ("trailing_30d", *dates.trailing_days(date(2001, 7, 15), 30))]
ADJ = [("2001-03-01", 5000.0), ("2001-06-01", 2500.0)]
ADJ_SQL = "(VALUES " + ", ".join(f"(DATE '{m}', {a}::DOUBLE)" for m, a in ADJ) + ") AS aj(m, amount)"


def prime_sql(periods):
    b = lambda c: f"round(coalesce(sum(abs_amount) FILTER (transaction_type = 'debit' AND {c}), 0), 2)"
    return f"""SELECT *, CASE WHEN raw < 55 THEN 'Excellent' WHEN raw < 60 THEN 'Good' WHEN raw < 65 THEN 'Elevated' ELSE 'Investigate' END AS grade, round(raw, 2) AS prime_pct, CASE WHEN gross_revenue > 0 THEN round(prime_cost_real / gross_revenue * 100, 2) ELSE 0 END AS prime_pct_real,
      CASE WHEN gross_revenue > 0 THEN round(labor_total / gross_revenue * 100, 2) ELSE 0 END AS labor_pct FROM (SELECT *, CASE WHEN gross_revenue > 0 THEN prime_cost / gross_revenue * 100 ELSE 0 END AS raw FROM (
      SELECT *, round(cogs_total + labor_total, 2) AS prime_cost, round(cogs_total + labor_ex_tips, 2) AS prime_cost_real FROM (SELECT *, round(net_sales + gratuity + tips + side_stream + adjustment, 2) AS gross_revenue, round(greatest(labor_total - gratuity - tips, 0), 2) AS labor_ex_tips, round(liquor_cogs + food_cogs, 2) AS cogs_total
      FROM (SELECT r.label, net_sales, gratuity, tips, liquor_cogs, food_cogs, labor_total, side_stream, coalesce(adjustment, 0) AS adjustment FROM
        (SELECT label, round(sum(amount), 2) AS net_sales, round(sum(gratuity), 2) AS gratuity, round(sum(tip), 2) AS tips FROM v_orders JOIN {_periods_sql(periods)} ON processing_date BETWEEN s AND e WHERE {_KEPT} GROUP BY 1) r
        JOIN (SELECT label, {b("category LIKE '2.%' AND contains(lower(category), 'liquor cogs')")} AS liquor_cogs, {b("category LIKE '2.%' AND contains(lower(category), 'food cogs')")} AS food_cogs, {b("category LIKE '3.%'")} AS labor_total,
          round(coalesce(sum(amount) FILTER (contains(lower(category), 'hookah sales') AND amount > 0), 0), 2) AS side_stream FROM v_bank JOIN {_periods_sql(periods)} ON transaction_date BETWEEN s AND e GROUP BY 1) x ON x.label = r.label
        LEFT JOIN (SELECT label, round(sum(amount), 2) AS adjustment FROM {ADJ_SQL} JOIN {_periods_sql(periods)} ON m BETWEEN s AND e GROUP BY 1) a ON a.label = r.label))))"""


def adjustments(t):
    return t.rows(ADJ, "month string, amount double").withColumn("month", F.to_date("month"))


def prime(t):
    return fin.prime_cost(t.orders, t.bank, PRIME, ["hookah sales"], adjustments(t))


@query("rep_prime_cost", f"SELECT * EXCLUDE (raw) FROM ({prime_sql(PRIME)})")
def _(t):
    return prime(t)


@query("rep_prime_alert", f"""
  WITH p AS ({prime_sql(PRIME)}), g AS (SELECT max(prime_pct) FILTER (label = 'trailing_30d') AS rolling_pct, round(avg(prime_pct) FILTER (label <> 'trailing_30d'), 2) AS mean_pct FROM p)
  SELECT *, rolling_pct >= 60 AS over_threshold, rolling_pct > mean_pct AS above_mean FROM g""")
def _(t):
    return fin.prime_alert(prime(t), "trailing_30d", 60.0)


@query("op_month_adjustment", f"""
  SELECT month, round(sum(v), 2) AS net_sales FROM (SELECT k AS month, net_sales AS v FROM ({rev_sql(OM)}) UNION ALL SELECT strftime(m, '%Y-%m'), amount FROM {ADJ_SQL}) GROUP BY 1""")
def _(t):
    return fin.month_adjustment(fin.revenue_by(fin.month_of(t.orders, "processing_date"), "month"), adjustments(t), "net_sales")


REVCAT = f"SELECT {OM} AS month, round(coalesce(sum(net_price) FILTER (sales_category = 'Food'), 0), 2) AS food_rev, round(coalesce(sum(net_price) FILTER (sales_category = 'Liquor'), 0), 2) AS liquor_rev, round(sum(net_price), 2) AS item_total FROM v_items WHERE {_KEPT} GROUP BY 1"
SIDEB = f"SELECT {BM} AS month, round(sum(amount), 2) AS side_bank FROM v_bank WHERE contains(lower(category), 'hookah sales') AND amount > 0 GROUP BY 1"
SIDEP = f"SELECT {OM} AS month, round(sum(net_price), 2) AS side_pos FROM v_items WHERE {_KEPT} AND (contains(lower(sales_category), 'hookah') OR contains(lower(sales_category), 'shisha')) GROUP BY 1"
TAX = f"SELECT {OM} AS month, round(sum(tax), 2) AS sales_tax FROM v_orders WHERE {_KEPT} GROUP BY 1"


@query("rep_revenue_monthly", f"SELECT k AS month, net_sales, tips, gratuity, order_count, grat_retained, pass_through, adj_revenue FROM ({rev_sql(OM)})")
def _(t):
    return fin.revenue_by(fin.month_of(t.orders, "processing_date"), "month")


@query("rep_revenue_by_category", REVCAT)
def _(t):
    return fin.revenue_by_category(t.items)


@query("rep_revenue_hookah_bank", SIDEB)
def _(t):
    return fin.side_stream_bank(t.bank, ["hookah sales"])


@query("rep_revenue_hookah_pos", SIDEP)
def _(t):
    return fin.side_stream_pos(t.items, ["hookah", "shisha"])


@query("rep_revenue_sales_tax", TAX)
def _(t):
    return fin.sales_tax(t.orders)


ST_LINES = [("cogs", "food_cogs", ["food cogs"]), ("cogs", "liquor_cogs", ["liquor cogs", "shisha cogs"]), ("labor", "labor_cost", ["3. labor", "labor cost", "payroll"]), ("marketing", "mkt_promoter", ["promoter"]),
            ("marketing", "mkt_event", ["event expense"]), ("marketing", "mkt_entertainment", ["entertainment"]), ("opex", "opex_rent", ["rent", "cam", "property tax"]), ("opex", "opex_security", ["security"]),
            ("opex", "opex_insurance", ["insurance"]), ("opex", "opex_contract", ["contract labor"])]
_BASE = ["net_sales", "tips", "gratuity", "food_rev", "liquor_rev", "side_bank", "side_pos", "sales_tax", "undeposited"] + [n for _, n, _ in ST_LINES]
_ALL = _BASE + ["other_rev", "total_revenue", "total_cogs", "gross_profit", "total_labor", "total_marketing", "total_opex", "ebitda", "ebitda_pct"]
_tot = lambda s: "round(" + " + ".join(n for x, n, _ in ST_LINES if x == s) + ", 2)"
STATEMENT = f"""
  lx AS (SELECT {BM} AS month, {', '.join(f"round(coalesce(sum(abs_amount) FILTER ({_like('category', w)}), 0), 2) AS {n}" for _, n, w in ST_LINES)} FROM v_bank WHERE transaction_type = 'debit' GROUP BY 1),
  b0 AS (SELECT {', '.join(f'coalesce({c}, 0) AS {c}' for c in _BASE)}, month FROM (SELECT k AS month, net_sales, tips, gratuity FROM ({rev_sql(OM)})) FULL OUTER JOIN ({REVCAT}) USING (month) FULL OUTER JOIN ({SIDEB}) USING (month)
    FULL OUTER JOIN ({SIDEP}) USING (month) FULL OUTER JOIN ({TAX}) USING (month) FULL OUTER JOIN ({UNDEP}) USING (month) FULL OUTER JOIN lx USING (month)),
  b1 AS (SELECT coalesce(month, 'total') AS month, {', '.join(f'round(sum({c}), 2) AS {c}' for c in _BASE)} FROM b0 GROUP BY ROLLUP (month)),
  b2 AS (SELECT *, round(greatest(net_sales - food_rev - liquor_rev - side_pos, 0), 2) AS other_rev, round(net_sales + tips + gratuity + undeposited + sales_tax + side_bank, 2) AS total_revenue, {', '.join(f'{_tot(s)} AS total_{s}' for s in ('cogs', 'labor', 'marketing', 'opex'))} FROM b1),
  b3 AS (SELECT *, round(total_revenue - total_cogs, 2) AS gross_profit FROM b2), b4 AS (SELECT *, round(gross_profit - total_labor - total_marketing - total_opex, 2) AS ebitda FROM b3),
  st AS (SELECT month, line, amount FROM (SELECT month, {', '.join(_ALL)} FROM (SELECT *, round(ebitda / CASE WHEN total_revenue > 0 THEN total_revenue ELSE 1 END * 100, 1) AS ebitda_pct FROM b4)) UNPIVOT (amount FOR line IN ({', '.join(_ALL)})))"""


def statement(t):
    return fin.statement_pnl(t.orders, t.items, t.payments, t.bank, ST_LINES, ["hookah sales"], ["hookah", "shisha"], ["transfer from chk"])


@query("rep_statement_pnl", f"WITH {STATEMENT} SELECT * FROM st")
def _(t):
    return statement(t)


@query("rep_addback", f"""
  WITH {STATEMENT}, g AS (SELECT month, round(sum(amount) FILTER (line = 'ebitda'), 2) AS reported, round(sum(amount) FILTER (line = 'total_revenue'), 2) AS revenue, round(sum(amount) FILTER (line IN ('mkt_event', 'opex_contract')), 2) AS addbacks, round(sum(amount) FILTER (line = 'opex_insurance'), 2) AS further FROM st GROUP BY 1)
  SELECT *, round(reported + addbacks, 2) AS adjusted, round(reported + addbacks + further, 2) AS fully_adjusted, round(round(reported + addbacks + further, 2) / CASE WHEN revenue > 0 THEN revenue ELSE 1 END * 100, 1) AS fully_adjusted_pct FROM g""")
def _(t):
    return fin.addback(statement(t), ["mkt_event", "opex_contract"], ["opex_insurance"])


# --- quarter ---

QP = [("q1_2001", date(2001, 1, 1), date(2001, 3, 31)), ("q4_2000", date(2000, 10, 1), date(2000, 12, 31)), ("q1_2000", date(2000, 1, 1), date(2000, 3, 31)), ("2001-01", date(2001, 1, 1), date(2001, 1, 31)), ("2001-02", date(2001, 2, 1), date(2001, 2, 28)), ("2001-03", date(2001, 3, 1), date(2001, 3, 31))]
_P = _periods_sql(QP)
CB = "CASE WHEN category LIKE '2.%' OR contains(lower(category), 'cost of goods') OR contains(lower(category), 'cogs') THEN 'cogs' WHEN category LIKE '3.%' OR contains(lower(category), 'labor') OR contains(lower(category), 'payroll') THEN 'labor' WHEN category LIKE '1.%' OR contains(lower(category), 'revenue') THEN 'revenue' ELSE 'opex' END"
QF = f"""SELECT *, round(ebitda / gross * 100, 1) AS ebitda_pct, round(labor / gross * 100, 1) AS labor_pct, round(cogs / gross * 100, 1) AS cogs_pct FROM (SELECT *, round(gross - cogs - labor - opex, 2) AS ebitda FROM (
  SELECT r.*, cogs, labor, opex, side_stream, round(net_sales + tips + gratuity + side_stream, 2) AS gross FROM (SELECT label, round(sum(amount), 2) AS net_sales, round(sum(tip), 2) AS tips, round(sum(gratuity), 2) AS gratuity, count(DISTINCT order_id) AS order_count FROM v_orders JOIN {_P} ON processing_date BETWEEN s AND e WHERE {_KEPT} GROUP BY 1) r
  JOIN (SELECT label, {', '.join(f"round(coalesce(sum(abs_amount) FILTER (transaction_type = 'debit' AND {CB} = '{x}'), 0), 2) AS {x}" for x in ('cogs', 'labor', 'opex'))}, round(coalesce(sum(amount) FILTER (contains(lower(category), 'hookah sales') AND amount > 0), 0), 2) AS side_stream FROM v_bank JOIN {_P} ON transaction_date BETWEEN s AND e GROUP BY 1) x ON x.label = r.label))"""


def qfacts(t):
    return fin.quarter_facts(t.orders, t.items, t.bank, QP, ["hookah sales"])


@query("rep_quarter_revenue", f"SELECT label, net_sales, tips, gratuity, side_stream, gross, order_count FROM ({QF})")
def _(t):
    return qfacts(t).select("label", "net_sales", "tips", "gratuity", "side_stream", "gross", "order_count")


@query("rep_quarter_revenue_mix", f"""
  WITH g AS (SELECT label, sales_category, round(sum(net_price), 2) AS revenue FROM v_items JOIN {_P} ON processing_date BETWEEN s AND e WHERE {_KEPT} GROUP BY 1, 2) SELECT *, round(revenue / sum(revenue) OVER (PARTITION BY label) * 100, 1) AS share_pct FROM g""")
def _(t):
    return fin.quarter_mix(t.items, QP)


@query("rep_quarter_costs", f"SELECT label, cogs, labor, opex, labor_pct, cogs_pct FROM ({QF})")
def _(t):
    return qfacts(t).select("label", "cogs", "labor", "opex", "labor_pct", "cogs_pct")


@query("rep_quarter_costs_opex", f"SELECT label, 'opex' AS bucket, category, round(sum(abs_amount), 2) AS total FROM v_bank JOIN {_P} ON transaction_date BETWEEN s AND e WHERE transaction_type = 'debit' AND {CB} = 'opex' GROUP BY 1, 3")
def _(t):
    return fin.quarter_expenses(t.bank, QP, "opex")


@query("rep_quarter_profit", f"SELECT label, gross, ebitda, ebitda_pct FROM ({QF})")
def _(t):
    return qfacts(t).select("label", "gross", "ebitda", "ebitda_pct")


@query("rep_quarter_kpis", f"""
  SELECT c.*, covers, net, labor_hours, round(net / business_days, 2) AS revenue_per_day, round(net / labor_hours, 2) AS revenue_per_hour FROM
  (SELECT label, count(*) AS checks, round(round(sum(total) * 100) / count(*)) / 100 AS avg_check, count(DISTINCT processing_date) AS business_days FROM (SELECT DISTINCT check_id, total, processing_date FROM v_checks) JOIN {_P} ON processing_date BETWEEN s AND e GROUP BY 1) c
  JOIN (SELECT label, CAST(sum(guest_count) AS BIGINT) AS covers, round(sum(amount), 2) AS net FROM v_orders JOIN {_P} ON processing_date BETWEEN s AND e WHERE {_KEPT} GROUP BY 1) o ON o.label = c.label
  JOIN (SELECT label, sum(regular_hours + overtime_hours) AS labor_hours FROM v_labor JOIN {_P} ON processing_date BETWEEN s AND e GROUP BY 1) h ON h.label = c.label""")
def _(t):
    return fin.quarter_kpis(t.orders, t.checks, t.labor, QP)


@query("rep_quarter_staff", f"""
  WITH x AS (SELECT 'items' AS kind, label, cook AS name, sum(qty)::DOUBLE AS value FROM v_items JOIN {_P} ON processing_date BETWEEN s AND e WHERE {_KEPT} GROUP BY 2, 3
    UNION ALL SELECT 'revenue', label, server, round(sum(total), 2) FROM v_orders JOIN {_P} ON processing_date BETWEEN s AND e WHERE {_KEPT} AND server IS NOT NULL GROUP BY 2, 3)
  SELECT *, CAST(row_number() OVER (PARTITION BY kind, label ORDER BY value DESC, name) AS INT) AS rank FROM x QUALIFY rank <= 5""")
def _(t):
    return fin.quarter_staff(t.items, t.orders, QP)


@query("rep_quarter_cashflow", f"""
  WITH v AS (SELECT label, vendor_normalized, round(sum(abs_amount), 2) AS total FROM v_bank JOIN {_P} ON transaction_date BETWEEN s AND e WHERE transaction_type = 'debit' AND vendor_normalized IS NOT NULL GROUP BY 1, 2),
  w AS (SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY total DESC, vendor_normalized) AS INT) AS rank, round(total / sum(total) OVER (PARTITION BY label) * 100, 1) AS share_pct FROM v) SELECT *, share_pct > 2.5 AS warning FROM w WHERE rank <= 10""")
def _(t):
    return fin.quarter_cashflow(t.bank, QP, 2.5)


@query("rep_quarter_cashflow_expenses", f"SELECT label, {CB} AS bucket, category, round(sum(abs_amount), 2) AS total FROM v_bank JOIN {_P} ON transaction_date BETWEEN s AND e WHERE transaction_type = 'debit' GROUP BY 1, 2, 3")
def _(t):
    return fin.quarter_expenses(t.bank, QP)


_QM = ["gross", "net_sales", "cogs", "labor", "opex", "ebitda"]


@query("rep_quarter_change", f"""
  WITH f AS ({QF}), l AS (SELECT label, metric, value FROM (SELECT label, {', '.join(_QM)} FROM f) UNPIVOT (value FOR metric IN ({', '.join(_QM)})))
  SELECT a.metric, a.value, b.value AS prior, CASE WHEN b.value <> 0 THEN round((a.value - b.value) / abs(b.value) * 100, 1) END AS change_pct FROM l a JOIN l b ON a.metric = b.metric AND b.label = 'q4_2000' WHERE a.label = 'q1_2001'""")
def _(t):
    return fin.quarter_change(qfacts(t), "q1_2001", "q4_2000", _QM)


# --- gratuity and payouts ---

HOUSE = {"Server": 0.3, "Bartender": 0.3, "Bottle Manager": 0.45, "Other": 0.5}
GB = """SELECT bucket, net_sales, gratuity, tips, orders, house_share, round(round(gratuity * 100) * round(house_share * 100) / 100) / 100 AS house, round(gratuity - round(round(gratuity * 100) * round(house_share * 100) / 100) / 100, 2) AS staff FROM (
  SELECT *, CASE bucket WHEN 'Server' THEN 0.3::DOUBLE WHEN 'Bartender' THEN 0.3::DOUBLE WHEN 'Bottle Manager' THEN 0.45::DOUBLE ELSE 0.5::DOUBLE END AS house_share FROM (
  SELECT CASE WHEN server = 'Bottle Manager' THEN server WHEN role IN ('Bartender', 'Server') THEN role ELSE 'Other' END AS bucket, round(sum(amount), 2) AS net_sales, round(sum(gratuity), 2) AS gratuity, round(sum(tip), 2) AS tips, count(*) AS orders
  FROM (SELECT o.*, r.job_title AS role FROM v_orders o LEFT JOIN (SELECT employee_name, job_title FROM v_labor WHERE trim(job_title) <> '' GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY employee_name ORDER BY sum(regular_hours + overtime_hours) DESC, job_title) = 1) r ON r.employee_name = o.server WHERE voided IS NULL OR voided = 'false') GROUP BY 1))"""


def buckets(t):
    return fin.gratuity_buckets(t.orders, joins.primary_role(t.labor), HOUSE)


@query("rep_gratuity_buckets", GB)
def _(t):
    return buckets(t)


@query("rep_gratuity_scenarios", f"""
  WITH b AS ({GB}), g AS (SELECT sum(gratuity) * 0.42 - sum(house) AS gap, sum(gratuity) FILTER (bucket <> 'Other') AS pool FROM b)
  SELECT 'raise ' || bucket AS scenario, bucket, round((house + gap) / gratuity, 4) AS house_share FROM b, g WHERE bucket IN ('Bottle Manager', 'Server', 'Bartender') AND gratuity > 0
  UNION ALL SELECT 'raise all', bucket, round(house_share + gap / pool, 4) FROM b, g WHERE bucket IN ('Bottle Manager', 'Server', 'Bartender')""")
def _(t):
    return fin.gratuity_scenarios(buckets(t), 0.42, ["Bottle Manager", "Server", "Bartender"])


SB = lambda rx: f"round(coalesce(sum(net_price) FILTER (regexp_matches(lower(sales_category), '{rx}')), 0), 2)"
PSALES = f"""SELECT w.event, {SB('liquor|beer|wine|bottle|cocktail|spirits|na beverage|n/a beverage')} AS net_liquor, {SB('food|kitchen|appetizer|entree|dessert|brunch')} AS net_food, {SB('hookah|shisha')} AS net_shisha, count(*) AS item_rows
  FROM v_items i JOIN {WINDOW_SQL} ON i.order_ts BETWEEN window_start AND window_end WHERE voided IS NULL OR lower(voided) <> 'true' GROUP BY 1"""
RATES = [("launch", 0.2, 0.3, 0.067, 350.0, 0.25), ("gala", 0.18, 0.28, 0.067, 0.0, 0.2)]


def psales(t):
    w = t.rows(WINDOWS, "event string, window_start string, window_end string").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
    return fin.payout_sales(joins.rows_in_windows(t.items, "order_ts", w))


@query("rep_payout_sales", PSALES)
def _(t):
    return psales(t)


@query("rep_payout", f"""
  WITH x AS (SELECT *, net_liquor + net_food + net_shisha AS g, net_liquor * lp + net_food * fp AS c, net_liquor * tp AS tx FROM ({PSALES}) JOIN (VALUES {', '.join(f"('{e}', {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE, {d}::DOUBLE, {f}::DOUBLE)" for e, a, b, c, d, f in RATES)}) AS r(event, lp, fp, tp, ex, pp) USING (event))
  SELECT event, round(g, 2) AS gross, round(c, 2) AS cogs, round(tx, 2) AS tax, round(g - c - tx, 2) AS net_sales, round(ex, 2) AS expenses, round(g - c - tx - ex, 2) AS net_profit, round((g - c - tx - ex) * pp, 2) AS payout FROM x""")
def _(t):
    return fin.payout(psales(t), t.rows(RATES, "event string, liquor_cogs_pct double, food_cogs_pct double, tax_pct double, expenses double, payout_pct double"))


@query("rep_payout_history", """
  SELECT order_id, server, processing_date, total FROM v_orders WHERE revenue_center = 'Bar' AND processing_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31' ORDER BY processing_date DESC, order_id DESC LIMIT 200""")
def _(t):
    from ..operators import filters
    return filters.history(t.orders, {"revenue_center": "Bar", "server": None}, "processing_date", "1997-01-01", "1999-12-31", [F.desc("processing_date"), F.desc("order_id")], 200).select(
        "order_id", "server", "processing_date", "total")


# --- findings ---

def _of(name: str) -> str:
    return f"({ORACLES[name]})"


@query("rep_insights_kpi", f"""
  SELECT metric AS key, status AS severity, CASE WHEN CASE WHEN lower_is_better THEN delta < 0 ELSE delta > 0 END THEN 'improved' WHEN delta <> 0 THEN 'worsened' ELSE 'unchanged' END AS subject, CAST(value AS DOUBLE) AS value
  FROM {_of("rep_kpi_scorecard")} s JOIN (VALUES {", ".join(f"('{b[0]}', {str(b[3]).upper()})" for b in BENCH)}) AS bm(bm_metric, lower_is_better) ON bm_metric = metric""")
def _(t):
    return ins.kpi_insights(scorecard(t), t.rows(BENCH, "metric string, good double, watch double, lower_is_better boolean"))


_SEV = "CASE status WHEN 'over_budget' THEN 'critical' WHEN 'watch' THEN 'warning' WHEN 'on_track' THEN 'info' ELSE 'good' END"


@query("rep_insights_budget", f"""
  SELECT 'overall' AS key, CASE WHEN margin_pct < 0 THEN 'critical' WHEN margin_pct < 15 THEN 'warning' ELSE 'good' END AS severity, margin_status AS subject, CAST(margin_pct AS DOUBLE) AS value FROM {_of("rep_budget_totals")} t
  UNION ALL SELECT key, {_SEV}, status, CAST(variance AS DOUBLE) FROM {_of("rep_budget_lines")} l
  UNION ALL SELECT 'sub_' || key, {_SEV}, status, CAST(variance AS DOUBLE) FROM {_of("rep_budget_sublines")} b WHERE status IN ('over_budget', 'watch')""")
def _(t):
    subs = QUERIES["rep_budget_sublines"](t.spark, t.sf_dir)
    return ins.budget_insights(fin.budget_totals(t.orders, t.bank, 15.0), lines(t), subs, 15.0)


@query("rep_insights_kpi_trend", f"""
  SELECT * FROM {_of("rep_insights_kpi")} i UNION ALL SELECT metric || '_trend', CASE trend WHEN 'rising' THEN 'warning' ELSE 'good' END, trend, NULL::DOUBLE FROM {_of("rep_kpi_scorecard_trend")} t
  WHERE (metric = 'cogs_pct' AND trend = 'rising') OR (metric = 'labor_pct' AND trend IN ('rising', 'falling'))""")
def _(t):
    found = QUERIES["rep_insights_kpi"](t.spark, t.sf_dir)
    return found.unionByName(ins.trend_insights(QUERIES["rep_kpi_scorecard_trend"](t.spark, t.sf_dir)))


_SUB_RULES = [(i, w, k) for i, (k, w) in enumerate((k, w) for k, ws in SUB_WORDS for w in ws)]
_SUB_TAG = "SELECT v.*, (SELECT arg_min(key, priority) FROM (VALUES " + ", ".join(f"({i}, '{w}', '{k}')" for i, w, k in _SUB_RULES) + ") AS gr(priority, keyword, key) WHERE contains(lower(v.category), keyword)) AS key FROM"
_BEHIND = "SELECT key, string_agg(vendor_normalized || ' ' || CAST(CAST(round(amount) AS BIGINT) AS VARCHAR), ', ' ORDER BY rank) AS vendors FROM ({}) WHERE rank <= 3 GROUP BY 1"
_DETAIL = "SELECT {key} AS key, {sev} AS severity, {pp} AS variance_pct, CASE WHEN variance > 0 THEN variance ELSE 0 END AS over, CASE WHEN variance < 0 THEN -variance ELSE 0 END AS headroom, CASE WHEN status <> 'under_budget' THEN b.vendors END AS vendors FROM {lines} l LEFT JOIN ({behind}) b ON b.key = l.key"
_SUB_TOP = f"SELECT key, vendor_normalized, amount, row_number() OVER (PARTITION BY key ORDER BY amount DESC, vendor_normalized, category) AS rank FROM ({_SUB_TAG} ({VT_SQL}) v) WHERE key IS NOT NULL"


@query("rep_insights_budget_detail", _DETAIL.format(key="l.key", sev=_SEV, pp="variance_pct", lines=_of("rep_budget_lines"), behind=_BEHIND.format(ORACLES["rep_budget_lines_vendors"])) + " UNION ALL "
       + _DETAIL.format(key="'sub_' || l.key", sev=_SEV, pp="round(actual_pct - target_pct, 1)", lines=_of("rep_budget_sublines"), behind=_BEHIND.format(with_tables(_SUB_TOP))) + " WHERE status IN ('over_budget', 'watch')")
def _(t):
    """Budget lines, and the sublines over or near their target, with percentage points, money and vendors."""
    rules = lambda rows: t.rows(rows, "priority int, keyword string, key string")
    subs = QUERIES["rep_budget_sublines"](t.spark, t.sf_dir).withColumn("variance_pct", F.round(F.col("actual_pct") - F.col("target_pct"), 1)).filter(F.col("status").isin("over_budget", "watch"))
    main = ins.budget_details(lines(t), fin.line_vendors(t.bank, rules(GROUP_RULES)))
    sub = ins.budget_details(subs, fin.line_vendors(t.bank, rules(_SUB_RULES)))
    return main.unionByName(sub.withColumn("key", F.concat(F.lit("sub_"), "key")))


@query("rep_insights_event", f"""
  WITH e AS (SELECT * FROM {_of("rep_event_roi")} x WHERE event <> '(all)'), c AS (SELECT * FROM e WHERE total_costs > 0), r AS (SELECT *, total_costs / adj_revenue AS ratio FROM c WHERE adj_revenue > 0)
  SELECT 'unattributed' AS key, 'warning' AS severity, CAST(vendors AS VARCHAR) AS subject, CAST(amount AS DOUBLE) AS value FROM (SELECT round(sum(amount), 2) AS amount, count(*) AS vendors FROM {_of("rep_event_unattributed")} u) WHERE amount > 0
  UNION ALL SELECT * FROM (SELECT 'best_roi', 'good', event, roi_pct::DOUBLE FROM c ORDER BY roi_pct DESC, event LIMIT 1)
  UNION ALL SELECT * FROM (SELECT 'worst_roi', CASE WHEN margin_pct < 25 THEN 'critical' ELSE 'warning' END, event, roi_pct::DOUBLE FROM c WHERE (SELECT count(*) FROM c) > 1 ORDER BY roi_pct, event LIMIT 1)
  UNION ALL SELECT * FROM (SELECT 'top_revenue', 'info', event, adj_revenue::DOUBLE FROM e ORDER BY adj_revenue DESC, event LIMIT 1)
  UNION ALL SELECT * FROM (SELECT 'most_efficient', 'info', event, round(ratio * 100, 1)::DOUBLE FROM r ORDER BY ratio, event LIMIT 1)""")
def _(t):
    costs = sinks.stage(ev_costs(t), "event-costs")
    return ins.event_insights(sinks.stage(fin.event_roi(ev_grid(t, costs)), "event-roi"), fin.event_unattributed(costs))
