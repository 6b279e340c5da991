"""Sales, menu, kitchen and weekly reports with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import sales
from .registry import ORACLES, query
from .relational import EVENT_SQL, event_rows

_BD = "CAST({} - INTERVAL 4 HOUR AS DATE)"
PAID = _BD.format("paid_ts")


@query("rep_revenue_by_dow", f"""
  WITH b AS (SELECT {PAID} AS business_date, * FROM v_payments WHERE void_ts IS NULL)
  SELECT dayname(business_date) AS day, CAST(dayofweek(business_date) + 1 AS INT) AS dow_num, count(*) AS txn_count, round(sum(amount), 2) AS net_sales, round(sum(tip), 2) AS tips,
    round(sum(gratuity), 2) AS gratuity, round(sum(total), 2) AS gross_revenue, round(round(sum(total) * 100) / count(*)) / 100 AS avg_check, count(DISTINCT business_date) AS num_days,
    round(round(sum(total), 2) / count(DISTINCT business_date), 2) AS avg_daily_revenue FROM b GROUP BY 1, 2""")
def _(t):
    return sales.revenue_by_dow(t.payments)


@query("rep_hourly_profile", f"""
  SELECT CAST(extract(hour FROM paid_ts) AS INT) AS hour, count(*) AS txn_count, round(sum(total), 2) AS gross_revenue, round(round(sum(total) * 100) / count(*)) / 100 AS avg_check, count(DISTINCT {PAID}) AS num_days,
    round(round(sum(total), 2) / count(DISTINCT {PAID}), 2) AS avg_daily_revenue FROM v_payments WHERE void_ts IS NULL GROUP BY 1""")
def _(t):
    return sales.hourly_profile(t.payments)


WEEKLY = f"""SELECT CAST(date_trunc('week', {PAID}) AS DATE) AS week_start, count(DISTINCT order_id) AS orders, round(sum(amount), 2) AS revenue FROM v_payments
  WHERE status IN ('CAPTURED', 'AUTHORIZED', 'CAPTURE_IN_PROGRESS') GROUP BY 1"""


@query("rep_weekly_revenue_calendar", f"""
  WITH w AS ({WEEKLY}), r AS (SELECT *, CAST(row_number() OVER (ORDER BY revenue DESC, week_start) AS INT) AS rank FROM w)
  SELECT r.week_start, r.orders, r.revenue, r.rank, coalesce((SELECT string_agg(DISTINCT name, ', ' ORDER BY name) FROM {EVENT_SQL} WHERE e.start_date <= r.week_start + 6 AND e.end_date >= r.week_start), '') AS events
  FROM r WHERE rank <= 20""")
def _(t):
    return sales.top_weeks(sales.weekly_revenue(t.payments), event_rows(t))


@query("rep_weekly_revenue_calendar_kpis", f"""
  WITH w AS ({WEEKLY}), m AS (SELECT strftime(week_start, '%Y-%m') AS month, round(sum(revenue), 2) AS rev FROM w GROUP BY 1)
  SELECT (SELECT round(avg(revenue), 2) FROM w WHERE revenue > 0) AS avg_weekly_revenue, w.revenue AS peak_week_revenue, w.week_start AS peak_week_date, m.month AS best_month, m.rev AS best_month_revenue
  FROM (SELECT * FROM w ORDER BY revenue DESC, week_start DESC LIMIT 1) w, (SELECT * FROM m ORDER BY rev DESC, month DESC LIMIT 1) m""")
def _(t):
    return sales.calendar_kpis(sales.weekly_revenue(t.payments))


@query("rep_weekly_revenue_calendar_upcoming", f"""
  WITH w AS ({WEEKLY}), h AS (SELECT e.name, year(e.start_date) + 1 AS y, max(w.revenue) AS historical_revenue FROM w JOIN {EVENT_SQL} ON e.start_date <= w.week_start + 6 AND e.end_date >= w.week_start GROUP BY 1, 2)
  SELECT e.name, e.start_date, e.end_date, h.historical_revenue FROM {EVENT_SQL} LEFT JOIN h ON h.name = e.name AND h.y = year(e.start_date) WHERE e.start_date >= DATE '1998-01-01' ORDER BY e.start_date, e.name LIMIT 10""")
def _(t):
    return sales.upcoming_events(sales.weekly_revenue(t.payments), event_rows(t), "1998-01-01")


@query("rep_weekly_revenue_calendar_lift", f"""
  WITH w AS ({WEEKLY}), b AS (SELECT avg(revenue) AS base FROM w WHERE revenue > 0),
  x AS (SELECT e.name AS label, avg(w.revenue) AS mean, max(w.revenue) AS peak FROM w JOIN {EVENT_SQL} ON e.start_date <= w.week_start + 6 AND e.end_date >= w.week_start WHERE w.revenue > 0 GROUP BY 1
    UNION ALL SELECT 'summer', avg(revenue), max(revenue) FROM w WHERE month(week_start) IN (6, 7))
  SELECT label, round(mean, 2) AS mean_revenue, peak, round((mean - base) / base * 100, 1) AS lift_pct FROM x, b""")
def _(t):
    return sales.event_lift(sales.weekly_revenue(t.payments), event_rows(t))


SERVERS = """SELECT server, count(DISTINCT order_id) AS orders, CAST(sum(guest_count) AS BIGINT) AS guests, round(sum(amount), 2) AS revenue, round(sum(tip), 2) AS tips, round(sum(gratuity), 2) AS gratuity,
    round(sum(discount_amount), 2) AS discounts, count(*) FILTER (discount_amount > 0) AS discounted_orders, round(sum(amount) / count(DISTINCT order_id), 2) AS avg_check,
    round(sum(amount) / nullif(sum(guest_count), 0), 2) AS rev_per_guest, round(sum(tip) / nullif(sum(amount), 0) * 100, 1) AS tip_pct,
    round(sum(discount_amount) / nullif(sum(amount + discount_amount), 0) * 100, 1) AS discount_pct
  FROM v_orders WHERE (voided IS NULL OR lower(voided) <> 'true') AND server IS NOT NULL AND trim(server) <> '' GROUP BY 1"""


@query("rep_server_performance", SERVERS)
def _(t):
    return sales.server_performance(t.orders)


for _by, _key in (("dow", f"dayname({PAID})"), ("hour", "CAST(extract(hour FROM paid_ts) AS INT)")):
    @query(f"rep_server_performance_{_by}", f"""
      SELECT server, {_key} AS {_by}, count(*) AS orders, round(sum(amount), 2) AS revenue, round(round(sum(amount) * 100) / count(*)) / 100 AS avg_check FROM v_payments
      WHERE status IN ('CAPTURED', 'AUTHORIZED', 'CAPTURE_IN_PROGRESS') AND server IS NOT NULL AND trim(server) <> '' GROUP BY 1, 2""")
    def _(t, by=_by):
        return sales.server_profile(t.payments, by)


@query("rep_server_performance_kpis", f"""
  WITH s AS ({SERVERS}) SELECT count(*) AS total_servers, round(sum(revenue) / count(*), 2) AS avg_revenue_per_server, max(revenue) AS top_server_revenue,
    round(sum(avg_check * orders) / sum(orders), 2) AS avg_check_size, round(sum(tips) / sum(revenue) * 100, 1) AS avg_tip_pct FROM s""")
def _(t):
    return sales.server_kpis(sales.server_performance(t.orders))


_S = "date_diff('second', fired_ts, fulfilled_ts)"
STATIONS = f"""SELECT station, count(*) AS tickets, count(fulfilled_ts) AS fulfilled, round(avg({_S}), 1) AS avg_sec, CAST(quantile_disc({_S}, 0.5) AS BIGINT) AS median_sec,
  CAST(min({_S}) AS BIGINT) AS min_sec, CAST(max({_S}) AS BIGINT) AS max_sec, round(count(fulfilled_ts) / count(*) * 100, 1) AS fulfillment_pct FROM v_kitchen GROUP BY 1"""
for _by, _sql in {
    "station": STATIONS,
    "hour": f"SELECT CAST(extract(hour FROM fired_ts) AS INT) AS hour, count(*) AS tickets, round(avg({_S}), 1) AS avg_sec FROM v_kitchen GROUP BY 1",
    "cook": f"SELECT fulfilled_by AS cook, count(*) AS tickets, round(avg({_S}), 1) AS avg_sec, CAST(min({_S}) AS BIGINT) AS min_sec FROM v_kitchen WHERE fulfilled_ts IS NOT NULL AND fulfilled_by IS NOT NULL GROUP BY 1",
    "week": f"SELECT CAST(date_trunc('week', {_BD.format('fired_ts')}) AS DATE) AS week, count(*) AS tickets, count(fulfilled_ts) AS fulfilled, round(avg({_S}), 1) AS avg_sec FROM v_kitchen GROUP BY 1",
}.items():
    @query("rep_kitchen_speed" if _by == "station" else f"rep_kitchen_speed_{_by}", _sql)
    def _(t, by=_by):
        return sales.kitchen_speed(t.kitchen, by)


@query("rep_kitchen_speed_kpis", f"""
  WITH s AS ({STATIONS}) SELECT CAST(sum(tickets) AS BIGINT) AS total_tickets, round(sum(avg_sec * fulfilled) / sum(fulfilled), 1) AS avg_fulfillment_sec,
    (SELECT station FROM s ORDER BY avg_sec, station LIMIT 1) AS fastest_station, (SELECT station FROM s ORDER BY avg_sec DESC, station DESC LIMIT 1) AS slowest_station,
    round(sum(fulfilled) / sum(tickets) * 100, 1) AS fulfillment_rate FROM s""")
def _(t):
    return sales.kitchen_kpis(sales.kitchen_speed(t.kitchen, "station"))


@query("rep_kitchen_ops", """
  SELECT station, count(*) AS tickets, count(fulfilled_ts) AS fulfilled, round(count(fulfilled_ts) / count(*) * 100, 1) AS rate, NULL AS status FROM v_kitchen GROUP BY 1
  UNION ALL SELECT '(all)', count(*), count(fulfilled_ts), round(count(fulfilled_ts) / count(*) * 100, 1), CASE WHEN count(fulfilled_ts) / count(*) >= 0.99 THEN 'OK' ELSE 'FLAG' END FROM v_kitchen""")
def _(t):
    return sales.kitchen_ops(t.kitchen)


DEDUP = """SELECT * FROM v_items QUALIFY row_number() OVER (PARTITION BY item_selection_id ORDER BY processing_date DESC, gross_price DESC, server, menu_item, net_price DESC, qty DESC) = 1"""
MATRIX = f"""g AS (SELECT menu_item, sales_category, menu_group, CAST(sum(qty) AS BIGINT) AS qty_sold, sum(net_price) AS net FROM ({DEDUP}) WHERE voided = 'false' OR voided IS NULL GROUP BY 1, 2, 3),
  x AS (SELECT *, net / qty_sold AS price, sum(qty_sold) OVER () AS tq, sum(net) OVER () AS tr, count(*) OVER () AS n FROM g),
  y AS (SELECT *, round(qty_sold / (tq / n), 2) AS popularity_index, round(price / (tr / tq), 2) AS profitability_index FROM x),
  mx AS (SELECT menu_item, sales_category, menu_group, qty_sold, round(net, 2) AS net_revenue, round(price, 2) AS avg_price, popularity_index, profitability_index,
    CASE WHEN popularity_index >= 1 AND profitability_index >= 1 THEN 'Star' WHEN popularity_index >= 1 THEN 'Plowhorse' WHEN profitability_index >= 1 THEN 'Puzzle' ELSE 'Dog' END AS classification,
    round(net / tr * 100, 1) AS revenue_pct, round(qty_sold / tq * 100, 1) AS qty_pct FROM y)"""


@query("rep_menu_engineering", f"WITH {MATRIX} SELECT * FROM mx")
def _(t):
    return sales.menu_matrix(t.items)


for _name, _by in (("rep_menu_engineering_classes", "classification"), ("rep_menu_engineering_categories", "sales_category")):
    @query(_name, f"WITH {MATRIX} SELECT {_by}, count(*) AS items, round(sum(net_revenue), 2) AS revenue, CAST(sum(qty_sold) AS BIGINT) AS qty, round(sum(net_revenue) / (SELECT sum(net_revenue) FROM mx) * 100, 1) AS revenue_pct FROM mx GROUP BY 1")
    def _(t, by=_by):
        return sales.menu_totals(sales.menu_matrix(t.items), by)


@query("rep_menu_mix", f"""
  WITH d AS ({DEDUP}), l AS (SELECT * FROM d WHERE voided = 'false' OR voided IS NULL), v AS (SELECT sum(net_price) AS r, sum(qty) AS q FROM d WHERE voided = 'true')
  SELECT round(sum(net_price), 2) AS total_revenue, CAST(sum(qty) AS BIGINT) AS total_items, count(DISTINCT check_id) AS unique_checks, round(sum(net_price) / count(DISTINCT check_id), 2) AS avg_check,
    (SELECT round(r, 2) FROM v) AS void_revenue, (SELECT CAST(q AS BIGINT) FROM v) AS void_qty, round((SELECT r FROM v) / (sum(net_price) + (SELECT r FROM v)) * 100, 2) AS void_rate FROM l""")
def _(t):
    return sales.menu_mix_kpis(t.items)


for _by, _key in {"category": "sales_category", "service": "service", "dow": f"dayname({_BD.format('order_ts')})", "hour": "CAST(extract(hour FROM order_ts) AS INT)"}.items():
    @query(f"rep_menu_mix_{_by}", f"""
      SELECT {_key} AS {_by}, CAST(sum(qty) AS BIGINT) AS items, round(sum(net_price), 2) AS revenue, count(DISTINCT check_id) AS checks, count(DISTINCT {_BD.format('order_ts')}) AS days,
        round(round(sum(net_price), 2) / count(DISTINCT {_BD.format('order_ts')}), 2) AS avg_per_day FROM ({DEDUP}) WHERE voided = 'false' OR voided IS NULL GROUP BY 1""")
    def _(t, by=_by):
        return sales.menu_mix_by(t.items, by)


@query("rep_menu_mix_top", f"""
  SELECT menu_item, CAST(sum(qty) AS BIGINT) AS quantity, round(sum(net_price), 2) AS revenue FROM ({DEDUP}) WHERE voided = 'false' OR voided IS NULL GROUP BY 1 ORDER BY revenue DESC, menu_item LIMIT 20""")
def _(t):
    return sales.top_items(sales.latest_items(t.items), "revenue", 20)


for _by in ("quantity", "revenue"):
    @query("rep_top_items" if _by == "quantity" else "rep_top_items_revenue", f"""
      SELECT menu_item, CAST(sum(qty) AS BIGINT) AS quantity, round(sum(net_price), 2) AS revenue FROM v_items WHERE voided = 'false' OR voided IS NULL GROUP BY 1 ORDER BY {_by} DESC, menu_item LIMIT 10""")
    def _(t, by=_by):
        return sales.top_items(t.items, by)


_KEPT = "(voided IS NULL OR voided = 'false')"


@query("rep_weekly_summary", f"""
  SELECT round(sum(amount), 2) AS total_revenue, round(sum(tax), 2) AS total_tax, round(sum(tip), 2) AS total_tips, round(sum(gratuity), 2) AS total_gratuity, round(sum(total), 2) AS grand_total,
    round(avg(total), 2) AS avg_check_size, count(*) AS total_checks FROM v_orders WHERE {_KEPT}""")
def _(t):
    return sales.weekly_summary(t.orders)


@query("rep_order_metrics", f"""
  WITH o AS (SELECT *, coalesce(nullif(trim(split_part(dining_options, ',', 1)), ''), 'Unknown') AS option FROM v_orders WHERE {_KEPT})
  SELECT option, count(DISTINCT order_id) AS orders, CAST(sum(guest_count) AS BIGINT) AS guests, round(sum(total), 2) AS revenue FROM o GROUP BY 1
  UNION ALL SELECT '(all)', count(DISTINCT order_id), CAST(sum(guest_count) AS BIGINT), round(sum(total), 2) FROM o""")
def _(t):
    return sales.order_metrics(t.orders)


TOP15 = f"""SELECT server, orders, revenue, tips, gratuity, round(round(gratuity * 100) * 65 / 100) / 100 AS staff_gratuity, round(round(gratuity * 100) * 35 / 100) / 100 AS house_gratuity FROM (
  SELECT coalesce(server, 'Unknown') AS server, count(DISTINCT order_id) AS orders, round(sum(total), 2) AS revenue, round(sum(tip), 2) AS tips, round(sum(gratuity), 2) AS gratuity
  FROM v_orders WHERE {_KEPT} GROUP BY 1 ORDER BY revenue DESC, server LIMIT 15)"""


@query("rep_server_top15", TOP15)
def _(t):
    return sales.top_servers(t.orders)


@query("rep_daily_vs_prior", f"""
  WITH d AS (SELECT processing_date AS day, round(sum(total), 2) AS revenue, count(DISTINCT order_id) AS orders FROM v_orders WHERE {_KEPT} GROUP BY 1)
  SELECT a.day, a.revenue, a.orders, b.revenue AS prior_revenue, dayname(a.day) AS day_name, CASE WHEN b.revenue <> 0 THEN round((a.revenue - b.revenue) / abs(b.revenue) * 100, 1) END AS change_pct
  FROM d a LEFT JOIN d b ON b.day + 7 = a.day""")
def _(t):
    return sales.daily_vs_prior(t.orders)


PAYTYPES = "SELECT payment_type AS type, count(*) AS n, round(sum(total), 2) AS amount, round(sum(tip), 2) AS tips FROM v_payments WHERE void_ts IS NULL GROUP BY 1"


@query("rep_payment_types", PAYTYPES)
def _(t):
    return sales.payment_types(t.payments)


WOW = f"""
  SELECT round(r0, 2) AS revenue, n0 AS orders, g0 AS guests, round(t0, 2) AS tips, round(a0, 2) AS avg_check, round(r1, 2) AS prior_revenue, n1 AS prior_orders, round(r2, 2) AS ly_revenue, n2 AS ly_orders,
    CASE WHEN r1 > 0 THEN round((r0 - r1) / r1 * 100, 1) ELSE 0 END AS revenue_pct, CASE WHEN n1 > 0 THEN round((n0 - n1) / n1 * 100, 1) ELSE 0 END AS orders_pct,
    CASE WHEN r2 > 0 THEN round((r0 - r2) / r2 * 100, 1) ELSE 0 END AS yoy_pct, round(n0 / 7, 1) AS orders_per_day
  FROM (SELECT sum(total) AS r0, count(DISTINCT order_id) AS n0, CAST(sum(guest_count) AS BIGINT) AS g0, sum(tip) AS t0, avg(total) AS a0 FROM v_orders WHERE {_KEPT} AND processing_date BETWEEN DATE '1998-06-01' AND DATE '1998-06-07'),
    (SELECT sum(total) AS r1, count(DISTINCT order_id) AS n1 FROM v_orders WHERE {_KEPT} AND processing_date BETWEEN DATE '1998-05-25' AND DATE '1998-05-31'),
    (SELECT sum(total) AS r2, count(DISTINCT order_id) AS n2 FROM v_orders WHERE {_KEPT} AND processing_date BETWEEN DATE '1997-06-02' AND DATE '1997-06-08')"""


@query("rep_wow_yoy", WOW)
def _(t):
    return sales.week_comparison(t.orders, "1998-06-01")


@query("rep_product_mix", f"""
  SELECT round(l, 2) AS liquor, round(f, 2) AS food, round(h, 2) AS hookah, round(s, 2) AS total, round(b, 2) AS bottle_service, round(l / s * 100, 1) AS liquor_pct, round(f / s * 100, 1) AS food_pct, round(h / s * 100, 1) AS hookah_pct
  FROM (SELECT sum(net_price) FILTER (sales_category = 'Liquor') AS l, sum(net_price) FILTER (sales_category = 'Food') AS f, sum(net_price) FILTER (sales_category = 'Hookah') AS h, sum(net_price) AS s,
    sum(net_price) FILTER (lower(menu_item) LIKE '%btl%') AS b FROM v_items WHERE {_KEPT})""")
def _(t):
    return sales.product_mix(t.items)


@query("rep_high_check", """
  SELECT count(*) AS total_checks, count(*) FILTER (total > 200) AS high_checks, round(count(*) FILTER (total > 200) / count(*) * 100, 1) AS high_check_rate,
    CASE WHEN count(*) FILTER (total > 200) / count(*) * 100 >= 8 THEN 'ON TARGET' ELSE 'BELOW TARGET' END AS status FROM v_checks""")
def _(t):
    return sales.high_checks(t.checks)


@query("rep_discount_void", """
  SELECT round(d, 2) AS discounts, round(g, 2) AS gross_sales, round(d / g * 100, 1) AS discount_rate, CASE WHEN round(d / g * 100, 1) < 5 THEN 'OK' ELSE 'FLAG - HIGH DISCOUNTS' END AS discount_status,
    n AS payments, v AS voided_payments, round(a, 2) AS voided_amount, round(v / n * 100, 2) AS void_rate, CASE WHEN round(v / n * 100, 2) < 1 THEN 'OK' ELSE 'FLAG - HIGH VOIDS' END AS void_status
  FROM (SELECT sum(discount_amount) AS d, sum(amount + discount_amount) AS g FROM v_orders), (SELECT count(DISTINCT payment_id) AS n, count(void_ts) AS v, sum(total) FILTER (void_ts IS NOT NULL) AS a FROM v_payments)""")
def _(t):
    return sales.discount_void(t.orders, t.payments)


@query("rep_discount_reasons", """
  SELECT round(m, 2) AS manager_comp, round(o, 2) AS open_discount, round(w, 2) AS owner_comp, round(b, 2) AS birthday_comp, round(s, 2) AS spillage_quality, round(m / g * 100, 2) AS manager_pct,
    CASE WHEN round(m / g * 100, 2) > 4 THEN 'FLAG - EXCEEDS 4%' ELSE 'OK' END AS manager_status, CASE WHEN o > 0 THEN 'FLAG - SHOULD BE $0' ELSE 'OK' END AS open_status
  FROM (SELECT sum(discount) FILTER (contains(reason, 'Manager Comp')) AS m, sum(discount) FILTER (contains(reason, 'Open $') OR contains(reason, 'Open %')) AS o, sum(discount) FILTER (contains(reason, 'Owner Comp')) AS w,
    sum(discount) FILTER (contains(reason, 'Birthday')) AS b, sum(discount) FILTER (contains(reason, 'Spillage') OR contains(reason, 'Quality')) AS s FROM v_checks), (SELECT sum(amount + discount_amount) AS g FROM v_orders)""")
def _(t):
    return sales.discount_reasons(t.checks, t.orders)


@query("rep_server_flags", """
  WITH o AS (SELECT server, count(DISTINCT order_id) AS n, round(sum(tip) * 100 / sum(amount), 1) AS tip, round(sum(discount_amount) * 100 / sum(amount + discount_amount), 1) AS disc FROM v_orders GROUP BY 1),
  v AS (SELECT server, count(DISTINCT payment_id) AS n, round(count(void_ts) * 100.0 / count(DISTINCT payment_id), 2) AS rate FROM v_payments GROUP BY 1)
  SELECT 'low_tip' AS flag, server, n, tip AS rate FROM o WHERE n >= 10 AND tip < 11 UNION ALL SELECT 'high_discount', server, n, disc FROM o WHERE n >= 10 AND disc > 2.5
  UNION ALL SELECT 'high_void', server, n, rate FROM v WHERE n >= 10 AND rate > 11""")
def _(t):
    return sales.server_flags(t.orders, t.payments, low_tip=11, high_disc=2.5, high_void=11)


@query("rep_cash_control", """
  SELECT c AS cash_payments, n AS total_payments, round(c / n * 100, 1) AS cash_pct, CASE WHEN round(c / n * 100, 1) BETWEEN 14 AND 20 THEN 'OK' ELSE 'REVIEW' END AS cash_status, ns AS no_sale_count,
    CASE WHEN ns > 100 THEN 'FLAG - HIGH NO_SALE' ELSE 'OK' END AS no_sale_status, round(o, 2) AS overage, round(s, 2) AS shortage, round(abs(o) + abs(s), 2) AS total_variance,
    CASE WHEN abs(o) + abs(s) > 50 THEN 'FLAG - HIGH VARIANCE' ELSE 'OK' END AS variance_status
  FROM (SELECT count(*) FILTER (payment_type = 'Cash' OR payment_type LIKE '%CASH%') AS c, count(DISTINCT payment_id) AS n FROM v_payments),
    (SELECT count(*) FILTER (action = 'NO_SALE') AS ns, sum(amount) FILTER (action = 'CLOSE_OUT_OVERAGE') AS o, sum(amount) FILTER (action = 'CLOSE_OUT_SHORTAGE') AS s FROM v_cash)""")
def _(t):
    return sales.cash_control(t.payments, t.cash_entries)


@query("rep_cash_handlers", """
  SELECT *, CAST(row_number() OVER (ORDER BY cash_collected DESC, employee) AS INT) AS rank FROM (SELECT employee, count(*) AS entries, round(coalesce(sum(amount) FILTER (action = 'CASH_COLLECTED'), 0), 2) AS cash_collected,
    count(*) FILTER (action = 'NO_SALE') AS no_sales, count(*) FILTER (action = 'PAY_OUT') AS payouts FROM v_cash GROUP BY 1) QUALIFY rank <= 10""")
def _(t):
    return sales.cash_handlers(t.cash_entries)


@query("rep_weekly_scorecard", """
  WITH m AS (SELECT (SELECT round(sum(total), 2) FROM v_orders) AS rev, (SELECT round(sum(discount_amount) / sum(amount + discount_amount) * 100, 1) FROM v_orders) AS disc,
    (SELECT round(count(void_ts) / count(*) * 100, 2) FROM v_payments) AS void, (SELECT count(*) FILTER (action = 'NO_SALE')::DOUBLE FROM v_cash) AS cash, (SELECT round(count(fulfilled_ts) / count(*) * 100, 1) FROM v_kitchen) AS kitchen)
  SELECT 'revenue' AS metric, rev AS value, 100000.0::DOUBLE AS target, CASE WHEN rev >= 100000 THEN 'PASS' ELSE 'BELOW TARGET' END AS status FROM m
  UNION ALL SELECT 'discount', disc, 8, CASE WHEN disc < 8 THEN 'PASS' ELSE 'REVIEW' END FROM m UNION ALL SELECT 'void', void, 1, CASE WHEN void < 1 THEN 'PASS' ELSE 'REVIEW' END FROM m
  UNION ALL SELECT 'cash', cash, 100, CASE WHEN cash <= 100 THEN 'PASS' ELSE 'REVIEW' END FROM m UNION ALL SELECT 'kitchen', kitchen, 99, CASE WHEN kitchen >= 99 THEN 'PASS' ELSE 'REVIEW' END FROM m""")
def _(t):
    return sales.weekly_scorecard(t.orders, t.payments, t.cash_entries, t.kitchen)


@query("rep_insights", f"""
  WITH w AS ({WOW}), dw AS (SELECT dayname(processing_date) AS d, round(sum(total), 2) AS r FROM v_orders WHERE {_KEPT} GROUP BY 1), s AS ({TOP15}),
  it AS (SELECT menu_item, sum(qty) AS q FROM v_items WHERE {_KEPT} GROUP BY 1), a AS (SELECT round(avg(total), 2) AS a FROM v_orders WHERE {_KEPT}), p AS ({PAYTYPES})
  SELECT 'revenue_growth' AS key, CASE WHEN revenue_pct > 0 THEN 'good' ELSE 'warning' END AS severity, '' AS subject, revenue_pct::DOUBLE AS value FROM w WHERE abs(revenue_pct) > 10
  UNION ALL SELECT 'avg_check', CASE WHEN a > 50 THEN 'good' ELSE 'warning' END, '', a FROM a WHERE a > 50 OR a < 25
  UNION ALL SELECT * FROM (SELECT 'best_day', 'info', d, r FROM dw ORDER BY r DESC LIMIT 1)
  UNION ALL SELECT * FROM (SELECT 'slow_day', CASE WHEN r < (SELECT max(r) FROM dw) * 0.5 THEN 'warning' ELSE 'info' END, d, r FROM dw ORDER BY r LIMIT 1)
  UNION ALL SELECT * FROM (SELECT 'top_server', 'info', server, revenue FROM s ORDER BY revenue DESC LIMIT 1)
  UNION ALL SELECT 'tip_rate', CASE WHEN round(sum(tips) / sum(revenue) * 100, 1) < 15 THEN 'warning' ELSE 'info' END, '', round(sum(tips) / sum(revenue) * 100, 1) FROM s
  UNION ALL SELECT * FROM (SELECT 'best_seller', 'info', menu_item, q::DOUBLE FROM it ORDER BY q DESC, menu_item LIMIT 1)
  UNION ALL SELECT 'party_size', 'info', '', round(sum(guest_count) / count(DISTINCT order_id), 1) FROM v_orders WHERE {_KEPT}
  UNION ALL SELECT 'cash_share', 'info', '', round(sum(amount) FILTER (type = 'Cash') / sum(amount) * 100, 1) FROM p""")
def _(t):
    return sales.insights(t.orders, t.payments, t.items, "1998-06-01")


@query("rep_insights_weekly", f"""
  WITH w AS ({WOW}), s AS ({TOP15}), f AS (SELECT * FROM s ORDER BY revenue DESC, server LIMIT 1),
  it AS (SELECT menu_item, sum(qty) AS q, round(sum(net_price), 2) AS r FROM v_items WHERE {_KEPT} GROUP BY 1), bs AS (SELECT menu_item FROM it ORDER BY q DESC, menu_item LIMIT 1), br AS (SELECT menu_item, r FROM it ORDER BY r DESC, menu_item LIMIT 1),
  op AS (SELECT coalesce(nullif(trim(split_part(dining_options, ',', 1)), ''), 'Unknown') AS option, count(DISTINCT order_id) AS n FROM v_orders WHERE {_KEPT} GROUP BY 1),
  dn AS (SELECT * FROM op WHERE contains(lower(option), 'dine') ORDER BY n DESC, option LIMIT 1)
  SELECT * FROM ({ORACLES["rep_insights"]})
  UNION ALL SELECT 'top_account', 'info', CASE WHEN contains(lower(server), 'bottle manager') THEN 'pool' WHEN contains(lower(server), 'srv_3') THEN 'manager' ELSE 'server' END, revenue FROM f
  UNION ALL SELECT 'share_techniques', 'info', server, revenue FROM f WHERE NOT contains(lower(server), 'bottle manager') AND NOT contains(lower(server), 'srv_3') AND (SELECT count(*) FROM s) > 1 AND revenue > 1.5 * (SELECT avg(revenue) FROM s)
  UNION ALL SELECT 'top_revenue_item', 'info', br.menu_item, br.r FROM br, bs WHERE br.menu_item <> bs.menu_item
  UNION ALL SELECT 'dine_in_share', 'info', dn.option, round(dn.n / (SELECT count(DISTINCT order_id) FROM v_orders WHERE {_KEPT}) * 100, 1) FROM dn WHERE EXISTS (SELECT 1 FROM op WHERE contains(lower(option), 'take'))
  UNION ALL SELECT 'growing_orders', 'info', '', orders_pct FROM w WHERE orders > 0 AND orders_pct > 0""")
def _(t):
    return sales.weekly_insights(t.orders, t.payments, t.items, "1998-06-01", ["srv_3"], ["Bottle Manager"])
