"""Joins, aggregations, windows, sorts and set operations over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, predicates, text
from ..functions.numbers import sum0, sum_if
from ..operators import aggregates as ag
from ..operators import joins, orderstats, windows
from ..operators.rules import first_match
from ..sources import sinks
from .registry import query

EVENTS = [
    ("Spring Fair", "1997-03-10", "1997-03-28", "culture"), ("Spring Fair", "1998-03-09", "1998-03-27", "culture"),
    ("Game Week", "1997-10-29", "1997-11-02", "sport"), ("Game Week", "1998-10-28", "1998-11-03", "sport"),
    ("New Year", "1998-12-31", "1999-01-01", "holiday"),
]
EVENT_SQL = "(VALUES " + ", ".join(f"('{n}', DATE '{s}', DATE '{e}', '{c}')" for n, s, e, c in EVENTS) + ") AS e(name, start_date, end_date, category)"


def event_rows(t):
    return t.rows(EVENTS, "name string, start_date string, end_date string, category string").withColumns(
        {"start_date": F.to_date("start_date"), "end_date": F.to_date("end_date")})


def weekly_revenue(t):
    return t.orders.groupBy(dates.week_start(F.col("processing_date")).alias("week_start")).agg(F.round(F.sum("amount"), 2).alias("revenue"))


WEEKLY_SQL = "SELECT CAST(date_trunc('week', processing_date) AS DATE) AS week_start, round(sum(amount), 2) AS revenue FROM v_orders GROUP BY 1"


# --- joins ---

@query("j_left_keys", """
  SELECT i.item_selection_id, i.menu_item, c.check_number, c.reason FROM v_check_items i
  LEFT JOIN v_checks c ON i.check_id = c.check_id AND i.processing_date = c.processing_date""")
def _(t):
    c = t.checks.select("check_id", "processing_date", "check_number", "reason")
    return t.check_items.join(c, ["check_id", "processing_date"], "left").select("item_selection_id", "menu_item", "check_number", "reason")


@query("j_left_preagg", """
  SELECT c.check_id, c.total, round(coalesce(i.item_net, 0), 2) AS item_net FROM v_checks c
  LEFT JOIN (SELECT check_id, sum(net_price) AS item_net FROM v_items GROUP BY 1) i ON c.check_id = i.check_id""")
def _(t):
    out = joins.left_preaggregated(t.checks.select("check_id", "total"), t.items, ["check_id"], {"item_net": "net_price"})
    return out.withColumn("item_net", F.round("item_net", 2))


@query("j_inner_self", """
  WITH k AS (SELECT card_digits || '-' || coalesce(card_type, '') AS card, strftime(processing_date, '%Y-%m') AS month, amount FROM v_payments WHERE card_digits IS NOT NULL),
  f AS (SELECT card, min(month) AS first_month FROM k GROUP BY 1)
  SELECT k.month, count(DISTINCT k.card) AS active, count(DISTINCT CASE WHEN k.month = f.first_month THEN k.card END) AS new_cards
  FROM k JOIN f ON k.card = f.card GROUP BY 1""")
def _(t):
    k = t.payments.filter(F.col("card_digits").isNotNull()).groupBy(
        text.card_key(F.col("card_digits"), F.col("card_type")).alias("card"), dates.month_label(F.col("processing_date")).alias("month")).agg(F.sum("amount"))
    first = k.groupBy("card").agg(F.min("month").alias("first_month"))
    return k.join(first, "card").groupBy("month").agg(
        F.count("*").alias("active"), F.count_if(F.col("month") == F.col("first_month")).alias("new_cards"))


@query("j_inner_multi", """
  SELECT c.check_id, c.reason, c.discount, i.menu_item, i.gross_price FROM v_checks c
  JOIN v_check_items i ON c.check_id = i.check_id AND c.processing_date = i.processing_date
  WHERE c.discount >= 75 AND (lower(c.reason) LIKE '%spillage%' OR lower(c.reason) LIKE '%food quality%')
    AND (upper(i.menu_item) LIKE 'BTL %' OR (lower(i.sales_category) LIKE '%liquor%' AND i.gross_price >= 100))""")
def _(t):
    c = t.checks.filter((F.col("discount") >= 75) & text.contains_any(F.col("reason"), ["spillage", "food quality"]))
    i = t.check_items.filter(F.upper("menu_item").startswith("BTL ") | (text.contains_any(F.col("sales_category"), ["liquor"]) & (F.col("gross_price") >= 100)))
    return c.select("check_id", "processing_date", "reason", "discount").join(
        i.select("check_id", "processing_date", "menu_item", "gross_price"), ["check_id", "processing_date"]).drop("processing_date")


@query("j_full_outer", """
  WITH a AS (SELECT opened_hour AS hour, round(sum(discount), 2) AS comp FROM v_checks WHERE discount > 0 GROUP BY 1),
  b AS (SELECT CAST(extract(hour FROM opened) AS INT) AS hour, round(sum(amount), 2) AS sales FROM v_orders WHERE tip > 20 GROUP BY 1)
  SELECT coalesce(a.hour, b.hour)::INT AS hour, coalesce(comp, 0) AS comp, coalesce(sales, 0) AS sales FROM a FULL OUTER JOIN b ON a.hour = b.hour""")
def _(t):
    a = t.checks.filter(F.col("discount") > 0).groupBy(dates.clock_hour(F.col("opened_time")).alias("hour")).agg(F.round(F.sum("discount"), 2).alias("comp"))
    b = t.orders.filter(F.col("tip") > 20).groupBy(F.hour("opened").alias("hour")).agg(F.round(F.sum("amount"), 2).alias("sales"))
    return joins.align_periods(a, b, "hour")


@query("j_align_periods", """
  WITH r AS (SELECT strftime(processing_date, '%Y-%m') AS month, round(sum(amount), 2) AS revenue FROM v_orders GROUP BY 1),
  x AS (SELECT strftime(transaction_date, '%Y-%m') AS month, round(sum(abs_amount), 2) AS expense FROM v_bank WHERE transaction_type = 'debit' GROUP BY 1)
  SELECT coalesce(r.month, x.month) AS month, coalesce(revenue, 0) AS revenue, coalesce(expense, 0) AS expense FROM r FULL OUTER JOIN x ON r.month = x.month""")
def _(t):
    r = t.orders.groupBy(dates.month_label(F.col("processing_date")).alias("month")).agg(F.round(F.sum("amount"), 2).alias("revenue"))
    x = t.bank.filter("transaction_type = 'debit'").groupBy(dates.month_label(F.col("transaction_date")).alias("month")).agg(
        F.round(F.sum("abs_amount"), 2).alias("expense"))
    return joins.align_periods(r, x, "month")


@query("j_cross_scalar", """
  SELECT (SELECT round(sum(amount), 2) FROM v_orders) AS revenue, (SELECT round(sum(abs_amount), 2) FROM v_bank WHERE transaction_type = 'debit') AS expense,
    (SELECT count(*) FROM v_cash WHERE action = 'NO_SALE') AS no_sales""")
def _(t):
    expense = t.bank.filter("transaction_type = 'debit'").agg(F.round(F.sum("abs_amount"), 2)).scalar()
    no_sales = t.cash_entries.filter("action = 'NO_SALE'").agg(F.count("*")).scalar()
    return t.orders.agg(F.round(F.sum("amount"), 2).alias("revenue")).select("revenue", expense.alias("expense"), no_sales.alias("no_sales"))


@query("j_shifted_date", """
  WITH d AS (SELECT processing_date AS day, round(sum(total), 2) AS revenue FROM v_orders GROUP BY 1)
  SELECT a.day, a.revenue, b.revenue AS prior_week FROM d a LEFT JOIN d b ON b.day + 7 = a.day""")
def _(t):
    d = t.orders.groupBy(F.col("processing_date").alias("day")).agg(F.round(F.sum("total"), 2).alias("revenue"))
    prior = d.select(F.date_add("day", 7).alias("day"), F.col("revenue").alias("prior_week"))
    return d.join(prior, "day", "left")


@query("j_topn_semi", """
  WITH r AS (SELECT vendor_normalized, sum(abs_amount) AS v FROM v_bank WHERE transaction_type = 'debit' AND vendor_normalized IS NOT NULL GROUP BY 1 ORDER BY v DESC, 1 LIMIT 15)
  SELECT vendor_normalized, strftime(transaction_date, '%Y-%m') AS month, round(sum(abs_amount), 2) AS spend, count(*) AS n
  FROM v_bank WHERE transaction_type = 'debit' AND vendor_normalized IN (SELECT vendor_normalized FROM r) GROUP BY 1, 2""")
def _(t):
    b = t.bank.filter("transaction_type = 'debit' AND vendor_normalized IS NOT NULL")
    return joins.restrict_to_top(b, "vendor_normalized", F.col("abs_amount"), 15).groupBy(
        "vendor_normalized", dates.month_label(F.col("transaction_date")).alias("month")).agg(
        F.round(F.sum("abs_amount"), 2).alias("spend"), F.count("*").alias("n"))


@query("j_interval_overlap", f"""
  WITH w AS ({WEEKLY_SQL}) SELECT w.week_start, w.revenue, e.name, e.category FROM w JOIN {EVENT_SQL} ON e.start_date <= w.week_start + 6 AND e.end_date >= w.week_start""")
def _(t):
    return joins.week_span_overlap(weekly_revenue(t), event_rows(t)).select("week_start", "revenue", "name", "category")


WINDOWS = [("launch", "1997-03-14 21:00:00", "1997-03-15 03:30:00"), ("gala", "1998-06-05 20:00:00", "1998-06-07 05:00:00")]
WINDOW_SQL = "(VALUES " + ", ".join(f"('{n}', TIMESTAMP '{s}', TIMESTAMP '{e}')" for n, s, e in WINDOWS) + ") AS w(event, window_start, window_end)"


@query("j_window_between", f"""
  SELECT w.event, i.item_selection_id, i.net_price FROM v_items i JOIN {WINDOW_SQL} ON i.order_ts BETWEEN window_start AND window_end""")
def _(t):
    w = t.rows(WINDOWS, "event string, window_start string, window_end string").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
    return joins.rows_in_windows(t.items, "order_ts", w).select("event", "item_selection_id", "net_price")


RULES = [("sun liquor", "Liquor", 1), ("foods", "Food", 2), ("north", "North", 3), ("wire", "Wire", 4), ("check", "Check", 5), ("to", "Generic", 6)]
RULES_SQL = "(VALUES " + ", ".join(f"('{k}', '{c}', {p})" for k, c, p in RULES) + ") AS r(keyword, label, priority)"


@query("j_keyword_first_match", f"""
  WITH d AS (SELECT description, count(*) AS n FROM v_bank GROUP BY 1),
  m AS (SELECT d.description, arg_min(label, priority) AS label FROM d JOIN {RULES_SQL} ON contains(lower(d.description), r.keyword) GROUP BY 1)
  SELECT m.label, CAST(sum(d.n) AS BIGINT) AS n FROM d LEFT JOIN m ON d.description = m.description GROUP BY 1""")
def _(t):
    rules = t.rows(RULES, "keyword string, label string, priority int")
    return first_match(t.bank.select("description"), rules, "description", ["label"]).groupBy("label").agg(F.count("*").alias("n"))


_WORDS_SQL = r"SELECT unnest(regexp_extract_all(lower(text), '[a-z]{9,}')) AS keyword FROM documents WHERE text IS NOT NULL"


@query("j_keyword_first_match_large", f"""
  WITH k AS (SELECT upper(keyword) AS keyword, CAST(count(*) AS BIGINT) AS n FROM ({_WORDS_SQL}) GROUP BY 1),
  d AS (SELECT row_number() OVER () AS r, upper(text) AS t FROM documents WHERE text IS NOT NULL),
  p AS (SELECT r, substr(t, i, 9) AS head, substr(t, i, (SELECT max(length(keyword)) FROM k)) AS tail FROM (SELECT r, t, unnest(range(1, length(t) - 7)) AS i FROM d) WHERE regexp_matches(substr(t, i, 9), '^[A-Z]{{9}}$')),
  m AS (SELECT r, min(struct_pack(p := -k.n, k := k.keyword)) AS hit FROM p JOIN k ON p.head = left(k.keyword, 9) AND starts_with(p.tail, k.keyword) GROUP BY 1)
  SELECT lower(hit.k) AS label, CAST(count(*) AS BIGINT) AS n FROM d LEFT JOIN m USING (r) GROUP BY 1""")
def _(t):
    """Every long word of the texts as a keyword, looked for in all whole texts; the commonest one contained labels a text."""
    docs = t.raw("documents").filter("text IS NOT NULL")
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{9,}"), F.lit(0))).alias("keyword")).groupBy("keyword").agg(F.count("*").alias("n"))
    rules = sinks.stage(words.select("keyword", (-F.col("n")).alias("priority"), F.col("keyword").alias("label")), "keywords")
    return first_match(docs.select("text"), rules, "text", ["label"], repeated=False).groupBy("label").agg(F.count("*").alias("n"))


@query("j_exists", "SELECT o.order_id FROM v_orders o WHERE EXISTS (SELECT 1 FROM v_items i WHERE i.order_id = o.order_id AND i.voided = 'true')")
def _(t):
    return t.orders.join(t.items.filter("voided = 'true'"), "order_id", "left_semi").select("order_id")


@query("j_not_exists", "SELECT o.order_id FROM v_orders o WHERE NOT EXISTS (SELECT 1 FROM v_items i WHERE i.order_id = o.order_id AND i.voided = 'true')")
def _(t):
    return t.orders.join(t.items.filter("voided = 'true'"), "order_id", "left_anti").select("order_id")


@query("j_calendar_prior_name", f"""
  WITH w AS ({WEEKLY_SQL}), h AS (SELECT e.name, year(e.start_date) + 1 AS y, max(w.revenue) AS historical_revenue FROM w JOIN {EVENT_SQL}
    ON e.start_date <= w.week_start + 6 AND e.end_date >= w.week_start GROUP BY 1, 2)
  SELECT e.name, e.start_date, e.end_date, h.historical_revenue FROM {EVENT_SQL} LEFT JOIN h ON h.name = e.name AND h.y = year(e.start_date)""")
def _(t):
    return joins.prior_year_best_week(event_rows(t), weekly_revenue(t))


@query("j_role_lookup", """
  WITH h AS (SELECT employee_name, job_title, sum(regular_hours + overtime_hours) AS hours FROM v_labor WHERE trim(job_title) <> '' GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY employee_name ORDER BY hours DESC, job_title) AS rn FROM h)
  SELECT o.order_id, o.server, r.job_title AS primary_role FROM v_orders o LEFT JOIN r ON r.employee_name = o.server AND rn = 1""")
def _(t):
    roles = joins.primary_role(t.labor).select(F.col("employee_name").alias("server"), "primary_role")
    return t.orders.select("order_id", "server").join(roles, "server", "left")


@query("j_tab_name_to_reservation", """
  WITH p AS (SELECT DISTINCT processing_date AS date, lower(regexp_extract(trim(tab_name), '(?i)^bday[\\s\\-\\.]*(?:f(?:ri)?|s(?:at)?|w(?:ed)?|u(?:un)?|sun)[\\s\\-\\.]+([a-z]+)', 1)) AS party FROM v_check_items)
  SELECT r.reservation_id, r.first_name, p.party IS NOT NULL AS attributed FROM v_reservations r LEFT JOIN p ON p.date = r.date AND p.party = r.first_name AND p.party <> ''""")
def _(t):
    from ..rulebook import PARTY_TAB
    p = t.check_items.select(F.col("processing_date").alias("date"), F.lower(F.regexp_extract(F.trim("tab_name"), PARTY_TAB, 1)).alias("first_name"))
    p = p.filter("first_name <> ''").distinct().withColumn("hit", F.lit(True))
    return t.reservations.join(p, ["date", "first_name"], "left").select("reservation_id", "first_name", F.coalesce("hit", F.lit(False)).alias("attributed"))


# --- aggregations ---

@query("a_sum_count_avg", """
  SELECT revenue_center, coalesce(round(sum(amount), 2), 0) AS net, count(*) AS n, round(avg(amount), 4) AS mean, min(amount) AS low, max(amount) AS high FROM v_orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy("revenue_center").agg(
        F.round(sum0("amount"), 2).alias("net"), F.count("*").alias("n"), F.round(F.avg("amount"), 4).alias("mean"),
        F.min("amount").alias("low"), F.max("amount").alias("high"))


@query("a_count_distinct", """
  SELECT menu_group, count(DISTINCT order_id) AS orders, count(DISTINCT processing_date) AS days, count(DISTINCT server) AS servers FROM v_items GROUP BY 1""")
def _(t):
    return t.items.groupBy("menu_group").agg(
        F.count_distinct("order_id").alias("orders"), F.count_distinct("processing_date").alias("days"), F.count_distinct("server").alias("servers"))


@query("a_conditional", """
  SELECT server, count(*) FILTER (discount > 0) AS discounted, round(coalesce(sum(net_price) FILTER (sales_category = 'Food'), 0), 2) AS food,
    round(coalesce(sum(net_price) FILTER (regexp_matches(lower(sales_category), 'liquor|beer|wine')), 0), 2) AS bar FROM v_items GROUP BY 1""")
def _(t):
    cat = F.col("sales_category")
    return t.items.groupBy("server").agg(
        F.count_if(F.col("discount") > 0).alias("discounted"), F.round(sum_if(cat == "Food", "net_price"), 2).alias("food"),
        F.round(sum_if(F.lower(cat).rlike("liquor|beer|wine"), "net_price"), 2).alias("bar"))


@query("a_approx_median", """
  SELECT station, CAST(quantile_disc(date_diff('second', fired_ts, fulfilled_ts), 0.5) AS BIGINT) AS median_sec FROM v_kitchen WHERE fulfilled_ts IS NOT NULL GROUP BY 1""")
def _(t):
    secs = F.timestamp_diff("SECOND", F.col("fired_ts"), F.col("fulfilled_ts"))
    return t.kitchen.groupBy("station").agg(F.percentile_approx(secs, 0.5, 10000).alias("median_sec"))


@query("a_upper_median", """
  SELECT server, median FROM (SELECT server, amount AS median, row_number() OVER (PARTITION BY server ORDER BY amount) - 1 AS i,
    count(*) OVER (PARTITION BY server) AS n FROM v_orders WHERE server IS NOT NULL) WHERE i = n // 2""")
def _(t):
    return orderstats.upper_median(t.orders.filter("server IS NOT NULL"), ["server"], "amount")


@query("a_having", "SELECT server, count(*) AS n, round(sum(amount), 2) AS net FROM v_orders GROUP BY 1 HAVING count(*) >= 300 AND sum(amount) > 1000")
def _(t):
    g = t.orders.groupBy("server").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("net"))
    return g.filter((F.col("n") >= 300) & (F.col("net") > 1000))


@query("a_string_agg_distinct", "SELECT server, string_agg(DISTINCT sales_category, ',' ORDER BY sales_category) AS categories FROM v_items GROUP BY 1")
def _(t):
    return t.items.groupBy("server").agg(F.array_join(F.sort_array(F.collect_set("sales_category")), ",").alias("categories"))


@query("a_max_text", "SELECT customer_id, max(customer) AS name, max(email) AS email FROM v_checks GROUP BY 1")
def _(t):
    return t.checks.groupBy("customer_id").agg(F.max("customer").alias("name"), F.max("email").alias("email"))


GROUPS = {"cogs": ["cost of goods", "cogs"], "labor": ["3. labor", "payroll"], "promo": ["marketing", "event", "promoter"], "opex": ["opex"]}


@query("a_sum_matching", """
  SELECT strftime(transaction_date, '%Y-%m') AS month,
    round(coalesce(sum(abs_amount) FILTER (lower(category) LIKE '%cost of goods%' OR lower(category) LIKE '%cogs%'), 0), 2) AS cogs,
    round(coalesce(sum(abs_amount) FILTER (lower(category) LIKE '%3. labor%' OR lower(category) LIKE '%payroll%'), 0), 2) AS labor,
    round(coalesce(sum(abs_amount) FILTER (lower(category) LIKE '%marketing%' OR lower(category) LIKE '%event%' OR lower(category) LIKE '%promoter%'), 0), 2) AS promo,
    round(coalesce(sum(abs_amount) FILTER (lower(category) LIKE '%opex%'), 0), 2) AS opex
  FROM v_bank WHERE transaction_type = 'debit' GROUP BY 1""")
def _(t):
    from ..operators.rules import any_match_sums
    b = t.bank.filter("transaction_type = 'debit'").withColumn("month", dates.month_label(F.col("transaction_date")))
    out = any_match_sums(b, GROUPS, "category", "abs_amount", ["month"])
    return out.withColumns({c: F.round(c, 2) for c in GROUPS})


@query("a_rollup_two_level", """
  WITH p AS (SELECT service, menu_group, count(DISTINCT check_id) AS n, sum(net_price) AS v FROM v_items GROUP BY 1, 2)
  SELECT 'service' AS level, p.service AS key, round(sum(v), 2) AS value, CAST(sum(n) AS BIGINT) AS additive, any_value(e.exact) AS exact FROM p
    JOIN (SELECT service, count(DISTINCT check_id) AS exact FROM v_items GROUP BY 1) e ON e.service = p.service GROUP BY 2
  UNION ALL SELECT 'menu_group', p.menu_group, round(sum(v), 2), CAST(sum(n) AS BIGINT), any_value(e.exact) FROM p
    JOIN (SELECT menu_group, count(DISTINCT check_id) AS exact FROM v_items GROUP BY 1) e ON e.menu_group = p.menu_group GROUP BY 2""")
def _(t):
    return ag.two_level(t.items, "service", "menu_group", "net_price", "check_id")


@query("a_period_total", """
  SELECT coalesce(month, 'total') AS month, round(sum(amount), 2) AS net, round(sum(tip), 2) AS tips, round(sum(tip) / sum(amount) * 100, 2) AS tip_pct
  FROM (SELECT strftime(processing_date, '%Y-%m') AS month, amount, tip FROM v_orders) GROUP BY ROLLUP (month)""")
def _(t):
    m = t.orders.groupBy(dates.month_label(F.col("processing_date")).alias("month")).agg(F.sum("amount").alias("net"), F.sum("tip").alias("tips"))
    out = ag.with_period_total(m, "month", ["net", "tips"])
    return out.select("month", F.round("net", 2).alias("net"), F.round("tips", 2).alias("tips"), F.round(F.col("tips") / F.col("net") * 100, 2).alias("tip_pct"))


@query("a_weighted_avg", """
  SELECT round(sum(m * n) / sum(n), 3) AS weighted FROM (SELECT avg(amount) AS m, count(*) AS n FROM v_orders GROUP BY server)""")
def _(t):
    g = t.orders.groupBy("server").agg(F.avg("amount").alias("m"), F.count("*").alias("n"))
    return g.agg(F.round(ag.weighted_mean(F.col("m"), F.col("n")), 3).alias("weighted"))


@query("a_top1_per_group", """
  SELECT check_id, sales_category, round(v, 2) AS discount FROM (SELECT check_id, sales_category, sum(discount) AS v,
    row_number() OVER (PARTITION BY check_id ORDER BY sum(discount) DESC, sales_category) AS rn FROM v_items GROUP BY 1, 2) WHERE rn = 1""")
def _(t):
    return ag.top1_of_sums(t.items, "check_id", "sales_category", "discount")


# --- windows ---

def _latest():
    return [F.desc("processing_date"), F.desc("gross_price"), F.asc("server"), F.asc("menu_item"), F.desc("net_price"), F.desc("qty")]


_LATEST_SQL = "processing_date DESC, gross_price DESC, server, menu_item, net_price DESC, qty DESC"


@query("w_latest_per_key", f"""
  SELECT item_selection_id, processing_date, menu_item, net_price FROM (SELECT *, row_number() OVER (PARTITION BY item_selection_id ORDER BY {_LATEST_SQL}) AS rn FROM v_items) WHERE rn = 1""")
def _(t):
    return windows.latest_per_key(t.items, ["item_selection_id"], _latest()).select("item_selection_id", "processing_date", "menu_item", "net_price")


@query("w_qualify", """
  SELECT customer_id, check_id, processing_date FROM v_checks QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY processing_date DESC, check_id DESC) = 1""")
def _(t):
    return windows.latest_per_key(t.checks, ["customer_id"], [F.desc("processing_date"), F.desc("check_id")]).select("customer_id", "check_id", "processing_date")


@query("w_dedup_rounded", """
  SELECT transaction_date, description, CAST(round(amount, 2) AS DECIMAL(18, 2)) AS amount_key, category FROM v_bank
  QUALIFY row_number() OVER (PARTITION BY transaction_date, description, CAST(round(amount, 2) AS DECIMAL(18, 2)) ORDER BY category, category_source, vendor_normalized) = 1""")
def _(t):
    from ..functions.numbers import dec_key
    b = t.bank.withColumn("amount_key", dec_key(F.col("amount")))
    return windows.latest_per_key(b, ["transaction_date", "description", "amount_key"], [F.asc("category"), F.asc("category_source"), F.asc("vendor_normalized")]).select(
        "transaction_date", "description", "amount_key", "category")


@query("w_rank_over_agg", """
  SELECT employee, cash, rank FROM (SELECT employee, round(sum(CASE WHEN action = 'CASH_COLLECTED' THEN amount ELSE 0 END), 2) AS cash,
    CAST(row_number() OVER (ORDER BY round(sum(CASE WHEN action = 'CASH_COLLECTED' THEN amount ELSE 0 END), 2) DESC, employee) AS INT) AS rank FROM v_cash GROUP BY 1) WHERE rank <= 10""")
def _(t):
    g = t.cash_entries.groupBy("employee").agg(F.round(sum_if(F.col("action") == "CASH_COLLECTED", "amount"), 2).alias("cash"))
    return windows.top_per_key(g, [], [F.desc("cash"), F.asc("employee")], 10)


@query("w_primary_by_sum", """
  SELECT employee_name, job_title AS primary_role, hours FROM (SELECT employee_name, job_title, sum(regular_hours + overtime_hours) AS hours,
    row_number() OVER (PARTITION BY employee_name ORDER BY sum(regular_hours + overtime_hours) DESC, job_title) AS rn FROM v_labor WHERE trim(job_title) <> '' GROUP BY 1, 2) WHERE rn = 1""")
def _(t):
    return joins.primary_role(t.labor)


@query("w_running_total", """
  WITH m AS (SELECT strftime(processing_date, '%Y-%m') AS month, round(sum(amount), 2) AS net FROM v_orders GROUP BY 1)
  SELECT month, net, round(sum(net) OVER (ORDER BY month), 2) AS net_to_date FROM m""")
def _(t):
    m = t.orders.groupBy(dates.month_label(F.col("processing_date")).alias("month")).agg(F.round(F.sum("amount"), 2).alias("net"))
    return windows.running_totals(m, "month", {"net_to_date": "net"})


_VM_SQL = """SELECT vendor_normalized AS vendor, strftime(transaction_date, '%Y-%m') AS month, round(sum(abs_amount), 2) AS spend FROM v_bank
  WHERE transaction_type = 'debit' AND vendor_normalized IS NOT NULL GROUP BY 1, 2"""


def vendor_months(t):
    return t.bank.filter("transaction_type = 'debit' AND vendor_normalized IS NOT NULL").groupBy(
        F.col("vendor_normalized").alias("vendor"), dates.month_label(F.col("transaction_date")).alias("month")).agg(F.round(F.sum("abs_amount"), 2).alias("spend"))


@query("w_mom_change", f"""
  WITH m AS ({_VM_SQL}), l AS (SELECT *, lag(spend) OVER (PARTITION BY vendor ORDER BY month) AS prior, row_number() OVER (PARTITION BY vendor ORDER BY month DESC) AS rn FROM m)
  SELECT vendor, month, spend AS current, prior, round((spend - prior) / prior * 100, 1) AS change_pct FROM l WHERE rn = 1 AND prior IS NOT NULL""")
def _(t):
    return windows.last_change(vendor_months(t), "vendor", "month", "spend")


@query("w_trend3", f"""
  WITH m AS ({_VM_SQL}), l AS (SELECT *, lag(spend) OVER w AS p1, lag(spend, 2) OVER w AS p2, row_number() OVER (PARTITION BY vendor ORDER BY month DESC) AS rn FROM m WINDOW w AS (PARTITION BY vendor ORDER BY month))
  SELECT vendor, CASE WHEN p2 <= p1 AND p1 <= spend THEN 'rising' WHEN p2 >= p1 AND p1 >= spend THEN 'falling' ELSE '' END AS trend FROM l WHERE rn = 1""")
def _(t):
    return windows.trend3(vendor_months(t), ["vendor"], "month", "spend")


@query("w_concentration", """
  WITH g AS (SELECT customer_id, sum(total) AS spend FROM v_checks GROUP BY 1), r AS (SELECT spend, row_number() OVER (ORDER BY spend DESC) AS i, count(*) OVER () AS n, sum(spend) OVER () AS s FROM g),
  f(label, k) AS (VALUES ('Top 5%', 0.05), ('Top 10%', 0.10), ('Top 20%', 0.20), ('Top 50%', 0.50))
  SELECT label, CAST(greatest(1, floor(n * k)) AS BIGINT) AS members, round(sum(spend), 2) AS amount, round(sum(spend) / any_value(s) * 100, 1) AS pct
  FROM r, f WHERE i <= greatest(1, floor(n * k)) GROUP BY 1, 2""")
def _(t):
    g = t.checks.groupBy("customer_id").agg(F.sum("total").alias("spend"))
    return orderstats.top_shares(g, "spend", [("Top 5%", 0.05), ("Top 10%", 0.10), ("Top 20%", 0.20), ("Top 50%", 0.50)])


@query("w_peer_threshold", """
  WITH g AS (SELECT customer_id, round(sum(discount), 2) AS v FROM v_checks GROUP BY 1), r AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n FROM g WHERE v > 0),
  m AS (SELECT v AS median FROM r WHERE i = n // 2)
  SELECT customer_id, v AS value, median FROM g, m WHERE v > 1.5 * median AND v > 250""")
def _(t):
    g = t.checks.groupBy("customer_id").agg(F.round(F.sum("discount"), 2).alias("value"))
    median = orderstats.upper_median(g.filter("value > 0"), [], "value").scalar()
    return g.withColumn("median", median).filter((F.col("value") > 1.5 * F.col("median")) & (F.col("value") > 250))


@query("w_trailing_avg", """
  WITH d AS (SELECT server, processing_date, round(sum(discount), 2) AS discount FROM v_checks WHERE server IS NOT NULL GROUP BY 1, 2)
  SELECT server, processing_date, discount, round(sum(discount) OVER (PARTITION BY server ORDER BY processing_date RANGE BETWEEN INTERVAL 28 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) / 4, 4) AS trailing_mean FROM d""")
def _(t):
    d = t.checks.filter("server IS NOT NULL").groupBy("server", "processing_date").agg(F.round(F.sum("discount"), 2).alias("discount"))
    return windows.trailing_mean(d, ["server"], "processing_date", "discount").withColumn("trailing_mean", F.round("trailing_mean", 4))


@query("w_share", """
  SELECT menu_item, round(sum(net_price), 2) AS net, round(sum(net_price) / sum(sum(net_price)) OVER () * 100, 3) AS share_pct FROM v_items GROUP BY 1""")
def _(t):
    g = t.items.groupBy("menu_item").agg(F.round(F.sum("net_price"), 2).alias("net"))
    return windows.with_share(g, "net", digits=3)


# --- sorts, limits, sets ---

@query("s_topk", "SELECT menu_item, round(sum(net_price), 2) AS net FROM v_items GROUP BY 1 ORDER BY net DESC, menu_item LIMIT 10")
def _(t):
    return t.items.groupBy("menu_item").agg(F.round(F.sum("net_price"), 2).alias("net")).orderBy(F.desc("net"), "menu_item").limit(10)


@query("s_topk_per_group", """
  SELECT category, vendor_normalized, spend, CAST(rank AS INT) AS rank FROM (SELECT category, vendor_normalized, round(sum(abs_amount), 2) AS spend,
    row_number() OVER (PARTITION BY category ORDER BY round(sum(abs_amount), 2) DESC, vendor_normalized) AS rank FROM v_bank WHERE vendor_normalized IS NOT NULL GROUP BY 1, 2) WHERE rank <= 5""")
def _(t):
    g = t.bank.filter("vendor_normalized IS NOT NULL").groupBy("category", "vendor_normalized").agg(F.round(F.sum("abs_amount"), 2).alias("spend"))
    return windows.top_per_key(g, ["category"], [F.desc("spend"), F.asc("vendor_normalized")], 5)


@query("s_multi_key", """
  SELECT customer_id, count(*) AS visits, round(sum(total), 2) AS spend FROM v_checks GROUP BY 1 HAVING count(*) > 1 ORDER BY visits DESC, spend DESC, customer_id LIMIT 50""")
def _(t):
    g = t.checks.groupBy("customer_id").agg(F.count("*").alias("visits"), F.round(F.sum("total"), 2).alias("spend"))
    return g.filter("visits > 1").orderBy(F.desc("visits"), F.desc("spend"), "customer_id").limit(50)


@query("s_paginate", """
  SELECT transaction_date, description, amount, vendor_normalized, (SELECT count(*) FROM v_bank WHERE category = 'Uncategorized') AS total_rows FROM v_bank WHERE category = 'Uncategorized'
  ORDER BY amount DESC, transaction_date DESC, description, vendor_normalized LIMIT 50 OFFSET 100""")
def _(t):
    b = t.bank.filter("category = 'Uncategorized'").select("transaction_date", "description", "amount", "vendor_normalized")
    total = b.agg(F.count("*")).scalar()
    page = b.orderBy(F.desc("amount"), F.desc("transaction_date"), F.asc("description"), F.asc_nulls_last("vendor_normalized")).offset(100).limit(50)
    return page.withColumn("total_rows", total)


@query("s_rule_order", "SELECT DISTINCT description AS keyword, length(description) AS n FROM v_bank ORDER BY n DESC, keyword")
def _(t):
    k = t.bank.select(F.col("description").alias("keyword")).distinct().withColumn("n", F.length("keyword").cast("bigint"))
    return k.orderBy(F.desc("n"), "keyword")


@query("u_union_distinct", """
  SELECT employee AS name, 'cash' AS src, processing_date FROM v_cash UNION SELECT server, 'check', processing_date FROM v_checks
  UNION SELECT employee_name, 'labor', processing_date FROM v_labor""")
def _(t):
    a = t.cash_entries.select(F.col("employee").alias("name"), F.lit("cash").alias("src"), "processing_date")
    b = t.checks.select("server", F.lit("check"), "processing_date")
    c = t.labor.select("employee_name", F.lit("labor"), "processing_date")
    return a.union(b).union(c).distinct()


@query("u_distinct", "SELECT DISTINCT check_id, total, processing_date FROM v_checks")
def _(t):
    return t.checks.select("check_id", "total", "processing_date").dropDuplicates()


@query("u_key_union", """
  SELECT strftime(processing_date, '%Y-%m') AS month FROM v_orders UNION SELECT strftime(transaction_date, '%Y-%m') FROM v_bank UNION SELECT strftime(processing_date, '%Y-%m') FROM v_cash""")
def _(t):
    m = lambda df, c: df.select(dates.month_label(F.col(c)).alias("month")).distinct()
    return m(t.orders, "processing_date").union(m(t.bank, "transaction_date")).union(m(t.cash_entries, "processing_date")).distinct()
