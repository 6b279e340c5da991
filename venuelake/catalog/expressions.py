"""Filters, projections, scalar expressions and cleaning steps over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean, dates, predicates, text
from ..functions.numbers import pct_change, ratio_or_null
from ..operators import filters
from .registry import query

D0, D1 = "1996-01-01", "1999-12-31"


@query("f_date_between", """
  SELECT order_id, processing_date, amount FROM v_orders WHERE processing_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def _(t):
    return dates.between_dates(t.orders, "processing_date", D0, D1).select("order_id", "processing_date", "amount")


@query("f_not_voided", """
  SELECT coalesce(voided, '-') AS voided, count(*) FILTER (voided IS NULL OR voided = 'false') AS strict_rows,
    count(*) FILTER (voided IS NULL OR lower(voided) <> 'true') AS lenient_rows FROM v_orders GROUP BY 1""")
def _(t):
    v = F.col("voided")
    return t.orders.groupBy(F.coalesce(v, F.lit("-")).alias("voided")).agg(
        F.count_if(predicates.not_voided(v)).alias("strict_rows"),
        F.count_if(predicates.not_voided_lenient(v)).alias("lenient_rows"))


@query("f_valid_payment", """
  SELECT payment_id, status, amount FROM v_payments WHERE status IN ('CAPTURED', 'AUTHORIZED', 'CAPTURE_IN_PROGRESS')""")
def _(t):
    return t.payments.filter(predicates.valid_payment(F.col("status"))).select("payment_id", "status", "amount")


@query("f_nonblank", "SELECT order_id, server FROM v_orders WHERE server IS NOT NULL AND trim(server) <> ''")
def _(t):
    return t.orders.filter(predicates.nonblank(F.col("server"))).select("order_id", "server")


_WORDS = ["liquor", "payroll", "Security"]


@query("f_keyword_like", """
  SELECT transaction_date, description, amount, category FROM v_bank
  WHERE lower(category) LIKE '%liquor%' OR lower(category) LIKE '%payroll%' OR lower(category) LIKE '%security%'""")
def _(t):
    return t.bank.filter(text.contains_any(F.col("category"), _WORDS)).select("transaction_date", "description", "amount", "category")


@query("f_keyword_not_like", """
  SELECT transaction_date, description, amount, category FROM v_bank
  WHERE lower(category) NOT LIKE '%liquor%' AND lower(category) NOT LIKE '%payroll%' AND lower(category) NOT LIKE '%security%'""")
def _(t):
    return t.bank.filter(~text.contains_any(F.col("category"), _WORDS)).select("transaction_date", "description", "amount", "category")


@query("f_regex", """
  SELECT doc_id, n_chars FROM documents WHERE regexp_matches(text, '(?i)\\b(the|der|le)\\s+[a-z]+ing\\b')""")
def _(t):
    return t.raw("documents").filter(F.col("text").rlike(r"(?i)\b(the|der|le)\s+[a-z]+ing\b")).select("doc_id", "n_chars")


@query("f_item_log", """
  SELECT item_selection_id, check_id, menu_item, discount, tab_name FROM v_items
  WHERE discount > 0 OR menu_item IN ('BTL Gold 1942', 'Cristal Magnum')
     OR (starts_with(upper(menu_item), 'OWNER ') AND (lower(tab_name) LIKE '%owner_a%' OR lower(tab_name) LIKE '%owner_b%'))""")
def _(t):
    prices = t.rows([("BTL Gold 1942", 900.0), ("Cristal Magnum", 1500.0)], "menu_item string, retail double")
    return filters.item_log(t.items, prices, ["owner_a", "owner_b"]).select(
        "item_selection_id", "check_id", "menu_item", "discount", "tab_name")


@query("f_txn_search", """
  SELECT transaction_date, description, amount, category, category_source, vendor_normalized FROM v_bank
  WHERE category_source = 'auto' AND (upper(description) LIKE '%CHECK%' OR upper(coalesce(vendor_normalized, '')) LIKE '%CHECK%')
    AND transaction_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def _(t):
    return filters.search_transactions(t.bank, status="auto", text="check", start=D0, end=D1, sort="amount_desc").select(
        "transaction_date", "description", "amount", "category", "category_source", "vendor_normalized")


@query("f_optional_filters", """
  SELECT order_id, server, processing_date, total FROM v_orders WHERE server = 'srv_7' AND processing_date >= DATE '1996-01-01'
  ORDER BY processing_date DESC, order_id DESC LIMIT 500""")
def _(t):
    return filters.history(
        t.orders, equals={"server": "srv_7", "revenue_center": None}, date_col="processing_date", start=D0, end=None,
        order=[F.desc("processing_date"), F.desc("order_id")], limit=9999,
    ).select("order_id", "server", "processing_date", "total")


@query("p_month_label", "SELECT strftime(processing_date, '%Y-%m') AS month, count(*) AS n FROM v_orders GROUP BY 1")
def _(t):
    return t.orders.groupBy(dates.month_label(F.col("processing_date")).alias("month")).agg(F.count("*").alias("n"))


@query("p_week_start", "SELECT CAST(date_trunc('week', processing_date) AS DATE) AS week, count(*) AS n FROM v_orders GROUP BY 1")
def _(t):
    return t.orders.groupBy(dates.week_start(F.col("processing_date")).alias("week")).agg(F.count("*").alias("n"))


@query("p_dow", """
  SELECT dayname(processing_date) AS day_name, CAST(dayofweek(processing_date) + 1 AS INT) AS dow_num, count(*) AS n FROM v_orders GROUP BY 1, 2""")
def _(t):
    d = F.col("processing_date")
    return t.orders.groupBy(dates.dow_name(d).alias("day_name"), dates.dow_num(d).alias("dow_num")).agg(F.count("*").alias("n"))


@query("p_business_date", "SELECT event_id, CAST(ts - INTERVAL 4 HOUR AS DATE) AS business_date FROM events")
def _(t):
    return t.raw("events").select("event_id", dates.business_date(F.col("ts")).alias("business_date"))


@query("p_first_of_list", """
  SELECT coalesce(nullif(trim(split_part(dining_options, ',', 1)), ''), 'Unknown') AS dining_option, count(*) AS n FROM v_orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy(text.first_of_list(F.col("dining_options")).alias("dining_option")).agg(F.count("*").alias("n"))


@query("p_category_section", "SELECT split_part(category, '/', 1) AS section, count(*) AS n FROM v_bank GROUP BY 1")
def _(t):
    return t.bank.groupBy(text.category_section(F.col("category")).alias("section")).agg(F.count("*").alias("n"))


@query("p_card_key", "SELECT payment_id, card_digits || '-' || coalesce(card_type, '') AS card_key FROM v_payments")
def _(t):
    return t.payments.select("payment_id", text.card_key(F.col("card_digits"), F.col("card_type")).alias("card_key"))


@query("fn_string", """
  SELECT check_id, upper(tab_name) AS up, lower(tab_name) AS low, left(tab_name, 5) AS head, length(tab_name) AS len,
    split_part(tab_name, ' ', 2) AS second_word, starts_with(tab_name, 'Bday') AS is_bday, tab_name || '/' || reason AS joined FROM v_checks""")
def _(t):
    c = F.col("tab_name")
    return t.checks.select(
        "check_id", F.upper(c).alias("up"), F.lower(c).alias("low"), F.left(c, F.lit(5)).alias("head"),
        F.length(c).alias("len"), F.split_part(c, F.lit(" "), F.lit(2)).alias("second_word"),
        F.startswith(c, F.lit("Bday")).alias("is_bday"), F.concat(c, F.lit("/"), F.col("reason")).alias("joined"))


@query("fn_regex", """
  SELECT check_id, regexp_matches(lower(reason), '\\b(comp|open)\\b') AS has_word,
    regexp_extract(lower(tab_name), '^bday[ .-]*(?:f|sat)[ .-]+([a-z]+)', 1) AS party,
    regexp_extract(reason, '\\(([0-9.]+)%\\)', 1) AS pct_text FROM v_checks""")
def _(t):
    return t.checks.select(
        "check_id", F.lower("reason").rlike(text.whole_word(["comp", "open"])).alias("has_word"),
        F.regexp_extract(F.lower("tab_name"), r"^bday[ .-]*(?:f|sat)[ .-]+([a-z]+)", 1).alias("party"),
        F.regexp_extract("reason", r"\(([0-9.]+)%\)", 1).alias("pct_text"))


_NORM_SQL = """
  CASE WHEN regexp_extract(trim(description), '(?i)^zelle\\s+payment\\s+(?:to|from)\\s+(.+?)(?:\\s+for\\s+.*|\\s+conf#.*|[";]+.*)$', 1) <> ''
    THEN rtrim(trim(regexp_extract(trim(description), '(?i)^zelle\\s+payment\\s+(?:to|from)\\s+(.+?)(?:\\s+for\\s+.*|\\s+conf#.*|[";]+.*)$', 1)), '";')
    ELSE trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(description),
      '(?i)^ach\\s+(?:debit|credit|hold)\\s+', ''), '(?i)^purchase\\s+(?:authorized\\s+)?on\\s+\\d{2}/\\d{2}\\s+', ''),
      '(?i)^checkcard\\s+\\d{4}\\s+', ''), '\\s+ID:\\S*$', ''), '\\s+Conf#.*$', '')) END"""
_WIRE_SQL = """
  CASE WHEN upper(description) LIKE '%WIRE TYPE:%' THEN coalesce(nullif(trim(regexp_extract(description, 'BNF:([^/]+?)\\s*ID:', 1)), ''),
    nullif(trim(regexp_extract(description, 'ORIG:\\d*/([^/]+?)\\s*ID:', 1)), '')) END"""


@query("fn_normalize_description", f"SELECT description, {_NORM_SQL} AS normalized, count(*) AS n FROM v_bank GROUP BY 1, 2")
def _(t):
    d = F.col("description")
    return t.bank.groupBy(d, text.normalize_description(d).alias("normalized")).agg(F.count("*").alias("n"))


@query("fn_wire_party", f"SELECT description, {_WIRE_SQL} AS party, count(*) AS n FROM v_bank GROUP BY 1, 2")
def _(t):
    d = F.col("description")
    return t.bank.groupBy(d, text.wire_party(d).alias("party")).agg(F.count("*").alias("n"))


@query("fn_clean_phone", """
  SELECT check_id, CASE WHEN p IS NULL OR p IN ('', '5555555555', '15555555555') THEN ''
    WHEN length(t) = 10 THEN '+1' || t ELSE t END AS phone
  FROM (SELECT *, CASE WHEN length(p) = 11 AND starts_with(p, '1') THEN substr(p, 2) ELSE p END AS t
        FROM (SELECT check_id, trim(replace(phone, '.0', '')) AS p FROM v_checks))""")
def _(t):
    return t.checks.select("check_id", text.clean_phone(F.col("phone")).alias("phone"))


@query("fn_split_name", """
  SELECT check_id, split_part(customer, ' ', 1) AS first_name, split_part(customer, ' ', 2) AS last_name FROM v_checks""")
def _(t):
    c = F.col("customer")
    return t.checks.select("check_id", text.first_name(c).alias("first_name"), text.rest_of_name(c).alias("last_name"))


@query("fn_null_safe", """
  SELECT order_id, coalesce(server, 'none') AS server, nullif(trim(server), '') AS server_or_null, tip / nullif(amount, 0) AS tip_share,
    try_cast(dining_options AS BIGINT) AS bad_number, CASE WHEN gratuity > 0 THEN 'auto' ELSE 'none' END AS grat_kind FROM v_orders""")
def _(t):
    return t.orders.select(
        "order_id", F.coalesce("server", F.lit("none")).alias("server"), clean.blank_to_null(F.col("server")).alias("server_or_null"),
        ratio_or_null(F.col("tip"), F.col("amount")).alias("tip_share"),
        F.col("dining_options").try_cast("bigint").alias("bad_number"),
        F.when(F.col("gratuity") > 0, "auto").otherwise("none").alias("grat_kind"))


# Two-digit years are read as 20yy, hence the century shift in the SQL.
@query("fn_date_parse", """
  SELECT order_id, CAST(CASE WHEN year(processing_date) < 2000 THEN processing_date + INTERVAL 100 YEAR ELSE processing_date END AS DATE) AS d1,
    CASE WHEN order_id % 2 = 1 AND year(opened) < 2000 THEN opened + INTERVAL 100 YEAR ELSE opened END AS d2, CAST(extract(hour FROM opened) AS INT) AS clock_hour, NULL::TIMESTAMP AS bad FROM v_orders""")
def _(t):
    o = t.orders
    return o.select(
        "order_id", F.to_date(F.date_format("processing_date", "MM/dd/yy"), "MM/dd/yy").alias("d1"),
        dates.first_timestamp(F.when(F.col("order_id") % 2 == 0, F.date_format("opened", "yyyy-MM-dd HH:mm:ss"))
                              .otherwise(F.date_format("opened", "M/d/yy h:mm a")), ["yyyy-MM-dd HH:mm:ss", "M/d/yy h:mm a"]).alias("d2"),
        dates.clock_hour(F.date_format("opened", "h:mm a")).alias("clock_hour"),
        dates.first_timestamp(F.col("revenue_center"), ["yyyy-MM-dd"]).alias("bad"))


@query("fn_date_format", """
  SELECT order_id, strftime(opened, '%A') AS day_name, CAST(extract(hour FROM opened) AS INT) AS hour, CAST(date_trunc('week', opened) AS DATE) AS week,
    strftime(opened, '%Y-%m') AS month FROM v_orders""")
def _(t):
    o = F.col("opened")
    return t.orders.select("order_id", dates.dow_name(o).alias("day_name"), F.hour(o).alias("hour"),
                           dates.week_start(o).alias("week"), dates.month_label(o).alias("month"))


@query("fn_date_math", """
  SELECT ticket_id, CAST(processing_date + 7 AS DATE) AS next_week, CAST(processing_date - 28 AS DATE) AS four_weeks_ago,
    CAST(DATE '2001-12-31' - processing_date AS INT) AS age_days, CAST(date_diff('second', fired_ts, fulfilled_ts) AS BIGINT) AS secs FROM v_kitchen""")
def _(t):
    d = F.col("processing_date")
    return t.kitchen.select(
        "ticket_id", F.date_add(d, 7).alias("next_week"), F.date_sub(d, 28).alias("four_weeks_ago"),
        F.datediff(F.lit("2001-12-31").cast("date"), d).alias("age_days"),
        F.timestamp_diff("SECOND", F.col("fired_ts"), F.col("fulfilled_ts")).alias("secs"))


@query("fn_math", """
  SELECT order_id, round(amount / 7, 2) AS rounded, abs(amount - 200) AS gap, greatest(amount - 250, 0) AS above FROM v_orders""")
def _(t):
    a = F.col("amount")
    return t.orders.select("order_id", F.round(a / 7, 2).alias("rounded"), F.abs(a - 200).alias("gap"),
                           F.greatest(a - 250, F.lit(0.0)).alias("above"))


@query("fn_json", """
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, props LIKE '%"k": 1%' AS starts_1 FROM events""")
def _(t):
    return t.raw("events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
                                  F.contains("props", F.lit('"k": 1')).alias("starts_1"))


@query("fn_array", """
  SELECT reservation_id, CAST(trim(part) AS BIGINT) AS check_number FROM (SELECT reservation_id, unnest(string_split(check_numbers, ',')) AS part FROM v_reservations)
  WHERE regexp_full_match(trim(part), '[0-9]+')""")
def _(t):
    return t.reservations.select("reservation_id", F.explode(text.int_list(F.col("check_numbers"))).alias("check_number"))


@query("fn_prior_period", """
  SELECT order_id, CASE WHEN same_month THEN CAST(s - INTERVAL 1 MONTH AS DATE) ELSE CAST(s - INTERVAL 12 MONTH AS DATE) END AS prior_start,
    CASE WHEN same_month THEN CAST(e - INTERVAL 1 MONTH AS DATE) ELSE CAST(e - INTERVAL 12 MONTH AS DATE) END AS prior_end
  FROM (SELECT order_id, processing_date AS s, CAST(processing_date + 10 AS DATE) AS e,
          date_trunc('month', processing_date) = date_trunc('month', processing_date + 10) AS same_month FROM v_orders)""")
def _(t):
    s = F.col("processing_date")
    ps, pe = dates.prior_period(s, F.date_add(s, 10))
    return t.orders.select("order_id", ps.alias("prior_start"), pe.alias("prior_end"))


@query("fn_calendar_windows", """
  WITH w(label, s, e) AS (VALUES ('week', DATE '1998-06-01', DATE '1998-06-07'), ('prior_week', DATE '1998-05-25', DATE '1998-05-31'),
    ('d30', DATE '1998-05-11', DATE '1998-06-09'), ('1998-03', DATE '1998-03-01', DATE '1998-03-31'), ('1998-04', DATE '1998-04-01', DATE '1998-04-30'),
    ('1998-05', DATE '1998-05-01', DATE '1998-05-31'), ('pay', DATE '1998-05-25', DATE '1998-06-07'))
  SELECT label, count(*) AS orders, round(sum(amount), 2) AS net FROM v_orders JOIN w ON processing_date BETWEEN s AND e GROUP BY 1""")
def _(t):
    from datetime import date
    today = date(1998, 6, 10)
    periods = [("week", *dates.last_full_week(today)), ("prior_week", *dates.prior_full_week(today)),
               ("d30", *dates.trailing_days(today, 30)), *dates.trailing_months(today, 3),
               ("pay", *dates.pay_period(today, date(1998, 6, 7)))]
    return dates.by_period(t.orders, "processing_date", periods).groupBy("label").agg(
        F.count("*").alias("orders"), F.round(F.sum("amount"), 2).alias("net"))


@query("fn_pct_change", """
  SELECT order_id, CASE WHEN tax <> 0 THEN round((tip - tax) / abs(tax) * 100, 1) END AS change_pct FROM v_orders""")
def _(t):
    return t.orders.select("order_id", pct_change(F.col("tip"), F.col("tax")).alias("change_pct"))


@query("xf_rename_sanitize", """
  SELECT o_orderkey AS order_id, o_orderstatus AS _1_status, o_totalprice AS total__usd, o_orderpriority AS priority_level FROM orders""")
def _(t):
    raw = t.raw("orders").select(
        F.col("o_orderkey").alias("Order Id"), F.col("o_orderstatus").alias("1 Status"),
        F.col("o_totalprice").alias("Total ($) USD"), F.col("o_orderpriority").alias("Priority-Level"))
    return clean.rename_columns(raw, {"Order Id": "order_id"})


@query("xf_multi_format_ts", """
  SELECT order_id, CASE order_id % 4 WHEN 3 THEN 'later' WHEN 2 THEN strftime(processing_date, '%Y-%m-%d') || ' 00:00:00'
    WHEN 0 THEN strftime(CASE WHEN year(opened) < 2000 THEN opened + INTERVAL 100 YEAR ELSE opened END, '%Y-%m-%d %H:%M:%S')
    ELSE strftime(opened, '%Y-%m-%d %H:%M:%S') END AS opened_text FROM v_orders""")
def _(t):
    raw = F.expr("CASE order_id % 4 WHEN 0 THEN date_format(opened, 'M/d/yy h:mm a') WHEN 1 THEN date_format(opened, 'M/d/yyyy h:mm a') "
                 "WHEN 2 THEN date_format(processing_date, 'yyyy-MM-dd') ELSE 'later' END")
    return t.orders.select("order_id", clean.normalized_datetime_text(raw).alias("opened_text"))


@query("xf_type_by_name", """
  SELECT CAST(order_id AS VARCHAR) AS order_id, CASE WHEN order_id % 3 = 0 THEN NULL ELSE amount END AS amount,
    CASE WHEN voided = 'true' THEN TRUE WHEN voided = 'false' THEN FALSE END AS voided, nullif(trim(server), '') AS server FROM v_orders""")
def _(t):
    raw = t.orders.select(
        "order_id", F.when(F.col("order_id") % 3 == 0, "n/a").otherwise(F.col("amount").cast("string")).alias("amount"), "voided", "server")
    return clean.type_by_name(raw, numeric={"amount"}, flags={"voided"})


@query("xf_bool_norm", """
  SELECT order_id, CASE order_id % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE WHEN 3 THEN FALSE END AS flag FROM v_orders""")
def _(t):
    w = F.expr("element_at(array(' Yes', '0', 'y', 'FALSE ', 'maybe'), CAST(order_id % 5 AS INT) + 1)")
    return t.orders.select("order_id", clean.to_flag(w).alias("flag"))


@query("xf_calc_total", """
  SELECT order_id, CASE WHEN voided IS NULL THEN NULL ELSE amount + tax + tip + gratuity END AS total FROM v_orders""")
def _(t):
    raw = t.orders.withColumn("tip", F.when(F.col("voided").isNotNull(), F.col("tip")))
    return clean.with_total(raw).select("order_id", "total")


@query("xf_add_load_date", """
  SELECT order_id, processing_date AS load_date FROM v_orders""")
def _(t):
    path = F.concat(F.lit("/landing/"), F.date_format("processing_date", "yyyyMMdd"), F.lit("/OrderDetails.csv"))
    return t.orders.select("order_id", clean.load_date_from_path(path).alias("load_date"))
