"""Sources, cleaning of whole files, merges and run logs with their SQL.

Raw files are first written by Spark from the test tables into the shared folder and then
read through the source under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge
from ..session import shared_dir
from ..sources import feeds, files, sinks, status
from .registry import query


# --- file sources ---

@query("src_daily_csv", """
  SELECT CAST(order_id AS DOUBLE) AS order_id, server, CAST(guest_count AS DOUBLE) AS guest_count, table_loc, opened, amount, tax, tip, gratuity, voided, processing_date, amount + tax + tip + gratuity AS calculated_total FROM (
    SELECT order_id, nullif(trim(server), '') AS server, guest_count, revenue_center AS table_loc, strftime(opened, '%Y-%m-%d %H:%M:%S') AS opened, amount, tax, CASE WHEN order_id % 10 = 0 THEN NULL ELSE tip END AS tip, gratuity, CASE voided WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS voided,
      CAST(date_trunc('year', processing_date) AS DATE) AS processing_date FROM v_orders)""")
def _(t):
    raw = t.orders.select(
        F.col("order_id").alias("Order Id"), F.col("server").alias("Server"), F.col("guest_count").alias("# of Guests"), F.col("revenue_center").alias("Table"), F.date_format("opened", "M/d/yyyy h:mm a").alias("Opened"),
        F.col("amount").alias("Amount"), F.col("tax").alias("Tax"), F.when(F.col("order_id") % 10 == 0, "n/a").otherwise(F.col("tip").cast("string")).alias("Tip"), F.col("gratuity").alias("Gratuity"), F.col("voided").alias("Voided"),
        F.date_format(F.trunc("processing_date", "year"), "yyyyMMdd").alias("load"))
    path = shared_dir(t.spark, "daily")
    raw.hint("rebalance", "load").write.partitionBy("load").option("header", True).csv(path)
    return files.read_daily_csv(t.spark, f"{path}/load=*/", ("opened",), ("voided",))


# Header spellings of one number and one amount per kind of daily file.
_DAILY = {
    "OrderDetails": ("orders", {"Order Id": "order_id", "Amount": "amount", "# of Guests": "guest_count"}),
    "CheckDetails": ("checks", {"Check Id": "check_id", "Total": "total", "Discount": "discount"}),
    "PaymentDetails": ("payments", {"Payment Id": "payment_id", "Amount": "amount", "Type": "payment_type"}),
    "ItemSelectionDetails": ("items", {"Item Selection Id": "item_selection_id", "Gross Price": "gross_price", "Void?": "voided"}),
    "AllItemsReport": ("items", {"Item Id": "item_selection_id", "Gross Amount": "gross_price", "Qty Sold": "qty"}),
    "CashEntries": ("cash_entries", {"Entry Id": "entry_id", "Amount": "amount", "Action": "action"}),
    "KitchenTimings": ("kitchen", {"ID": "ticket_id", "Station": "station", "Fulfilled By": "fulfilled_by"}),
}
_DAILY_SUM = {"OrderDetails": "amount", "CheckDetails": "total", "PaymentDetails": "amount", "ItemSelectionDetails": "gross_price", "AllItemsReport": "gross_amount", "CashEntries": "amount", "KitchenTimings": "id"}


def _land_daily(t):
    """All kinds of daily files by year; orders of odd years have another column order and a new column; one kind is unknown."""
    root = shared_dir(t.spark, "daily-files")
    for kind, (name, columns) in _DAILY.items():
        year = F.year("processing_date")
        df = getattr(t, name).select(*[F.col(c).alias(h) for h, c in columns.items()], F.date_format(F.trunc("processing_date", "year"), "yyyyMMdd").alias("load"), (year % 2 == 1).alias("odd"))
        odd = df.filter("odd").drop("odd")
        if kind == "OrderDetails":
            odd = odd.select(F.lit("web").alias("Channel"), *reversed(odd.columns))
            df = df.filter("not odd")
            odd.hint("rebalance", "load").write.mode("append").partitionBy("load").option("header", True).csv(f"{root}/{kind}")
        df.drop("odd").hint("rebalance", "load").write.mode("append").partitionBy("load").option("header", True).csv(f"{root}/{kind}")
    t.orders.select("order_id").limit(0).write.option("header", True).csv(f"{root}/SomethingElse")
    return root


@query("src_daily_files", " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, count(*) AS rows, count(DISTINCT date_trunc('year', processing_date)) AS days, round(sum({list(columns.values())[1] if kind != 'KitchenTimings' else 'ticket_id'}), 2) AS total FROM v_{'cash' if name == 'cash_entries' else name}" for kind, (name, columns) in _DAILY.items()))
def _(t):
    frames = files.read_daily_files(t.spark, _land_daily(t))
    out = None
    for kind, df in frames.items():
        part = df.agg(F.lit(kind).alias("kind"), F.count("*").alias("rows"), F.countDistinct("processing_date").alias("days"), F.round(F.sum(_DAILY_SUM[kind]), 2).alias("total"))
        out = part if out is None else out.unionByName(part)
    return out


@query("src_daily_files_drift", "SELECT 'OrderDetails' AS kind, count(*) FILTER (year(processing_date) % 2 = 1) AS with_channel, count(*) FILTER (year(processing_date) % 2 = 0) AS without FROM v_orders")
def _(t):
    """A column that only some days have: the load goes on, and the rows without it are counted."""
    orders = files.read_daily_files(t.spark, _land_daily(t))["OrderDetails"]
    return orders.agg(F.lit("OrderDetails").alias("kind"), F.count("channel").alias("with_channel"), F.count_if(F.col("channel").isNull()).alias("without"))


def _land_statements(t):
    """One statement file per quarter of bank lines: preamble, header, quoted text, amounts with commas."""
    b = t.bank.withColumn("file", F.date_format(F.trunc("transaction_date", "quarter"), "yyyyMM"))
    line = F.concat(F.date_format("transaction_date", "M/d/yyyy"), F.lit(',"'), "description", F.lit('","'), F.format_number("amount", 2), F.lit('",'))
    body = b.select("file", F.lit(9).alias("pos"), line.alias("value"))
    top = ["\ufeffAccount summary,,", "Total credits,1.00", "", "Date,Description,Amount,Running Bal."]
    head = b.select("file").distinct().select("file", F.posexplode(F.array(*[F.lit(x) for x in top])).alias("pos", "value"))
    path = shared_dir(t.spark, "statements")
    head.unionByName(body).repartition("file").sortWithinPartitions("file", "pos").drop("pos").write.partitionBy("file").text(path)
    return path


@query("src_bank_csv", """
  SELECT transaction_date, description, amount, NULL::DOUBLE AS running_balance, transaction_type, abs_amount FROM v_bank""")
def _(t):
    return files.read_bank_csv(t.spark, f"{_land_statements(t)}/file=*/").drop("source_file")


@query("src_check_register", """
  SELECT CAST(check_id AS VARCHAR) AS check_number, customer AS payee, total AS amount, reason AS memo, nullif(tab_name, '') AS category FROM v_checks""")
def _(t):
    """Two kinds of registers in one folder, with other spellings and another column order."""
    path = shared_dir(t.spark, "register")
    number, amount = F.concat(F.lit("No. "), "check_id"), F.concat(F.lit("$"), F.format_number("total", 2))
    even, odd = t.checks.filter("check_id % 2 = 0"), t.checks.filter("check_id % 2 = 1")
    even.select(number.alias("Chk #"), F.col("customer").alias("Pay To"), amount.alias("Amt"), F.col("reason").alias("Notes"), F.col("tab_name").alias("Cat")).write.option("header", True).csv(f"{path}/a")
    odd.select(F.lit("x").alias("Extra"), F.col("tab_name").alias("Category"), F.col("reason").alias("Memo"), F.col("customer").alias("Vendor"), amount.alias("Total"), number.alias("Check No")).write.option("header", True).csv(f"{path}/b")
    return files.read_check_register(t.spark, path)


def _land_json(df, purpose):
    path = shared_dir(df.sparkSession, purpose)
    df.write.json(path)
    return path


@query("src_labor_entries", """
  SELECT CAST(guid AS VARCHAR) AS guid, employee_name AS employee_guid, CASE WHEN employee_name = 'srv_0' THEN '' ELSE 'Name ' || employee_name END AS employee_name, job_title AS job_guid, CASE WHEN job_title = '' THEN '' ELSE 'Job ' || job_title END AS job_title,
    processing_date + INTERVAL 17 HOUR AS clock_in, NULL::TIMESTAMP AS clock_out, regular_hours, 0.0::DOUBLE AS overtime_hours, 0.0::DOUBLE AS hourly_wage, processing_date FROM v_labor""")
def _(t):
    l = t.labor
    raw = l.select(
        F.col("guid").cast("string").alias("guid"), F.struct(F.col("employee_name").alias("guid")).alias("employeeReference"), F.struct(F.col("job_title").alias("guid")).alias("jobReference"),
        F.concat(F.date_format("processing_date", "yyyy-MM-dd"), F.lit("T18:00:00.000+0100")).alias("inDate"), F.lit("later").alias("outDate"), F.date_format("processing_date", "yyyyMMdd").alias("businessDate"),
        F.col("regular_hours").alias("regularHours"), F.lit("n/a").alias("overtimeHours"))
    emp = l.select(F.col("employee_name").alias("guid")).distinct().filter("guid <> 'srv_0'").select("guid", F.concat(F.lit("Name "), "guid").alias("name"))
    jobs = l.select(F.col("job_title").alias("guid")).distinct().filter("guid <> ''").select("guid", F.concat(F.lit("Job "), "guid").alias("title"))
    out = feeds.labor_entries(feeds.read_json(t.spark, _land_json(raw, "labor"), feeds.LABOR_SCHEMA), emp, jobs)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("clock_in", "clock_out")})


@query("src_bank_feed_a", """
  SELECT transaction_date, description, amount, transaction_type, abs_amount, CASE WHEN category = 'Uncategorized' THEN NULL ELSE category END AS category, CASE WHEN category = 'Uncategorized' THEN 'uncategorized' ELSE 'feed_a' END AS category_source,
    coalesce(vendor_normalized, description) AS vendor_normalized, 'feed_a' AS source_file FROM (SELECT * REPLACE (CASE WHEN amount > 0 THEN 'credit' ELSE 'debit' END AS transaction_type) FROM v_bank) WHERE source_file <> 'file_7'""")
def _(t):
    b = t.bank
    raw = b.select(
        F.when(F.col("source_file") != "file_7", F.date_format("transaction_date", "yyyy-MM-dd")).alias("date"), (-F.col("amount")).alias("amount"), F.col("description").alias("name"), F.coalesce("vendor_normalized", F.lit("")).alias("merchant_name"),
        F.col("description").alias("original_description"), F.struct(F.lit("TOP").alias("primary"), F.col("category").alias("detailed")).alias("pfc"))
    pfc = F.when(F.col("pfc.detailed") != "Uncategorized", F.struct(F.lit("TOP").alias("primary"), F.col("pfc.detailed").alias("detailed")))
    return feeds.bank_feed_a(feeds.read_json(t.spark, _land_json(raw.withColumn("personal_finance_category", pfc).drop("pfc"), "feed-a"), feeds.FEED_A_SCHEMA))


@query("src_bank_feed_b", """
  SELECT transaction_date, description, amount, transaction_type, abs_amount, 'feed_b' AS source_file FROM v_bank WHERE category_source <> 'manual' AND transaction_date >= DATE '1996-01-01'""")
def _(t):
    raw = t.bank.select(F.date_format("transaction_date", "yyyy-MM-dd").alias("date"), F.concat("description", F.lit(" \nsecond line")).alias("description"), F.col("amount").cast("string").alias("amount"),
                        F.when(F.col("category_source") == "manual", "pending").otherwise("posted").alias("status"))
    return feeds.bank_feed_b(feeds.read_json(t.spark, _land_json(raw, "feed-b"), feeds.FEED_B_SCHEMA), "1996-01-01")


@query("src_reservations", """
  SELECT CAST(reservation_id AS VARCHAR) AS id, date, first_name, CASE WHEN max_guests = 12 THEN NULL ELSE max_guests END AS max_guests, status_simple, nullif(check_numbers, '~') AS check_numbers, total_payment, notes, updated, tags_json, max_guests > 6 AS is_vip FROM v_reservations WHERE status_simple <> 'Canceled'""")
def _(t):
    r = t.reservations
    raw = r.select(F.to_json(F.struct(
        F.when(F.col("status_simple") != "Canceled", F.col("reservation_id").cast("string")).alias("id"), F.date_format("date", "yyyy-MM-dd").alias("date"), "first_name", F.when(F.col("max_guests") == 12, "many").otherwise(F.col("max_guests").cast("string")).alias("max_guests"), "status_simple", "check_numbers",
        "total_payment", "notes", F.date_format("updated", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated"), F.from_json("tags_json", F.lit("array<struct<name:string>>")).alias("tags"), (F.col("max_guests") > 6).alias("is_vip"),
        F.array().cast("array<string>").alias("upgrades"))).alias("value"))
    path = shared_dir(t.spark, "reservations")
    raw.write.text(path)
    out = feeds.read_reservations(t.spark, path)
    return out.select("id", "date", "first_name", "max_guests", "status_simple", "check_numbers", "total_payment", "notes", F.col("updated").cast("timestamp_ntz").alias("updated"), "tags_json", "is_vip")


# --- drift, run log, status ---

@query("chk_schema_drift", """
  SELECT 'new' AS change, 'channel' AS column, count(revenue_center) AS filled FROM v_orders UNION ALL SELECT 'removed', 'dining_options', count(dining_options) FROM v_orders""")
def _(t):
    return status.schema_drift(t.orders.drop("dining_options").withColumn("channel", F.col("revenue_center")), t.orders)


@query("run_summary", """
  WITH f AS (SELECT source_file AS file, count(*) FILTER (amount <> 0 AND vendor_normalized IS NOT NULL) AS rows, count(*) FILTER (amount = 0 OR vendor_normalized IS NULL) AS errors FROM v_bank GROUP BY 1),
  g AS (SELECT *, CASE WHEN rows > 0 AND errors = 0 THEN 'success' WHEN rows > 0 THEN 'partial' WHEN errors > 0 THEN 'error' ELSE 'skipped' END AS status FROM f)
  SELECT file, rows, errors, status FROM g UNION ALL SELECT '(run)', CAST(sum(rows) AS BIGINT), CAST(sum(errors) AS BIGINT), CASE WHEN count(*) FILTER (status IN ('error', 'partial')) = 0 THEN 'success' WHEN count(*) FILTER (status = 'success') > 0 THEN 'partial_success' ELSE 'failed' END FROM g""")
def _(t):
    """The seven files of a run, counted while their good rows are written."""
    b = t.bank.withColumn("file", F.col("source_file"))
    ok = (F.col("amount") != 0) & F.col("vendor_normalized").isNotNull()
    return sinks.load_observed(b, ok, shared_dir(t.spark, "loaded"), [f"file_{i}" for i in range(1, 8)])


_STATUS = """SELECT 'orders' AS "table", count(*) AS rows, max(processing_date) AS latest FROM v_orders UNION ALL SELECT 'bank', count(*), max(transaction_date) FROM v_bank UNION ALL SELECT 'cash', count(*), max(processing_date) FROM v_cash"""


def _status(t):
    return status.table_status({"orders": t.orders, "bank": t.bank, "cash": t.cash_entries}, {"orders": "processing_date", "bank": "transaction_date", "cash": "processing_date"})


@query("tbl_status", _STATUS)
def _(t):
    return _status(t)


@query("tbl_freshness", f"""
  SELECT "table", latest, CAST(DATE '2024-02-01' - latest AS INT) AS age_days, DATE '2024-02-01' - latest > CASE "table" WHEN 'cash' THEN 2 WHEN 'bank' THEN 9000 ELSE 3 END AS stale FROM ({_STATUS})""")
def _(t):
    return status.freshness(_status(t), "2024-02-01", {"cash": 2, "bank": 9000})


# --- sinks and merges ---

def merge_sql(t, s, keys, cols, order, merged=None, when="TRUE"):
    """Independent SQL of an upsert: matched target rows, untouched target rows, new rows."""
    merged = merged or {}
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    pick = ", ".join(f"CASE WHEN coalesce({when}, FALSE) THEN {merged.get(c, 's.' + c)} ELSE t.{c} END AS {c}" for c in cols)
    return f"""WITH t AS ({t}), s AS (SELECT * FROM ({s}) QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1)
      SELECT {pick} FROM t JOIN s ON {on} UNION ALL SELECT {', '.join('t.' + c for c in cols)} FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {on}) UNION ALL SELECT {', '.join('s.' + c for c in cols)} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {on})"""


@query("snk_replace_day", """
  WITH o AS (SELECT order_id, server, total, CAST(date_trunc('month', processing_date) AS DATE) AS processing_date FROM v_orders)
  SELECT * FROM o WHERE processing_date < DATE '2000-01-01' UNION ALL SELECT order_id, 'reloaded', total, processing_date FROM o WHERE processing_date >= DATE '2000-01-01'""")
def _(t):
    """Monthly folders loaded once, then the folders from 2000 on loaded again."""
    o = t.orders.select("order_id", "server", "total", F.trunc("processing_date", "month").alias("processing_date"))
    return sinks.replace_day_table(o, o.filter("processing_date >= DATE '2000-01-01'").withColumn("server", F.lit("reloaded")))


@query("snk_replace_day_plan", """
  WITH o AS (SELECT order_id, server, total, processing_date FROM v_orders), s AS (SELECT order_id, 'reloaded' AS server, total, processing_date FROM o WHERE server = 'srv_7')
  SELECT * FROM o WHERE processing_date NOT IN (SELECT processing_date FROM s) UNION ALL SELECT * FROM s""")
def _(t):
    o = t.orders.select("order_id", "server", "total", "processing_date")
    return merge.replace_days(o, o.filter("server = 'srv_7'").withColumn("server", F.lit("reloaded")))


@query("snk_insert_if_absent", """
  WITH l AS (SELECT guid, processing_date, employee_name FROM v_labor), t AS (SELECT * FROM l WHERE processing_date < DATE '2000-01-01' OR employee_name = 'srv_3'), s AS (SELECT * FROM l WHERE processing_date >= DATE '1999-07-01')
  SELECT * FROM t UNION ALL SELECT * FROM s WHERE processing_date NOT IN (SELECT processing_date FROM t)""")
def _(t):
    l = t.labor.select("guid", "processing_date", "employee_name")
    return merge.insert_if_absent(l.filter("processing_date < DATE '2000-01-01' OR employee_name = 'srv_3'"), l.filter("processing_date >= DATE '1999-07-01'"))


@query("snk_upsert_keys", merge_sql("SELECT order_id, server, total FROM v_orders WHERE voided IS NOT NULL", "SELECT order_id, 'new' AS server, -total AS total FROM v_orders WHERE tip > 20", ["order_id"], ["order_id", "server", "total"], "total"))
def _(t):
    """A table stored by month; only the months of the incoming orders are read and replaced."""
    o = t.orders.withColumn("month", F.trunc("processing_date", "month"))
    inc = o.filter("tip > 20").select("order_id", F.lit("new").alias("server"), (-F.col("total")).alias("total"), "month")
    return _merged(t, o.filter("voided IS NOT NULL").select(*inc.columns), inc, "month", lambda old, new: merge.upsert(old, new, ["order_id"], [F.asc("total")])).drop("month")


def _merged(t, target, incoming, part, apply, moving=None):
    """The stored table after a merge that touches only some of its partitions."""
    path = shared_dir(t.spark, "table")
    sinks.write_days(target, path, part)
    sinks.merge_partitions(t.spark, path, incoming.select(*target.columns), part, apply, moving)
    return sinks.read_days(t.spark, path, target, part)


_REG_T = "SELECT CAST(check_id AS VARCHAR) AS check_number, customer AS payee, reason AS category, total AS amount FROM v_checks WHERE discount > 0"
_REG_S = "SELECT CAST(check_id AS VARCHAR) AS check_number, server AS payee, CASE WHEN voided IS NULL THEN '' ELSE sales_category END AS category, gross_price AS amount, processing_date, item_selection_id FROM v_items"


def _registers(t):
    target = t.checks.filter("discount > 0").select(F.col("check_id").cast("string").alias("check_number"), F.col("customer").alias("payee"), F.col("reason").alias("category"), F.col("total").alias("amount"))
    inc = t.items.select(F.col("check_id").cast("string").alias("check_number"), F.col("server").alias("payee"), F.when(F.col("voided").isNull(), "").otherwise(F.col("sales_category")).alias("category"), F.col("gross_price").alias("amount"), "processing_date", "item_selection_id")
    return target, inc, [F.desc("processing_date"), F.desc("item_selection_id"), F.desc("amount"), F.asc("payee")]


_REG_O, _REG_C = "processing_date DESC, item_selection_id DESC, amount DESC, payee", ["check_number", "payee", "category", "amount"]


@query("snk_merge_register_full", merge_sql(_REG_T, _REG_S, ["check_number"], _REG_C, _REG_O))
def _(t):
    return merge.merge_register(*_registers(t))


@query("snk_merge_register_keep", merge_sql(_REG_T, _REG_S, ["check_number"], _REG_C, _REG_O, {"category": "coalesce(nullif(s.category, ''), t.category)"}))
def _(t):
    return merge.merge_register(*_registers(t), keep_category=True)


_BC = ["transaction_date", "description", "amount", "transaction_type", "abs_amount", "category", "category_source", "vendor_normalized", "source_file"]
_KEY = "CAST(round(amount, 2) AS DECIMAL(18, 2)) AS amount_key"
_BANK_T = f"SELECT {', '.join(_BC)}, {_KEY} FROM v_bank WHERE source_file <> 'file_2'"
_BANK_S = f"SELECT transaction_date, description, amount, transaction_type, abs_amount, 'New/' || category AS category, 'auto' AS category_source, 'v2 ' || vendor_normalized AS vendor_normalized, 'upload' AS source_file, {_KEY} FROM v_bank WHERE source_file IN ('file_1', 'file_2', 'file_3')"
_BO = "category, vendor_normalized"
_NM = "coalesce(t.category_source, '') <> 'manual'"


def _bank_pair(t):
    b = t.bank.select(*_BC)
    inc = b.filter("source_file IN ('file_1', 'file_2', 'file_3')").withColumns({"category": F.concat(F.lit("New/"), "category"), "category_source": F.lit("auto"), "vendor_normalized": F.concat(F.lit("v2 "), "vendor_normalized"), "source_file": F.lit("upload")})
    return b.filter("source_file <> 'file_2'"), inc, [F.asc("category"), F.asc_nulls_last("vendor_normalized")]


_BK = ["transaction_date", "description", "amount_key"]
_man = lambda c: f"CASE WHEN t.category_source = 'manual' THEN t.{c} ELSE s.{c} END"


@query("snk_merge_bank_csv", merge_sql(_BANK_T, _BANK_S, _BK, _BC, _BO, {c: _man(c) for c in ("category", "category_source", "vendor_normalized")}))
def _(t):
    return merge.merge_bank_statement(*_bank_pair(t))


@query("snk_merge_bank_csv_months", merge_sql(_BANK_T, _BANK_S, _BK, _BC, _BO, {c: _man(c) for c in ("category", "category_source", "vendor_normalized")}))
def _(t):
    """The same merge on a table stored by month."""
    target, inc, order = _bank_pair(t)
    by_month = lambda df: df.withColumn("month", F.trunc("transaction_date", "month"))
    return _merged(t, by_month(target), by_month(inc), "month", lambda old, new: merge.merge_bank_statement(old, new, order)).drop("month")


@query("snk_merge_bank_feed_b", merge_sql(_BANK_T, _BANK_S, _BK, _BC, _BO, {c: f"t.{c}" for c in ("transaction_date", "description", "amount", "transaction_type", "abs_amount")}, "t.category_source <> 'manual'"))
def _(t):
    return merge.merge_bank_posted(*_bank_pair(t))


@query("snk_merge_bank_feed_a", merge_sql(_BANK_T.replace("category, category_source", "CASE WHEN category = 'Uncategorized' THEN NULL ELSE category END AS category, category_source"), _BANK_S, _BK, _BC, _BO,
       {**{c: f"t.{c}" for c in _BC}, "category": "coalesce(t.category, s.category)", "vendor_normalized": "coalesce(t.vendor_normalized, s.vendor_normalized)", "category_source": "coalesce(nullif(t.category_source, ''), s.category_source)", "source_file": "s.source_file"}, _NM))
def _(t):
    target, inc, order = _bank_pair(t)
    return merge.merge_bank_fill(target.withColumn("category", F.when(F.col("category") != "Uncategorized", F.col("category"))), inc, order)


_TWIN = f"SELECT * FROM (SELECT {', '.join(_BC)} FROM v_bank UNION ALL SELECT transaction_date, 'clean ' || description, amount, transaction_type, abs_amount, category, 'feed_a', vendor_normalized, 'feed' FROM v_bank WHERE source_file = 'file_4')"


@query("snk_cross_source_dedup", f"""
  WITH b AS ({_TWIN}), f AS (SELECT *, CAST(round(amount, 2) AS DECIMAL(18, 2)) AS k, category_source = 'feed_a' AS fed FROM b),
  c AS (SELECT transaction_date, vendor_normalized, k, count(*) FILTER (fed) AS nf, count(*) FILTER (NOT fed) AS no FROM f WHERE vendor_normalized IS NOT NULL GROUP BY 1, 2, 3)
  SELECT {', '.join('f.' + c for c in _BC)} FROM f LEFT JOIN c ON c.transaction_date = f.transaction_date AND c.vendor_normalized = f.vendor_normalized AND c.k = f.k WHERE fed OR NOT coalesce(nf > 0 AND no = 1, FALSE)""")
def _(t):
    b = t.bank.select(*_BC)
    fed = b.filter("source_file = 'file_4'").withColumns({"description": F.concat(F.lit("clean "), "description"), "category_source": F.lit("feed_a"), "source_file": F.lit("feed")})
    return merge.drop_cross_source_twins(b.unionByName(fed), F.col("category_source") == "feed_a")


_RES = ["reservation_id", "status_simple", "updated"]


@query("snk_merge_reservations", merge_sql("SELECT reservation_id, status_simple, updated FROM v_reservations WHERE status_simple <> 'Seated'", "SELECT order_id AS reservation_id, 'Changed' AS status_simple, order_ts AS updated FROM v_items", ["reservation_id"], _RES, "updated DESC, status_simple", when="s.updated >= t.updated"))
def _(t):
    r = t.reservations.select(*_RES)
    inc = t.items.select(F.col("order_id").alias("reservation_id"), F.lit("Changed").alias("status_simple"), F.col("order_ts").alias("updated"))
    return merge.merge_newest(r.filter("status_simple <> 'Seated'"), inc, "reservation_id", "updated", [F.asc("status_simple")])


@query("snk_merge_reservations_months", merge_sql("SELECT reservation_id, status_simple, updated FROM v_reservations WHERE status_simple <> 'Seated'", "SELECT order_id AS reservation_id, 'Changed' AS status_simple, order_ts AS updated FROM v_items WHERE order_id % 50 = 0", ["reservation_id"], _RES, "updated DESC, status_simple", when="s.updated >= t.updated"))
def _(t):
    """Stored by month of the version: a newer version moves a reservation to another month."""
    by_month = lambda df: df.withColumn("month", F.trunc("updated", "month"))
    inc = t.items.filter("order_id % 50 = 0").select(F.col("order_id").alias("reservation_id"), F.lit("Changed").alias("status_simple"), F.col("order_ts").alias("updated"))
    apply = lambda old, new: merge.merge_newest(old, new, "reservation_id", "updated", [F.asc("status_simple")])
    return _merged(t, by_month(t.reservations.select(*_RES).filter("status_simple <> 'Seated'")), by_month(inc), "month", apply, ["reservation_id"]).drop("month")


_RULE_T = "SELECT description AS keyword, min(category) AS category, min(vendor_normalized) AS vendor_normalized FROM v_bank WHERE description NOT LIKE 'Check%' GROUP BY 1"
_RULE_S = "SELECT upper(description) AS keyword, max(category) AS category, 'edited' AS vendor_normalized FROM v_bank WHERE description LIKE 'C%' OR description LIKE 'T%' GROUP BY 1"


def _rule_tables(t):
    target = t.bank.filter("description NOT LIKE 'Check%'").groupBy(F.col("description").alias("keyword")).agg(F.min("category").alias("category"), F.min("vendor_normalized").alias("vendor_normalized"))
    inc = t.bank.filter("description LIKE 'C%' OR description LIKE 'T%'").groupBy(F.upper("description").alias("keyword")).agg(F.max("category").alias("category"), F.lit("edited").alias("vendor_normalized"))
    return target, inc


@query("snk_rule_upsert", f"""
  WITH t AS ({_RULE_T}), s AS ({_RULE_S}) SELECT s.* FROM s UNION ALL SELECT t.* FROM t WHERE upper(t.keyword) NOT IN (SELECT upper(keyword) FROM s)""")
def _(t):
    target, inc = _rule_tables(t)
    return merge.upsert_rules(target, inc, [F.asc("category")])


@query("snk_rule_delete", f"WITH t AS ({_RULE_T}), s AS ({_RULE_S}) SELECT t.* FROM t WHERE upper(t.keyword) NOT IN (SELECT upper(keyword) FROM s)")
def _(t):
    target, inc = _rule_tables(t)
    return merge.delete_rules(target, inc.select(F.lower("keyword").alias("keyword")))


@query("snk_rule_seed", f"WITH s AS ({_RULE_S}) SELECT * FROM s")
def _(t):
    """Defaults go into an empty rule table; a filled one is left as it is."""
    target, inc = _rule_tables(t)
    seeded = merge.seed_rules(target.filter("keyword IS NULL"), inc)
    return merge.seed_rules(seeded, target)


_ED = "SELECT DISTINCT transaction_date, description, CAST(round(amount, 2) AS DECIMAL(18, 2)) AS k FROM v_bank WHERE source_file = 'file_7'"


def _edits(t):
    return t.bank.filter("source_file = 'file_7'").select("transaction_date", "description", "amount", F.lit("Edited/By Hand").alias("category"))


_HIT = "EXISTS (SELECT 1 FROM e WHERE e.transaction_date = b.transaction_date AND e.description = b.description AND e.k = CAST(round(b.amount, 2) AS DECIMAL(18, 2)))"


@query("snk_bulk_recategorize", f"""
  WITH e AS ({_ED}) SELECT transaction_date, description, amount, CASE WHEN hit THEN 'Edited/By Hand' ELSE category END AS category, CASE WHEN hit THEN 'manual' ELSE category_source END AS category_source, vendor_normalized FROM (SELECT b.*, {_HIT} AS hit FROM v_bank b)""")
def _(t):
    return merge.recategorize(t.bank, _edits(t)).select("transaction_date", "description", "amount", "category", "category_source", "vendor_normalized")


@query("snk_bulk_recategorize_audit", f"WITH e AS ({_ED}) SELECT transaction_date, description, amount, category AS old_category, 'Edited/By Hand' AS new_category FROM v_bank b WHERE {_HIT}")
def _(t):
    return merge.recategorize_audit(t.bank, _edits(t))


@query("snk_bulk_delete", """
  WITH b AS (SELECT transaction_date, description, CASE WHEN category = 'Uncategorized' THEN NULL ELSE amount END AS amount, source_file FROM v_bank), k AS (SELECT transaction_date, description, CASE WHEN category = 'Uncategorized' THEN 0 ELSE amount END AS amount FROM v_bank WHERE source_file = 'file_5')
  SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.transaction_date = b.transaction_date AND k.description = b.description AND CAST(round(k.amount, 2) AS DECIMAL(18, 2)) = CAST(round(coalesce(b.amount, 0), 2) AS DECIMAL(18, 2)))""")
def _(t):
    none = F.col("category") == "Uncategorized"
    b = t.bank.select("transaction_date", "description", F.when(~none, F.col("amount")).alias("amount"), "source_file")
    keys = t.bank.filter("source_file = 'file_5'").select("transaction_date", "description", F.when(none, 0.0).otherwise(F.col("amount")).alias("amount"))
    return merge.delete_transactions(b, keys)


_PAY = """SELECT order_id AS payout_id, amount AS net_liquor, tax AS net_food, tip AS net_shisha, gratuity AS expenses FROM v_orders"""
_CALC = "payout_id, round(net_liquor + net_food + net_shisha, 2) AS gross, round(net_liquor + net_food + net_shisha - net_liquor * 0.2::DOUBLE - net_food * 0.3::DOUBLE - net_liquor * 0.067::DOUBLE - expenses, 3) AS net_profit"


@query("snk_payout_upsert", f"""
  WITH t AS (SELECT order_id AS payout_id, 0.0::DOUBLE AS gross, 0.0::DOUBLE AS net_profit FROM v_orders WHERE voided IS NOT NULL), s AS (SELECT {_CALC} FROM ({_PAY} WHERE revenue_center = 'Bar')) SELECT * FROM s UNION ALL SELECT * FROM t WHERE payout_id NOT IN (SELECT payout_id FROM s)""")
def _(t):
    """Totals are recomputed from the parts before the row replaces the stored one."""
    o = t.orders
    p = o.filter("revenue_center = 'Bar'").select(F.col("order_id").alias("payout_id"), (F.col("amount") + F.col("tax") + F.col("tip")).alias("g"), "amount", "tax", "gratuity")
    p = p.select("payout_id", F.round("g", 2).alias("gross"), F.round(F.col("g") - F.col("amount") * 0.2 - F.col("tax") * 0.3 - F.col("amount") * 0.067 - F.col("gratuity"), 3).alias("net_profit"))
    target = o.filter("voided IS NOT NULL").select(F.col("order_id").alias("payout_id"), F.lit(0.0).alias("gross"), F.lit(0.0).alias("net_profit"))
    return merge.upsert(target, p, ["payout_id"], [F.desc("gross")])
