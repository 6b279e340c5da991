"""Rule engines and classifiers over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rulebook as rb
from ..functions import dates, text
from ..operators import classify as cl
from ..operators import orderstats, windows
from .expressions import _NORM_SQL, _WIRE_SQL
from .registry import query

BANK_RULES = [
    ("sun liquor", "2. Cost of Goods Sold (COGS)/Liquor COGS", "Sun Liquor"),
    ("north foods", "2. Cost of Goods Sold (COGS)/Food COGS", "North Foods"),
    ("foods", "2. Cost of Goods Sold (COGS)/Food COGS", "Other Foods"),
    ("grand events", "4. Marketing & Entertainment/Event Expense", "Grand Events"),
    ("payroll", "3. Labor Cost/Payroll", "Payroll Service"),
    ("lin", "6. General/Partial Word", "No Whole Word"),
    ("reed", "4. Marketing & Entertainment/Entertainment", "Dana Reed"),
]
REGISTER = [("101", "Jo Foods", "", ""), ("102", "Rent Co", "5. Operating Expenses (OPEX)/Rent", "Rent Co"), ("103", "Nobody Known", "", "")]


def _q(v):
    return "'" + v.replace("'", "''") + "'"


def values(rows, alias):
    return "(VALUES " + ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows) + f") AS {alias}"


def bank_rules(t):
    return t.rows(BANK_RULES, "keyword string, category string, vendor_normalized string")


def register(t):
    return t.rows(REGISTER, "check_number string, payee string, category string, vendor_normalized string")


# The SQL answers per distinct description and joins back by the description.
CATEGORIZE_CTE = f"""
  d AS (SELECT DISTINCT description, nullif(regexp_extract(trim(description), '(?i)^check\\s+(\\d+)$', 1), '') AS no, {_NORM_SQL} AS norm, {_WIRE_SQL} AS wire FROM v_bank),
  reg AS (SELECT * FROM {values(REGISTER, 'g(no, payee, rc, rv)')}),
  rules AS (SELECT * FROM {values(BANK_RULES, 'r(keyword, rule_category, rule_vendor)')}),
  d2 AS (SELECT d.*, reg.no IS NOT NULL AS listed, payee, nullif(rc, '') AS rc, nullif(rv, '') AS rv, CASE WHEN d.no IS NOT NULL THEN payee ELSE norm END AS rule_text FROM d LEFT JOIN reg ON d.no = reg.no),
  m AS (SELECT d2.description, arg_min(struct_pack(c := rule_category, v := rule_vendor), lpad(CAST(1000 - length(keyword) AS VARCHAR), 5, '0') || keyword) AS hit
    FROM d2 JOIN rules ON regexp_matches(upper(rule_text), '\\b' || upper(keyword) || '\\b') GROUP BY 1),
  a AS (SELECT d2.description, CASE
      WHEN no IS NOT NULL AND listed AND rc IS NOT NULL THEN struct_pack(category := rc, src := 'check_register', vendor := coalesce(rv, payee))
      WHEN no IS NOT NULL AND listed AND hit IS NOT NULL THEN struct_pack(category := hit.c, src := 'check_register', vendor := hit.v)
      WHEN no IS NOT NULL AND listed THEN struct_pack(category := 'Uncategorized', src := 'uncategorized', vendor := payee)
      WHEN no IS NOT NULL THEN struct_pack(category := 'Uncategorized', src := 'uncategorized', vendor := d2.description)
      WHEN upper(d2.description) LIKE '%TOAST%DES:DEP%' THEN struct_pack(category := '1. Revenue/Sales Revenue', src := 'auto', vendor := 'Toast Deposit')
      WHEN upper(d2.description) LIKE '%TOAST%DES:EOM%' THEN struct_pack(category := '1. Revenue/Sales Revenue', src := 'auto', vendor := 'Toast EOM Adjustment')
      WHEN regexp_matches(upper(d2.description), 'TOAST,?\\s*INC\\.?\\s+DES:\\d{{8}}') THEN struct_pack(category := '1. Revenue/Sales Revenue', src := 'auto', vendor := 'Toast Settlement')
      WHEN upper(d2.description) LIKE '%TOAST%DES:REF%' THEN struct_pack(category := '5. Operating Expenses (OPEX)/POS & Technology Fees', src := 'auto', vendor := 'Toast Refund')
      WHEN regexp_matches(upper(d2.description), 'TOAST,?\\s*INC\\s+DES:TOAST') THEN struct_pack(category := '5. Operating Expenses (OPEX)/POS & Technology Fees', src := 'auto', vendor := 'Toast Platform Fee')
      WHEN hit IS NOT NULL THEN struct_pack(category := hit.c, src := 'auto', vendor := coalesce(wire, hit.v))
      ELSE struct_pack(category := 'Uncategorized', src := 'uncategorized', vendor := coalesce(wire, nullif(norm, ''), d2.description)) END AS ans
    FROM d2 LEFT JOIN m ON m.description = d2.description)"""


@query("r_bank_categorize", f"""
  WITH {CATEGORIZE_CTE}
  SELECT b.description, ans.category AS category, ans.src AS category_source, ans.vendor AS vendor_normalized, count(*) AS n, round(sum(b.amount), 2) AS amount
  FROM v_bank b JOIN a ON a.description = b.description GROUP BY 1, 2, 3, 4""")
def _(t):
    out = cl.categorize_bank(t.bank, bank_rules(t), register(t))
    return out.groupBy("description", "category", "category_source", "vendor_normalized").agg(
        F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


@query("r_recategorize_checks", f"""
  WITH {CATEGORIZE_CTE}
  SELECT b.transaction_date, b.description, b.amount, CASE WHEN fix THEN ans.category ELSE b.category END AS category,
    CASE WHEN fix THEN ans.src ELSE b.category_source END AS category_source
  FROM (SELECT b.*, ans, coalesce(b.category = 'Uncategorized' AND regexp_matches(b.description, '(?i)^check\\s+\\d+') AND ans.category <> 'Uncategorized', FALSE) AS fix
    FROM v_bank b JOIN a ON a.description = b.description) b""")
def _(t):
    from ..operators.merge import recategorize_checks
    return recategorize_checks(t.bank, bank_rules(t), register(t)).select("transaction_date", "description", "amount", "category", "category_source")


TAX_RULES = [("vendor", "vendor_7\\b", "4. Marketing/Artist Booking", None), ("vendor", "vendor_8\\b", "5. OPEX/Legal", "1998-01-01"),
             ("fallback", "liquor|foods", "2. COGS/Unsorted", None), ("fallback", "\\brent\\b", "5. OPEX/Rent", None)]
FEED_MAP = [("Cash Deposit", "1. Revenue/Cash Deposit")]


@query("r_expense_taxonomy", """
  SELECT taxonomy, count(*) AS n, round(sum(abs_amount), 2) AS total FROM (SELECT abs_amount, CASE
    WHEN regexp_matches(coalesce(vendor_normalized || ' ', '') || description, '(?i)vendor_7\\b') THEN '4. Marketing/Artist Booking'
    WHEN regexp_matches(coalesce(vendor_normalized || ' ', '') || description, '(?i)vendor_8\\b') AND transaction_date >= DATE '1998-01-01' THEN '5. OPEX/Legal'
    WHEN regexp_matches(category, '^\\d+\\.') THEN category WHEN category = 'Cash Deposit' THEN '1. Revenue/Cash Deposit'
    WHEN regexp_matches(coalesce(vendor_normalized || ' ', '') || description, '(?i)liquor|foods') THEN '2. COGS/Unsorted'
    WHEN regexp_matches(coalesce(vendor_normalized || ' ', '') || description, '(?i)\\brent\\b') THEN '5. OPEX/Rent' ELSE category END AS taxonomy FROM v_bank) GROUP BY 1""")
def _(t):
    out = cl.expense_taxonomy(t.bank, TAX_RULES, t.rows(FEED_MAP, "feed_category string, taxonomy string"))
    return out.groupBy("taxonomy").agg(F.count("*").alias("n"), F.round(F.sum("abs_amount"), 2).alias("total"))


def _bucket_query(name, table, label_fn, sql_case, sql_table, value, sql_value=None):
    @query(name, f"SELECT {sql_case} AS bucket, count(*) AS n, round(sum({sql_value or value}), 2) AS total FROM {sql_table} GROUP BY 1")
    def _(t):
        df = getattr(t, table)
        return df.groupBy(label_fn(df).alias("bucket")).agg(F.count("*").alias("n"), F.round(F.sum(value), 2).alias("total"))


_bucket_query("r_expense_section", "bank", lambda d: cl.expense_section(F.col("category")), """
  CASE WHEN lower(category) LIKE '%cost of goods%' OR lower(category) LIKE '%cogs%' THEN 'cogs' WHEN lower(category) LIKE '%labor%' OR lower(category) LIKE '%payroll%' THEN 'labor'
    WHEN lower(category) LIKE '%marketing%' OR lower(category) LIKE '%entertainment%' OR lower(category) LIKE '%promoter%' THEN 'marketing'
    WHEN lower(category) LIKE '%operating%' OR lower(category) LIKE '%opex%' THEN 'opex' ELSE 'other' END""", "v_bank", "abs_amount")
_bucket_query("r_cost_bucket", "bank", lambda d: cl.cost_bucket(F.col("category")), """
  CASE WHEN category LIKE '2.%' OR lower(category) LIKE '%cost of goods%' OR lower(category) LIKE '%cogs%' THEN 'cogs'
    WHEN category LIKE '3.%' OR lower(category) LIKE '%labor%' OR lower(category) LIKE '%payroll%' THEN 'labor'
    WHEN category LIKE '1.%' OR lower(category) LIKE '%revenue%' THEN 'revenue' ELSE 'opex' END""", "v_bank", "abs_amount")
_bucket_query("r_prime_bucket", "bank", lambda d: cl.prime_bucket(F.col("category")), """
  CASE WHEN category LIKE '2.%' THEN CASE WHEN lower(category) LIKE '%liquor cogs%' THEN 'liquor_cogs' WHEN lower(category) LIKE '%food cogs%' THEN 'food_cogs' ELSE 'other_cogs' END
    WHEN category LIKE '3.%' OR lower(category) LIKE '%labor cost%' OR lower(category) LIKE '%payroll%' THEN 'labor' END""", "v_bank", "abs_amount")
_bucket_query("r_sales_bucket", "items", lambda d: cl.sales_bucket(F.col("sales_category")), """
  CASE WHEN regexp_matches(lower(sales_category), 'liquor|beer|wine|bottle|cocktail|spirits|na beverage|n/a beverage') THEN 'liquor'
    WHEN regexp_matches(lower(sales_category), 'food|kitchen|appetizer|entree|dessert|brunch') THEN 'food'
    WHEN regexp_matches(lower(sales_category), 'hookah|shisha') THEN 'shisha' ELSE 'other' END""", "v_items", "net_price")
_bucket_query("r_deposit_type", "bank", lambda d: cl.deposit_type(F.col("description"), F.col("amount")), """
  CASE WHEN description LIKE '%NET SETLMT%' AND amount > 0 THEN 'card_settlement' WHEN description LIKE '%TOAST DES:DEP%' AND amount > 0 THEN 'processor_deposit'
    WHEN description LIKE '%TOAST DES:EOM%' THEN 'processor_month_end' WHEN description LIKE '%Counter Credit%' AND amount > 0 THEN 'counter_credit'
    WHEN description LIKE '%Toast, Inc DES:Toast%' AND amount < 0 THEN 'platform_fee'
    WHEN description LIKE 'Online Banking transfer from CHK%' AND amount > 0 THEN 'transfer_in' END""", "v_bank", "amount")

REASON_SQL = "CASE " + " ".join("WHEN lower(reason) LIKE '%" + w.replace("'", "''").replace("%", "\\%") + f"%' ESCAPE '\\' THEN '{b}'" for w, b in rb.COMP_REASONS) + " ELSE 'other' END"
ITEM_SQL = """CASE WHEN upper(menu_item) LIKE '%BIRTHDAY%' OR upper(menu_item) LIKE '%BDAY%' THEN 'programmatic_birthday' WHEN upper(menu_item) LIKE '%WYCLIFF%' THEN 'programmatic_standing'
  WHEN starts_with(upper(menu_item), 'OWNER ') OR starts_with(menu_item, '$') THEN 'owner_discretion' WHEN starts_with(upper(menu_item), 'THURSDAY') THEN 'programmatic_promoter' END"""
OWNERS = ["owner_a", "owner_b"]
OWNER_WORDS = [("owner_a", "A"), ("owner_b", "B")]
# position, key, event, weekday (Monday = 0), bottles allowed, who pays, signals
CAPS = [
    (1, "thu_social", "Thursday Social", 3, 40, "external", ["thursday", "social"]),
    (2, "fri_live", "Friday Live", 4, 60, "internal", ["friday", "live"]),
    (3, "sun_brunch", "Sunday Brunch", 6, 50, "external", ["brunch"]),
    (4, "sun_crew", "Sunday Crew", 6, 30, "internal", ["crew", "sunday"]),
]
CAP_HIT_SQL = """CASE isodow(processing_date) - 1 WHEN 3 THEN CASE WHEN lower(tab_name) LIKE '%thursday%' OR lower(tab_name) LIKE '%social%' THEN 'thu_social' END
  WHEN 4 THEN CASE WHEN lower(tab_name) LIKE '%friday%' OR lower(tab_name) LIKE '%live%' THEN 'fri_live' END
  WHEN 6 THEN CASE WHEN lower(tab_name) LIKE '%brunch%' THEN 'sun_brunch' WHEN lower(tab_name) LIKE '%crew%' OR lower(tab_name) LIKE '%sunday%' THEN 'sun_crew' END END"""
TAB_SQL = f"""CASE WHEN trim(tab_name) = '' THEN NULL WHEN lower(tab_name) LIKE 'spill%' OR lower(tab_name) LIKE 'bug%' OR lower(tab_name) LIKE '%broke%' THEN 'recovery'
  WHEN regexp_matches(lower(tab_name), '^(per )?owner_[ab]') AND lower(tab_name) NOT LIKE '%tasting%' THEN 'owner_discretion'
  WHEN lower(tab_name) LIKE '%owner tasting%' THEN 'owner_discretion' WHEN regexp_matches(lower(tab_name), '^vip( -|:| )') THEN 'vip'
  WHEN lower(tab_name) LIKE '%birthday%' OR lower(tab_name) LIKE '%bday%' THEN 'programmatic_birthday'
  WHEN lower(tab_name) LIKE 'promoter%' OR lower(tab_name) LIKE 'promo %' THEN 'programmatic_promoter'
  WHEN lower(tab_name) LIKE 'tasting%' OR lower(tab_name) LIKE 'distributor%' OR lower(tab_name) LIKE '%wycliff%' THEN 'programmatic_marketing'
  WHEN ({CAP_HIT_SQL}) IS NOT NULL THEN 'programmatic_promoter' END"""
OWNER_SQL = "CASE WHEN contains(' ' || lower(trim(tab_name)), ' owner_a') THEN 'A' WHEN contains(' ' || lower(trim(tab_name)), ' owner_b') THEN 'B' END"
BOTTLE_SQL = """(contains(lower(sales_category), 'liquor') OR contains(lower(sales_category), 'champagne')) AND (starts_with(upper(menu_item), 'BTL ') OR contains(upper(menu_item), ' BTL')
  OR starts_with(upper(menu_item), 'OWNER ') OR starts_with(upper(menu_item), 'THURSDAY ') OR gross_price >= 100)"""
PREMIUM_SQL = "NOT starts_with(upper(menu_item), 'OWNER ') AND regexp_matches(lower(menu_item), '" + "|".join(rb.PREMIUM_WORDS) + "')"


def caps(t):
    return t.rows(CAPS, "position int, key string, event string, dow int, cap int, cap_type string, signals array<string>")


@query("r_comp_reason", f"SELECT reason, {REASON_SQL} AS bucket, count(*) AS n FROM v_checks GROUP BY 1, 2")
def _(t):
    return t.checks.groupBy("reason", cl.comp_reason(F.col("reason")).alias("bucket")).agg(F.count("*").alias("n"))


@query("r_comp_item", f"SELECT menu_item, {ITEM_SQL} AS bucket, count(*) AS n FROM v_items GROUP BY 1, 2")
def _(t):
    return t.items.groupBy("menu_item", cl.comp_item(F.col("menu_item")).alias("bucket")).agg(F.count("*").alias("n"))


@query("r_comp_tab", f"SELECT check_id, tab_name, {TAB_SQL} AS bucket FROM v_checks")
def _(t):
    c = cl.match_cap(t.checks, caps(t))
    return c.select("check_id", "tab_name", cl.comp_tab(F.col("tab_name"), OWNERS, F.col("cap_key")).alias("bucket"))


@query("r_comp_final", f"SELECT check_id, item_selection_id, coalesce({TAB_SQL}, {ITEM_SQL}, {REASON_SQL}) AS bucket, round(sum(discount), 2) AS discount FROM (SELECT i.*, c.reason FROM v_check_items i JOIN (SELECT check_id, reason FROM v_checks) c ON c.check_id = i.check_id) GROUP BY 1, 2, 3")
def _(t):
    i = t.check_items.select("check_id", "processing_date", "item_selection_id", "menu_item", "tab_name", "discount").join(t.checks.select("check_id", "reason"), "check_id")
    i = cl.match_cap(i, caps(t))
    b = cl.comp_final(cl.comp_tab(F.col("tab_name"), OWNERS, F.col("cap_key")), cl.comp_item(F.col("menu_item")), cl.comp_reason(F.col("reason")))
    return i.groupBy("check_id", "item_selection_id", b.alias("bucket")).agg(F.round(F.sum("discount"), 2).alias("discount"))


@query("r_cap_match", f"SELECT check_id, processing_date, {CAP_HIT_SQL} AS cap_key FROM v_checks")
def _(t):
    return cl.match_cap(t.checks, caps(t)).select("check_id", "processing_date", "cap_key")


@query("r_owner_tab", f"SELECT check_id, {OWNER_SQL} AS owner FROM v_checks")
def _(t):
    return t.checks.select("check_id", cl.owner_of_tab(F.col("tab_name"), OWNER_WORDS).alias("owner"))


@query("r_bottle", f"SELECT menu_item, ({BOTTLE_SQL}) AS is_bottle, count(*) AS n FROM v_items GROUP BY 1, 2")
def _(t):
    return t.items.groupBy("menu_item", cl.is_bottle(F.col("menu_item"), F.col("sales_category"), F.col("gross_price")).alias("is_bottle")).agg(F.count("*").alias("n"))


@query("r_premium", f"SELECT menu_item, ({PREMIUM_SQL}) AS is_premium, count(*) AS n FROM v_items GROUP BY 1, 2")
def _(t):
    return t.items.groupBy("menu_item", cl.is_premium(F.col("menu_item")).alias("is_premium")).agg(F.count("*").alias("n"))


PRICES = [("BTL Gold 1942", 900.0, "premium"), ("Cristal Magnum", 1500.0, "premium"), ("Moet House", 300.0, "premium"), ("Reserve Rose", 250.0, "premium"), ("Steak Dinner", 60.0, "standard")]
ALIASES = [("OWNER Moet", "Moet House"), ("OWNER Reserve Rose", "Reserve Rose"), ("$Blue Agave BTL", "Unlisted")]
RETAIL_SQL = "CASE menu_item WHEN 'BTL Gold 1942' THEN 900.0::DOUBLE WHEN 'Cristal Magnum' THEN 1500.0::DOUBLE WHEN 'OWNER Moet' THEN 300.0::DOUBLE WHEN 'OWNER Reserve Rose' THEN 250.0::DOUBLE WHEN 'Steak Dinner' THEN 60.0::DOUBLE END"


def price_tables(t):
    return t.rows(PRICES, "menu_item string, retail double, tier string"), t.rows(ALIASES, "menu_item string, retail_item string")


@query("r_retail_price", f"SELECT item_selection_id, menu_item, {RETAIL_SQL} AS retail_price FROM v_items")
def _(t):
    return cl.with_retail_price(t.items, *price_tables(t)).select("item_selection_id", "menu_item", "retail_price")


_RFM_SQL = "SELECT customer_id, count(DISTINCT processing_date) AS days, CAST(DATE '2001-08-01' - max(processing_date) AS INT) AS recency, sum(total) AS spend FROM v_checks GROUP BY 1"
SEG_SQL = """CASE WHEN recency > 90 THEN 'dormant' WHEN days >= 10 AND recency <= 30 THEN 'champions' WHEN days >= 10 THEN 'loyal' WHEN days >= 5 AND recency <= 45 THEN 'regulars'
  WHEN days >= 3 AND recency > 45 THEN 'at_risk' WHEN days >= 2 THEN 'returning' WHEN recency <= 30 THEN 'new' ELSE 'dormant' END"""


def _rfm(t):
    return t.checks.groupBy("customer_id").agg(
        F.count_distinct("processing_date").alias("days"), F.datediff(F.lit("2001-08-01").cast("date"), F.max("processing_date")).alias("recency"),
        F.sum("total").alias("spend"))


@query("r_guest_segment", f"SELECT customer_id, days, recency, {SEG_SQL} AS segment FROM ({_RFM_SQL})")
def _(t):
    return _rfm(t).select("customer_id", "days", "recency", cl.guest_segment(F.col("days"), F.col("recency")).alias("segment"))


@query("r_guest_tier", f"SELECT CASE WHEN days >= 10 THEN 'Champions' WHEN days >= 5 THEN 'Regulars' WHEN days >= 2 THEN 'Returning' ELSE 'New' END AS tier, count(*) AS n FROM ({_RFM_SQL}) GROUP BY 1")
def _(t):
    return _rfm(t).groupBy(cl.guest_tier(F.col("days")).alias("tier")).agg(F.count("*").alias("n"))


@query("r_guest_tags", f"""
  SELECT customer_id, concat_ws('; ', {SEG_SQL}, CASE WHEN spend >= 500 THEN 'High Spender' WHEN spend >= 100 THEN 'Medium Spender' END,
    CASE WHEN days >= 5 THEN 'Frequent Visitor' WHEN days >= 2 THEN 'Repeat Visitor' END, 'House Guest') AS tags FROM ({_RFM_SQL})""")
def _(t):
    seg = cl.guest_segment(F.col("days"), F.col("recency"))
    return _rfm(t).select("customer_id", F.array_join(cl.guest_tags(seg, F.col("spend"), F.col("days")), "; ").alias("tags"))


@query("r_daypart", """
  SELECT CASE WHEN h BETWEEN 17 AND 22 THEN 'Pre-11p' WHEN h IN (23, 0) THEN 'Peak (11p-1a)' WHEN h BETWEEN 1 AND 3 THEN 'Late (1a-close)' ELSE 'Other' END AS daypart, count(*) AS n
  FROM (SELECT extract(hour FROM ts) AS h FROM events) GROUP BY 1""")
def _(t):
    return t.raw("events").groupBy(cl.daypart(F.hour("ts")).alias("daypart")).agg(F.count("*").alias("n"))


@query("r_service_account", """
  SELECT void_user, (contains(lower(void_user), 'example.com') OR contains(lower(void_user), '@test') OR regexp_matches(lower(void_user), '^[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}')) AS synthetic,
    count(*) AS n FROM v_payments WHERE void_user IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return t.payments.filter("void_user IS NOT NULL").groupBy("void_user", cl.is_service_account(F.col("void_user")).alias("synthetic")).agg(F.count("*").alias("n"))


@query("r_grade", """
  SELECT server, round(sum(tip) / sum(amount) * 100, 2) AS tip_pct, CASE WHEN sum(tip) / sum(amount) * 100 >= 13 THEN 'good' WHEN sum(tip) / sum(amount) * 100 >= 11 THEN 'watch' ELSE 'critical' END AS tip_grade,
    round(sum(discount_amount) / sum(amount) * 100, 2) AS disc_pct, CASE WHEN sum(discount_amount) / sum(amount) * 100 <= 2.4 THEN 'good' WHEN sum(discount_amount) / sum(amount) * 100 <= 2.6 THEN 'watch' ELSE 'critical' END AS disc_grade
  FROM v_orders WHERE server IS NOT NULL GROUP BY 1""")
def _(t):
    g = t.orders.filter("server IS NOT NULL").groupBy("server").agg(
        (F.sum("tip") / F.sum("amount") * 100).alias("tp"), (F.sum("discount_amount") / F.sum("amount") * 100).alias("dp"))
    return g.select("server", F.round("tp", 2).alias("tip_pct"), cl.grade(F.col("tp"), F.lit(13.0), F.lit(11.0), F.lit(False)).alias("tip_grade"),
                    F.round("dp", 2).alias("disc_pct"), cl.grade(F.col("dp"), F.lit(2.4), F.lit(2.6), F.lit(True)).alias("disc_grade"))


@query("r_budget_status", """
  WITH g AS (SELECT category, sum(abs_amount) AS total FROM v_bank WHERE transaction_type = 'debit' GROUP BY 1), p AS (SELECT category, total, total / (SELECT sum(amount) FROM v_orders) * 100 AS pct FROM g)
  SELECT category, round(pct, 3) AS pct, CASE WHEN pct <= 25 THEN 'under_budget' WHEN pct <= 27 THEN 'on_track' WHEN pct <= 45 THEN 'watch' ELSE 'over_budget' END AS by_pct,
    CASE WHEN total / 900000 <= 1 THEN 'under_budget' WHEN total / 900000 <= 1.15 THEN 'on_track' WHEN total / 900000 <= 1.3 THEN 'watch' ELSE 'over_budget' END AS by_ratio FROM p""")
def _(t):
    g = t.bank.filter("transaction_type = 'debit'").groupBy("category").agg(F.sum("abs_amount").alias("total"))
    g = g.withColumn("revenue", t.orders.agg(F.sum("amount")).scalar()).withColumn("p", F.col("total") / F.col("revenue") * 100)
    return g.select("category", F.round("p", 3).alias("pct"), cl.budget_status_pct(F.col("p"), F.lit(25.0), F.lit(45.0)).alias("by_pct"),
                    cl.budget_status_ratio(F.col("total"), F.lit(900000.0)).alias("by_ratio"))


@query("r_menu_quadrant", """
  WITH g AS (SELECT menu_item, sum(qty) AS qty, sum(net_price) AS net FROM v_items GROUP BY 1),
  x AS (SELECT *, qty / (avg(qty) OVER ()) AS pop, (net / qty) / (sum(net) OVER () / sum(qty) OVER ()) AS pri FROM g)
  SELECT menu_item, CASE WHEN pop >= 1 AND pri >= 1 THEN 'Star' WHEN pop >= 1 THEN 'Plowhorse' WHEN pri >= 1 THEN 'Puzzle' ELSE 'Dog' END AS quadrant FROM x""")
def _(t):
    g = t.items.groupBy("menu_item").agg(F.sum("qty").alias("qty"), F.sum("net_price").alias("net"))
    base = g.agg(F.struct(F.avg("qty").alias("q"), (F.sum("net") / F.sum("qty")).alias("p"))).scalar()
    g = g.withColumn("base", base)
    return g.select("menu_item", cl.menu_quadrant(F.col("qty") / F.col("base.q"), F.col("net") / F.col("qty") / F.col("base.p")).alias("quadrant"))


@query("r_bi_tiers", """
  WITH g AS (SELECT server, sum(amount) AS revenue, sum(tip) / sum(amount) * 100 AS tip_pct, sum(discount_amount) / sum(amount) * 100 AS disc_pct, avg(amount) AS mean FROM v_orders WHERE server IS NOT NULL AND trim(server) <> '' GROUP BY 1),
  r AS (SELECT *, row_number() OVER (ORDER BY revenue DESC, server) AS rank, count(*) OVER () AS n FROM g)
  SELECT server, CASE WHEN rank * 5 <= n THEN 'Top' WHEN rank * 2 <= n THEN 'Core' ELSE 'Developing' END AS server_tier,
    CASE WHEN mean >= 255 THEN 'High' WHEN mean >= 245 THEN 'Medium' ELSE 'Low' END AS revenue_tier, disc_pct > 2.6 OR tip_pct < 11 AS risk_flag,
    CASE WHEN disc_pct > 2.6 THEN 'High' WHEN disc_pct > 2.4 THEN 'Medium' ELSE 'Low' END AS discount_impact, round(0.6 * (n - rank + 1) * 100 / n + 0.4 * least(tip_pct * 5, 100), 3) AS score FROM r""")
def _(t):
    from ..plans.sales import server_tiers
    return server_tiers(t.orders, high_check=255.0, mid_check=245.0, high_disc=2.6, mid_disc=2.4, low_tip=11.0)
