"""Comp, audit and reservation reports with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rulebook as rb
from ..plans import audit, comps as cp, reservations as rv
from ..sources import sinks
from .classifiers import ALIASES, BOTTLE_SQL, CAP_HIT_SQL, CAPS, ITEM_SQL, OWNER_SQL, OWNER_WORDS, PREMIUM_SQL, PRICES, REASON_SQL, RETAIL_SQL, TAB_SQL, caps, price_tables
from .registry import query

ROSTER = [("srv_3", "Manager"), ("srv_7", "Manager"), ("srv_11", "Bar Lead"), ("srv_20", "Manager"), ("nobody", "Manager")]
ROSTER_SQL = "(VALUES " + ", ".join(f"('{s}', '{r}')" for s, r in ROSTER) + ") AS ro(server, role)"
_IN = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"
LISTED = _IN([p for p, *_ in PRICES] + [a for a, _ in ALIASES])
VALID = "status IN ('CAPTURED', 'AUTHORIZED', 'CAPTURE_IN_PROGRESS')"

LOG = f"""il AS (SELECT * FROM v_check_items WHERE discount > 0 OR menu_item IN {LISTED} OR (starts_with(upper(menu_item), 'OWNER ') AND (contains(lower(tab_name), 'owner_a') OR contains(lower(tab_name), 'owner_b'))))"""
CC = f"""{LOG}, pc AS (SELECT check_id, max(nullif(tab_name, '')) AS tab_name, max(CASE WHEN ({ITEM_SQL}) IS NOT NULL AND discount > 0 THEN struct_pack(d := discount, m := menu_item) END).m AS menu_item FROM il GROUP BY 1),
  c0 AS (SELECT c.check_id, c.processing_date, c.server, c.reason, c.discount AS amount, pc.tab_name, pc.menu_item FROM v_checks c LEFT JOIN pc ON pc.check_id = c.check_id WHERE c.discount > 0),
  c1 AS (SELECT *, {TAB_SQL} AS tab_bucket, {ITEM_SQL} AS item_bucket, {REASON_SQL} AS reason_bucket FROM c0), cc AS (SELECT *, coalesce(tab_bucket, item_bucket, reason_bucket) AS bucket FROM c1), ck AS (SELECT * FROM cc WHERE bucket <> 'employee')"""
EL = f"""{LOG}, el AS (SELECT i.*, coalesce({ITEM_SQL}, CASE WHEN reason IS NULL THEN 'other' ELSE {REASON_SQL} END) AS bucket, ({PREMIUM_SQL}) AS premium, ({BOTTLE_SQL}) AS bottle, {OWNER_SQL} AS owner, {CAP_HIT_SQL} AS cap_key, {RETAIL_SQL} AS retail_price
    FROM (SELECT il.*, c.reason, coalesce(p.collected, 0) AS collected FROM il LEFT JOIN (SELECT check_id, CASE WHEN discount > 0 THEN reason END AS reason FROM v_checks) c ON c.check_id = il.check_id
      LEFT JOIN (SELECT check_id, sum(amount) AS collected FROM v_payments WHERE {VALID} GROUP BY 1) p ON p.check_id = il.check_id) i)"""
EL2 = EL.replace(LOG + ", ", "")
DISC, UNCAT = _IN(rb.DISCRETIONARY), _IN(rb.UNCATEGORIZED)


def house(t):
    prices, aliases = price_tables(t)
    return cp.House(OWNER_WORDS, caps(t), prices, aliases)


def comp_rows(t, store=False):
    return cp.comp_checks(t.checks, t.check_items, house(t), store)


def shared_comps(t):
    """For reports that read the checks several times."""
    return sinks.stage(comp_rows(t, True), "comps")


def shared_log(t):
    return sinks.stage(elog(t, True), "enriched-log")


def elog(t, store=False):
    return cp.enriched_log(t.check_items, t.checks, t.payments.filter(F.col("status").isin(*["CAPTURED", "AUTHORIZED", "CAPTURE_IN_PROGRESS"])), house(t), store=store)


def net_sales(t):
    return t.orders.agg(F.sum("amount")).scalar()


def roster(t):
    return t.rows(ROSTER, "server string, role string")


@query("rep_comp_period", f"WITH {CC} SELECT bucket, count(*) AS n, round(sum(amount), 2) AS total, round(sum(amount) / (SELECT sum(amount) FROM v_orders) * 100, 3) AS pct_of_sales FROM ck GROUP BY 1")
def _(t):
    return cp.by_bucket(comp_rows(t), net_sales(t))


_FX = lambda c: f"round(coalesce(sum(amount) FILTER ({c}), 0), 2)"
SV = f"""sv AS (SELECT *, (discretionary > 0)::INT + (recovery > 0)::INT + (owner > 0)::INT + (programmatic > 0)::INT AS diversity FROM (SELECT server, count(*) AS comp_count, round(sum(amount), 2) AS total, {_FX(f'bucket IN {DISC}')} AS discretionary,
  {_FX("starts_with(bucket, 'programmatic')")} AS programmatic, {_FX("bucket = 'owner_discretion'")} AS owner, {_FX("bucket = 'recovery'")} AS recovery FROM ck WHERE server IS NOT NULL AND server <> '' GROUP BY 1))"""


@query("rep_comp_period_servers", f"WITH {CC}, {SV} SELECT * FROM sv")
def _(t):
    return cp.by_server(comp_rows(t))


@query("rep_comp_period_days", f"WITH {CC} SELECT dayname(processing_date) AS day, bucket, count(*) AS n, round(sum(amount), 2) AS total FROM ck GROUP BY 1, 2")
def _(t):
    return cp.by_weekday(comp_rows(t))


HL = f"""h0 AS (SELECT (SELECT round(sum(amount), 2) FROM v_orders) AS net_sales, round(sum(amount), 2) AS total, {_FX(f'bucket IN {DISC}')} AS disc, {_FX("bucket = 'discretionary_manager'")} AS mgr, {_FX("bucket = 'recovery'")} AS rec, {_FX(f'bucket IN {UNCAT}')} AS uncategorized FROM ck),
  h1 AS (SELECT *, total / net_sales * 100 AS tp, disc / net_sales * 100 AS dp, mgr / net_sales * 100 AS mp, rec / net_sales * 100 AS rp FROM h0),
  hl AS (SELECT net_sales, total, uncategorized, round(tp, 3) AS total_pct, round(dp, 3) AS discretionary_pct, round(mp, 3) AS manager_pct, round(rp, 3) AS recovery_pct, CASE WHEN tp < 4 THEN 'On Target' WHEN tp < 5 THEN 'Watch' ELSE 'Investigate' END AS grade,
    CASE WHEN dp <= 2 THEN 'On Target' WHEN dp <= 3 THEN 'Watch' ELSE 'Investigate' END AS discretionary_grade, CASE WHEN mp <= 1 THEN 'On Target' WHEN mp <= 1.5 THEN 'Watch' ELSE 'Investigate' END AS manager_grade,
    CASE WHEN rp <= 0.5 THEN 'On Target' WHEN rp <= 1 THEN 'Watch' ELSE 'Investigate' END AS recovery_grade FROM h1)"""


def head(t):
    return cp.headline(comp_rows(t), net_sales(t))


@query("rep_comp_period_headline", f"WITH {CC}, {HL} SELECT * FROM hl")
def _(t):
    return head(t)


TG = [("total_pct", 4.0), ("manager_pct", 1.0), ("recovery_pct", 0.5)]


@query("rep_comp_variance", f"""
  WITH {CC}, {HL}, l AS (SELECT net_sales, metric, actual FROM (SELECT net_sales, total_pct, manager_pct, recovery_pct FROM hl) UNPIVOT (actual FOR metric IN (total_pct, manager_pct, recovery_pct)))
  SELECT l.metric, actual, target::DOUBLE AS target, round((actual - target::DOUBLE) / 100 * net_sales, 2) AS variance_dollars FROM l JOIN (VALUES {', '.join(str(x) for x in TG)}) AS tt(metric, target) ON tt.metric = l.metric""")
def _(t):
    return cp.variance(head(t), t.rows(TG, "metric string, target double"))


@query("rep_comp_mismatch", f"WITH {CC} SELECT check_id, server, reason_bucket, bucket AS final_bucket, CASE WHEN tab_bucket IS NOT NULL THEN 'tab' ELSE 'item' END AS override, amount FROM cc WHERE bucket <> reason_bucket AND (tab_bucket IS NOT NULL OR item_bucket IS NOT NULL)")
def _(t):
    return cp.mismatches(comp_rows(t))


@query("rep_comp_flags", f"""
  WITH {CC}, {SV}, s AS (SELECT * FROM sv WHERE server <> 'Bottle Manager'), md AS (SELECT discretionary AS m FROM (SELECT discretionary, row_number() OVER (ORDER BY discretionary) - 1 AS i, count(*) OVER () AS n FROM s WHERE discretionary > 0) WHERE i = n // 2)
  SELECT 'uncategorized' AS flag, CAST(check_id AS VARCHAR) AS key, server, amount FROM cc WHERE bucket IN {UNCAT}
  UNION ALL SELECT 'server_outlier', 'SERVER_OUTLIER', server, discretionary FROM s, md WHERE discretionary > 1.1 * m AND discretionary > 250""")
def _(t):
    return cp.flags(shared_comps(t), "Bottle Manager", factor=1.1)


@query("rep_comp_items", f"""WITH {EL} SELECT item_selection_id, check_id, menu_item, discount, bucket, premium, bottle, owner, cap_key, retail_price,
    nullif(concat_ws(' / ', CASE WHEN premium AND cap_key IS NOT NULL THEN 'Premium under promoter tab' END, CASE WHEN bucket IN {UNCAT} THEN 'Uncategorized' END), '') AS protocol_flag FROM el""")
def _(t):
    return elog(t).select("item_selection_id", "check_id", "menu_item", "discount", "bucket", "premium", "bottle", "owner", "cap_key", "retail_price", "protocol_flag")


@query("rep_comp_items_top", f"WITH {LOG} SELECT menu_item, count(*) AS n, round(sum(discount), 2) AS total FROM il WHERE discount > 0 GROUP BY 1 ORDER BY total DESC, menu_item LIMIT 10")
def _(t):
    return cp.top_items(cp.log(t.check_items, house(t)))


CAPV = "(VALUES " + ", ".join(f"('{k}', '{e}', {d}, {c}, '{ct}')" for _, k, e, d, c, ct, _s in CAPS) + ") AS cv(key, event, dow, cap, cap_type)"
CP = f"""cb AS (SELECT *, CASE isodow(processing_date) - 1 WHEN 3 THEN 'thu_social' WHEN 4 THEN 'fri_live' WHEN 6 THEN coalesce(cap_key, 'sun_brunch') END AS key FROM el WHERE discount > 0 AND bottle AND owner IS NULL AND NOT contains(lower(tab_name), 'birthday') AND NOT contains(lower(tab_name), 'bday')),
  cg AS (SELECT key, count(*) AS bottles, round(sum(discount), 2) AS dollars, count(*) FILTER (premium) AS premium_bottles, round(coalesce(sum(discount) FILTER (premium), 0), 2) AS premium_dollars FROM cb WHERE key IS NOT NULL GROUP BY 1),
  cw AS (SELECT cv.key, event, cap, cap_type, coalesce(bottles, 0) AS bottles, coalesce(dollars, 0) AS dollars, coalesce(premium_bottles, 0) AS premium_bottles, coalesce(premium_dollars, 0) AS premium_dollars, greatest(coalesce(bottles, 0) - cap, 0) AS excess, coalesce(bottles, 0) > cap AS over_cap,
    round(CASE WHEN cap_type = 'external' THEN greatest(coalesce(bottles, 0) - cap, 0) * 0.8 * 350 ELSE 0 END::DOUBLE, 2) AS clawback FROM {CAPV} LEFT JOIN cg ON cg.key = cv.key)"""


def cap_rows(t):
    return cp.caps(elog(t), house(t), "sun_brunch")


@query("rep_comp_caps", f"WITH {EL}, {CP} SELECT * FROM cw")
def _(t):
    return cap_rows(t)


PM = f"""pm AS (SELECT *, round(greatest(retail_value - recovered, 0), 2) AS foregone FROM (SELECT menu_item, count(*) AS rings, round(coalesce(sum(retail_price), 0), 2) AS retail_value, count(*) FILTER (collected <= 0.01) AS house_comped, count(*) FILTER (collected > 0.01 AND owner IS NOT NULL) AS owner_paid,
    count(*) FILTER (collected > 0.01 AND owner IS NULL) AS other_paid, round(coalesce(sum(CASE WHEN collected > 0.01 THEN CASE WHEN owner IS NOT NULL THEN gross_price ELSE coalesce(retail_price, gross_price) END END), 0), 2) AS recovered
    FROM el WHERE premium OR menu_item IN {_IN([a for a, _ in ALIASES] + [p for p, _, tier in PRICES if tier == 'premium'])} GROUP BY 1))"""


def movement(t):
    return cp.premium_movement(elog(t), *price_tables(t))


@query("rep_comp_premium", f"WITH {EL}, {PM} SELECT * FROM pm")
def _(t):
    return movement(t)


OL = """ol AS (SELECT owner, round(coalesce(sum(gross_price) FILTER (collected > 0), 0), 2) AS paid_by_owner, round(coalesce(sum(gross_price) FILTER (collected <= 0), 0), 2) AS comped_at_cost, round(coalesce(sum(coalesce(retail_price, 0)) FILTER (collected <= 0), 0), 2) AS comped_retail,
  count(DISTINCT check_id) FILTER (collected > 0) AS tabs_paid, count(DISTINCT check_id) FILTER (collected <= 0) AS tabs_comped FROM el WHERE owner IS NOT NULL GROUP BY 1)"""


@query("rep_comp_owner_ledger", f"WITH {EL}, {OL} SELECT * FROM ol")
def _(t):
    return cp.owner_ledger(elog(t))


@query("rep_comp_owner_residual", f"""
  WITH {CC}, {EL2}, {OL}, g AS (SELECT {_FX("bucket = 'owner_discretion'")} AS owner_comps, (SELECT round(sum(paid_by_owner + comped_at_cost), 2) FROM ol) AS personal FROM ck)
  SELECT *, round(greatest(owner_comps - personal, 0), 2) AS non_personal FROM g""")
def _(t):
    return cp.owner_residual(comp_rows(t), cp.owner_ledger(elog(t)))


RS = f"""rs AS (SELECT ro.server, ro.role, coalesce(comp_count, 0) AS comp_count, coalesce(total, 0) AS total, coalesce(discretionary, 0) AS discretionary, coalesce(programmatic, 0) AS programmatic, coalesce(owner, 0) AS owner, coalesce(recovery, 0) AS recovery, coalesce(diversity, 0) AS diversity
    FROM {ROSTER_SQL} LEFT JOIN sv ON sv.server = ro.server),
  rm AS (SELECT discretionary AS m FROM (SELECT discretionary, row_number() OVER (ORDER BY discretionary) - 1 AS i, count(*) OVER () AS n FROM rs WHERE role = 'Manager' AND comp_count > 0) WHERE i = n // 2)"""


@query("rep_comp_roster", f"WITH {CC}, {SV}, {RS} SELECT rs.*, m AS peer_median, round(discretionary - m, 2) AS vs_median FROM rs, rm")
def _(t):
    return cp.roster_scores(sinks.stage(cp.by_server(comp_rows(t, True)), "servers"), roster(t))


@query("rep_comp_roster_waterfall", f"""
  WITH {CC}, j AS (SELECT ck.*, ro.role FROM ck LEFT JOIN {ROSTER_SQL} ON ro.server = ck.server), g AS (SELECT {_FX(f"bucket IN {DISC} AND role = 'Manager'")} AS managers, {_FX(f"bucket IN {DISC} AND role = 'Bar Lead'")} AS bar_leads, {_FX(f"bucket IN {DISC} AND server = 'Bottle Manager'")} AS pool,
    {_FX("bucket = 'discretionary_manager'")} AS m, {_FX(f'bucket IN {UNCAT}')} AS uncategorized FROM j), h AS (SELECT managers, bar_leads, pool, round(greatest(m - managers - bar_leads - pool, 0), 2) AS other, uncategorized FROM g),
  l AS (SELECT source, amount FROM h UNPIVOT (amount FOR source IN (managers, bar_leads, pool, other, uncategorized))) SELECT source, amount, round(amount / (SELECT sum(amount) FROM l) * 100, 1) AS share_pct FROM l""")
def _(t):
    return cp.waterfall(comp_rows(t), roster(t), "Bottle Manager")


@query("rep_comp_risk", f"""
  WITH {CC}, {HL}, {EL2}, {CP}, {PM} SELECT (SELECT round(sum(foregone), 2) FROM pm) AS foregone, (SELECT CAST(sum(house_comped) AS BIGINT) FROM pm) AS house_comped, (SELECT round(sum(clawback), 2) FROM cw) AS clawback, (SELECT count(*) FROM cw WHERE over_cap) AS cap_breaches, uncategorized,
    total_pct >= 5 OR discretionary_pct >= 3 OR manager_pct > 1 OR recovery_pct > 1 OR uncategorized > 500 OR (SELECT count(*) FROM cw WHERE over_cap OR premium_bottles > 0) > 0 AS alert FROM hl""")
def _(t):
    log = shared_log(t)
    return cp.risk(cp.headline(comp_rows(t, True), net_sales(t)), cp.caps(log, house(t), "sun_brunch"), cp.premium_movement(log, *price_tables(t)))


@query("rep_comp_actions", f"""
  WITH {CC}, {SV}, {RS}, {EL2}, {CP}, {PM}, w AS (SELECT server, discretionary FROM rs WHERE role = 'Manager' AND discretionary >= 500),
  tp AS (SELECT server, discretionary, check_id, row_number() OVER (PARTITION BY server ORDER BY discount DESC, check_id, item_selection_id, menu_item) AS rank FROM el JOIN w USING (server) WHERE discount > 0 QUALIFY rank <= 3)
  SELECT 'discretionary' AS kind, server AS subject, any_value(discretionary) AS amount, string_agg(CAST(check_id AS VARCHAR), ',' ORDER BY rank) AS detail FROM tp GROUP BY server
  UNION ALL SELECT 'cap_' || cap_type, event, clawback, '' FROM cw WHERE over_cap
  UNION ALL SELECT 'uncategorized', CAST(count(*) AS VARCHAR), round(sum(amount), 2), '' FROM cc WHERE bucket IN {UNCAT} HAVING count(*) > 0
  UNION ALL SELECT * FROM (SELECT 'foregone', menu_item, foregone, '' FROM pm WHERE house_comped > 0 AND foregone >= 500 ORDER BY foregone DESC, menu_item LIMIT 3)""")
def _(t):
    c, e = shared_comps(t), shared_log(t)
    return cp.actions(cp.roster_scores(sinks.stage(cp.by_server(c), "servers"), roster(t)), e, cp.caps(e, house(t), "sun_brunch"), c, cp.premium_movement(e, *price_tables(t)))


COST = [("Food", 0.32), ("Liquor", 0.22), ("Beer", 0.25), ("Wine", 0.3), ("Hookah", 0.1)]


@query("rep_comp_cogs_drag", f"""
  WITH {EL} SELECT sales_category, round(sum(discount), 2) AS retail, round(round(sum(discount) * 100) * round(coalesce(max(rate::DOUBLE), 0.28::DOUBLE) * 100, 4) / 100) / 100 AS drag FROM el LEFT JOIN (VALUES {', '.join(str(x) for x in COST)}) AS r(cat, rate) ON cat = sales_category
  WHERE discount > 0 AND bucket NOT IN {_IN(rb.INTENT_BUCKETS)} GROUP BY 1""")
def _(t):
    return cp.cogs_drag(elog(t), t.rows(COST, "sales_category string, rate double"), 0.28)


DP = "CASE WHEN {h} BETWEEN 17 AND 22 THEN 'Pre-11p' WHEN {h} IN (23, 0) THEN 'Peak (11p-1a)' WHEN {h} BETWEEN 1 AND 3 THEN 'Late (1a-close)' ELSE 'Other' END"


@query("rep_comp_daypart", f"""
  SELECT c.daypart, comp_dollars, comp_count, net_sales FROM (SELECT {DP.format(h='opened_hour')} AS daypart, round(sum(discount), 2) AS comp_dollars, count(*) AS comp_count FROM v_checks WHERE discount > 0 GROUP BY 1) c
  JOIN (SELECT {DP.format(h='extract(hour FROM opened)')} AS daypart, round(sum(amount), 2) AS net_sales FROM v_orders GROUP BY 1) o ON o.daypart = c.daypart""")
def _(t):
    return cp.dayparts(t.checks, t.orders)


@query("rep_comp_trend", f"""
  WITH {CC}, c AS (SELECT (DATE '2001-07-29' - processing_date) // 7 AS w, round(sum(amount), 2) AS total, {_FX("bucket = 'discretionary_manager'")} AS m, {_FX("bucket = 'recovery'")} AS r FROM ck WHERE processing_date BETWEEN DATE '2001-07-29' - 83 AND DATE '2001-07-29' GROUP BY 1),
  o AS (SELECT (DATE '2001-07-29' - processing_date) // 7 AS w, round(sum(amount), 2) AS net_sales FROM v_orders WHERE processing_date BETWEEN DATE '2001-07-29' - 83 AND DATE '2001-07-29' GROUP BY 1)
  SELECT CAST(o.w AS BIGINT) AS weeks_ago, net_sales, coalesce(total, 0) AS total, round(coalesce(m, 0) / net_sales * 100, 3) AS manager_pct, round(coalesce(r, 0) / net_sales * 100, 3) AS recovery_pct FROM o LEFT JOIN c ON c.w = o.w""")
def _(t):
    return cp.weekly_trend(comp_rows(t), t.orders, "2001-07-29", 12)


# --- loss prevention ---

LV = """lv AS (SELECT payment_id, check_id, processing_date, server, amount, payment_type, void_user, void_approver, coalesce(s <> '' AND u <> '' AND (s = u OR contains(u, split_part(s, ' ', 1)) OR contains(s, split_part(u, ' ', 1))), FALSE) AS self_approved,
    contains(lower(payment_type), 'cash') AS is_cash, CAST(date_diff('second', paid_ts, void_ts) AS BIGINT) AS secs_to_void, contains(u, 'example.com') OR contains(u, '@test') OR regexp_matches(u, '^[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}') AS synthetic_user
  FROM (SELECT *, lower(trim(server)) AS s, lower(trim(void_user)) AS u FROM v_payments WHERE void_user IS NOT NULL AND void_user <> ''))"""


@query("rep_lp_voids", f"WITH {LV} SELECT * FROM lv")
def _(t):
    return audit.voids(t.payments)


@query("rep_lp_summary", f"WITH {LV} " + " UNION ALL ".join(f"SELECT '{k}' AS signal, count(*) AS n, round(coalesce(sum(amount), 0), 2) AS dollars FROM lv WHERE {c}" for k, c in
       {"all": "TRUE", "cash": "is_cash", "self_approved": "self_approved", "fast": "secs_to_void < 120", "synthetic_user": "synthetic_user"}.items()))
def _(t):
    return audit.void_summary(audit.voids(t.payments))


@query("rep_lp_pairs", """
  SELECT *, contains(lower(void_user), 'example.com') OR contains(lower(void_user), '@test') OR regexp_matches(lower(void_user), '^[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}') AS synthetic_user FROM (
  SELECT coalesce(void_approver, '') AS approver, coalesce(server, '') AS server, void_user, count(*) AS events, round(sum(amount), 2) AS dollars FROM v_payments WHERE processing_date BETWEEN DATE '2001-07-31' - 720 AND DATE '2001-07-31' AND void_user IS NOT NULL GROUP BY 1, 2, 3
  HAVING count(*) >= 3 OR sum(amount) >= 500 ORDER BY dollars DESC, approver, server, void_user LIMIT 20)""")
def _(t):
    return audit.approver_pairs(t.payments, "2001-07-31", 720)


@query("rep_lp_reason_item", """
  SELECT c.check_id, c.processing_date, c.server, c.reason, c.discount AS amount, i.item_selection_id, i.menu_item, i.sales_category, i.tab_name FROM v_checks c JOIN v_check_items i ON i.check_id = c.check_id AND i.processing_date = c.processing_date
  WHERE c.discount >= 75 AND (lower(c.reason) LIKE '%spillage%' OR lower(c.reason) LIKE '%food quality%' OR lower(c.reason) LIKE '%didn%t like%' OR lower(c.reason) LIKE '%remake%')
    AND (upper(i.menu_item) LIKE 'BTL %' OR upper(i.menu_item) LIKE 'OWNER %' OR i.menu_item LIKE '$%' OR (lower(i.sales_category) LIKE '%liquor%' AND i.gross_price >= 100))
  ORDER BY amount DESC, c.check_id, i.item_selection_id, i.menu_item LIMIT 20""")
def _(t):
    return audit.reason_item_conflicts(t.checks, t.check_items)


@query("rep_lp_station", """
  SELECT count(*) FILTER (discount > 0) AS comps, round(sum(discount) FILTER (discount > 0), 2) AS comp_dollars, count(*) FILTER (own) AS owner_rings, round(sum(CASE WHEN discount > 0 THEN discount ELSE gross_price END) FILTER (own), 2) AS owner_dollars,
    count(*) FILTER (voided = 'true' AND gross_price >= 100) AS large_voids, round(sum(gross_price) FILTER (voided = 'true' AND gross_price >= 100), 2) AS large_void_dollars
  FROM (SELECT *, starts_with(upper(menu_item), 'OWNER ') AND (discount > 0 OR coalesce(voided = 'true', FALSE)) AS own FROM v_items WHERE server = 'srv_5')""")
def _(t):
    return audit.station_audit(t.items, "srv_5")


@query("rep_lp_station_top", "SELECT menu_item, tab_name, count(*) AS n, round(sum(discount), 2) AS dollars FROM v_items WHERE server = 'srv_5' AND discount > 0 GROUP BY 1, 2 ORDER BY dollars DESC, menu_item, tab_name LIMIT 5")
def _(t):
    return audit.station_top_items(t.items, "srv_5")


BS, BE = "1997-01-01", "2000-12-31"


@query("rep_behavior", f"""
  WITH {EL}, a AS (SELECT el.server, count(*) AS events, round(sum(discount), 2) AS dollars, count(*) FILTER (discount >= 10 AND abs(discount - round(discount)) < 0.001 AND CAST(round(discount) AS BIGINT) % 5 = 0) AS re,
      count(*) FILTER (coalesce(reason, '') NOT IN ('', 'Manager Comp - Check (100.00%)')) AS sp, round(coalesce(sum(discount) FILTER (menu_item IN ('BTL Gold 1942', 'Cristal Magnum')), 0), 2) AS retail FROM el WHERE discount > 0 AND processing_date BETWEEN DATE '{BS}' AND DATE '{BE}' GROUP BY 1),
  v AS (SELECT server, count(*) AS n, round(sum(amount), 2) AS d FROM v_payments WHERE lower(server) = lower(void_user) AND processing_date BETWEEN DATE '{BS}' AND DATE '{BE}' GROUP BY 1),
  c AS (SELECT server, round(sum(discount) FILTER (processing_date >= DATE '{BS}'), 2) AS cd, round(coalesce(sum(discount) FILTER (processing_date >= DATE '{BS}' AND (opened_hour = 23 OR opened_hour * 60 + opened_minute < 150)), 0), 2) AS late, round(coalesce(sum(discount) FILTER (processing_date < DATE '{BS}'), 0), 2) AS b
    FROM v_checks WHERE discount > 0 AND processing_date BETWEEN DATE '{BS}' - 28 AND DATE '{BE}' GROUP BY 1)
  SELECT ro.server, coalesce(events, 0) AS events, coalesce(dollars, 0) AS dollars, CASE WHEN events > 0 THEN round(re / events * 100, 1) ELSE 0 END AS round_ratio, CASE WHEN events > 0 THEN round(sp / events * 100, 1) ELSE 0 END AS specificity_pct, CASE WHEN dollars > 0 THEN round(retail / dollars * 100, 1) ELSE 0 END AS retail_mix_pct,
    coalesce(v.n, 0) AS self_approvals, coalesce(v.d, 0) AS self_dollars, CASE WHEN cd > 0 THEN round(late / cd * 100, 1) ELSE 0 END AS late_ratio, CASE WHEN b > 0 THEN round((cd - b / 4) / (b / 4) * 100, 1) END AS trend_vs_mean_pct
  FROM {ROSTER_SQL} LEFT JOIN a ON a.server = ro.server LEFT JOIN v ON v.server = ro.server LEFT JOIN c ON c.server = ro.server""")
def _(t):
    return audit.behavior(elog(t), t.payments, t.checks, roster(t), ["BTL Gold 1942", "Cristal Magnum"], BS, BE, round_floor=10.0, round_step=5)


@query("rep_shifts_worked", f"""
  WITH s AS (SELECT employee_name AS who, processing_date AS day, 'labor' AS src FROM v_labor WHERE regular_hours >= 1 UNION SELECT employee, processing_date, 'cash' FROM v_cash UNION SELECT void_approver, processing_date, 'void_appr' FROM v_payments
    UNION SELECT void_user, processing_date, 'void_user' FROM v_payments UNION SELECT server, processing_date, 'server' FROM v_checks UNION SELECT server, processing_date, 'order_srv' FROM v_orders),
  g AS (SELECT lower(who) AS who, count(DISTINCT day) AS shifts, string_agg(DISTINCT src, ',' ORDER BY src) AS sources FROM s GROUP BY 1)
  SELECT ro.server, coalesce(shifts, 0) AS shifts, coalesce(sources, '') AS sources, CASE WHEN shifts IS NULL THEN 'none' WHEN contains(sources, 'labor') THEN 'labor' ELSE 'floor_activity' END AS basis FROM {ROSTER_SQL} LEFT JOIN g ON g.who = lower(ro.server)""")
def _(t):
    return audit.shifts_worked(t.labor, t.cash_entries, t.payments, t.checks, t.orders, roster(t))


# --- reservations ---

PROG_SQL = "(VALUES " + ", ".join(f"({d}, '{w}', '{m}')" for d, w, m in rb.BIRTHDAY_PROGRAM) + ") AS pg(dow, word, mode)"
_W = lambda c, ws: "(" + " OR ".join(f"contains(lower({c}), '{w}')" for w in ws) + ")"
RV = f"""rg AS (SELECT i.processing_date AS date, i.check_id AS check_number, i.item_selection_id, i.tab_name, i.menu_item, i.gross_price, i.discount, i.discount > 0 AND abs(i.discount - i.gross_price) < 0.01 AS comped, (starts_with(upper(trim(i.menu_item)), 'OWNER ') OR starts_with(trim(i.menu_item), '$')) AND coalesce(i.discount, 0) = 0 AS cost_basis, {_W('i.tab_name', rb.BIRTHDAY_WORDS)} AS bday_tab,
      nullif(lower(regexp_extract(trim(i.tab_name), '(?i)^bday[\\s\\-\\.]*(?:f(?:ri)?|s(?:at)?|w(?:ed)?|u(?:un)?|sun)[\\s\\-\\.]+([a-z]+)', 1)), '') AS party FROM v_check_items i WHERE {_W('i.menu_item', rb.CHAMPAGNE_WORDS)}),
  rr AS (SELECT *, {_W('notes', rb.PACKAGE_WORDS)} AS registered, isodow(date) - 1 AS wd FROM v_reservations WHERE lower(status_simple) IN ('complete', 'seated') AND (coalesce({_W('tags_json', rb.BIRTHDAY_WORDS)}, FALSE) OR coalesce(contains(lower(notes), 'birthday'), FALSE) OR coalesce(contains(lower(client_requests), 'birthday'), FALSE))),
  rp AS (SELECT rr.*, word, mode FROM rr LEFT JOIN {PROG_SQL} ON pg.dow = rr.wd),
  ex AS (SELECT * FROM (SELECT reservation_id, date, first_name, registered, word, mode, trim(unnest(string_split(check_numbers, ','))) AS part FROM rp) WHERE regexp_full_match(part, '[0-9]+')),
  ec AS (SELECT *, CAST(part AS BIGINT) AS cn FROM ex),
  sp AS (SELECT reservation_id, round(coalesce(sum(p.paid), 0), 2) AS spend, count(*) AS nchecks FROM ec LEFT JOIN (SELECT c.processing_date, c.check_number, sum(y.amount) AS paid FROM v_checks c JOIN v_payments y ON y.check_id = c.check_id AND y.processing_date = c.processing_date GROUP BY 1, 2) p ON p.processing_date = ec.date AND p.check_number = ec.cn GROUP BY 1),
  oc AS (SELECT reservation_id, count(*) AS rings, count(*) FILTER (contains(lower(menu_item), word) AND CASE mode WHEN 'comped' THEN comped WHEN 'cost_basis' THEN cost_basis ELSE TRUE END) AS good FROM ec JOIN rg ON rg.date = ec.date AND rg.check_number = ec.cn WHERE registered GROUP BY 1),
  tb AS (SELECT date, party, max(tab_name) AS tab FROM rg WHERE party IS NOT NULL GROUP BY 1, 2),
  us AS (SELECT date, cn FROM ec WHERE registered UNION SELECT rg.date, rg.check_number FROM rg WHERE EXISTS (SELECT 1 FROM ec WHERE ec.registered AND ec.word IS NOT NULL AND ec.date = rg.date AND lower(trim(ec.first_name)) = rg.party)),
  pl AS (SELECT DISTINCT rg.date, pg.word FROM rg JOIN {PROG_SQL} ON contains(lower(rg.menu_item), pg.word) WHERE (comped OR cost_basis) AND bday_tab AND NOT EXISTS (SELECT 1 FROM us WHERE us.date = rg.date AND us.cn = rg.check_number)),
  rc AS (SELECT rp.reservation_id, rp.date, rp.first_name, rp.registered, CASE WHEN rp.registered THEN coalesce(spend, 0) ELSE 0 END AS spend, coalesce(rings, 0) AS rings, CASE WHEN NOT rp.registered THEN 'not_eligible' WHEN nchecks IS NULL THEN 'no_bridge' WHEN rp.word IS NULL THEN 'no_program' WHEN tb.tab IS NOT NULL THEN 'delivered_attributed'
      WHEN coalesce(good, 0) > 0 AND mode = 'cost_basis' THEN 'delivered_cost_basis' WHEN coalesce(good, 0) > 0 THEN 'delivered_comped' WHEN coalesce(rings, 0) > 0 THEN 'wrong_item' WHEN pl.word IS NOT NULL AND spend >= 200 THEN 'delivered_off_book' WHEN spend < 200 THEN 'sub_minimum' ELSE 'not_delivered' END AS status
    FROM rp LEFT JOIN sp USING (reservation_id) LEFT JOIN oc USING (reservation_id) LEFT JOIN tb ON tb.date = rp.date AND tb.party = lower(trim(rp.first_name)) LEFT JOIN pl ON pl.date = rp.date AND pl.word = rp.word)"""


def program(t):
    return t.rows(rb.BIRTHDAY_PROGRAM, "dow int, word string, mode string")


#: What this venue's own tabs hold or are called.
HOUSE_WORDS = ["owner_a", "owner_b", "host stand", "wycliffe", "tasting", "distributor"]
HOUSE_TABS = ["door", "dnl"]


def recon(t):
    return rv.reconcile(t.reservations, t.check_items, t.checks, t.payments, program(t))


@query("rep_reservation_recon", f"WITH {RV} SELECT * FROM rc")
def _(t):
    return recon(t)


@query("rep_reservation_recon_status", f"WITH {RV} SELECT status, count(*) AS n, round(sum(spend), 2) AS spend FROM rc GROUP BY 1")
def _(t):
    return rv.status_counts(recon(t))


@query("rep_reservation_rates", f"""
  WITH {RV}, g AS (SELECT count(*) AS reservations, count(*) FILTER (status NOT IN {_IN(rv.NOT_OWED)}) AS eligible, count(*) FILTER (status IN {_IN(rv.DELIVERED)}) AS delivered, count(*) FILTER (status = 'delivered_attributed') AS attributed FROM rc)
  SELECT *, round(delivered / eligible * 100, 1) AS delivery_rate, round(attributed / eligible * 100, 1) AS attributed_rate FROM g""")
def _(t):
    return rv.rates(recon(t))


@query("rep_reservation_ghosts", f"""
  WITH {RV} SELECT date, check_number, item_selection_id, menu_item, tab_name, gross_price FROM rg WHERE comped AND NOT {_W('tab_name', ['owner_a', 'owner_b', 'host stand', 'wycliffe', 'tasting', 'distributor'])} AND lower(tab_name) NOT IN ('door', 'dnl')
    AND NOT EXISTS (SELECT 1 FROM us WHERE us.date = rg.date AND us.cn = rg.check_number)""")
def _(t):
    return rv.ghosts(t.reservations, t.check_items, t.checks, program(t), HOUSE_WORDS, HOUSE_TABS)


@query("rep_reservation_ghosts_pattern", f"WITH {RV} SELECT menu_item, tab_name, count(*) AS n, round(sum(gross_price), 2) AS gross FROM rg WHERE cost_basis AND bday_tab GROUP BY 1, 2")
def _(t):
    return rv.cost_basis_pattern(t.check_items, t.checks)
