"""Guest reports with their SQL."""

from __future__ import annotations

from ..plans import guests as gs
from .registry import query

S, E = "1999-01-01", "2001-12-31"
CARDS = f"""cd AS (SELECT *, CAST(paid_ts AS DATE) AS day, card_digits || '-' || coalesce(card_type, '') AS card FROM v_payments WHERE status IN ('CAPTURED', 'AUTHORIZED', 'CAPTURE_IN_PROGRESS')
    AND card_digits IS NOT NULL AND card_digits <> '' AND CAST(paid_ts AS DATE) BETWEEN DATE '{S}' AND DATE '{E}' QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY processing_date DESC) = 1)"""
SEG = """CASE WHEN recency_days > 90 THEN 'dormant' WHEN {v} >= 10 AND recency_days <= 30 THEN 'champions' WHEN {v} >= 10 THEN 'loyal' WHEN {v} >= 5 AND recency_days <= 45 THEN 'regulars'
  WHEN {v} >= 3 AND recency_days > 45 THEN 'at_risk' WHEN {v} >= 2 THEN 'returning' WHEN recency_days <= 30 THEN 'new' ELSE 'dormant' END"""
RFM_END = "2001-08-15"
RFM = f"""{CARDS}, g AS (SELECT *, {SEG.format(v='visit_days')} AS segment FROM (SELECT card, count(*) AS txn_count, count(DISTINCT day) AS visit_days, round(sum(amount), 2) AS total_spend, round(round(sum(amount) * 100) / count(*)) / 100 AS avg_per_visit,
    round(sum(tip) / nullif(sum(amount), 0) * 100, 1) AS tip_pct, min(day) AS first_seen, max(day) AS last_seen, CAST(DATE '{RFM_END}' - max(day) AS INT) AS recency_days FROM cd GROUP BY 1))"""


def cards(t):
    return gs.card_payments(t.payments, S, E)


def guest_rows(t):
    return gs.rfm(cards(t), RFM_END)


@query("rep_guest_rfm", f"WITH {RFM} SELECT * FROM g")
def _(t):
    return guest_rows(t)


@query("rep_guest_rfm_kpis", f"""
  WITH {RFM} SELECT count(*) AS total_guests, count(*) FILTER (visit_days > 1) AS repeat_guests, round(sum(total_spend), 2) AS total_revenue, round(sum(total_spend) FILTER (visit_days > 1), 2) AS repeat_revenue,
    round(count(*) FILTER (visit_days > 1) / count(*) * 100, 1) AS repeat_pct, round(sum(total_spend) FILTER (visit_days > 1) / sum(total_spend) * 100, 1) AS repeat_rev_pct,
    round(sum(visit_days) FILTER (visit_days > 1) / count(*) FILTER (visit_days > 1), 1) AS avg_visits_repeat, round(sum(total_spend) / sum(txn_count), 2) AS avg_spend, round(sum(total_spend) / count(*), 2) AS rev_per_guest FROM g""")
def _(t):
    return gs.guest_kpis(guest_rows(t))


_TOT = "round(guests / (SELECT count(*) FROM g) * 100, 1) AS pct_guests, round(revenue / (SELECT sum(total_spend) FROM g) * 100, 1) AS pct_revenue, round(revenue / guests, 2) AS avg_spend"


@query("rep_guest_rfm_segments", f"WITH {RFM} SELECT *, {_TOT} FROM (SELECT segment, count(*) AS guests, round(sum(total_spend), 2) AS revenue FROM g GROUP BY 1)")
def _(t):
    return gs.segments(guest_rows(t))


@query("rep_guest_rfm_bands", f"""
  WITH {RFM} SELECT *, {_TOT} FROM (SELECT CASE WHEN visit_days = 1 THEN '1 visit' WHEN visit_days <= 3 THEN '2-3 visits' WHEN visit_days <= 6 THEN '4-6 visits' WHEN visit_days <= 12 THEN '7-12 visits' WHEN visit_days <= 25 THEN '13-25 visits' ELSE '26+ visits' END AS band,
    count(*) AS guests, round(sum(total_spend), 2) AS revenue FROM g GROUP BY 1)""")
def _(t):
    return gs.frequency_bands(guest_rows(t))


@query("rep_guest_rfm_concentration", f"""
  WITH {RFM}, r AS (SELECT total_spend AS v, row_number() OVER (ORDER BY total_spend DESC) AS i, count(*) OVER () AS n, sum(total_spend) OVER () AS s FROM g)
  SELECT label, CAST(greatest(1, floor(n * k)) AS BIGINT) AS members, round(sum(v), 2) AS amount, round(sum(v) / any_value(s) * 100, 1) AS pct FROM r, (VALUES ('Top 5%', 0.05), ('Top 10%', 0.10), ('Top 20%', 0.20), ('Top 50%', 0.50)) AS f(label, k)
  WHERE i <= greatest(1, floor(n * k)) GROUP BY 1, 2""")
def _(t):
    return gs.concentration(guest_rows(t))


@query("rep_guest_rfm_top", f"WITH {RFM} SELECT * FROM g WHERE visit_days > 1 ORDER BY visit_days DESC, total_spend DESC, card LIMIT 50")
def _(t):
    return gs.top_repeat(guest_rows(t))


@query("rep_guest_monthly", f"""
  WITH {CARDS}, k AS (SELECT *, strftime(day, '%Y-%m') AS month FROM cd), f AS (SELECT card, min(month) AS fm FROM k GROUP BY 1),
  m AS (SELECT k.month, count(DISTINCT k.card) AS active_guests, count(DISTINCT CASE WHEN k.month = fm THEN k.card END) AS new_guests, count(DISTINCT CASE WHEN k.month <> fm THEN k.card END) AS returning_guests, round(sum(amount), 2) AS total_revenue,
    round(sum(CASE WHEN k.month <> fm THEN amount ELSE 0 END), 2) AS repeat_revenue FROM k JOIN f USING (card) GROUP BY 1)
  SELECT *, round(repeat_revenue / total_revenue * 100, 1) AS repeat_rev_pct FROM m""")
def _(t):
    return gs.monthly_flow(cards(t))


PATTERNS = f"""{CARDS}, tr AS (SELECT card, CASE WHEN count(DISTINCT day) >= 10 THEN 'Champions' WHEN count(DISTINCT day) >= 5 THEN 'Regulars' WHEN count(DISTINCT day) >= 2 THEN 'Returning' ELSE 'New' END AS tier FROM cd GROUP BY 1),
  pt AS (SELECT tier, dayname(day) AS day_name, CAST(dayofweek(day) + 1 AS INT) AS dow_num, CAST(extract(hour FROM paid_ts) AS INT) AS hour, count(*) AS txn_count, round(sum(amount), 2) AS revenue, round(round(sum(amount) * 100) / count(*)) / 100 AS avg_txn FROM cd JOIN tr USING (card) GROUP BY 1, 2, 3, 4)"""


@query("rep_guest_patterns", f"WITH {PATTERNS} SELECT * FROM pt")
def _(t):
    return gs.patterns(cards(t))


@query("rep_guest_patterns_weekday", f"""
  WITH {PATTERNS} SELECT dow_num, day_name, CAST(sum(txn_count) AS BIGINT) AS txns, round(sum(revenue), 2) AS revenue, {', '.join(f"CAST(coalesce(sum(txn_count) FILTER (tier = '{x}'), 0) AS BIGINT) AS {x.lower()}_txns" for x in ('Champions', 'Regulars', 'Returning', 'New'))} FROM pt GROUP BY 1, 2""")
def _(t):
    return gs.pattern_by_weekday(gs.patterns(cards(t)))


CONTACTS = f"""ct AS (SELECT *, {SEG.format(v='visits')} AS segment FROM (SELECT customer_id, name, coalesce(trim(email), '') AS email, CASE WHEN p IS NULL OR p IN ('', '5555555555', '15555555555') THEN '' WHEN length(t) = 10 THEN '+1' || t ELSE t END AS phone, visits, total_spend, avg_check, first_visit, last_visit, linked_card, linked_card_type,
    CAST(DATE '{RFM_END}' - last_visit AS INT) AS recency_days FROM (SELECT *, CASE WHEN length(p) = 11 AND starts_with(p, '1') THEN substr(p, 2) ELSE p END AS t FROM (
    SELECT c.customer_id, max(c.customer) AS name, trim(replace(max(c.phone), '.0', '')) AS p, max(c.email) AS email, count(DISTINCT c.check_id) AS visits, round(sum(c.total), 2) AS total_spend, round(round(sum(c.total) * 100) / count(*)) / 100 AS avg_check,
      min(c.processing_date) AS first_visit, max(c.processing_date) AS last_visit, max(pl.card_digits) AS linked_card, max(pl.card_type) AS linked_card_type
    FROM (SELECT * FROM v_checks WHERE processing_date BETWEEN DATE '{S}' AND DATE '{RFM_END}') c LEFT JOIN (SELECT * FROM v_payments WHERE status IN ('CAPTURED', 'AUTHORIZED', 'CAPTURE_IN_PROGRESS') AND CAST(paid_ts AS DATE) BETWEEN DATE '{S}' AND DATE '{RFM_END}') pl ON pl.check_id = c.check_id GROUP BY 1))))"""


@query("rep_guest_contacts", f"WITH {CONTACTS} SELECT * FROM ct")
def _(t):
    return gs.contacts(t.checks, t.payments, S, RFM_END)


EXPORT = f"""WITH {CONTACTS} SELECT split_part(name, ' ', 1) AS first_name, split_part(name, ' ', 2) AS last_name, email, phone, visits, total_spend, avg_check, first_visit, last_visit, sg AS segment,
    concat_ws('; ', sg, CASE WHEN total_spend >= 500 THEN 'High Spender' WHEN total_spend >= 100 THEN 'Medium Spender' END, CASE WHEN visits >= 5 THEN 'Frequent Visitor' WHEN visits >= 2 THEN 'Repeat Visitor' END, 'House Guest') AS tags
  FROM (SELECT *, CASE segment WHEN 'at_risk' THEN 'At Risk' ELSE upper(segment[1]) || segment[2:] END AS sg FROM ct) WHERE email <> '' OR phone <> ''"""


@query("snk_contacts_export", EXPORT)
def _(t):
    """Writes the contact CSV to the shared folder and reads it back."""
    from ..sources.sinks import round_trip_csv
    return round_trip_csv(gs.contact_export(gs.contacts(t.checks, t.payments, S, RFM_END)), "contacts")
