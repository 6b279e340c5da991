"""DuckDB text of the venue tables, one CTE body per name, for the SQL checks."""

from __future__ import annotations

from .. import stand_ins as si


def _list(values: list[str], index: str) -> str:
    body = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{body}])[CAST({index} % {len(values)} AS INT) + 1]"


def _server(k: str) -> str:
    return (
        f"CASE WHEN {k} % 41 = 0 THEN NULL WHEN {k} % 41 = 1 THEN '  ' "
        f"WHEN {k} % 41 = 2 THEN 'Bottle Manager' ELSE 'srv_' || ({k} % 40) END"
    )


_O = "(SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)"
_L = "(SELECT *, CAST(round(l_extendedprice) AS BIGINT) AS cents, CASE WHEN l_discount >= 0.095 AND l_linestatus = 'F' THEN 100 ELSE CAST(round(l_discount * 100) AS BIGINT) END AS pct FROM lineitem)"
_MIN = "to_minutes(CAST({k} % 1440 AS INT))"

CTES: dict[str, str] = {
    "v_orders": f"""
      SELECT *, amount + tax + tip + gratuity AS total FROM (
      SELECT o_orderkey AS order_id, o_orderdate + to_minutes(CAST(o_orderkey * 37 % 1440 AS INT)) AS opened,
        CAST(o_orderdate AS DATE) AS processing_date, {_server('o_custkey')} AS server,
        CASE o_custkey % 3 WHEN 0 THEN 'Bar' WHEN 1 THEN 'Patio' ELSE 'Main' END AS revenue_center,
        CASE o_orderkey % 4 WHEN 0 THEN 'Dine In, Take Out' WHEN 1 THEN 'Dine In' WHEN 2 THEN ' Bar , Dine In' END AS dining_options,
        1 + o_custkey % 6 AS guest_count, (cents // 1000) / 100.0::DOUBLE AS amount, (cents // 12000) / 100.0::DOUBLE AS tax,
        (cents * (o_custkey % 25) // 100000) / 100.0::DOUBLE AS tip,
        CASE WHEN o_orderkey % 3 = 0 THEN (cents // 5000) / 100.0::DOUBLE ELSE 0.0::DOUBLE END AS gratuity,
        CASE WHEN o_orderkey % 5 = 0 THEN (cents // 8000) / 100.0::DOUBLE ELSE 0.0::DOUBLE END AS discount_amount,
        CASE o_orderstatus WHEN 'P' THEN CASE WHEN o_orderkey % 4 = 0 THEN 'true' ELSE 'false' END WHEN 'O' THEN 'false' END AS voided,
        o_custkey AS customer_id FROM {_O})""",
    "v_payments": f"""
      SELECT * EXCLUDE (void_delay), amount + tip + gratuity AS total,
        CASE WHEN void_user IS NOT NULL THEN paid_ts + to_seconds(void_delay) END AS void_ts FROM (
      SELECT o_orderkey AS payment_id, o_orderkey AS order_id, o_orderkey AS check_id,
        o_orderdate + to_minutes(CAST(o_orderkey * 37 % 1440 AS INT)) AS paid_ts, CAST(o_orderdate AS DATE) AS processing_date,
        {_server('o_custkey')} AS server, (cents // 1000) / 100.0::DOUBLE AS amount,
        (cents * (o_custkey % 25) // 100000) / 100.0::DOUBLE AS tip,
        CASE WHEN o_orderkey % 3 = 0 THEN (cents // 5000) / 100.0::DOUBLE ELSE 0.0::DOUBLE END AS gratuity,
        (cents // 50000) / 100.0::DOUBLE AS card_fee,
        CASE o_orderstatus WHEN 'F' THEN 'CAPTURED' WHEN 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'AUTHORIZED' ELSE 'CAPTURE_IN_PROGRESS' END
          ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'VOIDED' ELSE 'DENIED' END END AS status,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Cash' WHEN '4-NOT SPECIFIED' THEN 'Gift Card' ELSE 'Credit' END AS payment_type,
        CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') END AS card_digits,
        CASE o_custkey % 5 WHEN 0 THEN 'VISA' WHEN 1 THEN 'AMEX' WHEN 2 THEN 'MC' WHEN 3 THEN 'DISC' END AS card_type,
        CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN CASE o_orderkey % 4 WHEN 0 THEN 'srv_' || (o_custkey % 40)
          WHEN 1 THEN 'a1b2c3d4-0000-1111-2222-abcdefabcdef@pos' WHEN 2 THEN 'mgr_' || (o_custkey % 3) ELSE 'qa@example.com' END END AS void_user,
        CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 'mgr_' || (o_custkey % 3) END AS void_approver,
        o_custkey % 400 AS void_delay FROM {_O})""",
    "v_items": f"""
      SELECT l_orderkey * 8 + l_linenumber AS item_selection_id, l_orderkey AS order_id, l_orderkey AS check_id,
        l_shipdate + to_minutes(CAST(l_orderkey * 37 % 1440 AS INT)) AS order_ts, CAST(l_shipdate AS DATE) AS processing_date,
        {_list(si.MENU, 'l_partkey')} AS menu_item, {_list(si.MENU_CATEGORY, 'l_partkey')} AS sales_category,
        'grp_' || (l_suppkey % 8) AS menu_group,
        CASE l_linenumber % 3 WHEN 0 THEN 'Dinner' WHEN 1 THEN 'Late' ELSE 'Brunch' END AS service,
        CAST(l_quantity AS BIGINT) AS qty, cents / 100.0::DOUBLE AS gross_price, (cents * pct // 100) / 100.0::DOUBLE AS discount,
        (cents - cents * pct // 100) / 100.0::DOUBLE AS net_price,
        CASE l_returnflag WHEN 'R' THEN CASE WHEN l_linenumber % 4 = 0 THEN 'true' ELSE 'false' END WHEN 'A' THEN 'false' END AS voided,
        'srv_' || (l_suppkey % 40) AS server, {_list(si.TABS, 'l_orderkey')} AS tab_name, 'cook_' || (l_partkey % 15) AS cook FROM {_L}""",
    "v_check_items": """
      SELECT i.* EXCLUDE (processing_date), CAST(o_orderdate AS DATE) AS processing_date FROM v_items i JOIN orders o ON i.check_id = o.o_orderkey""",
    "v_checks": f"""
      SELECT o_orderkey AS check_id, o_orderkey AS check_number, CAST(o_orderdate AS DATE) AS processing_date, {_server('o_custkey')} AS server,
        o_custkey AS customer_id, 'Guest ' || o_custkey AS customer,
        CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN (2000000000 + o_custkey) || '.0' WHEN 2 THEN '5555555555' ELSE '1' || (3000000000 + o_custkey) END AS phone,
        CASE WHEN o_custkey % 3 = 0 THEN 'g' || o_custkey || '@mail.test' END AS email,
        CASE WHEN o_orderkey % 7 = 0 THEN 0.0::DOUBLE ELSE (cents // 1000) / 100.0::DOUBLE END AS total,
        CASE WHEN o_orderkey % 2 = 0 THEN (cents // 2000) / 100.0::DOUBLE ELSE 0.0::DOUBLE END AS discount,
        {_list(si.REASONS, 'o_orderkey')} AS reason, {_list(si.TABS, 'o_orderkey')} AS tab_name,
        (o_orderkey * 37 % 1440) // 60 AS opened_hour, (o_orderkey * 37 % 1440) % 60 AS opened_minute FROM {_O}""",
    "v_kitchen": """
      SELECT * EXCLUDE (secs), fired_ts + to_seconds(secs) AS fulfilled_ts FROM (
      SELECT l_orderkey * 8 + l_linenumber AS ticket_id, CAST(l_shipdate AS DATE) AS processing_date, 'stn_' || (l_suppkey % 6) AS station,
        l_shipdate + to_minutes(CAST(l_orderkey * 37 % 1440 AS INT)) AS fired_ts,
        CASE WHEN l_returnflag = 'N' AND l_linenumber % 3 = 0 THEN NULL ELSE 'cook_' || (l_partkey % 15) END AS fulfilled_by,
        CASE WHEN l_returnflag = 'N' AND l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_quantity AS INT) * 20 + l_linenumber * 7 END AS secs FROM lineitem)""",
    "v_cash": """
      SELECT event_id AS entry_id, CAST(ts AS DATE) AS processing_date, 'srv_' || (user_id % 40) AS employee,
        CASE event_type WHEN 'view' THEN 'NO_SALE' WHEN 'click' THEN 'CASH_COLLECTED' WHEN 'signup' THEN 'PAY_OUT'
          WHEN 'error' THEN 'CLOSE_OUT_SHORTAGE' ELSE 'CLOSE_OUT_OVERAGE' END AS action, value AS amount FROM events""",
    "v_labor": """
      SELECT o_orderkey AS guid, CAST(o_orderdate AS DATE) AS processing_date, 'srv_' || (o_custkey % 40) AS employee_name,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 'Bartender' WHEN o_orderpriority = '5-LOW' THEN '' WHEN o_custkey % 2 = 0 THEN 'Server' ELSE 'Barback' END AS job_title,
        (o_custkey % 9) + 0.5::DOUBLE AS regular_hours, CASE WHEN o_custkey % 9 = 8 THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END AS overtime_hours FROM orders""",
    "v_bank": f"""
      SELECT CAST(l_shipdate AS DATE) AS transaction_date, {_list(si.BANK_TEXT, 'l_partkey')} AS description,
        CASE WHEN l_returnflag = 'N' THEN cents / 100.0::DOUBLE ELSE -cents / 100.0::DOUBLE END AS amount,
        CASE WHEN l_returnflag = 'N' THEN 'credit' ELSE 'debit' END AS transaction_type, cents / 100.0::DOUBLE AS abs_amount,
        {_list(si.BANK_CATEGORY, 'l_suppkey')} AS category,
        CASE WHEN l_linestatus = 'F' THEN 'auto' WHEN l_linenumber % 2 = 0 THEN 'manual' ELSE 'uncategorized' END AS category_source,
        CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE 'vendor_' || (l_suppkey % 60) END AS vendor_normalized,
        'file_' || l_linenumber AS source_file FROM {_L}""",
    "v_reservations": f"""
      SELECT o_orderkey AS reservation_id, CAST(o_orderdate AS DATE) AS date, {_list(si.GUESTS, 'o_custkey')} AS first_name,
        1 + o_custkey % 12 AS max_guests, CASE o_orderstatus WHEN 'F' THEN 'Complete' WHEN 'O' THEN 'Seated' ELSE 'Canceled' END AS status_simple,
        CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN o_orderkey || ', ' || (o_orderkey + 1) WHEN 2 THEN 'x' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS check_numbers,
        {_list(si.NOTES, 'o_orderkey')} AS notes, CASE WHEN o_custkey % 3 = 0 THEN '[{{"name":"Birthday"}}]' END AS tags_json,
        CASE o_orderkey % 11 WHEN 0 THEN 'Birthday candle, please' WHEN 1 THEN 'quiet corner' END AS client_requests, (cents // 1000) / 100.0::DOUBLE AS total_payment, o_orderdate + to_minutes(CAST(o_orderkey * 11 % 1440 AS INT)) AS updated FROM {_O}""",
}
_NEEDS = {"v_check_items": ["v_items"]}


def with_tables(body: str) -> str:
    """Prefix a query with the CTEs it mentions. A body may start with its own ``WITH``."""
    used: list[str] = []

    def add(name: str) -> None:
        for dep in _NEEDS.get(name, []):
            add(dep)
        if name not in used:
            used.append(name)

    for name in CTES:
        if name in body:
            add(name)
    body = body.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n]})" for n in used)
    if not used:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
