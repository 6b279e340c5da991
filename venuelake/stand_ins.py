"""Venue tables derived by Spark from the star-schema test tables.

The reports work on venue tables (orders, payments, items, ...). Where no venue data is at
hand, these adapters compute the same columns from ``orders``, ``lineitem``, ``events`` and
``customer`` with plain column arithmetic, row for row, so the work grows with the tables.
Money is built from integer cents so that sums can be compared across engines.
"""

from __future__ import annotations

from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

MENU = [
    "Wings Basket", "OWNER Reserve Rose", "Bottle Cola", "BTL Gold 1942", "Lamb Chops",
    "Thursday Anejo", "Birthday Shot", "Hookah Mint", "Fries", "BTL Prosecco Brut",
    "Wycliff Split", "$Blue Agave BTL", "Sliders", "Bellaire Rose", "Brunch Plate",
    "OWNER Moet", "Hookah Grape", "House Beer", "Draft Wine", "Bday Cake",
    "Steak Dinner", "Cristal Magnum", "Soda", "Dessert Sampler",
]
MENU_CATEGORY = [
    "Food", "Liquor", "NA Beverage", "Liquor", "Food",
    "Liquor", "Liquor", "Hookah", "Food", "Liquor",
    "Liquor", "Liquor", "Food", "Liquor", "Brunch Food",
    "Liquor", "Shisha", "Beer", "Wine", "Dessert",
    "Food", "Liquor", "NA Beverage", "Dessert",
]
TABS = [
    "Table 4", "owner_a party", "VIP - lounge", "Bday F - ann", "Promoter Zed",
    "Spill bar", "Tasting room", "", "Distributor visit", "thursday social",
    "Bday Sat - bob", "owner_b", "Owner Tasting - May", "Patio 2", "sunday brunch crew",
    "per owner_a", "Birthday cleo", "Bar 7", "Broke glass", "friday live",
]
REASONS = [
    "Manager Comp - Check (100.00%)", "Birthday Comp (100.00%)", "Owner Comp-Check (100.00%)",
    "Employee Discount - Item (30.00%)", "Open $ Check", "Open % Item", "Spillage",
    "Food Quality", "Promoter Comp", "Customer didn't like", "Loyalty",
]
BANK_TEXT = [
    "ACH Debit NORTH FOODS ID:A17", "CHECKCARD 0115 SUN LIQUOR HOUSE", "Zelle payment to Dana Reed for music; Conf# x1",
    "WIRE TYPE:WIRE OUT BNF:GRAND EVENTS INC ID:77", "TOAST DES:DEP 240115", "TOAST DES:EOM", "Toast, Inc DES:Toast",
    "TOAST DES:REF", "TOAST, INC. DES:20250115", "Counter Credit", "Check 101", "Check 102", "Check 103", "Check 999",
    "PURCHASE AUTHORIZED ON 01/15 CITY POWER GAS", "PAYROLL SERVICE BATCH ID:9", "RENT OF HALL", "MERCHANT NET SETLMT",
    "Online Banking transfer from CHK 0001", "WIRE TYPE:WIRE IN ORIG:1/LEE PARK ID:3", "hookah lounge deposit", "unknown text",
]
BANK_CATEGORY = [
    "1. Revenue/Sales Revenue", "2. Cost of Goods Sold (COGS)/Liquor COGS", "2. Cost of Goods Sold (COGS)/Food COGS",
    "3. Labor Cost/Payroll", "4. Marketing & Entertainment/Promoters", "4. Marketing & Entertainment/Event Expense",
    "5. Operating Expenses (OPEX)/Rent", "5. Operating Expenses (OPEX)/Security", "Uncategorized",
    "1. Revenue/Hookah Sales", "5. Operating Expenses (OPEX)/Contract Labor", "Cash Deposit",
    "5. Operating Expenses (OPEX)/Insurance",
]
NOTES = [
    "", "window seat", "Birthday dinner package booked", "birthday, wants cake", "bday package for 8", "anniversary",
]
GUESTS = ["ann", "bob", "cleo", "dan", "eve", "fay"]


def _arr(values: list[str]) -> str:
    return "array(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in values) + ")"


def pick(values: list[str], index: str) -> str:
    """SQL text choosing one word of a fixed list by a row-derived number."""
    return f"element_at({_arr(values)}, CAST({index} % {len(values)} AS INT) + 1)"


_SERVER = (
    "CASE WHEN {k} % 41 = 0 THEN NULL WHEN {k} % 41 = 1 THEN '  ' "
    "WHEN {k} % 41 = 2 THEN 'Bottle Manager' ELSE concat('srv_', {k} % 40) END"
)


class Tables:
    """Lazily opened test tables and the venue tables derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def rows(self, data: list[tuple], schema: str) -> DataFrame:
        """A small parameter table (rules, caps, targets), kept local so its size is known to the optimizer."""
        fields = _parse_datatype_string(schema)
        columns = [pa.array([r[i] for r in data], type=to_arrow_type(f.dataType)) for i, f in enumerate(fields)]
        return self.spark.createDataFrame(pa.Table.from_arrays(columns, names=fields.fieldNames()), schema=fields)

    @cached_property
    def orders(self) -> DataFrame:
        return (
            self.raw("orders")
            .selectExpr("*", "CAST(round(o_totalprice * 100) AS BIGINT) AS cents")
            .selectExpr(
                "o_orderkey AS order_id",
                "o_orderdate + make_dt_interval(0, 0, CAST(o_orderkey * 37 % 1440 AS INT), 0) AS opened",
                "CAST(o_orderdate AS DATE) AS processing_date",
                _SERVER.format(k="o_custkey") + " AS server",
                "CASE o_custkey % 3 WHEN 0 THEN 'Bar' WHEN 1 THEN 'Patio' ELSE 'Main' END AS revenue_center",
                "CASE o_orderkey % 4 WHEN 0 THEN 'Dine In, Take Out' WHEN 1 THEN 'Dine In' "
                "WHEN 2 THEN ' Bar , Dine In' END AS dining_options",
                "1 + o_custkey % 6 AS guest_count",
                "(cents div 1000) / 100.0D AS amount",
                "(cents div 12000) / 100.0D AS tax",
                "(cents * (o_custkey % 25) div 100000) / 100.0D AS tip",
                "CASE WHEN o_orderkey % 3 = 0 THEN (cents div 5000) / 100.0D ELSE 0.0D END AS gratuity",
                "CASE WHEN o_orderkey % 5 = 0 THEN (cents div 8000) / 100.0D ELSE 0.0D END AS discount_amount",
                "CASE o_orderstatus WHEN 'P' THEN CASE WHEN o_orderkey % 4 = 0 THEN 'true' ELSE 'false' END "
                "WHEN 'O' THEN 'false' END AS voided",
                "o_custkey AS customer_id",
            )
            .selectExpr("*", "amount + tax + tip + gratuity AS total")
        )

    @cached_property
    def payments(self) -> DataFrame:
        return (
            self.raw("orders")
            .selectExpr("*", "CAST(round(o_totalprice * 100) AS BIGINT) AS cents")
            .selectExpr(
                "o_orderkey AS payment_id", "o_orderkey AS order_id", "o_orderkey AS check_id",
                "o_orderdate + make_dt_interval(0, 0, CAST(o_orderkey * 37 % 1440 AS INT), 0) AS paid_ts",
                "CAST(o_orderdate AS DATE) AS processing_date",
                _SERVER.format(k="o_custkey") + " AS server",
                "(cents div 1000) / 100.0D AS amount",
                "(cents * (o_custkey % 25) div 100000) / 100.0D AS tip",
                "CASE WHEN o_orderkey % 3 = 0 THEN (cents div 5000) / 100.0D ELSE 0.0D END AS gratuity",
                "(cents div 50000) / 100.0D AS card_fee",
                "CASE o_orderstatus WHEN 'F' THEN 'CAPTURED' WHEN 'O' THEN "
                "CASE WHEN o_orderkey % 2 = 0 THEN 'AUTHORIZED' ELSE 'CAPTURE_IN_PROGRESS' END "
                "ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'VOIDED' ELSE 'DENIED' END END AS status",
                "CASE o_orderpriority WHEN '1-URGENT' THEN 'Cash' WHEN '4-NOT SPECIFIED' THEN 'Gift Card' "
                "ELSE 'Credit' END AS payment_type",
                "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE lpad(CAST(o_custkey % 10000 AS STRING), 4, '0') END AS card_digits",
                "CASE o_custkey % 5 WHEN 0 THEN 'VISA' WHEN 1 THEN 'AMEX' WHEN 2 THEN 'MC' WHEN 3 THEN 'DISC' END AS card_type",
                "CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN CASE o_orderkey % 4 "
                "WHEN 0 THEN concat('srv_', o_custkey % 40) WHEN 1 THEN 'a1b2c3d4-0000-1111-2222-abcdefabcdef@pos' "
                "WHEN 2 THEN concat('mgr_', o_custkey % 3) ELSE 'qa@example.com' END END AS void_user",
                "CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN concat('mgr_', o_custkey % 3) END AS void_approver",
                "o_custkey % 400 AS void_delay",
            )
            .selectExpr(
                "*", "amount + tip + gratuity AS total",
                "CASE WHEN void_user IS NOT NULL THEN paid_ts + make_dt_interval(0, 0, 0, void_delay) END AS void_ts",
            )
            .drop("void_delay")
        )

    @cached_property
    def items(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .selectExpr("*", "CAST(round(l_extendedprice) AS BIGINT) AS cents", "CASE WHEN l_discount >= 0.095D AND l_linestatus = 'F' THEN 100 ELSE CAST(round(l_discount * 100) AS BIGINT) END AS pct")
            .selectExpr(
                "l_orderkey * 8 + l_linenumber AS item_selection_id", "l_orderkey AS order_id", "l_orderkey AS check_id",
                "l_shipdate + make_dt_interval(0, 0, CAST(l_orderkey * 37 % 1440 AS INT), 0) AS order_ts",
                "CAST(l_shipdate AS DATE) AS processing_date",
                pick(MENU, "l_partkey") + " AS menu_item", pick(MENU_CATEGORY, "l_partkey") + " AS sales_category",
                "concat('grp_', l_suppkey % 8) AS menu_group",
                "CASE l_linenumber % 3 WHEN 0 THEN 'Dinner' WHEN 1 THEN 'Late' ELSE 'Brunch' END AS service",
                "CAST(l_quantity AS BIGINT) AS qty",
                "cents / 100.0D AS gross_price", "(cents * pct div 100) / 100.0D AS discount",
                "(cents - cents * pct div 100) / 100.0D AS net_price",
                "CASE l_returnflag WHEN 'R' THEN CASE WHEN l_linenumber % 4 = 0 THEN 'true' ELSE 'false' END "
                "WHEN 'A' THEN 'false' END AS voided",
                "concat('srv_', l_suppkey % 40) AS server", pick(TABS, "l_orderkey") + " AS tab_name",
                "concat('cook_', l_partkey % 15) AS cook",
            )
        )

    @cached_property
    def check_items(self) -> DataFrame:
        """Item lines dated by their check (item line joined to its order)."""
        o = self.raw("orders").selectExpr("o_orderkey AS check_id", "CAST(o_orderdate AS DATE) AS processing_date")
        return self.items.drop("processing_date").join(o, "check_id")

    @cached_property
    def checks(self) -> DataFrame:
        return (
            self.raw("orders")
            .selectExpr("*", "CAST(round(o_totalprice * 100) AS BIGINT) AS cents")
            .selectExpr(
                "o_orderkey AS check_id", "o_orderkey AS check_number", "CAST(o_orderdate AS DATE) AS processing_date",
                _SERVER.format(k="o_custkey") + " AS server",
                "o_custkey AS customer_id", "concat('Guest ', o_custkey) AS customer",
                "CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN concat(2000000000 + o_custkey, '.0') "
                "WHEN 2 THEN '5555555555' ELSE concat('1', 3000000000 + o_custkey) END AS phone",
                "CASE WHEN o_custkey % 3 = 0 THEN concat('g', o_custkey, '@mail.test') END AS email",
                "CASE WHEN o_orderkey % 7 = 0 THEN 0.0D ELSE (cents div 1000) / 100.0D END AS total",
                "CASE WHEN o_orderkey % 2 = 0 THEN (cents div 2000) / 100.0D ELSE 0.0D END AS discount",
                pick(REASONS, "o_orderkey") + " AS reason", pick(TABS, "o_orderkey") + " AS tab_name",
                "date_format(o_orderdate + make_dt_interval(0, 0, CAST(o_orderkey * 37 % 1440 AS INT), 0), 'h:mm a') AS opened_time",
            )
        )

    @cached_property
    def kitchen(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .selectExpr(
                "l_orderkey * 8 + l_linenumber AS ticket_id", "CAST(l_shipdate AS DATE) AS processing_date",
                "concat('stn_', l_suppkey % 6) AS station",
                "l_shipdate + make_dt_interval(0, 0, CAST(l_orderkey * 37 % 1440 AS INT), 0) AS fired_ts",
                "CASE WHEN l_returnflag = 'N' AND l_linenumber % 3 = 0 THEN NULL ELSE concat('cook_', l_partkey % 15) END AS fulfilled_by",
                "CASE WHEN l_returnflag = 'N' AND l_linenumber % 3 = 0 THEN NULL "
                "ELSE CAST(l_quantity AS INT) * 20 + l_linenumber * 7 END AS secs",
            )
            .selectExpr("*", "fired_ts + make_dt_interval(0, 0, 0, secs) AS fulfilled_ts")
            .drop("secs")
        )

    @cached_property
    def cash_entries(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "event_id AS entry_id", "CAST(ts AS DATE) AS processing_date", "concat('srv_', user_id % 40) AS employee",
            "CASE event_type WHEN 'view' THEN 'NO_SALE' WHEN 'click' THEN 'CASH_COLLECTED' WHEN 'signup' THEN 'PAY_OUT' "
            "WHEN 'error' THEN 'CLOSE_OUT_SHORTAGE' ELSE 'CLOSE_OUT_OVERAGE' END AS action",
            "value AS amount",
        )

    @cached_property
    def labor(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS guid", "CAST(o_orderdate AS DATE) AS processing_date",
            "concat('srv_', o_custkey % 40) AS employee_name",
            "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Bartender' WHEN o_orderpriority = '5-LOW' THEN '' "
            "WHEN o_custkey % 2 = 0 THEN 'Server' ELSE 'Barback' END AS job_title",
            "(o_custkey % 9) + 0.5D AS regular_hours", "CASE WHEN o_custkey % 9 = 8 THEN 1.5D ELSE 0.0D END AS overtime_hours",
        )

    @cached_property
    def bank(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .selectExpr("*", "CAST(round(l_extendedprice) AS BIGINT) AS cents")
            .selectExpr(
                "CAST(l_shipdate AS DATE) AS transaction_date", pick(BANK_TEXT, "l_partkey") + " AS description",
                "CASE WHEN l_returnflag = 'N' THEN cents / 100.0D ELSE -cents / 100.0D END AS amount",
                "CASE WHEN l_returnflag = 'N' THEN 'credit' ELSE 'debit' END AS transaction_type",
                "cents / 100.0D AS abs_amount", pick(BANK_CATEGORY, "l_suppkey") + " AS category",
                "CASE WHEN l_linestatus = 'F' THEN 'auto' WHEN l_linenumber % 2 = 0 THEN 'manual' ELSE 'uncategorized' END AS category_source",
                "CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE concat('vendor_', l_suppkey % 60) END AS vendor_normalized",
                "concat('file_', l_linenumber) AS source_file",
            )
        )

    @cached_property
    def reservations(self) -> DataFrame:
        return (
            self.raw("orders")
            .selectExpr("*", "CAST(round(o_totalprice * 100) AS BIGINT) AS cents")
            .selectExpr(
                "o_orderkey AS reservation_id", "CAST(o_orderdate AS DATE) AS date",
                pick(GUESTS, "o_custkey") + " AS first_name",
                "1 + o_custkey % 12 AS max_guests",
                "CASE o_orderstatus WHEN 'F' THEN 'Complete' WHEN 'O' THEN 'Seated' ELSE 'Canceled' END AS status_simple",
                "CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN concat(o_orderkey, ', ', o_orderkey + 1) "
                "WHEN 2 THEN concat('x', o_orderkey) ELSE CAST(o_orderkey AS STRING) END AS check_numbers",
                pick(NOTES, "o_orderkey") + " AS notes",
                "CASE WHEN o_custkey % 3 = 0 THEN '[{\"name\":\"Birthday\"}]' END AS tags_json",
                "CASE o_orderkey % 11 WHEN 0 THEN 'Birthday candle, please' WHEN 1 THEN 'quiet corner' END AS client_requests",
                "(cents div 1000) / 100.0D AS total_payment",
                "o_orderdate + make_dt_interval(0, 0, CAST(o_orderkey * 11 % 1440 AS INT), 0) AS updated",
            )
        )
