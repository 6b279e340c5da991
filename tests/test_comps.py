"""Comp period on the five-check example."""

from datetime import date

from venuelake.operators.classify import match_cap
from venuelake.plans import comps as cp

D = date(2026, 4, 16)
CHECKS = [("c1", "srv_a", "Manager Comp - Check (100.00%)", 100.0), ("c2", "srv_a", "Birthday Comp (100.00%)", 50.0), ("c3", "srv_b", "Owner Comp-Check (100.00%)", 200.0),
          ("c4", "srv_a", "Employee Discount - Item (30.00%)", 15.0), ("c5", "srv_c", "Open $ Check", 75.0)]


def house(spark):
    caps = spark.createDataFrame([(1, "thu", "Thu", 3, 1, "external", ["social"])], "position int, key string, event string, dow int, cap int, cap_type string, signals array<string>")
    return cp.House([("pat", "P")], caps, spark.createDataFrame([("BTL 1942", 900.0)], "menu_item string, retail double"), spark.createDataFrame([("OWNER X", "X")], "menu_item string, retail_item string"))


def frames(spark, items=()):
    c = spark.createDataFrame([(k, D, s, r, a) for k, s, r, a in CHECKS], "check_id string, processing_date date, server string, reason string, discount double")
    i = spark.createDataFrame([(n, k, D, "s", item, "Liquor", g, d, tab, None) for n, (k, item, g, d, tab) in enumerate(items)],
                              "item_selection_id int, check_id string, processing_date date, server string, menu_item string, sales_category string, gross_price double, discount double, tab_name string, voided string")
    return c, i


def test_period_totals(spark):
    c, i = frames(spark)
    comps = cp.comp_checks(c, i, house(spark))
    total = cp.counted(comps).groupBy().sum("amount").first()[0]
    assert total == 425.0
    from pyspark.sql import functions as F
    b = {r.bucket: r.total for r in cp.by_bucket(comps, F.lit(50000.0)).collect()}
    assert b == {"discretionary_manager": 100.0, "programmatic_birthday": 50.0, "owner_discretion": 200.0, "uncategorized_open_dollar": 75.0}
    s = {r.server: r for r in cp.by_server(comps).collect()}
    assert (s["srv_a"].total, s["srv_a"].discretionary, s["srv_a"].programmatic) == (150.0, 100.0, 50.0)


def test_tab_then_item_then_reason(spark):
    c, i = frames(spark, [("c1", "OWNER X", 30.0, 30.0, None), ("c5", "Wings", 20.0, 20.0, "social club")])
    got = {r.check_id: r.bucket for r in cp.comp_checks(c, i, house(spark)).collect()}
    assert got["c1"] == "owner_discretion" and got["c5"] == "programmatic_promoter"
    assert {r.check_id: r.override for r in cp.mismatches(cp.comp_checks(c, i, house(spark))).collect()} == {"c1": "item", "c5": "tab"}


def test_caps_count_every_bottle_of_a_single_cap_day(spark):
    h = house(spark)
    c, i = frames(spark, [("c1", "BTL 1942", 900.0, 900.0, "any"), ("c2", "BTL B", 300.0, 300.0, "social"), ("c3", "BTL B", 300.0, 300.0, "pat party"), ("c5", "BTL B", 300.0, 300.0, "bday x")])
    pay = spark.createDataFrame([("c2", 10.0)], "check_id string, amount double")
    r = cp.caps(cp.enriched_log(i, c, pay, h), h).first()
    assert (r.bottles, r.premium_bottles, r.excess, r.over_cap, r.clawback) == (2, 1, 1, True, 280.0)
    assert match_cap(i, h.caps).filter("cap_key = 'thu'").count() == 1
