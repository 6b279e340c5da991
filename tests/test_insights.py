"""Findings whose conditions the test tables don't meet."""

from datetime import date

import pytest

from venuelake.plans import insights as ins
from venuelake.plans import sales


@pytest.mark.parametrize("name, kind, shares", [("Ann", "server", True), ("Bottle MANAGER 2", "pool", False), ("kim winner", "manager", False)])
def test_top_account_and_shared_techniques(spark, name, kind, shares):
    day = date(1998, 6, 1)
    orders = spark.createDataFrame(
        [(i, day, s, "Dine In, Take Out" if i % 3 else "Take Out", 2, 10.0, 1.0, 1.0, 0.0, v, v, None) for i, (s, v) in enumerate([(name, 500.0), ("bob", 100.0), ("cleo", 90.0), ("dan", 20.0)])],
        "order_id int, processing_date date, server string, dining_options string, guest_count int, amount double, tax double, tip double, gratuity double, total double, net double, voided string")
    items = spark.createDataFrame([("tea", 9, 1.0, None), ("rose", 1, 300.0, None)], "menu_item string, qty int, net_price double, voided string")
    payments = spark.createDataFrame([(1, "Cash", 5.0, 0.0, None)], "payment_id int, payment_type string, total double, tip double, void_ts timestamp")
    got = {r.key: (r.subject, r.value) for r in sales.weekly_insights(orders, payments, items, "1998-06-01", ["winn"], ["bottle manager"]).collect()}
    assert got["top_account"] == (kind, 500.0) and ("share_techniques" in got) == shares
    assert got["top_revenue_item"] == ("rose", 300.0) and got["best_seller"][0] == "tea" and got["dine_in_share"] == ("Dine In", 50.0)
    assert "growing_orders" not in got


def test_trends(spark):
    t = spark.createDataFrame([("cogs_pct", "rising"), ("labor_pct", "falling"), ("margin_pct", "rising"), ("avg_check", "")], "metric string, trend string")
    assert sorted((r.key, r.severity, r.subject) for r in ins.trend_insights(t).collect()) == [("cogs_pct_trend", "warning", "rising"), ("labor_pct_trend", "good", "falling")]


def test_vendors_behind_a_line(spark):
    lines = spark.createDataFrame([("a", "over_budget", 5.0, 1.5), ("b", "under_budget", -7.0, -2.0), ("c", "watch", 1.0, 0.1)], "key string, status string, variance double, variance_pct double")
    vendors = spark.createDataFrame([("a", r, f"v{r}", 100.4 - r) for r in (4, 2, 1, 3)] + [("b", 1, "x", 1.0)], "key string, rank int, vendor_normalized string, amount double")
    got = {r.key: (r.severity, r.over, r.headroom, r.vendors) for r in ins.budget_details(lines, vendors).collect()}
    assert got == {"a": ("critical", 5.0, 0.0, "v1 99, v2 98, v3 97"), "b": ("good", 0.0, 7.0, None), "c": ("warning", 1.0, 0.0, None)}
