"""Order statistics and shares against brute force, heavy ties and one hot group included."""

import random

from pyspark.sql import functions as F

from venuelake.operators import orderstats, windows
from venuelake.plans import finance as fin


def test_upper_median_against_sorting(spark):
    rng = random.Random(5)
    data = [("hot", round(rng.choice([5.0, 5.0, rng.uniform(0, 3000)]), 2)) for _ in range(4000)] + [(f"k{i % 7}", round(rng.uniform(0, 2000), 2)) for i in range(500)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: r.median for r in orderstats.upper_median(df, ["k"], "v").collect()}
    for k in {k for k, _ in data}:
        v = sorted(x for kk, x in data if kk == k)
        assert got[k] == v[len(v) // 2]


def test_top_shares_against_sorting(spark):
    rng = random.Random(7)
    v = [round(rng.choice([100.0, rng.uniform(0, 50000)]), 2) for _ in range(3001)]
    got = {r.label: r for r in orderstats.top_shares(spark.createDataFrame([(x,) for x in v], "v double"), "v", [("a", 0.05), ("b", 0.5), ("c", 10), ("d", 99999)]).collect()}
    s = sorted(v, reverse=True)
    for label, n in (("a", 150), ("b", 1500), ("c", 10), ("d", 3001)):
        assert got[label].members == n and abs(got[label].amount - sum(s[:n])) < 0.005


def test_vendor_anomaly_threshold(spark):
    df = spark.createDataFrame([("2025-01", "a", 1000.0), ("2025-02", "a", 2000.0), ("2025-01", "b", 1000.0), ("2025-02", "b", 1100.0), ("2025-02", "c", 5.0)], "month string, vendor string, spend double")
    got = [(r.vendor, r.change_pct, r.severity) for r in fin.vendor_anomalies(df).collect()]
    assert got == [("a", 100.0, "high")]


def test_trend_ties_count_as_rising(spark):
    df = spark.createDataFrame([("x", m, v) for m, v in enumerate([9.0, 1.0, 1.0, 2.0])] + [("y", m, v) for m, v in enumerate([3.0, 2.0, 1.0])] + [("z", 0, 1.0)], "k string, m int, v double")
    assert {r.k: r.trend for r in windows.trend3(df, ["k"], "m", "v").collect()} == {"x": "rising", "y": "falling", "z": ""}


def test_allocations_add_up(spark):
    costs = spark.createDataFrame([("v", "2025-01", 100.0, 1, ["a", "b", "c"]), ("w", "2025-01", 50.0, 1, None)], "vendor string, month string, amount double, txns int, events array<string>")
    parts = fin.split_evenly(costs).select("event", "share").collect()
    assert len(parts) == 3 and abs(sum(p.share for p in parts) - 100.0) <= 0.03
    rev = spark.createDataFrame([("a", "2025-01", 300.0), ("b", "2025-01", 100.0)], "event string, month string, adj_revenue double")
    alloc = fin.allocate_by_revenue(rev, spark.createDataFrame([("2025-01", 80.0)], "month string, c double"), "c", "x").collect()
    assert {r.event: r.x for r in alloc} == {"a": 60.0, "b": 20.0}


def test_prime_cost_month(spark):
    from datetime import date
    d = date(2025, 1, 15)
    orders = spark.createDataFrame([(1, d, 500000.0, 20000.0, 100000.0, None)], "order_id int, processing_date date, amount double, tip double, gratuity double, voided string")
    cats = [("2. COGS/Liquor COGS", 80000.0), ("2. COGS/Food COGS", 25000.0), ("2. COGS/Supplies", 5000.0), ("3. Labor Cost/Payroll", 180000.0), ("5. OPEX/Rent", 20000.0)]
    bank = spark.createDataFrame([(d, c, -a, a, "debit") for c, a in cats] + [(d, "1. Revenue/Side Sales", 15000.0, 15000.0, "credit")], "transaction_date date, category string, amount double, abs_amount double, transaction_type string")
    r = fin.prime_cost(orders, bank, [("2025-01", date(2025, 1, 1), date(2025, 1, 31))], ["side sales"]).first()
    assert (r.gross_revenue, r.prime_cost, r.cogs_total, r.labor_ex_tips) == (635000.0, 285000.0, 105000.0, 60000.0) and 44 < r.prime_pct < 46
