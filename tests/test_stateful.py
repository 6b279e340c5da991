"""Streams with event-time state: equal to batch over triggers out of order, with bounded state and safe replays."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from venuelake.session import shared_dir
from venuelake.streaming import jobs, stateful

SCHEMA = "id int, ts timestamp_ntz, value double"
START = datetime(2025, 3, 1)


def deliver(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def deliveries(spark, seed=3, n=6):
    """Files mostly in order of time, with rows that come hours or days late, repeats, and rows without a time."""
    rng, src, rows = random.Random(seed), shared_dir(spark, "src"), []
    for k in range(n):
        part = [(k * 100 + i, START + timedelta(hours=12 * k, minutes=rng.randrange(720)), 1.0 + i) for i in range(8)]
        part += [(k * 100 + 50 + i, START + timedelta(minutes=rng.randrange(60 * 12 * (k + 1))), 0.5) for i in range(3)]
        part += rng.sample(rows, min(len(rows), 6)) + part[:2] + ([(900 + k, None, 1.0)] if k % 2 else [])
        rows += part
        deliver(spark, src, part)
    return src, rows


def test_hours_equal_batch_and_late_rows_are_corrections(spark):
    src, rows = deliveries(spark)
    path = shared_dir(spark, "hours")
    schema = spark.read.parquet(src).schema
    run = lambda: stateful.windowed_revenue(spark, src, schema, lambda s: s.filter("value > 0"), "ts", "value", "4 hours", 1, path)
    want = {}
    for _, ts, v in rows:
        if ts:
            h = ts.replace(minute=0, second=0)
            want[h] = (want.get(h, (0, 0))[0] + 1, want.get(h, (0, 0))[1] + v)
    got = {r.hour_start: (r.txns, r.revenue) for r in run().collect()}
    assert got == {h: (n, round(v, 2)) for h, (n, v) in want.items()}
    late = stateful._batches(spark, f"{path}/late", SCHEMA)
    assert late.where("ts is not null").count() > 0 and late.where("ts is null").count() == sum(ts is None for _, ts, _ in rows)
    # Only the last hours are still open: what a batch lands shrinks to the windows the watermark hasn't passed.
    deliver(spark, src, [(1000, START + timedelta(days=30), 2.0), (1001, START, 7.0)])
    h = START
    again = {r.hour_start: (r.txns, r.revenue) for r in run().collect()}
    assert again[START + timedelta(days=30)] == (1, 2.0) and again[h] == (want.get(h, (0, 0))[0] + 1, round(want.get(h, (0, 0))[1] + 7.0, 2))
    assert {r.hour_start: (r.txns, r.revenue) for r in run().collect()} == again


def test_events_once_however_late(spark):
    src, rows = deliveries(spark, 4)
    other = shared_dir(spark, "other")
    for k in (3, 1, 2, 0):
        deliver(spark, other, rows[k::4])
    path = shared_dir(spark, "unique")
    schema = spark.read.parquet(src).schema
    run = lambda: stateful.unique_events(spark, [src, other], schema, "id", "ts", "6 hours", 1, path)
    want = sorted({r for r in rows}, key=str)
    assert sorted((tuple(r) for r in run().collect()), key=str) == want
    deliver(spark, other, rows[:5] + [(5000, START, 9.0)])
    assert sorted((tuple(r) for r in run().collect()), key=str) == sorted([*want, (5000, START, 9.0)], key=str)


def test_cursors_are_committed_with_their_rows(spark):
    src = shared_dir(spark, "feed")
    schema = "feed string, day date, v int"
    for days in ([9, 3], [1], [5, 10]):
        spark.createDataFrame([("a" if d % 2 else "b", datetime(2025, 1, d).date(), d) for d in days], schema).coalesce(1).write.mode("append").parquet(src)
    path = shared_dir(spark, "cursor")
    run = lambda: stateful.land_with_cursor(jobs.file_stream(spark, src, schema, 1), path, f"{path}/ck", "feed", "day")
    run()
    run()
    start = spark.createDataFrame([("b", datetime(2025, 1, 20).date()), ("c", datetime(2025, 1, 2).date())], "feed string, cursor date")
    assert {r.feed: r.cursor.day for r in stateful.cursors(spark, path, "feed string, cursor date").collect()} == {"a": 9, "b": 10}
    assert {r.feed: r.cursor.day for r in stateful.cursors(spark, path, "feed string, cursor date", start).collect()} == {"a": 9, "b": 20, "c": 2}
    # A batch whose cursor isn't there yet doesn't count; its replay writes both again.
    spark.createDataFrame([("a", datetime(2025, 1, 30).date(), 30)], schema).write.parquet(f"{path}/rows/batch=000000007")
    assert sorted(r.v for r in stateful.committed_rows(spark, path, schema).collect()) == [1, 3, 5, 9, 10]


def test_incremental_start_reads_the_days_from_it_on(spark):
    src, target = shared_dir(spark, "versions"), shared_dir(spark, "seen")
    schema = "id int, at timestamp_ntz"
    rows = spark.createDataFrame([(d, START + timedelta(days=d, hours=5)) for d in range(40)], schema).withColumn("day", F.to_date("at"))
    rows.write.partitionBy("day").parquet(src)
    rows.where("id < 30").write.partitionBy("day").parquet(target)
    out = stateful.since_watermark(spark, src, target, rows.drop("day").schema, "at", "day")
    assert sorted(r.id for r in out.collect()) == list(range(28, 40))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(at)" in plan
    first = stateful.since_watermark(spark, src, shared_dir(spark, "none"), rows.drop("day").schema, "at", "day", lookback="3 days")
    assert sorted(r.id for r in first.collect()) == [36, 37, 38, 39]
