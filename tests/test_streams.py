"""Streaming jobs: replayed batches change nothing, batch and stream agree."""

from pyspark.sql import functions as F

from venuelake.session import shared_dir
from venuelake.streaming import jobs

SF = "/root/testdata/sf0.001"


def test_replayed_batch_changes_nothing(spark):
    path = shared_dir(spark, "replay")
    b = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, v int, t string")
    order = [F.desc("v")]
    for i in (0, 1, 1):
        jobs.write_changes(b if i else b.filter("v = 1"), i, path, ["k"], order)
    now = jobs.current_rows(jobs.read_changes(spark, path, b.schema), ["k"], order).collect()
    assert sorted(map(tuple, now)) == [("a", 2, "y"), ("b", 1, "z")]


def test_stream_restarts_from_its_checkpoint(spark):
    src, path, ck = shared_dir(spark, "in"), shared_dir(spark, "out"), shared_dir(spark, "ck")
    rows = spark.createDataFrame([(1, 10)], "k int, v int")
    rows.write.mode("append").parquet(src)
    run = lambda: jobs.run_upsert_stream(jobs.file_stream(spark, src, rows.schema), path, ck, ["k"], lambda: [F.desc("v")])
    run()
    spark.createDataFrame([(1, 5), (2, 7)], rows.schema).write.mode("append").parquet(src)
    run()
    run()
    now = jobs.current_rows(jobs.read_changes(spark, path, rows.schema), ["k"], [F.desc("v")]).collect()
    assert sorted(map(tuple, now)) == [(1, 10), (2, 7)]


def _files_out_of_order(spark):
    """Four files of one event each, the newest first."""
    src = shared_dir(spark, "disorder")
    for k, ts in enumerate(["2025-01-05 20:00:00", "2025-01-05 10:30:00", "2025-01-01 10:10:00", "2025-01-05 10:00:00"]):
        spark.createDataFrame([(k % 3, ts, 1.0)], "id int, ts string, value double").selectExpr("id", "CAST(ts AS timestamp) AS ts", "value").write.mode("append").parquet(src)
    return src, spark.read.parquet(src).schema


def test_late_files_count_in_the_hourly_totals(spark):
    src, schema = _files_out_of_order(spark)
    got = jobs.windowed_revenue(spark, src, schema, lambda s: s, "ts", "value", max_files=1).collect()
    assert sorted((str(r.hour_start), r.txns, r.revenue) for r in got) == [("2025-01-01 10:00:00", 1, 1.0), ("2025-01-05 10:00:00", 2, 2.0), ("2025-01-05 20:00:00", 1, 1.0)]


def test_late_repeats_are_dropped_once(spark):
    src, schema = _files_out_of_order(spark)
    got = jobs.deduplicated(spark, [src, src], schema, "id", "ts", max_files=1).collect()
    assert sorted((r.id, str(r.ts)) for r in got) == [(0, "2025-01-05 20:00:00"), (1, "2025-01-05 10:30:00"), (2, "2025-01-01 10:10:00")]


def test_compaction_keeps_the_current_rows(spark):
    path = shared_dir(spark, "compact")
    b = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, v int, t string")
    order = [F.desc("v")]
    for i in range(3):
        jobs.write_changes(b, i, path, ["k"], order)
    fresh = jobs.compact(spark, path, b.schema, ["k"], order)
    changes = jobs.read_changes(spark, fresh, b.schema)
    assert sorted(map(tuple, changes.collect())) == [("a", 2, "y", 2), ("b", 1, "z", 2)]
    jobs.write_changes(b.filter("k = 'b'").withColumn("v", F.lit(9)), 3, fresh, ["k"], order)
    assert {r.k: r.v for r in jobs.current_rows(jobs.read_changes(spark, fresh, b.schema), ["k"], order).collect()} == {"a": 2, "b": 9}
