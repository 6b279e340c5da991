"""Merges: same result when run twice, precedence of manual edits, twins, deletes."""

from datetime import date

from pyspark.sql import functions as F

from venuelake.operators import merge
from venuelake.sources import sinks
from venuelake.session import shared_dir

BANK = "transaction_date date, description string, amount double, category string, category_source string, vendor_normalized string, source_file string"
D = date(2025, 1, 5)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_twice_is_upsert_once(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, n string, v double")
    s = spark.createDataFrame([(2, "x", 5.0), (2, "y", 9.0), (3, "z", 3.0)], "k int, n string, v double")
    once = merge.upsert(t, s, ["k"], [F.desc("v")])
    assert rows(once) == [(1, "a", 1.0), (2, "y", 9.0), (3, "z", 3.0)]
    assert rows(merge.upsert(once, s, ["k"], [F.desc("v")])) == rows(once)


def test_replace_days_on_disk_twice(spark):
    base = spark.createDataFrame([(date(2025, 1, 1), 1), (date(2025, 1, 1), 2), (date(2025, 1, 2), 3)], "processing_date date, v int")
    new = spark.createDataFrame([(date(2025, 1, 1), 9)], "processing_date date, v int")
    path = shared_dir(spark, "t")
    sinks.write_days(base, path)
    for _ in range(2):
        sinks.write_days(new, path)
        assert rows(sinks.read_days(spark, path, base, "processing_date")) == [(date(2025, 1, 1), 9), (date(2025, 1, 2), 3)]


def test_bank_merges(spark):
    t = spark.createDataFrame([(D, "A", -10.0, "hand", "manual", "V", "f0"), (D, "B", -20.0, None, "uncategorized", None, "f0")], BANK)
    s = spark.createDataFrame([(D, "A", -10.001, "auto", "auto", "W", "f1"), (D, "B", -20.0, "auto", "auto", "W", "f1"), (D, "C", 5.0, "auto", "auto", "W", "f1")], BANK)
    order = [F.asc("category")]
    csv = {r.description: r for r in merge.merge_bank_statement(t, s, order).collect()}
    assert csv["A"].category == "hand" and csv["A"].source_file == "f1" and csv["B"].category == "auto" and len(csv) == 3
    posted = {r.description: r for r in merge.merge_bank_posted(t, s, order).collect()}
    assert posted["A"].source_file == "f0" and posted["B"].source_file == "f1"
    fill = {r.description: r for r in merge.merge_bank_fill(t, s, order).collect()}
    assert fill["A"].vendor_normalized == "V" and fill["B"].category == "auto" and fill["B"].category_source == "uncategorized"


def test_cross_source_twins(spark):
    b = spark.createDataFrame([
        (D, "RAW ONE", -10.0, "c", "csv", "V", "f"), (D, "one", -10.0, "c", "feed", "V", "f"),
        (D, "RAW 1", -7.0, "c", "csv", "V", "f"), (D, "RAW 2", -7.0, "c", "csv", "V", "f"), (D, "seven", -7.0, "c", "feed", "V", "f"), (D, "no vendor", -10.0, "c", "csv", None, "f")], BANK)
    left = {r.description for r in merge.drop_cross_source_twins(b, F.col("category_source") == "feed").collect()}
    assert left == {"one", "RAW 1", "RAW 2", "seven", "no vendor"}


def test_newest_version_wins(spark):
    t = spark.createDataFrame([("a", 5, "old"), ("b", 9, "keep")], "id string, updated int, v string")
    s = spark.createDataFrame([("a", 6, "new"), ("a", 4, "stale"), ("b", 8, "stale"), (None, 1, "no id")], "id string, updated int, v string")
    assert rows(merge.merge_newest(t, s, "id", "updated", [F.asc("v")])) == [("a", 6, "new"), ("b", 9, "keep")]


def test_rules_delete_seed_and_bulk_delete(spark):
    r = spark.createDataFrame([("Sysco", "a"), ("rent", "b")], "keyword string, category string")
    up = merge.upsert_rules(r, spark.createDataFrame([("SYSCO", "z")], "keyword string, category string"), [F.asc("category")])
    assert rows(up) == [("SYSCO", "z"), ("rent", "b")]
    assert rows(merge.delete_rules(r, spark.createDataFrame([("RENT",)], "keyword string"))) == [("Sysco", "a")]
    empty = r.filter("keyword = 'none'")
    assert merge.seed_rules(empty, r).count() == 2 and merge.seed_rules(r, r).count() == 2
    b = spark.createDataFrame([(D, "A", None), (D, "A", 1.0)], "transaction_date date, description string, amount double")
    assert rows(merge.delete_transactions(b, spark.createDataFrame([(D, "A", 0.0)], b.schema))) == [(D, "A", 1.0)]


def test_posted_feed_keeps_what_it_does_not_bring(spark):
    schema = BANK + ", running_balance double"
    t = spark.createDataFrame([(D, "A", -10.0, "old", "auto", "V", "f0", 100.0), (D, "B", -1.0, "x", None, "V", "f0", 5.0)], schema)
    s = spark.createDataFrame([(D, "A", -10.0, "new", "auto", "W", "f1", None), (D, "B", -1.0, "new", "auto", "W", "f1", None)], schema)
    got = merge.merge_bank_posted(t, s, [F.asc("category")])
    assert rows(got) == [(D, "A", -10.0, "new", "auto", "W", "f1", 100.0), (D, "B", -1.0, "x", None, "V", "f0", 5.0)]


def test_two_edits_of_one_line_agree_with_the_log(spark):
    bank = spark.createDataFrame([(D, "A", -10.0, "old", "auto", "V", "f0")], BANK)
    edits = spark.createDataFrame([(D, "A", -10.0, "first", 1), (D, "A", -10.0, "second", 2)], "transaction_date date, description string, amount double, category string, at int")
    newest = [F.desc("at")]
    assert merge.recategorize(bank, edits, newest).first().category == merge.recategorize_audit(bank, edits, newest).first().new_category == "second"


def test_twins_of_earlier_batches_stay(spark):
    b = spark.createDataFrame([(D, "a", -1.0, "c", "auto", "V", "csv"), (D, "a!", -1.0, "c", "feed", "V", "batch1"), (D, "b", -2.0, "c", "auto", "V", "csv"), (D, "b!", -2.0, "c", "feed", "V", "batch2")], BANK)
    got = merge.drop_cross_source_twins(b, F.col("category_source") == "feed", F.col("source_file") == "batch2")
    assert sorted(r.description for r in got.collect()) == ["a", "a!", "b!"]


def test_merge_touches_only_its_partitions(spark):
    """Untouched partitions keep their files, a key that moves leaves its old partition, an emptied partition goes."""
    from pathlib import Path

    from venuelake.session import shared_dir
    from venuelake.sources import sinks

    schema = "id int, v int, part int"
    path = shared_dir(spark, "parts")
    sinks.write_days(spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 1), (4, 1, 2), (5, 1, None)], schema), path, "part")
    files = lambda: {str(f.relative_to(path)) for f in Path(path).rglob("*.parquet")}
    before = files()
    inc = spark.createDataFrame([(1, 2, 0), (3, 2, 5), (6, 2, 5), (6, 1, 5)], schema)
    apply = lambda old, new: merge.upsert(old, new, ["id"], [F.desc("v")])
    sinks.merge_partitions(spark, path, inc, "part", apply, moving=["id"])
    got = sorted((r.id, r.v, r.part) for r in spark.read.schema(schema).parquet(path).collect())
    assert got == [(1, 2, 0), (2, 1, 0), (3, 2, 5), (4, 1, 2), (5, 1, None), (6, 2, 5)]
    kept = {f for f in before if f.startswith(("part=2/", "part=__HIVE"))}
    assert len(kept) == 2 and kept <= files() and not any(f.startswith("part=1/") for f in files())
    sinks.merge_partitions(spark, path, inc, "part", apply, moving=["id"])
    assert sorted((r.id, r.v, r.part) for r in spark.read.schema(schema).parquet(path).collect()) == got


def test_run_log_is_counted_while_writing(spark):
    from venuelake.session import shared_dir
    from venuelake.sources import sinks, status

    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", None), ("c", None), ("x", 1)], "file string, v int")
    path = shared_dir(spark, "observed")
    log = sinks.load_observed(rows, F.col("v") > 0, path, ["a", "b", "c", "d"])
    want = [("(run)", 4, 2, "partial_success"), ("a", 2, 0, "success"), ("b", 1, 1, "partial"), ("c", 0, 1, "error"), ("d", 0, 0, "skipped"), (None, 1, 0, "success")]
    assert sorted(map(tuple, log.collect()), key=str) == sorted(want, key=str) and spark.read.parquet(path).count() == 4
    assert sorted(map(tuple, status.run_log(status.run_counts(rows, F.col("v") > 0)).where("file in ('a', 'b', 'c')").collect())) == sorted(want[1:4])
