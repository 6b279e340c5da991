"""File and feed sources on small files."""

from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from venuelake.session import shared_dir
from venuelake.sources import feeds, files, status


def land(spark, name, content, encoding="utf-8"):
    p = Path(shared_dir(spark, "src")) / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_bytes(content.encode(encoding))
    return str(p)


def test_daily_csv(spark):
    p = land(spark, "20250115/OrderDetails.csv", "Location,Order Id,Order #,# of Guests,Opened,Amount,Tax,Tip,Gratuity,Total\nV1,ORD,12345,4,01/15/25 06:00 PM,100.0,8.0,x,2.0,125.50\n")
    r = files.read_daily_csv(spark, p, ("opened",)).first()
    assert r.processing_date == date(2025, 1, 15) and r.order_number == 12345.0 and r.guest_count == 4.0 and r.opened == "2025-01-15 18:00:00"
    assert r.tip is None and r.calculated_total is None and r.total == 125.5 and r.order_id is None
    assert files.read_daily_csv(spark, land(spark, "20250116/OrderDetails.csv", "Location,Order Id\n")).count() == 0


def test_bank_statement(spark):
    text = "﻿Summary,,\nTotal,1\n\nDate,Description,Amount,Running Bal.\n01/05/2025,\"A, B\",\"-1,200.50\",\"5,000.00\"\n1/6/25,DEP,10,\n\n"
    rows = files.read_bank_csv(spark, land(spark, "stmt.csv", text)).orderBy("transaction_date").collect()
    assert [(r.transaction_date, r.description, r.amount, r.running_balance, r.transaction_type, r.abs_amount, r.source_file) for r in rows] == [
        (date(2025, 1, 5), "A, B", -1200.5, 5000.0, "debit", 1200.5, "stmt.csv"), (date(2025, 1, 6), "DEP", 10.0, None, "credit", 10.0, "stmt.csv")]
    latin = files.read_bank_csv(spark, land(spark, "l.csv", "Date,Description,Amount\n1/6/25,CAFÉ,1\n", "latin-1")).first()
    assert latin.description == "CAFÉ" and latin.running_balance is None


def test_register(spark):
    r = files.read_check_register(spark, land(spark, "r.csv", "Chk #,Pay To,Amt,Cat\nNo. 1234,Acme,$1,Rent\n,x,1,y\n")).collect()
    assert [(x.check_number, x.payee, x.amount, x.memo, x.category) for x in r] == [("1234", "Acme", 1.0, None, "Rent")]


def test_feed_a(spark):
    lines = ['{"date":"2026-04-20","amount":42.5,"name":"N","merchant_name":"M","original_description":"ORIG","personal_finance_category":{"primary":"P","detailed":"D"}}',
             '{"date":"2026-04-20","amount":-100,"name":"N"}', '{"amount":1,"name":"N"}', '{"date":"2026-04-20","name":"N"}', '{"date":"2026-04-20","amount":1,"name":" "}']
    rows = feeds.bank_feed_a(feeds.read_json(spark, land(spark, "a.json", "\n".join(lines)), feeds.FEED_A_SCHEMA)).orderBy("amount").collect()
    assert [(r.amount, r.transaction_type, r.abs_amount, r.description, r.category, r.category_source, r.vendor_normalized) for r in rows] == [
        (-42.5, "debit", 42.5, "ORIG", "D", "feed_a", "M"), (100.0, "credit", 100.0, "N", None, "uncategorized", "N")]


def test_reservations(spark):
    line = '{"id":"r1","date":"2026-04-20","arrival_time":"20:00","max_guests":"many","is_vip":true,"updated":"2026-04-20T01:02:03Z","tags":[{"name":"Birthday"}],"pos_tickets":[],"check_numbers":"1, 2","total_payment":12.5}'
    out = feeds.read_reservations(spark, land(spark, "r.json", line + '\n{"date":"2026-04-20"}\n'))
    assert len(out.columns) == 56
    r = out.first()
    assert out.count() == 1 and r.max_guests is None and r.is_vip is True and r.tags_json == '[{"name":"Birthday"}]' and r.pos_tickets_json is None and r.raw_json == line and r.total_payment == 12.5


def test_drift_and_freshness(spark):
    a = spark.createDataFrame([(1, None)], "x int, y string")
    b = spark.createDataFrame([(1, "q")], "x int, z string")
    assert sorted(map(tuple, status.schema_drift(a, b).collect())) == [("new", "y", 0), ("removed", "z", 1)]
    assert status.schema_drift(a, a).count() == 0
    s = status.table_status({"t": spark.createDataFrame([(date(2025, 1, 1),)], "d date")}, {"t": "d"})
    assert status.freshness(s, "2025-01-05", {}).first().stale is True


def test_statement_of_ten_columns(spark):
    from venuelake.sources.files import parse_bank_text
    text = "Preamble\nDate,a,b,c,d,e,f,Description,Amount,Running Bal.\n1/2/2025,1,2,3,4,5,6,\"Say \"\"hi\"\", friend\",\"1,234.50\",99.25\n1/3/2025,,,,,,,plain,-2.00,"
    got = parse_bank_text(spark.createDataFrame([(text, "f")], "value string, source_file string")).orderBy("transaction_date").collect()
    assert [(r.description, r.amount, r.running_balance, r.transaction_type) for r in got] == [('Say "hi", friend', 1234.5, 99.25, "credit"), ("plain", -2.0, None, "debit")]


def test_headers_of_each_file(spark):
    """Other column orders, spellings and widths in one folder; a file without a column has NULL there."""
    p = Path(land(spark, "20250115/OrderDetails.csv", "Order Id,Amount,Server\n1,\"1,000.5\",a\n\n2,2,b\n"))
    for day, text in (("20250116", "﻿Server,Channel,Order Id,Amount,Amount\r\nc,web,3,3,9\r\n"), ("20250117", ""), ("20250118", "Order Id\n"), ("20250119", "\n amount ,Order Id\n4,5\n")):
        (p.parent.parent / day).mkdir()
        (p.parent.parent / day / "OrderDetails.csv").write_bytes(text.encode())
    got = sorted((r.order_id, r.amount, r.server, r.channel, r.processing_date.day) for r in files.read_daily_csv(spark, str(p.parent.parent)).collect())
    assert got == [(1.0, 1000.5, "a", None, 15), (2.0, 2.0, "b", None, 15), (3.0, 3.0, "c", "web", 16), (5.0, None, None, None, 19)]


def test_large_statement_is_split(spark):
    """One statement is read by several tasks; its preamble lies in the first of them."""
    text = "Summary,,\n" * 50 + "Date,Description,Amount\n" + "".join(f"1/2/2025,line {i},{i}\n" for i in range(4000))
    path = land(spark, "big.csv", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        out = files.read_bank_csv(spark, path)
        from venuelake.sources import delimited
        assert delimited.file_lines(spark, path).rdd.getNumPartitions() >= 8
        assert out.count() == 4000 and out.agg(F.sum("amount")).first()[0] == 3999 * 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_registers_of_two_layouts(spark):
    p = Path(land(spark, "a.csv", "Chk #,Pay To,Amt,Cat\nNo. 1,Acme,\"$1,000\",Rent\n"))
    (p.parent / "b.csv").write_text("Category,Memo,Vendor,Total,Check Number\n,\"say \"\"hi\"\", x\",Bob,2,#2\n")
    got = sorted(tuple(r) for r in files.read_check_register(spark, str(p.parent)).collect())
    assert got == [("1", "Acme", 1000.0, None, "Rent"), ("2", "Bob", 2.0, 'say "hi", x', None)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_headers_in_one_pass(spark):
    """A file's header is found without sorting, shuffling or reading the lines again."""
    from venuelake.sources import delimited
    p = land(spark, "20250115/OrderDetails.csv", "Order Id,Amount\n1,2\n")
    heads = delimited.headers(delimited.file_lines(spark, p))
    assert plan(heads).count("Scan text") == 1 and "Join" not in plan(heads)
    assert [(r.header, r.utf8) for r in heads.collect()] == [("Order Id,Amount", True)]


def test_rows_stay_where_they_are_read(spark):
    """Rows meet headers as small stored tables: nothing that grows with the rows is shuffled or sorted."""
    statement = files.read_bank_csv(spark, land(spark, "s.csv", "Summary,,\nDate,Description,Amount\n1/6/25,\"say \"\"a, b\"\"\",1\n1/7/2025,c,2\n"))
    assert sorted((r.description, r.amount, r.transaction_date) for r in statement.collect()) == [("c", 2.0, date(2025, 1, 7)), ('say "a, b"', 1.0, date(2025, 1, 6))]
    register = files.read_check_register(spark, land(spark, "r.csv", "Chk #,Pay To,Amt\n7,Acme,1\n"))
    for df in (statement, register):
        assert "SortMergeJoin" not in plan(df) and "hashpartitioning" not in plan(df)


def test_punches_stay_where_they_are_read(spark):
    """Employees and jobs are small stored tables: punches are neither shuffled nor sorted by the few guids they share."""
    line = '{"guid":"1","employeeReference":{"guid":"e"},"jobReference":{"guid":"j"},"inDate":"2026-04-20T18:00:00.000+0100","outDate":"2026-04-20T18:00:00Z"}'
    names = spark.range(200_000).selectExpr("concat('e', nullif(id % 40, 0)) AS guid", "'x' AS name")
    labor = feeds.labor_entries(feeds.read_json(spark, land(spark, "l.json", line), feeds.LABOR_SCHEMA), names.union(spark.createDataFrame([("e", "Ann")], "guid string, name string")), spark.createDataFrame([("j", "Cook")], "guid string, title string"))
    r = labor.first()
    assert (r.employee_name, r.job_title, r.clock_out - r.clock_in) == ("Ann", "Cook", timedelta(hours=1))
    assert "SortMergeJoin" not in plan(labor) and "hashpartitioning" not in plan(labor)


def test_iso_layouts(spark):
    texts = ["2026-04-20T01:02:03.000+0000", "2026-04-20T01:02:03.000Z", "2026-04-20T02:02:03+01:00", "2026-04-20T01:02:03+0000", "2026-04-20T01:02:03Z", "later", "1:2", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", feeds.utc_timestamp(F.col("t")).cast("long").alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == [1776646923] * 5 + [None] * 3
