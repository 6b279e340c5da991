"""Column expressions on small literal frames."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from venuelake.functions import clean, dates, numbers, text


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_business_date_before_and_after_cutoff(spark):
    rows = [(datetime(2025, 1, 16, 3, 59),), (datetime(2025, 1, 16, 4, 0),)]
    got = values(spark, rows, "ts timestamp_ntz", dates.business_date(F.col("ts")).alias("d"))
    assert got == [(date(2025, 1, 15),), (date(2025, 1, 16),)]


def test_calendar_windows():
    today = date(2026, 4, 22)
    assert dates.last_full_week(today) == (date(2026, 4, 13), date(2026, 4, 19))
    assert dates.prior_full_week(today) == (date(2026, 4, 6), date(2026, 4, 12))
    assert dates.trailing_days(today, 30) == (date(2026, 3, 23), date(2026, 4, 21))
    months = dates.trailing_months(date(2025, 1, 10), 12)
    assert len(months) == 12 and months[0][0] == "2024-01" and months[-1][0] == "2024-12"
    assert months[1][2] == date(2024, 2, 29)
    assert dates.pay_period(date(2026, 4, 22), date(2026, 4, 5)) == (date(2026, 4, 6), date(2026, 4, 19))


def test_prior_period_clamps(spark):
    rows = [(date(2025, 3, 31), date(2025, 3, 31)), (date(2024, 2, 29), date(2024, 3, 10))]
    s, e = dates.prior_period(F.col("s"), F.col("e"))
    got = values(spark, rows, "s date, e date", s.alias("a"), e.alias("b"))
    assert got == [(date(2025, 2, 28), date(2025, 2, 28)), (date(2023, 2, 28), date(2023, 3, 10))]


def test_number_rules(spark):
    got = values(spark, [(1.0, 0.0), (3.0, 2.0)], "a double, b double", numbers.ratio_or_null(F.col("a"), F.col("b")).alias("x"),
                 numbers.ratio_or_zero(F.col("a"), F.col("b")).alias("y"), numbers.pct_change(F.col("a"), F.col("b")).alias("z"))
    assert got == [(None, 0.0, None), (1.5, 1.5, 50.0)]


@pytest.mark.parametrize("raw, expected", [
    ("01/15/25 06:00 PM", "2025-01-15 18:00:00"), ("1/5/2025 6:05 AM", "2025-01-05 06:05:00"), ("2025-01-15 18:00:00", "2025-01-15 18:00:00"),
    ("1/15/25", "2025-01-15 00:00:00"), ("2025-01-15", "2025-01-15 00:00:00"), ("soon", "soon"),
])
def test_datetime_layouts(spark, raw, expected):
    assert values(spark, [(raw,)], "c string", clean.normalized_datetime_text(F.col("c")).alias("x")) == [(expected,)]


def test_flags_numbers_durations(spark):
    got = values(spark, [("Yes", "1,234.50", "1 hour and 2 minutes"), ("0", "n/a", "02:03"), ("maybe", "", "x")], "f string, n string, d string",
                 clean.to_flag(F.col("f")).alias("f"), clean.to_number(F.col("n")).alias("n"), clean.duration_seconds(F.col("d")).alias("d"))
    assert got == [(True, 1234.5, 3720), (False, None, 123), (None, None, None)]


def test_header_names():
    assert [clean.clean_name(c) for c in ("Order Id", "Order #", "2nd Name", "Net/Gross (all)", "Void?")] == [
        "order_id", "order_number", "_2nd_name", "net_gross_all", "void"]


def test_total_needs_every_part(spark):
    df = spark.createDataFrame([(1.0, 2.0, None, 4.0)], "amount double, tax double, tip double, gratuity double")
    assert clean.with_total(df).first().total is None
    assert "total" not in clean.with_total(df.drop("tip")).columns


def test_load_date(spark):
    got = values(spark, [("/x/20250115/a.csv",), ("/x/load=2025-01-15/a.csv",), ("/x/a.csv",)], "p string", clean.load_date_from_path(F.col("p")).alias("d"))
    assert got == [(date(2025, 1, 15),), (date(2025, 1, 15),), (None,)]


@pytest.mark.parametrize("raw, expected", [
    ("Zelle payment to Ann Lee Conf# x1", "Ann Lee"), ('Zelle payment from Bo for rent"; Conf# x', "Bo"), ("ACH Debit SYSCO CORP ID:55", "SYSCO CORP"),
    ("PURCHASE AUTHORIZED ON 01/15 COSTCO", "COSTCO"), ("PURCHASE ON 01/15 COSTCO", "COSTCO"), ("CHECKCARD 0115 STORE", "STORE"), ("plain", "plain"),
])
def test_normalize_description(spark, raw, expected):
    assert values(spark, [(raw,)], "c string", text.normalize_description(F.col("c")).alias("x")) == [(expected,)]


def test_wire_phone_name_lists(spark):
    rows = [("WIRE TYPE:WIRE OUT BNF:ACME INC. ID:9", "15125550100.0", "Ann  Lee Ray", " Bar , Dine", "12, x, 7")]
    got = values(spark, rows, "w string, p string, n string, l string, k string", text.wire_party(F.col("w")).alias("a"), text.clean_phone(F.col("p")).alias("b"),
                 text.first_name(F.col("n")).alias("c"), text.rest_of_name(F.col("n")).alias("d"), text.first_of_list(F.col("l")).alias("e"), text.int_list(F.col("k")).alias("f"))
    assert got == [("ACME INC.", "+15125550100", "Ann", "Lee Ray", "Bar", [12, 7])]


def test_shapes_of_layouts(spark):
    """A layout is tried on every text it fits and on few others."""
    from venuelake.functions import dates
    formats = ["M/d/yy h:mm a", "M/d/yyyy h:mm a", "yyyy-MM-dd HH:mm:ss", "M/d/yy", "M/d/yyyy", "yyyy-MM-dd", "yyyyMMdd", "yyyy-MM-dd'T'HH:mm:ss"]
    texts = ["1/2/25", "01/02/2025", "001/2/25", "1/2/25 3:04 pm", "1/2/2025 3:04 PM", "2025-01-02", "2025-01-02 03:04:05", "20250102", "-2025-01-02", "+12025-01-02", "2025-01-02T03:04:05", "x", "", "1/2/25 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for f in formats:
        plain = F.try_to_timestamp("t", F.lit(f)).cast("timestamp_ntz")
        assert df.where(~plain.eqNullSafe(dates.first_timestamp(F.col("t"), [f]))).count() == 0, f
    assert df.where(F.col("t").rlike(dates.layout_shape("M/d/yy"))).count() == 2
