"""File sources: daily POS extracts, bank statements, check registers.

All files of all days go through one read; the day comes from the path. Files are read by line (``delimited``), so a large one
is split among tasks, and each file by its own header.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..functions.text import digits_only
from . import delimited
from .sinks import stage

# Headers whose column name does not follow the cleaning rule.
HEADER_NAMES = {
    "# of Guests": "guest_count",
    "Table": "table_loc",
    "Type": "payment_type",
    "Void?": "voided",
    "# Orders": "num_orders",
    "% of Ttl Qty (incl voids)": "pct_of_ttl_qty_incl_voids",
    "% of Ttl Amt (incl voids)": "pct_of_ttl_amt_incl_voids",
    "% of Ttl # Orders": "pct_of_ttl_num_orders",
    "% Qty (Group)": "pct_qty_group",
    "% Qty (Menu)": "pct_qty_menu",
    "% Qty (All)": "pct_qty_all",
    "% Net Amt (Group)": "pct_net_amt_group",
    "% Net Amt (Menu)": "pct_net_amt_menu",
    "% Net Amt (All)": "pct_net_amt_all",
}
# Columns read as numbers.
NUMERIC_COLUMNS = {
    "amount", "tip", "gratuity", "total", "tax", "discount", "discount_amount", "net_price", "gross_price", "swiped_card_amount",
    "keyed_card_amount", "amount_tendered", "refund_amount", "refund_tip_amount", "v_mc_d_fees", "net_amount", "gross_amount",
    "void_amount", "avg_price", "gross_amount_incl_voids", "qty", "guest_count", "table_size", "calculated_total", "qty_sold",
    "void_qty", "item_qty", "item_qty_incl_voids", "num_orders", "pct_of_net_sales", "pct_of_ttl_qty_incl_voids",
    "pct_of_ttl_amt_incl_voids", "pct_of_ttl_num_orders", "pct_qty_group", "pct_qty_menu", "pct_qty_all", "pct_net_amt_group",
    "pct_net_amt_menu", "pct_net_amt_all", "order_id", "check_id", "payment_id", "order_number", "check_number",
    "item_selection_id", "id", "entry_id",
}
# The daily files and the key of their tables.
DAILY_FILES = {
    "OrderDetails": ["order_id", "processing_date"],
    "CheckDetails": ["check_id", "processing_date"],
    "PaymentDetails": ["payment_id", "processing_date"],
    "ItemSelectionDetails": ["item_selection_id", "processing_date"],
    "AllItemsReport": ["master_id", "item_id", "processing_date"],
    "CashEntries": ["entry_id", "processing_date"],
    "KitchenTimings": ["id", "processing_date"],
}
# Header spellings of a check register.
REGISTER_HEADERS = {
    "check_number": ["check number", "check_number", "check #", "check no", "check", "number", "chk", "chk #", "chk no"],
    "payee": ["payee", "vendor", "pay to", "pay to the order of", "name", "paid to"],
    "amount": ["amount", "amt", "total"],
    "memo": ["memo", "note", "notes", "description", "desc", "expense"],
    "category": ["category", "expense category", "cat", "type"],
}


def daily_headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, header, utf8 and cells of every daily file with a line, staged: one row for each file."""
    heads = delimited.headers(delimited.file_lines(spark, paths))
    return stage(heads.select("file", "header", "utf8", delimited.csv_cells(F.col("header")).alias("cells")), "headers")


def read_daily_csv(spark: SparkSession, paths: str | list[str], datetime_columns: tuple[str, ...] = (), flags: tuple[str, ...] = ()) -> DataFrame:
    """One kind of daily file over any number of day folders, cleaned and typed.

    Each file is read by its own header, so added, missing or moved columns neither fail nor shift; a column that a file
    lacks is NULL there (``schema_drift`` reports it). Header-only and empty files have no rows. Only the distinct column names reach the driver.
    """
    heads = daily_headers(spark, paths)
    found = heads.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("cells")))).alias("names"), F.max(F.size("cells")).alias("width")).first()
    if not found.width:
        raise FileNotFoundError(f"no daily file with a header below {paths}")
    return transform_daily(_by_header(delimited.file_lines(spark, paths), heads, found.names, found.width), datetime_columns, flags)


def _by_header(lines: DataFrame, heads: DataFrame, names: list[str], width: int) -> DataFrame:
    """Text columns by cleaned name, and ``_path``. Of equal names in a header the first counts; blank ones are left out."""
    spellings: dict[str, list[str]] = {}
    for name in names:
        if name.strip():
            spellings.setdefault(clean.clean_name(name, HEADER_NAMES), []).append(name)
    columns = list(spellings)
    heads = heads.select("file", "header", "utf8", *[delimited.position(F.col("cells"), spellings[c]).alias(f"_p{i}") for i, c in enumerate(columns)])
    schema = ", ".join(f"c{i} string" for i in range(width))
    rows = delimited.rows_below(lines, heads).withColumn("_r", F.from_csv("value", F.lit(schema)))
    rows = rows.withColumn("_c", F.array(*[F.col(f"_r.c{i}") for i in range(width)]))
    return rows.select(*[F.get("_c", F.col(f"_p{i}") - 1).alias(c) for i, c in enumerate(columns)], F.col("file").alias("_path"))


def read_daily_files(spark: SparkSession, root: str, datetime_columns: tuple[str, ...] = (), flags: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Every known kind of daily file below ``root`` (one folder per kind, days below it). Unknown kinds and kinds without a file are skipped.

    The headers of all kinds are found in one pass.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    there = {x.getPath().getName() for x in folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)}
    kinds = [k for k in DAILY_FILES if k in there]
    if not kinds:
        return {}
    heads = daily_headers(spark, [f"{root}/{k}" for k in kinds]).withColumn("kind", F.regexp_extract("file", "^.*/(" + "|".join(kinds) + ")/", 1))
    out = {}
    for r in heads.groupBy("kind").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("cells")))).alias("names"), F.max(F.size("cells")).alias("width")).collect():
        lines = delimited.file_lines(spark, f"{root}/{r.kind}")
        out[r.kind] = transform_daily(_by_header(lines, heads.where(F.col("kind") == r.kind), r.names, r.width), datetime_columns, flags)
    return {k: out[k] for k in kinds if k in out}


def transform_daily(raw: DataFrame, datetime_columns: tuple[str, ...] = (), flags: tuple[str, ...] = ()) -> DataFrame:
    """Names, types, flags, date layouts, load date and computed total of raw text rows with ``_path``."""
    day = clean.load_date_from_path(F.col("_path"))
    df = clean.rename_columns(raw, {**HEADER_NAMES, "_path": "_path"})
    df = clean.type_by_name(df, NUMERIC_COLUMNS - {"processing_date"}, set(flags)).withColumn("processing_date", clean.load_date_from_path(F.col("_path"))).drop("_path")
    for c in datetime_columns:
        df = df.withColumn(c, clean.normalized_datetime_text(F.col(c)))
    return clean.with_total(df, name="calculated_total")


def read_bank_csv(spark: SparkSession, paths: str) -> DataFrame:
    """Bank statements: UTF-8 or Latin-1, preamble dropped, header names guessed, amounts with commas, several date layouts.

    Output: transaction_date, description, amount, running_balance, transaction_type, abs_amount, source_file.
    """
    return parse_bank_lines(stage(delimited.file_lines(spark, paths), "lines"))


def parse_bank_text(files: DataFrame) -> DataFrame:
    """Rows of statement texts (``value``, ``source_file``)."""
    lines = files.select(F.col("source_file").alias("file"), F.posexplode(F.split(F.ltrim("value", F.lit("\ufeff")), "\r?\n")).alias("line", "value"))
    return parse_bank_lines(lines.select("file", "value", F.struct(F.lit(0).alias("block"), "line").alias("at")))


def parse_bank_lines(lines: DataFrame) -> DataFrame:
    """Rows of statement lines (``value``, ``file``, ``at``): the header is the first line that begins with a date column, else the first line.

    ``lines`` are read twice and must have the same places each time. Headers are stored.
    """
    is_head = F.startswith(F.lower(F.trim("value")), F.lit("date,"))
    cells = F.transform(F.split(F.lower("header"), ","), lambda x: F.trim(x))
    where = lambda test: F.array_position(F.transform(cells, test), True).cast("int")
    heads = stage(delimited.headers(lines, is_head).select(
        "file", "head_at", "utf8", where(lambda x: x.contains("date") & ~x.contains("post")).alias("_d"), where(lambda x: x.contains("desc")).alias("_s"), where(lambda x: x.contains("amount")).alias("_a"),
        where(lambda x: x.contains("bal")).alias("_b")), "headers")
    row = delimited.rows_below(lines, heads, preamble=True).withColumn("_c", delimited.csv_cells(F.col("value")))
    pick = lambda i: F.get("_c", F.col(i) - 1)
    amount = clean.to_number(pick("_a"))
    day = F.to_date(clean.first_timestamp(F.trim(pick("_d")), ["M/d/yy", "M/d/yyyy", "yyyy-MM-dd"]))
    return row.filter(F.trim(pick("_d")) != "").select(
        day.alias("transaction_date"), F.coalesce(F.trim(pick("_s")), F.lit("")).alias("description"), amount.alias("amount"), F.when(F.col("_b") > 0, clean.to_number(pick("_b"))).alias("running_balance"),
        F.when(amount >= 0, "credit").otherwise("debit").alias("transaction_type"), F.abs(amount).alias("abs_amount"), F.element_at(F.split("file", "/"), -1).alias("source_file"))


def read_check_register(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Registers of any column order: each file's columns are found by its own header spellings."""
    lines = delimited.file_lines(spark, paths)
    spelled = F.transform(delimited.csv_cells(F.col("header")), lambda x: F.lower(F.trim(x)))
    heads = stage(delimited.headers(lines).select("file", "header", "utf8", *[delimited.position(spelled, s).alias(f"_{c}") for c, s in REGISTER_HEADERS.items()]), "headers")
    row = delimited.rows_below(lines, heads).withColumn("_c", delimited.csv_cells(F.col("value")))
    return normalize_register(row.select(*[F.nullif(F.get("_c", F.col(f"_{c}") - 1), F.lit("")).alias(c) for c in REGISTER_HEADERS]))


def normalize_register(raw: DataFrame) -> DataFrame:
    """Register columns found by header spelling; check numbers reduced to digits; rows without one dropped."""
    by_name = {c.strip().lower(): c for c in raw.columns}
    out = []
    for target, spellings in REGISTER_HEADERS.items():
        found = next((by_name[s] for s in spellings if s in by_name), None)
        out.append((F.col(f"`{found}`") if found else F.lit(None).cast("string")).alias(target))
    df = raw.select(*out)
    return df.select(digits_only(F.col("check_number")).alias("check_number"), F.trim("payee").alias("payee"), clean.to_number(F.regexp_replace("amount", "[$]", "")).alias("amount"),
                     F.trim("memo").alias("memo"), clean.blank_to_null(F.col("category")).alias("category")).filter(F.col("check_number").isNotNull())
