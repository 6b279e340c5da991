"""JSON feeds as landed files: labor entries, two bank feeds, reservations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import stage

LABOR_SCHEMA = (
    "guid string, employeeReference struct<guid:string>, jobReference struct<guid:string>, inDate string, outDate string, businessDate string, "
    "regularHours string, overtimeHours string, hourlyWage string"
)
FEED_A_SCHEMA = (
    "transaction_id string, account_id string, date string, amount string, name string, merchant_name string, original_description string, "
    "pending boolean, personal_finance_category struct<primary:string,detailed:string>"
)
FEED_B_SCHEMA = "id string, date string, description string, amount string, status string"
ISO = ["yyyy-MM-dd'T'HH:mm:ss.SSSZ", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ssZ"]


def read_json(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).json(paths)


def utc_timestamp(c: Column) -> Column:
    """ISO text with an offset as an instant, NULL when it does not parse.

    A failed parse costs far more than a good one, so layouts are tried only on texts that have their colons and, or not, their point.
    """
    tried = lambda point: F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in ISO if ("." in f) == point])
    return F.when(c.contains(":"), F.when(c.contains("."), tried(True)).otherwise(tried(False)))


def text_or_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def labor_entries(raw: DataFrame, employees: DataFrame, jobs: DataFrame) -> DataFrame:
    """Punches with employee and job names looked up; missing numbers are 0, missing names empty.

    The lookups are stored, so their size is known: small ones are broadcast and the punches, which share few jobs, stay where they are read.
    """
    e = employees.select(F.col("guid").alias("_e"), F.col("name").alias("employee_name")).groupBy("_e").agg(F.max("employee_name").alias("employee_name"))
    e = stage(e, "employees")
    j = jobs.select(F.col("guid").alias("_j"), F.col("title").alias("job_title")).groupBy("_j").agg(F.max("job_title").alias("job_title"))
    j = stage(j, "jobs")
    num = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    x = raw.withColumns({"employee_guid": F.coalesce("employeeReference.guid", F.lit("")), "job_guid": F.coalesce("jobReference.guid", F.lit(""))})
    x = x.join(e, F.col("employee_guid") == F.col("_e"), "left").join(j, F.col("job_guid") == F.col("_j"), "left")
    return x.select("guid", "employee_guid", F.coalesce("employee_name", F.lit("")).alias("employee_name"), "job_guid", F.coalesce("job_title", F.lit("")).alias("job_title"), utc_timestamp(F.col("inDate")).alias("clock_in"),
                    utc_timestamp(F.col("outDate")).alias("clock_out"), num("regularHours").alias("regular_hours"), num("overtimeHours").alias("overtime_hours"), num("hourlyWage").alias("hourly_wage"),
                    F.to_date(F.try_to_timestamp("businessDate", F.lit("yyyyMMdd"))).alias("processing_date"))


def bank_feed_a(raw: DataFrame, source: str = "feed_a") -> DataFrame:
    """Aggregator transactions: money out is positive there, so the sign flips; first usable text and category win."""
    amount = -F.col("amount").try_cast("double")
    desc = F.coalesce(*[F.when(F.col(c) != "", F.trim(F.col(c))) for c in ("original_description", "merchant_name", "name")])
    vendor = F.coalesce(F.when(F.col("merchant_name") != "", F.col("merchant_name")), F.when(F.col("name") != "", F.col("name")))
    cat = F.coalesce(F.nullif(F.col("personal_finance_category.detailed"), F.lit("")), F.nullif(F.col("personal_finance_category.primary"), F.lit("")))
    x = raw.select(F.to_date(F.try_to_timestamp("date", F.lit("yyyy-MM-dd"))).alias("transaction_date"), F.substring(desc, 1, 500).alias("description"), amount.alias("amount"), F.when(amount > 0, "credit").otherwise("debit").alias("transaction_type"),
                   F.abs(amount).alias("abs_amount"), cat.alias("category"), F.when(cat.isNotNull(), source).otherwise("uncategorized").alias("category_source"), F.substring(vendor, 1, 200).alias("vendor_normalized"), F.lit(source).alias("source_file"))
    return x.filter(F.col("transaction_date").isNotNull() & F.col("amount").isNotNull() & (F.col("description") != ""))


def bank_feed_b(raw: DataFrame, from_date: str | None = None, source: str = "feed_b") -> DataFrame:
    """Posted transactions only, first line of the description, optional date floor."""
    amount = F.col("amount").try_cast("double")
    x = raw.filter(F.col("status") == "posted").select(
        F.to_date("date").alias("transaction_date"), F.trim(F.get(F.split("description", "\n"), F.lit(0))).alias("description"), amount.alias("amount"), F.when(amount < 0, "debit").otherwise("credit").alias("transaction_type"),
        F.abs(amount).alias("abs_amount"), F.lit(source).alias("source_file"))
    return x.filter(F.col("transaction_date") >= F.lit(from_date).cast("date")) if from_date else x


# Reservation columns by type; nested parts are kept as JSON text.
RESERVATION_COLUMNS = {
    "string": ["id", "venue_id", "venue_group_id", "client_id", "reference_code", "external_id", "external_reference_code", "arrival_time", "seated_time", "left_time", "time_slot_iso", "first_name", "last_name", "email",
               "phone_number", "loyalty_tier", "booked_by", "served_by", "paid_by", "status", "status_simple", "status_display", "check_numbers", "shift_persistent_id", "shift_category", "venue_seating_area_id",
               "venue_seating_area_name", "reservation_type", "notes", "client_requests"],
    "bigint": ["duration", "max_guests", "arrived_guests", "mf_ratio_male", "mf_ratio_female"],
    "double": ["total_gross_payment", "total_net_payment", "total_payment", "onsite_payment_total", "prepayment_total", "cancellation_fee", "comps", "rating"],
    "boolean": ["is_vip", "deleted"],
    "timestamp": ["real_datetime_of_slot", "created", "updated"],
    "json": ["tags", "pos_tickets", "custom_fields", "upgrades", "table_numbers"],
}


def reservations(raw_lines: DataFrame, value: str = "value") -> DataFrame:
    """56 typed columns from reservation JSON lines; bad values become NULL, lines without id are dropped.

    Every field is read as text once (one parse per line) and cast afterwards, so a wrong type
    in one field does not lose the record.
    """
    names = [c for cols in RESERVATION_COLUMNS.values() for c in cols] + ["date"]
    one = raw_lines.withColumn("_r", F.from_json(F.col(value), F.lit(", ".join(f"`{c}` string" for c in names))))
    out = []
    for kind, cols in RESERVATION_COLUMNS.items():
        for c in cols:
            v = F.col(f"_r.`{c}`")
            if kind == "timestamp":
                out.append(utc_timestamp(v).alias(c))
            elif kind == "json":
                out.append(F.when(~v.isin("", "[]", "{}", "null"), v).alias(f"{c}_json"))
            else:
                out.append((v if kind == "string" else F.nullif(v, F.lit("")).try_cast(kind)).alias(c))
    out.append(F.to_date(F.try_to_timestamp(F.substring(F.col("_r.date"), 1, 10), F.lit("yyyy-MM-dd"))).alias("date"))
    return one.select(*out, F.col(value).alias("raw_json"), F.current_timestamp().alias("synced_at")).filter(F.coalesce(F.col("id"), F.lit("")) != "")


def read_reservations(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return reservations(spark.read.text(paths))
