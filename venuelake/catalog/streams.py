"""Incremental feeds with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shared_dir
from ..streaming import jobs, stateful
from .registry import query


def _deliveries(t, df, order, purpose):
    """The rows as files that arrive in four deliveries, by ``order`` (0 to 3)."""
    path = shared_dir(t.spark, purpose)
    for i in range(4):
        df.where(order == i).write.mode("append").parquet(path)
    return path


def _month_order(step):
    """Quarter of the time of day that a row's day has in ``step`` turns: 1 is the order of time within the month."""
    return F.pmod(F.floor(F.dayofmonth("ts") * step / 8), F.lit(4))


@query("st_high_watermark", """
  SELECT reservation_id, updated FROM v_reservations WHERE updated >= (SELECT max(updated) FROM v_reservations WHERE status_simple = 'Complete') - INTERVAL 1 DAY""")
def _(t):
    """Both tables are stored by month of their version; the start comes from folder names and one month of the target."""
    r = t.reservations.select("reservation_id", "status_simple", "updated", F.trunc("updated", "month").alias("day"))
    source, target = shared_dir(t.spark, "reservations"), shared_dir(t.spark, "loaded")
    r.hint("rebalance", "day").write.partitionBy("day").parquet(source)
    r.where("status_simple = 'Complete'").hint("rebalance", "day").write.partitionBy("day").parquet(target)
    return stateful.since_watermark(t.spark, source, target, r.drop("day").schema, "updated", "day", unit="month").select("reservation_id", "updated")


@query("st_cursor_state", """
  WITH s AS (SELECT source_file AS feed, max(transaction_date) AS cursor FROM v_bank WHERE category_source = 'manual' GROUP BY 1), l AS (SELECT source_file AS feed, max(transaction_date) AS cursor FROM v_bank WHERE category_source = 'auto' GROUP BY 1)
  SELECT coalesce(s.feed, l.feed) AS feed, greatest(s.cursor, l.cursor) AS cursor FROM s FULL OUTER JOIN l ON s.feed = l.feed""")
def _(t):
    """Bank lines arrive newest month first, in several triggers; each batch commits its lines and its cursors together."""
    state = t.bank.filter("category_source = 'manual'").groupBy(F.col("source_file").alias("feed")).agg(F.max("transaction_date").alias("cursor"))
    lines = t.bank.filter("category_source = 'auto'").select("source_file", "transaction_date", "description", "amount")
    source = _deliveries(t, lines, F.pmod(-F.month("transaction_date"), F.lit(4)), "bank-feed")
    path = shared_dir(t.spark, "cursor-feed")
    stateful.land_with_cursor(jobs.file_stream(t.spark, source, lines.schema, 4), path, f"{path}/checkpoint", "source_file", "transaction_date")
    return stateful.cursors(t.spark, path, "feed string, cursor date", state)


@query("st_upsert_latest", """
  SELECT user_id, event_id, ts, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(t):
    """Newest event per user, streamed from files into a change table."""
    schema = t.raw("events").schema
    return jobs.upsert_latest(t.spark, f"{t.sf_dir}/events*.parquet", schema, lambda s: s.select("user_id", "event_id", "ts", "event_type", "value"), ["user_id"], lambda: [F.desc("ts"), F.desc("event_id")])


@query("st_late_corrections", """
  WITH t AS (SELECT reservation_id, date, status_simple, updated FROM v_reservations WHERE status_simple <> 'Seated'), s AS (SELECT reservation_id, date, 'Closed' AS status_simple, updated FROM v_reservations WHERE date >= DATE '2001-08-01' - 400)
  SELECT coalesce(s.reservation_id, t.reservation_id) AS reservation_id, coalesce(s.date, t.date) AS date, coalesce(s.status_simple, t.status_simple) AS status_simple, coalesce(s.updated, t.updated) AS updated FROM t FULL OUTER JOIN s ON s.reservation_id = t.reservation_id""")
def _(t):
    cols = ["reservation_id", "date", "status_simple", "updated"]
    target = t.reservations.filter("status_simple <> 'Seated'").select(*cols)
    source = t.reservations.withColumn("status_simple", F.lit("Closed")).select(*cols)
    return jobs.late_corrections(target, source, "reservation_id", "updated", "date", 400, "2001-08-01", [F.asc("status_simple")])


@query("st_late_corrections_stream", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    """Two overlapping deliveries in several triggers, the months out of order, each event once."""
    e = t.raw("events")
    sources = [_deliveries(t, e, _month_order(k), f"events-{k}") for k in (5, 7)]
    return stateful.unique_events(t.spark, sources, e.schema, "event_id", "ts", max_files=6).select("event_id", "user_id", "event_type", "value")


_CH = """ch AS (SELECT order_id, server, total, CASE WHEN voided IS NULL THEN 'added' WHEN voided = 'true' THEN 'removed' ELSE 'modified' END AS change FROM v_orders WHERE tip > 20),
  tg AS (SELECT order_id, server, 0.0::DOUBLE AS total FROM v_orders WHERE voided IS NOT NULL)"""


def _changes(t):
    ch = t.orders.filter("tip > 20").select("order_id", "server", "total", F.when(F.col("voided").isNull(), "added").when(F.col("voided") == "true", "removed").otherwise("modified").alias("change"))
    return t.orders.filter("voided IS NOT NULL").select("order_id", "server", F.lit(0.0).alias("total")), ch


@query("st_feed_changes", f"""
  WITH {_CH}, m AS (SELECT * FROM ch WHERE change <> 'removed') SELECT coalesce(m.order_id, tg.order_id) AS order_id, CASE WHEN m.order_id IS NOT NULL THEN m.server ELSE tg.server END AS server, coalesce(m.total, tg.total) AS total FROM tg FULL OUTER JOIN m ON m.order_id = tg.order_id""")
def _(t):
    target, ch = _changes(t)
    return jobs.apply_feed_changes(target, ch, "order_id")


@query("st_feed_changes_stream", f"""
  WITH {_CH}, m AS (SELECT * FROM ch WHERE change <> 'removed'), x AS (SELECT coalesce(m.order_id, tg.order_id) AS order_id, CASE WHEN m.order_id IS NOT NULL THEN m.server ELSE tg.server END AS server, coalesce(m.total, tg.total) AS total FROM tg FULL OUTER JOIN m ON m.order_id = tg.order_id)
  SELECT * FROM x WHERE order_id NOT IN (SELECT order_id FROM ch WHERE change = 'removed')""")
def _(t):
    """The same changes from files, an older version of each in a file of its own."""
    target, ch = _changes(t)
    path = shared_dir(t.spark, "feed-files")
    older = ch.withColumns({"total": F.col("total") - 1, "change": F.lit("added"), "at": F.lit(1)})
    older.unionByName(ch.withColumn("at", F.lit(2))).write.parquet(path)
    return jobs.feed_changes(t.spark, path, "order_id long, server string, total double, change string, at int", target, "order_id", lambda: [F.desc("at")], delete_removed=True, max_files=3)


@query("st_feed_changes_deleting", f"""
  WITH {_CH}, m AS (SELECT * FROM ch WHERE change <> 'removed'), x AS (SELECT coalesce(m.order_id, tg.order_id) AS order_id, CASE WHEN m.order_id IS NOT NULL THEN m.server ELSE tg.server END AS server, coalesce(m.total, tg.total) AS total FROM tg FULL OUTER JOIN m ON m.order_id = tg.order_id)
  SELECT * FROM x WHERE order_id NOT IN (SELECT order_id FROM ch WHERE change = 'removed')""")
def _(t):
    target, ch = _changes(t)
    return jobs.apply_feed_changes(target, ch, "order_id", delete_removed=True)


@query("st_feed_changes_counts", f"WITH {_CH} SELECT change, count(*) AS n FROM ch GROUP BY 1")
def _(t):
    return jobs.change_counts(_changes(t)[1])


@query("st_windowed_revenue", """
  SELECT date_trunc('hour', ts)::TIMESTAMP AS hour_start, CAST(date_trunc('hour', ts) - INTERVAL 4 HOUR AS DATE) AS business_date, count(*) AS txns, round(sum(value), 2) AS revenue FROM events WHERE event_type = 'purchase' GROUP BY 1, 2""")
def _(t):
    """Payments delivered in several triggers, most in order of time, the others late."""
    e = t.raw("events")
    source = _deliveries(t, e, F.when(F.col("event_id") % 10 < 8, _month_order(1)).otherwise(_month_order(5)), "payments")
    return stateful.windowed_revenue(t.spark, source, e.schema, lambda s: s.filter("event_type = 'purchase'"), "ts", "value", max_files=4)
