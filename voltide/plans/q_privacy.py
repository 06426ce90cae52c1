"""Queries: encryption, pseudonyms, audit events."""

from pyspark.sql import functions as F

from voltide.operators import privacy
from voltide.plans.catalog import query, text_day
from voltide.plans.oracle import sql
from voltide.session import materialize, scratch_path
from voltide.sources import files
from voltide.sources.tables import read_table, trades_from_orders

SALT = "voltide"


@query("mask_roundtrip", sql("SELECT op_id, CAST(client_id AS VARCHAR) AS client_id, category, "
                             "TRUE AS was_masked FROM ops_orders"))
def mask_roundtrip(spark, sf):
    """Every year's trades have a key of their own, kept in a table."""
    t = trades_from_orders(spark, sf, ["op_id", "client_id", "category", "close_ts"])
    t = t.withColumns({"plain": F.col("category"), "key_id": F.coalesce(F.date_format("close_ts", "yyyy"), F.lit("none"))})
    years = [r[0] for r in t.select("key_id").distinct().collect()]
    keys = materialize(privacy.new_keys(spark, years), "keys")
    hidden = privacy.encrypt_by_key_id(t, ["client_id", "category"], keys)
    hidden = materialize(hidden.withColumn("was_masked", F.col("category") != F.col("plain")), "hidden")
    shown = privacy.decrypt_by_key_id(hidden, ["client_id", "category"], keys)
    return shown.drop("plain", "key_id", "close_ts")


@query("pseudonymize", sql(f"SELECT op_id, sha256(concat('{SALT}', client_id)) AS client FROM ops_orders"))
def pseudonymize(spark, sf):
    t = trades_from_orders(spark, sf, ["op_id", "client_id"])
    return privacy.pseudonymize(t, "client_id", SALT, "client")


def audit_events(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        "event_type",
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"),
        F.col("props").alias("details"),
    )


AUDIT = """
SELECT event_type, CASE event_type WHEN 'error' THEN 'failed' ELSE 'ok' END AS status,
  strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS events FROM events"""


@query("audit_counts", AUDIT + " GROUP BY ALL")
def audit_counts(spark, sf):
    return privacy.audit_counts(audit_events(spark, sf)).withColumn("day", text_day("day"))


@query("audit_retention", AUDIT + """
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 10 DAY GROUP BY ALL""")
def audit_retention(spark, sf):
    """Events that a repeated run has stored, old days deleted."""
    path = scratch_path(spark, "audit")
    events = audit_events(spark, sf)
    now = F.lit(events.agg(F.max("timestamp")).first()[0])
    for _ in range(2):
        files.append_audit_events(events, path, "daily", now, days=10)
    kept = files.read_audit_events(spark, path, now, days=10)
    return privacy.audit_counts(kept).withColumn("day", text_day("day"))
