"""Queries: drift, metric records, alerts, history."""

from pyspark.sql import functions as F

from voltide.operators import monitor
from voltide.plans.catalog import query, rounded, text_day
from voltide.plans.oracle import r, sql
from voltide.plans.views import event_metric_records, train_and_current
from voltide.session import scratch_path
from voltide.sources.tables import trades_from_events, trades_from_orders

DRIFTED = ("amount", "spread", "closed_rate")


@query("drift_report", sql(" UNION ALL ".join(f"""
SELECT '{c}' AS feature, {r('tm', 'train_mean')}, {r('ts', 'train_std')},
  {r('cm', 'current_mean')}, {r('cs', 'current_std')},
  {r('abs(cm - tm) / nullif(abs(tm), 0)', 'mean_drift')},
  {r('abs(cs - ts) / nullif(abs(ts), 0)', 'std_drift')},
  CAST(abs(cm - tm) / abs(tm) > 0.1 OR abs(cs - ts) / abs(ts) > 0.1 AS INT) AS has_drift
FROM (SELECT avg({c}) FILTER (s) AS tm, stddev_samp({c}) FILTER (s) AS ts,
             avg({c}) FILTER (NOT s) AS cm, stddev_samp({c}) FILTER (NOT s) AS cs FROM marked)"""
    for c in DRIFTED), extra="""
marked AS (SELECT amount, spread, closed_rate, epoch_us(close_ts) <= (
  SELECT quantile_cont(CAST(epoch_us(close_ts) AS DOUBLE), 0.8) FROM ops_orders) AS s
  FROM ops_orders)"""))
def drift_report(spark, sf):
    t = trades_from_orders(spark, sf, ["close_ts", "amount", "spread", "closed_rate"])
    train, current = train_and_current(t)
    out = monitor.drift_report(train, current, DRIFTED)
    return rounded(out)


E = "(amount - predicted_amount)"
RECORDS = f"""
base AS (SELECT avg(amount) AS bm, stddev_samp(amount) AS bs FROM ops_events
  WHERE epoch_us(close_ts) <= (SELECT quantile_cont(CAST(epoch_us(close_ts) AS DOUBLE), 0.8)
                               FROM ops_events)),
records AS (
  SELECT CAST(close_ts AS DATE) AS day, sqrt(avg({E} * {E})) AS rmse, avg(abs{E}) AS mae,
    1 - sum({E} * {E}) / (var_pop(amount) * count(*)) AS r2,
    avg(abs{E} / nullif(abs(amount), 0)) * 100 AS mape,
    abs(avg(amount) - any_value(bm)) / any_value(bm) AS mean_drift,
    abs(stddev_samp(amount) - any_value(bs)) / any_value(bs) AS std_drift
  FROM scored_events, base GROUP BY 1)"""
DAY = "strftime(day, '%Y-%m-%d') AS day"
SERIES = " UNION ALL ".join(
    [f"SELECT day, 'metric' AS section, '{m}' AS name, {m} AS value FROM records"
     for m in ("rmse", "mae", "r2", "mape")]
    + [f"SELECT day, '{d}', 'amount', {d} FROM records" for d in ("mean_drift", "std_drift")]
    + ["SELECT day, 'has_drift', 'amount', "
       "CAST(coalesce(mean_drift > 0.1, FALSE) OR coalesce(std_drift > 0.1, FALSE) AS INT) "
       "FROM records"])


@query("metric_records", sql(
    f"SELECT {DAY}, {r('rmse', 'rmse', 8)}, {r('mae', 'mae', 8)}, {r('r2', 'r2', 8)}, "
    f"{r('mape', 'mape', 8)}, "
    f"{r('mean_drift', 'mean_drift', 8)}, {r('std_drift', 'std_drift', 8)} FROM records",
    "scored_events", extra=RECORDS))
def metric_records(spark, sf):
    t = event_metric_records(spark, sf)
    return rounded(t.select(
        text_day("timestamp").alias("day"),
        *[F.col("metrics")[m].alias(m) for m in ("rmse", "mae", "r2", "mape")],
        *[F.col("drift_results")["amount"][d].alias(d) for d in ("mean_drift", "std_drift")]), 8)


def _from_files(spark, sf):
    """Metric records written as JSON, then read back with their schema."""
    from voltide.sources.files import read_metric_records, write_metric_records

    path = scratch_path(spark, "metrics")
    write_metric_records(event_metric_records(spark, sf), path, "daily")
    return read_metric_records(spark, path)


@query("metrics_flatten", sql(
    f"SELECT {DAY}, section, name, {r('value', 'value', 8)} FROM ({SERIES})",
    "scored_events", extra=RECORDS))
def metrics_flatten(spark, sf):
    long = monitor.flatten_metrics(_from_files(spark, sf))
    return rounded(long.select(text_day("timestamp").alias("day"), "section", "name", "value"), 8)


@query("metrics_latest", sql(
    f"SELECT {DAY}, {r('rmse', 'rmse')}, {r('mae', 'mae')} FROM records "
    "ORDER BY records.day DESC LIMIT 1", "scored_events", extra=RECORDS))
def metrics_latest(spark, sf):
    latest = monitor.latest_record(_from_files(spark, sf))
    return rounded(latest.select(
        text_day("timestamp").alias("day"),
        F.col("metrics")["rmse"].alias("rmse"), F.col("metrics")["mae"].alias("mae")))


LIMITS = {"rmse": 50.0, "mae": 35.0, "mape": 300.0, "drift": 0.05}


def _alert_sql(records: str = "records") -> str:
    parts = [
        f"SELECT {DAY}, '{m}' AS kind, '{m}' AS name, round({m}, 8) AS value, "
        f"CAST({LIMITS[m]} AS DOUBLE) AS threshold, printf('{m.upper()} (%.2f{p}) excede el umbral "
        f"({LIMITS[m]}{p})', {m}) AS message FROM {records} WHERE {m} > {LIMITS[m]}"
        for m, p in (("rmse", ""), ("mae", ""), ("mape", "%%"))]
    parts.append(
        f"SELECT {DAY}, 'drift', 'amount', round(mean_drift, 8), CAST({LIMITS['drift']} AS DOUBLE), "
        f"printf('Drift detectado en feature amount: %.2f', mean_drift) FROM {records} "
        f"WHERE mean_drift > {LIMITS['drift']}")
    return " UNION ALL ".join(parts)


@query("metric_alerts", sql(_alert_sql(), "scored_events", extra=RECORDS))
def metric_alerts(spark, sf):
    alerts = monitor.metric_alerts(event_metric_records(spark, sf), LIMITS)
    return rounded(alerts.withColumn("day", text_day("timestamp")).drop("timestamp"), 8)


@query("history_retention", sql(
    f"SELECT {DAY}, {r('rmse', 'rmse')} FROM records WHERE records.day > "
    "(SELECT max(records.day) FROM records) - INTERVAL 10 DAY", "scored_events", extra=RECORDS))
def history_retention(spark, sf):
    path = scratch_path(spark, "history")
    records = event_metric_records(spark, sf)
    monitor.append_history(records, path)
    now = F.lit(spark.read.parquet(path).agg(F.max("timestamp")).first()[0])
    kept = monitor.read_history(spark, path, now, days=10)
    return rounded(kept.select(
        text_day("timestamp").alias("day"), F.col("metrics")["rmse"].alias("rmse")))


@query("monitoring_run", sql(
    _alert_sql("(SELECT * FROM records ORDER BY records.day DESC LIMIT 1)"),
    "scored_events", extra=RECORDS))
def monitoring_run(spark, sf):
    records = event_metric_records(spark, sf)
    now = F.lit(trades_from_events(spark, sf).agg(F.max("close_ts")).first()[0])
    alerts, _ = monitor.run_monitoring(
        records, scratch_path(spark, "history"), now, limits=LIMITS)
    return rounded(alerts.withColumn("day", text_day("timestamp")).drop("timestamp"), 8)


@query("history_reruns", sql(
    f"SELECT {DAY}, count(*) AS records FROM records WHERE records.day >= "
    "(SELECT CAST(max(close_ts) AS DATE) FROM ops_events) - 10 GROUP BY ALL", "scored_events", extra=RECORDS))
def history_reruns(spark, sf):
    """What the history's folders hold after every step was run twice."""
    path = scratch_path(spark, "history")
    records = event_metric_records(spark, sf)
    now = F.lit(trades_from_events(spark, sf).agg(F.max("close_ts")).first()[0])
    for _ in range(2):
        monitor.append_history(records, path)
        monitor.run_monitoring(records, path, now, days=10, limits=LIMITS)
    stored = spark.read.parquet(path)
    return stored.groupBy(text_day("timestamp").alias("day")).agg(F.count(F.lit(1)).alias("records"))
