"""Queries: streams over the event table, compared with batch SQL."""

from pyspark.sql import functions as F

from voltide.operators import models, monitor
from voltide.operators.clean import impute_median
from voltide.operators.split import temporal_split
from voltide.plans.catalog import query, rounded, text_day
from voltide.plans.oracle import r, sql
from voltide.plans.q_monitor import LIMITS, RECORDS, _alert_sql
from voltide.plans.views import event_metric_records, train_and_current
from voltide.session import scratch_path
from voltide.sources.files import write_metric_records
from voltide.sources.tables import trades_from_events
from voltide.streaming import streams


@query("stream_daily_volume", sql("""
SELECT client_id, strftime(CAST(close_ts AS DATE), '%Y-%m-%d') AS day,
  round(sum(amount), 2) AS daily_volume, count(*) AS trades
FROM ops_events GROUP BY client_id, CAST(close_ts AS DATE)"""))
def stream_daily_volume(spark, sf):
    daily = streams.daily_volume_stream(streams.trade_stream(spark, sf))
    out = streams.run_to_table(
        spark, daily, streams.upsert_to, keys=("client_id", "day_start"))
    return rounded(out.select(
        "client_id", text_day("day_start").alias("day"), "daily_volume", "trades"), 2)


@query("stream_dedup", sql("SELECT op_id, client_id, amount FROM ops_events"))
def stream_dedup(spark, sf):
    once = streams.trade_stream(spark, sf)
    again = streams.trade_stream(spark, sf)
    out = streams.run_to_table(spark, streams.dedup_stream(once.union(again)), streams.append_to)
    return out.select("op_id", "client_id", "amount")


@query("stream_drift", sql(f"""
SELECT strftime(day, '%Y-%m-%d') AS day, 'amount' AS feature, rows,
  {r('abs(cm - bm) / abs(bm)', 'mean_drift')}, {r('abs(cs - bs) / abs(bs)', 'std_drift')},
  CAST(abs(cm - bm) / abs(bm) > 0.1 OR coalesce(abs(cs - bs) / abs(bs) > 0.1, FALSE) AS INT)
    AS has_drift
FROM (SELECT CAST(close_ts AS DATE) AS day, avg(amount) AS cm, stddev_samp(amount) AS cs,
             count(*) AS rows FROM ops_events GROUP BY 1),
     (SELECT avg(amount) AS bm, stddev_samp(amount) AS bs FROM ops_events
      WHERE epoch_us(close_ts) <= (SELECT quantile_cont(CAST(epoch_us(close_ts) AS DOUBLE), 0.8)
                                   FROM ops_events))"""))
def stream_drift(spark, sf):
    train, _ = train_and_current(trades_from_events(spark, sf))
    path = scratch_path(spark, "training-stats")
    monitor.training_stats(train, ["amount"]).write.parquet(path)
    drift = streams.drift_stream(streams.trade_stream(spark, sf), spark.read.parquet(path))
    out = streams.run_to_table(
        spark, drift, streams.upsert_to, keys=("feature", "window_start"))
    return rounded(out.select(
        text_day("window_start").alias("day"), "feature", "rows", "mean_drift", "std_drift",
        "has_drift"))


@query("stream_alerts", sql(_alert_sql(), "scored_events", extra=RECORDS))
def stream_alerts(spark, sf):
    path = scratch_path(spark, "metrics")
    write_metric_records(event_metric_records(spark, sf), path, "daily")
    alerts = streams.alert_stream(streams.metric_stream(spark, path), LIMITS)
    out = streams.run_to_table(spark, alerts, streams.append_to)
    return rounded(out.withColumn("day", text_day("timestamp")).drop("timestamp"), 8)


@query("stream_score")
def stream_score(spark, sf):
    t = trades_from_events(spark, sf).withColumns(
        {"hour": F.hour("close_ts"), "weekday": F.weekday("close_ts")})
    train = temporal_split(t).where("split = 'train'")
    features = ["hour", "weekday"]
    scorer = models.Scorer.train(
        impute_median(train, features), features, {"n_estimators": 3, "max_depth": 3})
    live = streams.trade_stream(spark, sf).withColumns(
        {"hour": F.hour("close_ts"), "weekday": F.weekday("close_ts")})
    scored = scorer.score_stream(live, F.col("close_ts"))
    out = streams.run_to_table(spark, scored, streams.append_to)
    return rounded(out.select("op_id", "amount", "predicted_amount"))
