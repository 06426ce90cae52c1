"""Queries: rolling, lagged and ordered columns."""

from pyspark.sql import functions as F

from voltide.functions.calendar import days_since_start, intraday
from voltide.operators import windows
from voltide.operators.encode import category_codes
from voltide.operators.ordering import fill_missing
from voltide.operators.stats import with_group_stats
from voltide.plans.catalog import query, rounded, text_day
from voltide.plans.cleaning import with_daily_volume
from voltide.plans.oracle import over_client, over_table, r, sql
from voltide.sources.tables import trades_from_events, trades_from_orders

BASIC = ["op_id", "client_id", "close_ts", "amount"]
FN = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min"}


def client_sql(specs, source="loaded", *views) -> str:
    columns = ", ".join(
        r(over_client(FN[s.how], s.column, s.rows), s.name, 4 if s.how == "std" else 6)
        for s in specs)
    return sql(f"SELECT op_id, {columns} FROM {source}", *views)


def spec_names(specs):
    return [s.name for s in specs]


def std_digits(specs):
    return {s.name: 4 for s in specs if s.how == "std"}


@query("daily_volume", sql(
    "SELECT op_id, round(sum(amount) OVER (PARTITION BY client_id, close_ts), 2) "
    "AS daily_volume FROM ops_orders"))
def daily_volume(spark, sf):
    t = with_daily_volume(trades_from_orders(spark, sf, BASIC))
    return rounded(t.select("op_id", "daily_volume"), 2)


@query("rolling_mean_5", client_sql(windows.mean_of_last_5(), "ops_orders"))
def rolling_mean_5(spark, sf):
    t = windows.rolling(trades_from_orders(spark, sf, BASIC), windows.mean_of_last_5())
    return rounded(t.select("op_id", "amount_ma_5"))


@query("rolling_means", client_sql(windows.volume_means(), "loaded", "loaded"))
def rolling_means(spark, sf):
    specs = windows.volume_means()
    t = windows.rolling(with_daily_volume(trades_from_orders(spark, sf, BASIC)), specs)
    return rounded(t.select("op_id", *spec_names(specs)))


@query("rolling_std", client_sql(windows.volume_stds(), "loaded", "loaded"))
def rolling_std(spark, sf):
    specs = windows.volume_stds()
    t = windows.rolling(with_daily_volume(trades_from_orders(spark, sf, BASIC)), specs)
    return rounded(t.select("op_id", *spec_names(specs)), **std_digits(specs))


@query("rolling_client_stats", client_sql(windows.client_amount_stats(), "ops_orders"))
def rolling_client_stats(spark, sf):
    specs = windows.client_amount_stats()
    t = windows.rolling(trades_from_orders(spark, sf, BASIC), specs)
    return rounded(t.select("op_id", *spec_names(specs)), **std_digits(specs))


@query("rolling_global_rate", sql(
    "SELECT op_id, " + ", ".join(
        r(over_table(FN[s.how], s.column, s.rows), s.name)
        for s in windows.table_rate_stats("amount")) + " FROM ops_events"))
def rolling_global_rate(spark, sf):
    specs = windows.table_rate_stats("amount")
    t = trades_from_events(spark, sf).select("op_id", "close_ts", "amount")
    return rounded(windows.rolling(t, specs, by=()).select("op_id", *spec_names(specs)))


@query("volume_trend", sql(
    "SELECT op_id, round({} / nullif({}, 0), 8) AS volume_trend FROM ops_events".format(
        over_client("avg", "amount", 30), over_client("avg", "amount", 90))))
def volume_trend(spark, sf):
    t = windows.volume_trend(trades_from_events(spark, sf).select(*BASIC))
    return rounded(t.select("op_id", "volume_trend"), 8)


@query("ffill_bfill", sql("""
SELECT op_id, coalesce(
  last_value(signed IGNORE NULLS) OVER (ORDER BY close_ts, op_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(signed IGNORE NULLS) OVER (ORDER BY close_ts, op_id
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS signed_amount
FROM (SELECT *, CASE op_type WHEN 'buy' THEN amount WHEN 'sell' THEN -amount END AS signed
      FROM ops_events)"""))
def ffill_bfill(spark, sf):
    from voltide.functions.ratios import signed_amount

    t = trades_from_events(spark, sf).select(
        "op_id", "close_ts", signed_amount().alias("signed_amount"))
    return fill_missing(t, ["signed_amount"]).select("op_id", "signed_amount")


@query("days_since_start", sql("""
SELECT op_id, CAST(floor((epoch_us(close_ts) - min(epoch_us(close_ts)) OVER ()) / 86400000000)
  AS BIGINT) AS days_since_start FROM ops_events"""))
def days_since_start_query(spark, sf):
    t = trades_from_events(spark, sf).select("op_id", "close_ts")
    return days_since_start(t).select("op_id", "days_since_start")


@query("category_codes", sql("""
SELECT op_id, CAST(CASE WHEN op_type IS NULL THEN -1 ELSE op_code END AS INT) AS op_type_code,
       CAST(CASE WHEN category IS NULL THEN -1 ELSE cat_code END AS INT) AS category_code
FROM (SELECT *, dense_rank() OVER (ORDER BY op_type NULLS LAST) - 1 AS op_code,
             dense_rank() OVER (ORDER BY category NULLS LAST) - 1 AS cat_code FROM ops_orders)"""))
def category_codes_query(spark, sf):
    t = trades_from_orders(spark, sf, ["op_id", "op_type", "category"])
    t = category_codes(category_codes(t, "op_type"), "category")
    return t.select("op_id", "op_type_code", "category_code")


DAY_COLUMNS = [f"volume_{n}d_{how}" for n in (7, 14, 30) for how in ("sum", "mean", "std")]


@query("rolling_days", sql(
    "SELECT client_id, strftime(day, '%Y-%m-%d') AS day, round(daily_volume, 2) AS daily_volume, "
    + ", ".join(
        r(f"{fn}(daily_volume) OVER (PARTITION BY client_id ORDER BY n "
          f"RANGE BETWEEN {d - 1} PRECEDING AND CURRENT ROW)", f"volume_{d}d_{how}", digits)
        for d in (7, 14, 30)
        for how, fn, digits in (("sum", "sum", 2), ("mean", "avg", 6), ("std", "stddev_samp", 6)))
    + """ FROM (SELECT client_id, CAST(close_ts AS DATE) AS day, sum(amount) AS daily_volume,
    datediff('day', DATE '1970-01-01', CAST(close_ts AS DATE)) AS n
    FROM ops_events GROUP BY ALL)"""))
def rolling_days(spark, sf):
    t = windows.rolling_days(trades_from_events(spark, sf))
    digits = {c: 2 for c in DAY_COLUMNS if c.endswith("sum")}
    return rounded(
        t.select("client_id", text_day("day").alias("day"), "daily_volume", *DAY_COLUMNS),
        6, daily_volume=2, **digits)


#: Means of short decimals lie half way between two roundings; this much more rounds them up.
UP = 1e-13


@query("rolling_days_rate", sql(
    f"SELECT strftime(day, '%Y-%m-%d') AS day, round(daily_rate + {UP}, 10) AS daily_rate, "
    + ", ".join(
        [r(f"avg(daily_rate) OVER (ORDER BY n RANGE BETWEEN {d - 1} PRECEDING "
           f"AND CURRENT ROW) + {UP}", f"rate_{d}d_mean", 10) for d in (7, 14, 30)]
        + [r(f"stddev_samp(daily_rate) OVER (ORDER BY n RANGE BETWEEN {d - 1} PRECEDING "
             "AND CURRENT ROW)", f"rate_{d}d_std", 8) for d in (7, 14, 30)])
    + """ FROM (SELECT CAST(close_ts AS DATE) AS day, avg(closed_rate) AS daily_rate,
    datediff('day', DATE '1970-01-01', CAST(close_ts AS DATE)) AS n
    FROM ops_orders GROUP BY ALL)"""))
def rolling_days_rate(spark, sf):
    t = windows.rolling_days_rate(trades_from_orders(spark, sf, ["close_ts", "closed_rate"]))
    means = ["daily_rate", *[f"rate_{d}d_mean" for d in (7, 14, 30)]]
    stds = [f"rate_{d}d_std" for d in (7, 14, 30)]
    up = [(F.col(c) + F.lit(UP)).alias(c) for c in means]
    return rounded(t.select(text_day("day").alias("day"), *up, *stds), 10, **{c: 8 for c in stds})


@query("daily_rate_stats", sql(f"""
SELECT strftime(CAST(close_ts AS DATE), '%Y-%m-%d') AS day, count(*) AS trades,
  {r('stddev_samp(closed_rate)', 'rate_std')},
  {r('max(closed_rate) - min(closed_rate)', 'rate_range')},
  {r('stddev_samp(amount)', 'amount_std')}
FROM ops_orders GROUP BY CAST(close_ts AS DATE)"""))
def daily_rate_stats(spark, sf):
    t = trades_from_orders(spark, sf, ["op_id", "close_ts", "amount", "closed_rate"])
    t = windows.daily_rate_stats(t)
    return rounded(t.withColumn("day", text_day("day")))


@query("intraday_features", sql(f"""
SELECT op_id, CAST(hour(close_ts) AS INT) AS hour, CAST(minute(close_ts) AS INT) AS minute,
  CAST(isodow(close_ts) < 6 AND hour(close_ts) BETWEEN 9 AND 17 AS INT) AS is_business_hours,
  {r('stddev_samp(amount) OVER h', 'hour_std')},
  round(max(amount) OVER h - min(amount) OVER h, 6) AS hour_range,
  count(*) OVER (PARTITION BY client_id) AS client_trades
FROM ops_events WINDOW h AS (PARTITION BY date_trunc('hour', close_ts))"""))
def intraday_features(spark, sf):
    t = trades_from_events(spark, sf).select(*BASIC).withColumns(intraday())
    t = t.withColumn("hour_start", F.date_trunc("hour", "close_ts"))
    t = with_group_stats(t, ["hour_start"], {
        "hour_std": F.stddev_samp("amount"),
        "hour_range": F.max("amount") - F.min("amount")})
    t = with_group_stats(t, ["client_id"], {"client_trades": F.count(F.lit(1))})
    return rounded(t.select(
        "op_id", "hour", "minute", "is_business_hours", "hour_std", "hour_range",
        "client_trades"))
