"""Queries: calendar, ratios, encodings, client statistics, feature chains."""

from pyspark.sql import functions as F

from voltide.functions import ratios
from voltide.functions.calendar import calendar, cyclic, with_holidays
from voltide.operators import stats, windows
from voltide.operators.encode import OneHotVectors, one_hot
from voltide.plans.catalog import query, rounded, text_time
from voltide.plans.cleaning import load_trades, with_daily_volume
from voltide.plans.features import features_g1a, features_g1b, features_g2, statistical_features
from voltide.plans.oracle import over_client, over_table, r, sql
from voltide.session import materialize, scratch_path
from voltide.sources.tables import trades_from_events, trades_from_orders

CALENDAR_SQL = """
  CAST(year(close_ts) AS INT) AS year, CAST(month(close_ts) AS INT) AS month,
  CAST(day(close_ts) AS INT) AS day, CAST(quarter(close_ts) AS INT) AS quarter,
  CAST(isodow(close_ts) - 1 AS INT) AS weekday, dayname(close_ts) AS day_name,
  CAST(isodow(close_ts) >= 6 AS INT) AS is_weekend,
  CAST(day(close_ts) <= 5 AS INT) AS is_month_start,
  CAST(day(close_ts) >= 25 AS INT) AS is_month_end,
  CAST(CAST(close_ts AS DATE) = last_day(close_ts) AS INT) AS is_last_day,
  strftime(close_ts + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS next_ts,
  CAST(floor(epoch(close_ts)) AS BIGINT) AS epoch_seconds"""

CYCLIC = {
    "month_sin": "sin(2 * pi() * month(close_ts) / 12)",
    "month_cos": "cos(2 * pi() * month(close_ts) / 12)",
    "weekday_sin": "sin(2 * pi() * (isodow(close_ts) - 1) / 7)",
    "weekday_cos": "cos(2 * pi() * (isodow(close_ts) - 1) / 7)",
}


@query("calendar_features", sql(f"SELECT op_id, {CALENDAR_SQL} FROM ops_events"))
def calendar_features(spark, sf):
    t = trades_from_events(spark, sf).select("op_id", "close_ts").withColumns(calendar())
    return t.withColumn("next_ts", text_time("next_ts")).drop("close_ts")


# a value that rounds to zero may carry either sign: adding zero takes it away
@query("cyclic_features", sql(
    "SELECT op_id, " + ", ".join(f"round({e}, 6) + 0.0 AS {n}" for n, e in CYCLIC.items())
    + " FROM ops_events"))
def cyclic_features(spark, sf):
    t = trades_from_events(spark, sf).select("op_id", "close_ts").withColumns(cyclic())
    return t.select("op_id", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in CYCLIC])


@query("ratio_features", sql(f"""
SELECT op_id, {r('daily_volume / nullif(amount, 0)', 'volume_amount_ratio')},
  {r('daily_volume / nullif(client_mean_amount, 0)', 'volume_mean_ratio')},
  {r('spread / nullif(daily_volume, 0)', 'spread_volume_ratio', 12)},
  {r('amount_ma_5 / nullif(client_mean_amount, 0)', 'ma5_to_mean_ratio')}
FROM loaded""", "loaded"))
def ratio_features(spark, sf):
    t = load_trades(trades_from_orders(spark, sf))
    new = {**ratios.volume_ratios(),
           "ma5_to_mean_ratio": ratios.trend_ratios()["ma5_to_mean_ratio"]}
    return rounded(t.select("op_id", *[c.alias(n) for n, c in new.items()]),
                   spread_volume_ratio=12)


@query("interaction_features", sql(f"""
SELECT op_id, {r('amount * client_mean_amount', 'amount_x_mean', -3)},
  {r('amount * spread', 'amount_x_spread', 8)}, {r('amount_ma_5 * spread', 'ma5_x_spread', 10)},
  {r('daily_volume / nullif(amount, 0)', 'volume_amount_ratio')},
  {r('spread / nullif(daily_volume, 0)', 'spread_volume_ratio', 12)},
  {r('amount * closed_rate', 'amount_x_rate', 8)}
FROM loaded""", "loaded"))
def interaction_features(spark, sf):
    t = load_trades(trades_from_orders(spark, sf))
    new = {**ratios.interactions(), "amount_x_rate": ratios.rate_interactions()["amount_x_rate"]}
    return rounded(t.select("op_id", *[c.alias(n) for n, c in new.items()]),
                   amount_x_mean=-3, amount_x_spread=8, ma5_x_spread=10, amount_x_rate=8,
                   spread_volume_ratio=12)


@query("signed_amount", sql("""
SELECT op_id, CASE op_type WHEN 'buy' THEN amount WHEN 'sell' THEN -amount END AS signed_amount
FROM ops_orders"""))
def signed_amount(spark, sf):
    t = trades_from_orders(spark, sf, ["op_id", "op_type", "amount"])
    return t.select("op_id", ratios.signed_amount().alias("signed_amount"))


@query("one_hot", sql("SELECT op_id, " + ", ".join(
    f"CAST(coalesce({c} = '{v}', FALSE) AS INT) AS \"{c}_{v}\""
    for c, vs in (("op_type", ("buy", "sell")),
                  ("category", ("click", "error", "purchase", "signup", "view")))
    for v in vs) + " FROM ops_events"))
def one_hot_query(spark, sf):
    t = trades_from_events(spark, sf).select("op_id", "op_type", "category")
    return one_hot(t, ["op_type", "category"]).drop("op_type", "category")


HOT = ("client_id", "category", "product", "op_type")


@query("one_hot_vectors", sql(f"""
SELECT op_id, array_to_string(list_sort([{', '.join(
    f"CASE WHEN {c} IS NOT NULL THEN p{i} END" for i, c in enumerate(HOT))}]
    .list_filter(lambda x: x IS NOT NULL)), ',') AS hot
FROM ops_orders """ + " ".join(
    f"LEFT JOIN (SELECT v AS v{i}, s + row_number() OVER (ORDER BY v) - 1 AS p{i} FROM "
    f"(SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM ops_orders WHERE {c} IS NOT NULL), (SELECT "
    + " + ".join(["0 * count(*)", *[f"count(DISTINCT {b})" for b in HOT[:i]]])
    + f" AS s FROM ops_orders)) t{i} ON CAST({c} AS VARCHAR) = v{i}" for i, c in enumerate(HOT))))
def one_hot_vectors(spark, sf):
    """The places of the ones: clients, categories, products and sides in one sparse vector."""
    t = materialize(trades_from_orders(spark, sf, ["op_id", *HOT]), "trades")
    encoder = OneHotVectors.fit(t, HOT)
    path = scratch_path(spark, "one-hot")
    encoder.save(path)
    out = OneHotVectors.load(spark, path).transform(t)
    text = F.regexp_extract(F.col("one_hot").cast("string"), r",\[([0-9,]*)\],", 1)
    return out.select("op_id", text.alias("hot"))


STATS = {
    f"client_{n}_{how}": f"{fn}({c})"
    for n, c, hows in (("volume", "daily_volume", "mean std max min"),
                       ("amount", "amount", "mean std max min"),
                       ("spread", "spread", "mean std"))
    for how, fn in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"), ("min", "min"))
    if how in hows.split()
}
STAT_DIGITS = {n: 10 if "spread" in n else 6 for n in STATS}


@query("client_stats", sql(
    "SELECT client_id, " + ", ".join(r(e, n, STAT_DIGITS[n]) for n, e in STATS.items())
    + " FROM loaded GROUP BY client_id", "loaded"))
def client_stats(spark, sf):
    t = with_daily_volume(trades_from_orders(
        spark, sf, ["op_id", "client_id", "close_ts", "amount", "spread"]))
    return rounded(stats.client_stats(t), **STAT_DIGITS)


@query("client_stats_join", sql(
    "SELECT op_id, " + ", ".join(
        r(f"{e} OVER (PARTITION BY client_id)", n, STAT_DIGITS[n]) for n, e in STATS.items())
    + " FROM loaded", "loaded"))
def client_stats_join(spark, sf):
    t = with_daily_volume(trades_from_orders(
        spark, sf, ["op_id", "client_id", "close_ts", "amount", "spread"]))
    return rounded(stats.with_client_stats(t).select("op_id", *STATS), **STAT_DIGITS)


TRANSFORM = {
    "amount_std": "stddev_samp(amount)", "amount_max": "max(amount)",
    "amount_min": "min(amount)", "amount_median": "median(amount)",
    "spread_std": "stddev_samp(spread)", "spread_max": "max(spread)",
    "spread_min": "min(spread)", "spread_median": "median(spread)",
}
TRANSFORM_DIGITS = {n: 10 if "spread" in n else 6 for n in TRANSFORM}
TREND_SQL = (f"{over_client('avg', 'amount', 30)} / "
             f"nullif({over_client('avg', 'amount', 90)}, 0)")


@query("client_transform_stats", sql(
    "SELECT op_id, " + ", ".join(
        r(f"{e} OVER (PARTITION BY client_id)", n, TRANSFORM_DIGITS[n])
        for n, e in TRANSFORM.items())
    + ", count(amount) OVER (PARTITION BY client_id) AS client_trades, "
    + r(TREND_SQL, "volume_trend", 8) + " FROM ops_orders"))
def client_transform_stats(spark, sf):
    t = statistical_features(trades_from_orders(
        spark, sf, ["op_id", "client_id", "close_ts", "amount", "spread"]))
    return rounded(t.select("op_id", *TRANSFORM, "client_trades", "volume_trend"),
                   volume_trend=8, **TRANSFORM_DIGITS)


HOLIDAYS_SQL = """
years AS (SELECT range AS y FROM range(1994, 2031)),
fixed AS (
  SELECT make_date(y, 1, 1) AS day FROM years UNION ALL
  SELECT make_date(y, 6, 19) FROM years WHERE y >= 2021 UNION ALL
  SELECT make_date(y, 7, 4) FROM years UNION ALL
  SELECT make_date(y, 11, 11) FROM years UNION ALL
  SELECT make_date(y, 12, 25) FROM years),
floating AS (
  SELECT d::DATE AS day FROM range(DATE '1994-01-01', DATE '2031-01-01', INTERVAL 1 DAY) t(d)
  WHERE (isodow(d) = 1 AND ((month(d) IN (1, 2) AND day(d) BETWEEN 15 AND 21)
                            OR (month(d) = 5 AND day(d) >= 25)
                            OR (month(d) = 9 AND day(d) <= 7)
                            OR (month(d) = 10 AND day(d) BETWEEN 8 AND 14)))
     OR (isodow(d) = 4 AND month(d) = 11 AND day(d) BETWEEN 22 AND 28)),
holidays AS (
  SELECT day FROM fixed UNION
  SELECT (day - INTERVAL 1 DAY)::DATE FROM fixed WHERE isodow(day) = 6 UNION
  SELECT (day + INTERVAL 1 DAY)::DATE FROM fixed WHERE isodow(day) = 7 UNION
  SELECT day FROM floating)"""


@query("holiday_flag", sql("""
SELECT op_id, CAST(CAST(close_ts AS DATE) IN (SELECT day FROM holidays) AS INT) AS is_holiday
FROM ops_orders""", extra=HOLIDAYS_SQL))
def holiday_flag(spark, sf):
    t = trades_from_orders(spark, sf, ["op_id", "close_ts"])
    return with_holidays(t).select("op_id", "is_holiday")


# ---- feature chains


def stored_loaded(spark, sf):
    """Chains read their input several times, so it is written once."""
    return materialize(load_trades(trades_from_orders(spark, sf)), "loaded")


G1A_INT = ("year", "month", "day", "weekday", "quarter",
           "is_weekend", "is_month_start", "is_month_end")
G1A_RAW = ("amount", "spread", "closed_rate", "amount_ma_5", "client_mean_amount", "daily_volume")
G1A_ROLLING = windows.volume_means() + windows.volume_stds()
FN = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min"}


def _g1a_sql() -> str:
    new = {
        "year": "year(close_ts)", "day": "day(close_ts)",
        "weekday": "isodow(close_ts) - 1", "quarter": "quarter(close_ts)",
        "is_weekend": "CAST(isodow(close_ts) >= 6 AS INT)",
        "is_month_start": "CAST(day(close_ts) <= 5 AS INT)",
        "is_month_end": "CAST(day(close_ts) >= 25 AS INT)",
        **CYCLIC,
        "volume_amount_ratio": "daily_volume / nullif(amount, 0)",
        "volume_mean_ratio": "daily_volume / nullif(client_mean_amount, 0)",
        "spread_volume_ratio": "spread / nullif(daily_volume, 0)",
        **{s.name: over_client(FN[s.how], s.column, s.rows) for s in G1A_ROLLING},
        **{n: f"{e} OVER (PARTITION BY client_id)" for n, e in STATS.items()},
        "category_code": "dense_rank() OVER (ORDER BY category) - 1",
    }
    listed = ", ".join(f"{e} AS {n}" for n, e in new.items())
    names = [*G1A_RAW, "month", *new]
    scaled = ", ".join(
        r(f"({n} - avg({n}) OVER ()) / coalesce(nullif(stddev_pop({n}) OVER (), 0), 1)", n)
        for n in names)
    return sql(f"SELECT op_id, client_id, {scaled} FROM featured", "loaded",
               extra=f"featured AS (SELECT *, {listed} FROM loaded)")


@query("features_g1a", _g1a_sql())
def features_g1a_query(spark, sf):
    t, _ = features_g1a(stored_loaded(spark, sf))
    numeric = [n for n, k in t.dtypes if k == "double"]
    return rounded(t.select("op_id", "client_id", *numeric))


G1B_DIGITS = {"spread_times_amount": 8, "trend_to_mean_ratio": 12}


def _g1b_sql() -> str:
    names = ("daily_to_mean_ratio", "ma5_to_mean_ratio", "spread_times_amount",
             "trend_to_mean_ratio")
    stat = ", ".join(
        r(f"{e} OVER (PARTITION BY client_id)", n, TRANSFORM_DIGITS[n])
        for n, e in TRANSFORM.items())
    filled = ", ".join(
        r(f"coalesce({n}, median({n}) OVER ())", n, G1B_DIGITS.get(n, 6)) for n in names)
    return sql(
        f"""SELECT op_id, {CALENDAR_SQL},
        {', '.join(f'round({e}, 6) + 0.0 AS {n}' for n, e in CYCLIC.items())}, {stat},
        count(amount) OVER (PARTITION BY client_id) AS client_trades,
        {r('volume_trend', 'volume_trend', 8)}, {filled} FROM (
        SELECT *, daily_volume / nullif(client_mean_amount, 0) AS daily_to_mean_ratio,
          amount_ma_5 / nullif(client_mean_amount, 0) AS ma5_to_mean_ratio,
          spread * amount AS spread_times_amount,
          volume_trend / nullif(client_mean_amount, 0) AS trend_to_mean_ratio
        FROM (SELECT *, {TREND_SQL} AS volume_trend FROM loaded))""", "loaded")


@query("features_g1b", _g1b_sql())
def features_g1b_query(spark, sf):
    t = features_g1b(stored_loaded(spark, sf))
    t = t.withColumns({
        **{c: F.round(c, 6) + F.lit(0.0) for c in CYCLIC},
        **{c: calendar()[c] for c in ("is_month_start", "is_month_end")},
        "next_ts": text_time("next_ts")})
    keep = ("op_id", "year", "month", "day", "quarter", "weekday", "day_name", "is_weekend",
            "is_month_start", "is_month_end", "is_last_day", "next_ts", "epoch_seconds", *CYCLIC,
            *TRANSFORM, "client_trades", "volume_trend", "daily_to_mean_ratio",
            "ma5_to_mean_ratio", "spread_times_amount", "trend_to_mean_ratio")
    out = rounded(t.select(*keep), volume_trend=8, **TRANSFORM_DIGITS, **G1B_DIGITS)
    return out.withColumns({c: F.col(c) + F.lit(0.0) for c in CYCLIC})


G2_ROLLING = windows.client_amount_stats()
G2_RATE = windows.table_rate_stats()
G2_LEVELS = {
    "op_type": ("buy", "sell"),
    "category": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    "product": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
}


def _g2_sql() -> str:
    rolled = ", ".join(
        r(over_client(FN[s.how], s.column, s.rows), s.name, 4 if s.how == "std" else 6)
        for s in G2_ROLLING)
    rates = ", ".join(r(over_table(FN[s.how], s.column, s.rows), s.name, 10) for s in G2_RATE)
    hot = ", ".join(
        f"CAST(coalesce({c} = '{v}', FALSE) AS INT) AS \"{c}_{v}\""
        for c, vs in G2_LEVELS.items() for v in vs)
    parts = CALENDAR_SQL.split("CAST(CAST(close_ts AS DATE) = last_day")[0].rstrip().rstrip(",")
    return sql(f"""SELECT op_id, {parts},
      CAST(floor((epoch_us(close_ts) - min(epoch_us(close_ts)) OVER ()) / 86400000000) AS BIGINT)
        AS days_since_start, {rolled}, {rates}, {hot},
      {r('amount * closed_rate', 'amount_x_rate', 8)},
      {r('spread * amount', 'spread_x_amount', 8)},
      CASE op_type WHEN 'buy' THEN amount WHEN 'sell' THEN -amount END AS signed_amount
      FROM ops_orders""")


@query("features_g2", _g2_sql())
def features_g2_query(spark, sf):
    t = features_g2(materialize(trades_from_orders(spark, sf), "trades"))
    t = t.withColumn("quarter", F.quarter("close_ts"))
    t = t.drop("client_id", "close_ts", "amount", "category", "product", "op_type", "spread",
               "closed_rate")
    return rounded(t, amount_x_rate=8, spread_x_amount=8, **{s.name: 10 for s in G2_RATE},
                   **{s.name: 4 for s in G2_ROLLING if s.how == "std"})
