"""Queries: casts, filters, imputation, clipping, scaling, profiles."""

from pyspark.sql import functions as F

from voltide.operators import clean, stats
from voltide.operators.scale import RobustScale, StandardScale
from voltide.plans.catalog import query, rounded, text_time
from voltide.plans.cleaning import clean_g1, clean_g2, load_trades
from voltide.plans.oracle import r, rs, sql
from voltide.session import materialize, scratch_path
from voltide.sources import files
from voltide.sources.tables import (
    read_table,
    stored_trades,
    trades_from_events,
    trades_from_orders,
)

FENCES = """
fences AS (
  SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
    SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM ops_events)
)"""


@query("cast_lenient", """
SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS prop_number,
       TRY_CAST(event_type AS DOUBLE) AS type_number
FROM events""")
def cast_lenient(spark, sf):
    e = read_table(spark, sf, "events").select(
        "event_id",
        F.regexp_extract("props", "[0-9]+", 0).alias("prop_number"),
        F.col("event_type").alias("type_number"),
    )
    return clean.cast_lenient(e, ["prop_number", "type_number"])


@query("iqr_filter", sql(
    "SELECT op_id, client_id, amount FROM ops_events, fences WHERE amount BETWEEN lo AND hi",
    extra=FENCES))
def iqr_filter(spark, sf):
    t = trades_from_events(spark, sf).select("op_id", "client_id", "amount")
    return clean.iqr_filter(t)


@query("iqr_report", sql("""
SELECT count(*) AS rows_before, count(*) FILTER (amount BETWEEN lo AND hi) AS rows_after,
       count(*) FILTER (amount < lo OR amount > hi) AS outliers,
       min(amount) AS min_before, max(amount) AS max_before,
       min(amount) FILTER (amount BETWEEN lo AND hi) AS min_after,
       max(amount) FILTER (amount BETWEEN lo AND hi) AS max_after
FROM ops_events, fences""", extra=FENCES))
def iqr_report(spark, sf):
    return clean.iqr_report(trades_from_events(spark, sf))


@query("range_repair", sql("""
SELECT op_id, CASE WHEN amount < 10 OR amount > 100 THEN (SELECT median(amount) FROM ops_events)
              ELSE amount END AS amount
FROM ops_events"""))
def range_repair(spark, sf):
    t = trades_from_events(spark, sf).select("op_id", "amount")
    return clean.range_repair(t, {"amount": (10.0, 100.0)})


def _validated(column: str) -> str:
    return f"""
SELECT '{column}' AS column_name, count(*) FILTER ({column} < 0) AS negatives,
       count(*) FILTER ({column} IS NULL) AS nulls,
       count(*) FILTER ({column} NOT BETWEEN lo AND hi) AS outliers,
       TRUE AS is_numeric, count(*) FILTER ({column} < 0) = 0 AS is_valid
FROM ops_v, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
  SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM ops_v))"""


@query("validate_batch", sql(
    " UNION ALL ".join(_validated(c) for c in ("amount", "signed_amount", "spread"))
    + """ UNION ALL SELECT 'category', 0, count(*) FILTER (category IS NULL), 0, FALSE, FALSE
FROM ops_v""",
    extra="""ops_v AS (SELECT *, CASE op_type WHEN 'buy' THEN amount WHEN 'sell' THEN -amount END
    AS signed_amount FROM ops_orders)"""))
def validate_batch(spark, sf):
    from voltide.functions.ratios import signed_amount

    t = stored_trades(spark, sf, ["op_id", "amount", "op_type", "spread", "category"])
    t = t.withColumn("signed_amount", signed_amount())
    return clean.validate_batch(t, ["amount", "signed_amount", "spread", "category"])


@query("impute_client_median", sql("""
SELECT op_id, round(coalesce(spread, m, median(coalesce(spread, m)) OVER ()), 10) AS spread,
       round(coalesce(closed_rate, mr, median(coalesce(closed_rate, mr)) OVER ()), 10)
         AS closed_rate
FROM (SELECT *, median(spread) OVER (PARTITION BY client_id) AS m,
             median(closed_rate) OVER (PARTITION BY client_id) AS mr FROM ops_orders)"""))
def impute_client_median(spark, sf):
    t = stored_trades(spark, sf, ["op_id", "client_id", "spread", "closed_rate"])
    out = clean.impute_client_median(t, ["spread", "closed_rate"])
    return rounded(out.select("op_id", "spread", "closed_rate"), 10)


@query("impute_weekday_median", sql("""
SELECT op_id, round(coalesce(spread, median(spread) OVER (PARTITION BY isodow(close_ts))), 10)
  AS spread
FROM ops_orders"""))
def impute_weekday_median(spark, sf):
    t = stored_trades(spark, sf, ["op_id", "close_ts", "spread"])
    return rounded(clean.impute_weekday_median(t, "spread").select("op_id", "spread"), 10)


@query("impute_median", sql("""
SELECT op_id, round(coalesce(spread, (SELECT median(spread) FROM ops_orders)), 10) AS spread,
  round(coalesce(closed_rate, (SELECT median(closed_rate) FROM ops_orders)), 10) AS closed_rate
FROM ops_orders"""))
def impute_median(spark, sf):
    t = stored_trades(spark, sf, ["op_id", "spread", "closed_rate"])
    return rounded(clean.impute_median(t, ["spread", "closed_rate"]), 10)


@query("impute_mean", sql("""
SELECT op_id, round(coalesce(spread, (SELECT avg(spread) FROM ops_orders)), 10) AS spread,
  round(coalesce(closed_rate, (SELECT avg(closed_rate) FROM ops_orders)), 10) AS closed_rate
FROM ops_orders"""))
def impute_mean(spark, sf):
    t = trades_from_orders(spark, sf, ["op_id", "spread", "closed_rate"])
    return rounded(clean.impute_mean(t, ["spread", "closed_rate"]), 10)


@query("winsorize", sql("""
SELECT op_id, round(least(greatest(amount, lo), hi), 6) AS amount,
  round(CASE WHEN signed IS NULL THEN NULL
        ELSE least(greatest(greatest(signed, 0), slo), shi) END, 6) AS signed_amount
FROM (
  SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi,
         s1 - 1.5 * (s3 - s1) AS slo, s3 + 1.5 * (s3 - s1) AS shi
  FROM signed_events, (
    SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3,
           quantile_cont(greatest(signed, 0), 0.25) FILTER (signed IS NOT NULL) AS s1,
           quantile_cont(greatest(signed, 0), 0.75) FILTER (signed IS NOT NULL) AS s3
    FROM signed_events))""",
    extra="""signed_events AS (SELECT *, CASE op_type WHEN 'buy' THEN amount
      WHEN 'sell' THEN -amount END AS signed FROM ops_events)"""))
def winsorize(spark, sf):
    from voltide.functions.ratios import signed_amount

    t = trades_from_events(spark, sf).select(
        "op_id", "amount", signed_amount().alias("signed_amount")
    )
    return rounded(clean.winsorize(t, ["amount", "signed_amount"], lower_zero=True))


@query("standard_scale", sql("""
SELECT op_id,
  round((amount - avg(amount) OVER ()) / nullif(stddev_pop(amount) OVER (), 0), 6) AS amount,
  round((spread - avg(spread) OVER ()) / nullif(stddev_pop(spread) OVER (), 0), 6) AS spread
FROM ops_orders"""))
def standard_scale(spark, sf):
    t = trades_from_orders(spark, sf, ["op_id", "amount", "spread"])
    return rounded(StandardScale.fit(t, ["amount", "spread"]).transform(t))


@query("robust_scale", sql("""
SELECT op_id, round(coalesce((x - m) / nullif(d, 0), 0), 6) AS amount
FROM (SELECT *, median(abs(x - m)) OVER () AS d
      FROM (SELECT *, median(x) OVER () AS m
            FROM (SELECT op_id, least(greatest(amount, lo), hi) AS x FROM ops_events, fences)))""",
    extra=FENCES))
def robust_scale(spark, sf):
    t = trades_from_events(spark, sf).select("op_id", "amount")
    return rounded(RobustScale.fit(t, ["amount"]).transform(t))


LINE_DAY = "strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate"


@query("dedup_rows", f"SELECT DISTINCT * REPLACE ({LINE_DAY}) FROM lineitem")
def dedup_rows(spark, sf):
    t = clean.drop_duplicate_rows(read_table(spark, sf, "lineitem"))
    return t.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query("dedup_report", """
SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after,
       CAST(sum(n) AS BIGINT) - count(*) AS removed
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)""")
def dedup_report(spark, sf):
    return clean.duplicate_report(read_table(spark, sf, "lineitem"))


@query("mad", sql("SELECT median(amount) AS median, mad(amount) AS mad FROM ops_events"))
def mad(spark, sf):
    median, spread = stats.mad(trades_from_events(spark, sf), "amount")
    return spark.createDataFrame([(median, spread)], "median double, mad double")


PROFILED = {"op_id": "bigint", "client_id": "bigint", "close_ts": "timestamp", "amount": "double",
            "category": "string", "product": "string", "op_type": "string", "spread": "double",
            "closed_rate": "double"}


@query("data_profile", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, "
    f"count(DISTINCT {c}) AS distinct_values, '{t}' AS data_type FROM ops_orders"
    for c, t in PROFILED.items())))
def data_profile(spark, sf):
    return stats.data_profile(trades_from_orders(spark, sf))


@query("validation_file", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, "
    f"count(DISTINCT {c}) AS distinct_values, '{t}' AS data_type, "
    "'column ''close_ts'' not found' AS issues FROM ops_orders"
    for c, t in PROFILED.items() if c != "close_ts")))
def validation_file(spark, sf):
    """The validation report of trades without a date, written and read again."""
    from voltide.plans.cleaning import validation_report

    report = validation_report(trades_from_orders(spark, sf, [c for c in PROFILED if c != "close_ts"]))
    path = scratch_path(spark, "report")
    files.write_report(report, path)
    back = files.read_report(spark, path, report.schema)
    return back.withColumn("issues", F.array_join("issues", "; "))


@query("column_summary", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')}, "
    f"count(*) - count({c}) AS nulls FROM ops_orders"
    for c in ("amount", "spread", "closed_rate"))))
def column_summary(spark, sf):
    columns = ["amount", "spread", "closed_rate"]
    return rounded(stats.column_summary(trades_from_orders(spark, sf, columns), columns))


@query("describe_features", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, {r(f'avg({c})', 'mean')}, "
    f"{r(f'stddev_samp({c})', 'std')}, {r(f'min({c})', 'min')}, {r(f'max({c})', 'max')}, "
    f"{r(f'quantile_cont({c}, 0.25)', 'p25')}, {r(f'quantile_cont({c}, 0.5)', 'p50')}, "
    f"{r(f'quantile_cont({c}, 0.75)', 'p75')} FROM ops_orders"
    for c in ("amount", "spread", "closed_rate"))))
def describe_features(spark, sf):
    columns = ["amount", "spread", "closed_rate"]
    return rounded(stats.describe_features(stored_trades(spark, sf, columns), columns))


@query("missing_counts", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM ops_orders"
    for c in ("amount", "op_type", "spread", "closed_rate"))))
def missing_counts(spark, sf):
    columns = ["amount", "op_type", "spread", "closed_rate"]
    return clean.missing_counts(trades_from_orders(spark, sf, columns))


CLEAN_G1 = ("amount", "spread", "closed_rate", "amount_ma_5", "client_mean_amount",
            "daily_volume", "month")
# means of numbers with few decimals fall on rounding ties: keep more digits
DIGITS = {"spread": 10, "closed_rate": 10}


def _clean_g1_sql() -> str:
    filled = ", ".join(
        f"greatest(coalesce({c}, {c}_m, median(coalesce({c}, {c}_m)) OVER ()), 0) AS {c}"
        for c in CLEAN_G1)
    medians = ", ".join(f"median({c}) OVER (PARTITION BY client_id) AS {c}_m" for c in CLEAN_G1)
    fences = ", ".join(
        f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3"
        for c in CLEAN_G1)
    clipped = ", ".join(
        r(f"least(greatest({c}, {c}_q1 - 1.5 * ({c}_q3 - {c}_q1)), "
          f"{c}_q3 + 1.5 * ({c}_q3 - {c}_q1))", c, DIGITS.get(c, 6))
        for c in CLEAN_G1 if c != "month")
    return sql(
        f"""SELECT op_id, CAST(client_id AS VARCHAR) AS client_id, category, day_name,
        CAST(month AS INT) AS month,
        strftime(next_ts, '%Y-%m-%d %H:%M:%S') AS next_ts, {clipped}
        FROM filled, (SELECT {fences} FROM filled)""",
        "loaded",
        extra=f"filled AS (SELECT op_id, client_id, category, day_name, next_ts, {filled} "
              f"FROM (SELECT *, {medians} FROM loaded))")


@query("clean_g1", _clean_g1_sql())
def clean_g1_query(spark, sf):
    out = clean_g1(materialize(load_trades(trades_from_orders(spark, sf)), "loaded"))
    return rounded(out.select(
        "op_id", "client_id", "category", "day_name", "month",
        text_time("next_ts").alias("next_ts"), *[c for c in CLEAN_G1 if c != "month"]), **DIGITS)


@query("clean_g2", sql(f"""
SELECT op_id, client_id, amount, {rs(['spread', 'closed_rate'], 10)} FROM (
  SELECT op_id, client_id, amount, coalesce(spread, median(spread) OVER ()) AS spread,
         coalesce(closed_rate, median(closed_rate) OVER ()) AS closed_rate
  FROM ops_orders, (
    SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
      SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3
      FROM ops_orders))
  WHERE amount BETWEEN lo AND hi)"""))
def clean_g2_query(spark, sf):
    out = clean_g2(trades_from_orders(spark, sf))
    return rounded(out.select("op_id", "client_id", "amount", "spread", "closed_rate"), 10)


@query("clean_g2_events", sql(
    "SELECT op_id, client_id, amount, category FROM ops_events, fences "
    "WHERE amount BETWEEN lo AND hi", extra=FENCES))
def clean_g2_events(spark, sf):
    return clean_g2(trades_from_events(spark, sf)).select(
        "op_id", "client_id", "amount", "category")
