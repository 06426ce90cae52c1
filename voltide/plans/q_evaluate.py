"""Queries: metrics, error distribution, error patterns, reports."""


from voltide.functions.errors import normal_cdf_sql, normal_quantile
from voltide.operators import evaluate as ev
from voltide.operators.split import temporal_cut
from voltide.operators.stats import correlation_matrix
from voltide.operators.windows import Rolling, rolling
from voltide.plans.catalog import query, rounded, text_time
from voltide.plans.cleaning import load_trades
from voltide.plans.oracle import r, sql
from voltide.plans.production import evaluate_against
from voltide.plans.report import performance_report
from voltide.plans.views import event_errors, scored_events, scored_orders
from voltide.session import scratch_path
from voltide.sources import files
from voltide.sources.tables import trades_from_events, trades_from_orders

E = "(amount - predicted_amount)"
METRICS = f"""count(*) AS n, {r(f'sqrt(avg({E} * {E}))', 'rmse')}, {r(f'avg(abs{E})', 'mae')},
  {r(f'1 - sum({E} * {E}) / (var_pop(amount) * count(*))', 'r2')},
  {r(f'avg(abs{E} / nullif(abs(amount), 0)) * 100', 'mape')}"""


@query("eval_metrics", sql(f"""
SELECT {METRICS}, count(*) FILTER (amount = 0) AS zero_actuals,
  CAST(sqrt(avg({E} * {E})) > 100 AS INT) AS rmse_alert, CAST(avg(abs{E}) > 50 AS INT) AS mae_alert
FROM scored_orders""", "scored_orders"))
def eval_metrics(spark, sf):
    return rounded(ev.evaluate(scored_orders(spark, sf)))


@query("eval_joined", sql(f"""
SELECT {METRICS}, count(*) FILTER (amount = 0) AS zero_actuals,
  CAST(sqrt(avg({E} * {E})) > 100 AS INT) AS rmse_alert, CAST(avg(abs{E}) > 50 AS INT) AS mae_alert
FROM scored_events""", "scored_events"))
def eval_joined(spark, sf):
    predictions = scored_events(spark, sf).select("op_id", "predicted_amount")
    return rounded(evaluate_against(predictions, trades_from_events(spark, sf)))


@query("eval_by_client", sql(f"""
SELECT client_id, {METRICS}, count(*) FILTER (amount = 0) AS zero_actuals,
  CAST(sqrt(avg({E} * {E})) > 100 AS INT) AS rmse_alert, CAST(avg(abs{E}) > 50 AS INT) AS mae_alert
FROM scored_events GROUP BY client_id""", "scored_events"))
def eval_by_client(spark, sf):
    return rounded(ev.evaluate(scored_events(spark, sf), by=["client_id"]))


def _t_sql(n: str, z: float = normal_quantile(0.975)) -> str:
    """Student's 97.5 % quantile by its expansion in 1 / (n - 1), good to 1e-12 from 200 rows on."""
    # The published expansion's polynomials.
    terms = ((z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96,
             (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
             (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160)
    return f"({z!r} + " + " + ".join(f"{x!r} / power({n} - 1, {k + 1})" for k, x in enumerate(terms)) + ")"


@query("eval_extended", sql(f"""
SELECT {METRICS}, {r(f'avg({E} * {E})', 'mse')}, {r(f'max(abs{E})', 'max_error')},
  {r(f'median(abs{E})', 'median_error')}, {r(f'stddev_pop({E})', 'error_std')},
  {r(f"avg({E}) - {_t_sql('count(*)')} * stddev_samp({E}) / sqrt(count(*))", 'error_ci_lower')},
  {r(f"avg({E}) + {_t_sql('count(*)')} * stddev_samp({E}) / sqrt(count(*))", 'error_ci_upper')}
FROM scored_events""", "scored_events"))
def eval_extended(spark, sf):
    return rounded(ev.evaluate_extended(scored_events(spark, sf)))


ERRORS = "errors AS (SELECT *, amount - predicted_amount AS error FROM scored_events)"
BIASED = """(SELECT count(*) AS n, avg(error) AS mean, stddev_pop(error) AS std,
  (avg(power(error, 3)) - 3 * avg(error) * avg(error * error) + 2 * power(avg(error), 3))
    / power(stddev_pop(error), 3) AS skewness, kurtosis_pop(error) AS kurtosis FROM errors)"""


@query("error_moments_biased", sql(
    f"SELECT n, {r('mean', 'mean')}, {r('std', 'std')}, {r('skewness', 'skewness')}, "
    f"{r('kurtosis', 'kurtosis')} FROM {BIASED}", "scored_events", extra=ERRORS))
def error_moments_biased(spark, sf):
    return rounded(ev.error_moments_biased(event_errors(spark, sf)))


@query("error_moments", sql(f"""
SELECT count(*) AS n, {r('avg(error)', 'mean_error')}, {r('stddev_samp(error)', 'std_error')},
  {r('median(error)', 'median_error')}, {r('skewness(error)', 'skewness')},
  {r('kurtosis(error)', 'kurtosis')}, {r('quantile_cont(error, 0.25)', 'q1_error')},
  {r('quantile_cont(error, 0.75)', 'q3_error')} FROM errors""", "scored_events", extra=ERRORS))
def error_moments(spark, sf):
    return rounded(ev.error_moments(event_errors(spark, sf)))


@query("normality_jb", sql(f"""
SELECT n, {r('jb', 'statistic', 4)}, {r('exp(-jb / 2)', 'p_value')}, exp(-jb / 2) > 0.05 AS is_normal
FROM (SELECT n, n / 6 * (skewness * skewness + kurtosis * kurtosis / 4) AS jb FROM {BIASED})""",
    "scored_events", extra=ERRORS))
def normality_jb(spark, sf):
    return rounded(ev.normality_jb(event_errors(spark, sf)), statistic=4)


@query("normality_ks", sql(f"""
SELECT n, {r('d', 'statistic')}, {r('least(1.0, p)', 'p_value', 9)}, least(1.0, p) > 0.05 AS is_normal
FROM (SELECT *, exp(-7.01256 * dd * dd * (m + 2.78019) + 2.99587 * dd * sqrt(m + 2.78019)
        - 0.122119 + 0.974598 / sqrt(m) + 1.67997 / m) AS p
  FROM (SELECT *, CASE WHEN n > 100 THEN 100 ELSE n END AS m,
               CASE WHEN n > 100 THEN d * power(n / 100, 0.49) ELSE d END AS dd
    FROM (SELECT any_value(n) AS n, max(greatest(c / n - f, f - (c - k) / n)) AS d
      FROM (SELECT *, {normal_cdf_sql('z')} AS f
        FROM (SELECT error, k, n, sum(k) OVER (ORDER BY error) AS c, (error - m) / s AS z
          FROM (SELECT error, count(*) AS k FROM errors GROUP BY error),
               (SELECT count(error) AS n, avg(error) AS m, stddev_samp(error) AS s FROM errors))))))""",
    "scored_events", extra=ERRORS))
def normality_ks(spark, sf):
    return rounded(ev.normality_ks(event_errors(spark, sf)), p_value=9)


QQ = ", ".join(f"({i / 100}, {normal_quantile(i / 100)!r})" for i in range(1, 100))


@query("qq_points", sql(f"""
SELECT p, round(CAST(theoretical AS DOUBLE), 6) AS theoretical, {r('s', 'sample')} FROM (
  SELECT unnest(list_transform(range(1, 100), lambda i: i / 100)) AS p,
         unnest(quantile_cont(error, {[i / 100 for i in range(1, 100)]})) AS s FROM errors)
JOIN (VALUES {QQ}) t(q, theoretical) ON p = q""", "scored_events", extra=ERRORS))
def qq_points(spark, sf):
    return rounded(ev.qq_points(event_errors(spark, sf)))


def _bias_sql(last: str) -> str:
    ladder = " ".join(
        f"WHEN amount >= e[{k + 1}] AND amount {'<' if k < 3 else last} e[{k + 2}] THEN {k}"
        for k in range(4))
    return sql(f"""
SELECT CAST(bin AS INT) AS bin, round(bias, 6) AS bias, rows, round(lo, 6) AS range_lo,
  round(hi, 6) AS range_hi, printf('%.2f-%.2f', lo, hi) AS range
FROM (SELECT bin, avg(predicted_amount - amount) AS bias, count(*) AS rows,
             any_value(e[bin + 1]) AS lo, any_value(e[bin + 2]) AS hi
      FROM (SELECT *, CASE {ladder} END AS bin FROM scored_events,
              (SELECT quantile_cont(amount, [0, 0.25, 0.5, 0.75, 1]) AS e FROM scored_events))
      WHERE bin IS NOT NULL GROUP BY bin)""", "scored_events")


@query("bias_by_range", _bias_sql("<="))
def bias_by_range(spark, sf):
    return rounded(ev.bias_by_range(scored_events(spark, sf)))


@query("bias_by_range_open", _bias_sql("<"))
def bias_by_range_open(spark, sf):
    return rounded(ev.bias_by_range(scored_events(spark, sf), include_max=False))


QUINTILES = ERRORS + """,
binned AS (
  SELECT *, CASE WHEN amount <= e[2] THEN 0 WHEN amount <= e[3] THEN 1 WHEN amount <= e[4] THEN 2
                 WHEN amount <= e[5] THEN 3 ELSE 4 END AS bin
  FROM errors, (SELECT quantile_cont(amount, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS e FROM scored_events))"""
BOUNDS = "round(any_value(e[bin + 1]), 6) AS range_lo, round(any_value(e[bin + 2]), 6) AS range_hi"


@query("error_by_quintile", sql(f"""
SELECT CAST(bin AS INT) AS bin, {r('avg(abs(error))', 'mean')},
  {r('stddev_samp(abs(error))', 'std')}, count(*) AS count, {BOUNDS}
FROM binned GROUP BY bin""", "scored_events", extra=QUINTILES))
def error_by_quintile(spark, sf):
    return rounded(ev.error_by_quintile(scored_events(spark, sf)))


@query("error_box", sql(f"""
SELECT CAST(bin AS INT) AS bin, {r('min(error)', 'low')},
  {r('quantile_cont(error, 0.25)', 'q1')}, {r('median(error)', 'median')},
  {r('quantile_cont(error, 0.75)', 'q3')}, {r('max(error)', 'high')}, {BOUNDS}
FROM binned GROUP BY bin""", "scored_events", extra=QUINTILES))
def error_box(spark, sf):
    return rounded(ev.error_box(scored_events(spark, sf)))


@query("histogram50", sql("""
SELECT CAST(bin AS INT) AS bin, count(*) AS rows, round(any_value(lo + (bin - 1) * w), 6) AS bin_lo
FROM (SELECT lo, (hi - lo) / 50 AS w, least(floor((amount - lo) / ((hi - lo) / 50)) + 1, 50) AS bin
      FROM ops_orders, (SELECT min(amount) AS lo, max(amount) AS hi FROM ops_orders))
GROUP BY bin"""))
def histogram50(spark, sf):
    return rounded(ev.histogram(trades_from_orders(spark, sf, ["amount"]), "amount"))


@query("error_acf", sql("""
SELECT CAST(k AS INT) AS lag, round(s / max(s) FILTER (k = 0) OVER (), 8) AS acf FROM ("""
    + " UNION ALL ".join(
        f"SELECT {k} AS k, sum(x * y) AS s FROM (SELECT x, lag(x, {k}) OVER "
        "(ORDER BY close_ts, op_id) AS y FROM off)" for k in range(21))
    + ")", "scored_events", extra=ERRORS
    + ", off AS (SELECT close_ts, op_id, error - avg(error) OVER () AS x FROM errors)"))
def error_acf(spark, sf):
    return rounded(ev.autocorrelation(event_errors(spark, sf)), 8)


FEATURES = ("amount", "predicted_amount", "spread", "closed_rate")


@query("feature_error_corr", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'corr({c}, abs{E})', 'correlation')} FROM scored_orders"
    for c in FEATURES), "scored_orders"))
def feature_error_corr(spark, sf):
    t = scored_orders(spark, sf, (
        "op_id", "client_id", "close_ts", "amount", "spread", "closed_rate"))
    return rounded(ev.feature_error_correlation(t, FEATURES))


CORRELATED = ("amount", "daily_volume", "client_mean_amount", "amount_ma_5", "spread")


@query("corr_matrix", sql(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r(f'corr({a}, {b})', 'correlation')} "
    "FROM loaded" for a in CORRELATED for b in CORRELATED), "loaded"))
def corr_matrix(spark, sf):
    return rounded(correlation_matrix(load_trades(trades_from_orders(spark, sf)), CORRELATED))


@query("prediction_summary", sql("""
SELECT count(*) AS n_predictions,
  strftime(min(close_ts), '%Y-%m-%d %H:%M:%S') AS first_prediction,
  strftime(max(close_ts), '%Y-%m-%d %H:%M:%S') AS last_prediction
FROM scored_events""", "scored_events"))
def prediction_summary(spark, sf):
    t = scored_events(spark, sf)
    s = ev.prediction_summary(t, "close_ts")
    return s.withColumns({c: text_time(c) for c in ("first_prediction", "last_prediction")})


@query("residual_points", sql(
    f"SELECT op_id, amount, {r('predicted_amount', 'predicted_amount')}, {r(E, 'error')}, "
    f"{r(f'abs{E}', 'abs_error')}, {r(f'{E} / nullif(amount, 0) * 100', 'error_pct')} "
    "FROM scored_events", "scored_events"))
def residual_points(spark, sf):
    return rounded(event_errors(spark, sf).select(
        "op_id", "amount", "predicted_amount", "error", "abs_error", "error_pct"))


NAIVE = {
    "last_1": "avg(amount) OVER (PARTITION BY client_id ORDER BY close_ts, op_id "
              "ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING)",
    "last_5": "avg(amount) OVER (PARTITION BY client_id ORDER BY close_ts, op_id "
              "ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)",
    "last_20": "avg(amount) OVER (PARTITION BY client_id ORDER BY close_ts, op_id "
               "ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)",
}


@query("model_comparison", sql(" UNION ALL ".join(f"""
SELECT '{m}' AS model, count(p) AS n, {r('sqrt(avg((amount - p) * (amount - p)))', 'rmse')},
  {r('avg(abs(amount - p))', 'mae')},
  {r('1 - sum((amount - p) * (amount - p)) / (var_pop(amount) * count(*))', 'r2')}
FROM (SELECT amount, {e} AS p FROM ops_events) WHERE p IS NOT NULL""" for m, e in NAIVE.items())))
def model_comparison(spark, sf):
    t = trades_from_events(spark, sf).select("op_id", "client_id", "close_ts", "amount")
    specs = [Rolling(f"last_{n}", "amount", "mean", n, shift=1) for n in (1, 5, 20)]
    return rounded(ev.compare_models(rolling(t, specs), [s.name for s in specs]))


@query("horizon_metrics", sql(f"""
SELECT horizon, count(*) AS n, {r(f'sqrt(avg({E} * {E}))', 'rmse')}, {r(f'avg(abs{E})', 'mae')}
FROM (SELECT *, CAST(floor((epoch_us(close_ts) - cut) / 604800000000.0) AS BIGINT) AS horizon
      FROM scored_orders, (SELECT quantile_cont(CAST(epoch_us(close_ts) AS DOUBLE), 0.8) AS cut
                           FROM scored_orders) WHERE epoch_us(close_ts) > cut)
GROUP BY horizon""", "scored_orders"))
def horizon_metrics(spark, sf):
    t = scored_orders(spark, sf)
    return rounded(ev.metrics_by_horizon(t, temporal_cut(t)))


def _report_sql() -> str:
    moments = {
        "mean_error": "avg(error)", "std_error": "stddev_samp(error)",
        "median_error": "median(error)", "skewness": "skewness(error)",
        "kurtosis": "kurtosis(error)", "q1_error": "quantile_cont(error, 0.25)",
        "q3_error": "quantile_cont(error, 0.75)",
    }
    parts = ["SELECT 'data_summary' AS section, 'n_predictions' AS name, "
             "CAST(count(*) AS DOUBLE) AS value FROM errors",
             "SELECT 'data_summary', 'first_prediction', floor(epoch(min(close_ts))) FROM errors",
             "SELECT 'data_summary', 'last_prediction', floor(epoch(max(close_ts))) FROM errors"]
    parts += [f"SELECT 'error_distribution', '{n}', round({e}, 6) FROM errors"
              for n, e in moments.items()]
    for n, e in (("mean", "avg(abs(error))"), ("std", "stddev_samp(abs(error))"),
                 ("count", "CAST(count(*) AS DOUBLE)")):
        parts.append(f"SELECT 'error_by_range', bin || '.{n}', round({e}, 6) FROM binned GROUP BY bin")
    parts += [f"SELECT 'autocorrelation', 'lag_{k}', round(sum(x * y) / (SELECT sum(x * x) FROM off), 6)"
              f" FROM (SELECT x, lag(x, {k}) OVER (ORDER BY close_ts, op_id) AS y FROM off)"
              for k in range(21)]
    parts += [f"SELECT 'error_correlation', '{c}', round(corr({c}, abs(error)), 6) FROM errors"
              for c in ("amount", "predicted_amount")]
    return sql(" UNION ALL ".join(parts), "scored_events", extra=QUINTILES
               + ", off AS (SELECT close_ts, op_id, error - avg(error) OVER () AS x FROM errors)")


@query("performance_report", _report_sql())
def performance_report_query(spark, sf):
    return rounded(performance_report(scored_events(spark, sf), ts="close_ts"))


@query("report_file", _report_sql())
def report_file(spark, sf):
    """The performance report, written and read again."""
    report = performance_report(scored_events(spark, sf), ts="close_ts")
    path = scratch_path(spark, "report")
    files.write_report(report, path)
    return rounded(files.read_report(spark, path, report.schema))
