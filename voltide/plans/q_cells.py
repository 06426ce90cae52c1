"""Queries: trees, scoring, search and stacking on two yes-or-no features.

A tree of depth 2 on them ends in their four combinations, a tree of depth 0 in one
leaf, so its predictions are averages and the whole chain around it (splits, scaling,
stored scorers, streams, folds, blends) has an SQL equivalent.
"""

import datetime as dt

from pyspark.sql import functions as F

from voltide.operators import forecast, joint, models
from voltide.operators.split import hash_split, temporal_split
from voltide.plans.catalog import query, rounded, text_time
from voltide.plans.oracle import r, sql
from voltide.plans.q_select import BUCKET
from voltide.session import materialize, scratch_path
from voltide.sources.tables import trades_from_events, trades_from_orders
from voltide.streaming import streams

CELLS = ("bought", "late")
TREE = {"n_estimators": 1, "max_depth": 2}
BASES = ({"n_estimators": 1, "max_depth": 0}, {"n_estimators": 1, "max_depth": 2})
RUN = dt.datetime(2024, 1, 1, 12)


def celled(trades):
    return trades.withColumns({
        "bought": F.coalesce(F.col("op_type") == "buy", F.lit(False)).cast("int"),
        "late": (F.dayofmonth("close_ts") > 15).cast("int"),
    })


def order_cells(spark, sf):
    return materialize(celled(trades_from_orders(
        spark, sf, ["op_id", "close_ts", "amount", "op_type"])), "cells")


def _cells(view: str) -> str:
    return f"""cells AS (SELECT op_id, close_ts, amount, CAST(coalesce(op_type = 'buy', FALSE) AS INT) AS bought,
    CAST(day(close_ts) > 15 AS INT) AS late, {BUCKET} AS bucket FROM {view})"""


@query("tree_predict", sql(f"""
SELECT op_id, amount, round(p, 6) AS predicted_amount FROM cells
JOIN (SELECT bought, late, avg(amount) AS p FROM cells WHERE bucket % 100 < 80 GROUP BY ALL) USING (bought, late)
WHERE bucket % 100 >= 80""", extra=_cells("ops_orders")))
def tree_predict(spark, sf):
    t = hash_split(order_cells(spark, sf))
    model = models.fit(t.where("split = 'train'"), CELLS, TREE)
    return rounded(model.transform(t.where("split = 'test'")).select("op_id", "amount", "predicted_amount"))


@query("tree_holdout", sql(f"""
SELECT count(*) AS n, {r('sqrt(avg((amount - p) * (amount - p)))', 'rmse')}, {r('avg(abs(amount - p))', 'mae')},
  {r('1 - sum((amount - p) * (amount - p)) / (var_pop(amount) * count(*))', 'r2')},
  {r('avg(abs(amount - p) / nullif(abs(amount), 0)) * 100', 'mape')}, count(*) FILTER (amount = 0) AS zero_actuals,
  CAST(sqrt(avg((amount - p) * (amount - p))) > 100 AS INT) AS rmse_alert, CAST(avg(abs(amount - p)) > 50 AS INT) AS mae_alert
FROM cells
JOIN (SELECT bought, late, avg(amount) AS p FROM cells WHERE bucket % 100 < 80 GROUP BY ALL) USING (bought, late)
WHERE bucket % 100 >= 80""", extra=_cells("ops_orders")))
def tree_holdout(spark, sf):
    t = hash_split(order_cells(spark, sf))
    model = models.fit(t.where("split = 'train'"), CELLS, TREE)
    return rounded(models.holdout_metrics(model, t.where("split = 'test'")))


_SCORED = """
SELECT op_id, bought, late, round(p, 6) AS predicted_amount, {time} AS prediction_timestamp FROM cells
JOIN (SELECT bought, late, avg(amount) AS p FROM cells, cut WHERE epoch_us(close_ts) <= cut_at GROUP BY ALL)
  USING (bought, late){where}"""
_CUT = ", cut AS (SELECT quantile_cont(CAST(epoch_us(close_ts) AS DOUBLE), 0.8) AS cut_at FROM cells)"


@query("scored_cells", sql(
    _SCORED.format(time="'2024-01-01 12:00:00'", where=", cut WHERE epoch_us(close_ts) > cut_at"),
    extra=_cells("ops_orders") + _CUT))
def scored_cells(spark, sf):
    """A stored scorer, read again, scores the batch after its training rows."""
    t = temporal_split(order_cells(spark, sf))
    scorer = models.Scorer.train(t.where("split = 'train'"), CELLS, TREE)
    path = scratch_path(spark, "scorer")
    scorer.save(spark, path)
    batch = t.where("split = 'test'").drop("split")
    out = models.Scorer.load(spark, path).score(batch, F.lit(RUN))
    return rounded(out.select("op_id", *CELLS, "predicted_amount", text_time("prediction_timestamp").alias("prediction_timestamp")))


@query("stream_scored_cells", sql(
    _SCORED.format(time="strftime(close_ts, '%Y-%m-%d %H:%M:%S')", where=""), extra=_cells("ops_events") + _CUT))
def stream_scored_cells(spark, sf):
    t = temporal_split(celled(trades_from_events(spark, sf)))
    scorer = models.Scorer.train(t.where("split = 'train'"), CELLS, TREE)
    live = celled(streams.trade_stream(spark, sf))
    out = streams.run_to_table(spark, scorer.score_stream(live, F.col("close_ts")), streams.append_to)
    return rounded(out.select("op_id", *CELLS, "predicted_amount", text_time("prediction_timestamp").alias("prediction_timestamp")))


def _fold_errors(folds: int, depth: int) -> str:
    """The squared errors of each row by a tree fitted to the other folds."""
    same = "a.bought = b.bought AND a.late = b.late AND " if depth else ""
    return f"""(SELECT a.fold, a.amount - b.p AS e FROM (SELECT *, bucket % {folds} AS fold FROM cells) a JOIN (
      SELECT f AS fold{', bought, late' if depth else ''}, avg(amount) AS p FROM cells, range({folds}) fs(f)
      WHERE bucket % {folds} <> f GROUP BY ALL) b ON {same}a.fold = b.fold)"""


def _search_sql(folds: int = 3) -> str:
    parts = [
        f"SELECT {depth}.0::DOUBLE AS max_depth, 1.0::DOUBLE AS n_estimators, {child}.0::DOUBLE AS min_child_weight, "
        f"{r('avg(rmse)', 'rmse')}, {r('stddev_pop(rmse)', 'std')} FROM "
        f"(SELECT sqrt(avg(e * e)) AS rmse FROM {_fold_errors(folds, depth)} GROUP BY fold)"
        for depth in (0, 2) for child in (1, 3)
    ]
    return sql(" UNION ALL ".join(parts), extra=_cells("ops_orders"))


@query("search_cells", _search_sql())
def search_cells(spark, sf):
    grid = {"max_depth": [0, 2], "n_estimators": [1], "min_child_weight": [1, 3]}
    _, found = models.search(order_cells(spark, sf), CELLS, grid=grid)
    return rounded(found.select(*[F.col("settings")[k].alias(k) for k in grid], "rmse", "std"))


@query("cross_validated_cells", sql(f"""
SELECT CAST(fold AS INT) AS fold, rows, round(rmse, 6) AS rmse, {r('avg(rmse) OVER ()', 'rmse_mean')},
  {r('stddev_pop(rmse) OVER ()', 'rmse_std')}
FROM (SELECT fold, count(*) AS rows, sqrt(avg(e * e)) AS rmse FROM {_fold_errors(5, 2)} GROUP BY fold)""",
    extra=_cells("ops_orders")))
def cross_validated_cells(spark, sf):
    return rounded(models.cross_validate(order_cells(spark, sf), CELLS, TREE))


@query("stacked_cells", sql("""
SELECT op_id, round(i + w1 * a + w2 * b, 4) AS predicted_amount FROM cells
JOIN (SELECT bought, late, avg(amount) AS b FROM cells WHERE bucket % 100 < 80 GROUP BY ALL) USING (bought, late),
  (SELECT avg(amount) AS a FROM cells WHERE bucket % 100 < 80),
  (SELECT w1, w2, my - w1 * m1 - w2 * m2 AS i FROM (
    SELECT *, (g1 * c22 - g2 * c12) / (c11 * c22 - c12 * c12) AS w1, (g2 * c11 - g1 * c12) / (c11 * c22 - c12 * c12) AS w2
    FROM (SELECT avg(a) AS m1, avg(b) AS m2, avg(amount) AS my, var_pop(a) * count(*) + 1 AS c11,
        var_pop(b) * count(*) + 1 AS c22, covar_pop(a, b) * count(*) AS c12,
        covar_pop(a, amount) * count(*) AS g1, covar_pop(b, amount) * count(*) AS g2
      FROM (SELECT t.amount, x.a, y.b FROM train t
        JOIN (SELECT f, avg(amount) AS a FROM train, range(3) fs(f) WHERE fold <> f GROUP BY f) x ON t.fold = x.f
        JOIN (SELECT f, bought, late, avg(amount) AS b FROM train, range(3) fs(f) WHERE fold <> f GROUP BY ALL) y
          ON t.fold = y.f AND t.bought = y.bought AND t.late = y.late))))
WHERE bucket % 100 >= 80""", extra=_cells("ops_orders")
    + ", train AS (SELECT *, bucket % 3 AS fold FROM cells WHERE bucket % 100 < 80)"))
def stacked_cells(spark, sf):
    """Out-of-fold predictions of two bases, blended by ridge regression."""
    t = hash_split(order_cells(spark, sf))
    model = models.stack(t.where("split = 'train'"), CELLS, bases=BASES, alphas=[1.0])
    return rounded(model.transform(t.where("split = 'test'")).select("op_id", "predicted_amount"), 4)


# ---- forecasts


@query("forecast_rows", sql("""
SELECT strftime(close_ts, '%Y-%m-%d') AS ds, round(daily_volume, 6) AS y, amount, round(client_mean_amount, 6) AS client_mean_amount,
  round(amount_ma_5, 6) AS amount_ma_5, spread FROM loaded""", "loaded"))
def forecast_rows(spark, sf):
    from voltide.plans.cleaning import load_trades

    rows = forecast.forecast_input(load_trades(trades_from_orders(spark, sf)))
    return rounded(rows.withColumn("ds", F.date_format("ds", "yyyy-MM-dd")))


_TERMS = ["_holiday", *[f"_{name}_{f}_{k}" for name, (_, order) in joint.SEASONS.items()
                        for k in range(1, order + 1) for f in ("sin", "cos")],
          *[f"_x_{c}" for c in ("client_mean_amount", "amount_ma_5")]]


@query("forecast_certificate", sql(
    f"SELECT unnest({_TERMS!r}) AS name, 0.0::DOUBLE AS gradient FROM (SELECT max(amount) FROM ops_orders)"))
def forecast_certificate(spark, sf):
    """The gradient of the joint forecaster's objective at its weights, from all rows: zero."""
    from voltide.plans.cleaning import load_trades

    t = load_trades(trades_from_orders(spark, sf))
    rows = materialize(forecast.forecast_input(t, ["client_mean_amount", "amount_ma_5"]), "rows")
    model = joint.JointForecaster.fit(rows, regressors=["client_mean_amount", "amount_ma_5"])
    return model.certificate(rows).select("name", (F.round("gradient", 6) + F.lit(0.0)).alias("gradient"))


@query("forecast_joint")
def forecast_joint(spark, sf):
    """Daily volume of all trades and 30 days ahead, trend and seasons fitted together."""
    daily = trades_from_orders(spark, sf, ["close_ts", "amount"]).groupBy(
        F.to_date("close_ts").cast("timestamp").alias("ds")).agg(F.sum("amount").alias("y"))
    daily = materialize(daily, "daily")
    model = joint.JointForecaster.fit(daily, seasons={k: joint.SEASONS[k] for k in ("yearly", "weekly")})
    out = forecast.forecast_future(model, daily, 30)
    return rounded(out.select("ds", "part", "yhat", "yhat_lower", "yhat_upper"))
