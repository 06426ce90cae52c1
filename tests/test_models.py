"""Models recover known structure; streams equal their batch counterpart."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltide.operators import forecast, joint, models, temporal
from voltide.operators.monitor import training_stats
from voltide.operators.split import id_bucket
from voltide.plans.production import evaluate_against, production_run, train_chain
from voltide.plans.queries import QUERIES
from voltide.sources.files import read_metric_records
from voltide.streaming import streams

FAST = {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def lines(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(0, 10, (400, 2))
    y = 5 * x[:, 0] + (x[:, 1] > 5) * 20 + 3
    rows = [(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "op_id bigint, a double, b double, amount double")


def halves(df):
    return df.where(id_bucket(4) > 0), df.where(id_bucket(4) == 0)


def test_boosted_trees_beat_the_mean(lines):
    train, test = halves(lines)
    model = models.fit(train, ["a", "b"], FAST)
    assert models.holdout_metrics(model, test).first()["r2"] > 0.8
    ranked = models.importance(model, ["a", "b"]).collect()
    assert {r["feature"] for r in ranked} == {"a", "b"}


def test_stacking_scores_every_row(lines):
    train, test = halves(lines)
    stacked = models.stack(train, ["a", "b"], bases=[FAST, {**FAST, "max_depth": 2}])
    out = stacked.transform(test)
    assert out.columns == [*test.columns, "predicted_amount"]
    assert out.count() == test.count()
    error = out.agg(F.avg(F.abs(F.col("amount") - F.col("predicted_amount")))).first()[0]
    assert error < 8


def test_stacking_query_fits_the_whole_bases(spark, sf, monkeypatch):
    """Both bases with all their trees, on each of three folds and on all rows."""
    asked, fit = [], models.fit

    def short(df, features, settings, label, output):
        asked.append(tuple(sorted(settings.items())))
        return fit(df, features, {**settings, "n_estimators": 1, "max_depth": 1}, label, output)

    monkeypatch.setattr(models, "fit", short)
    assert QUERIES["stacking_predict"](spark, sf).count() > 0
    assert sorted(asked) == sorted(4 * [tuple(sorted(b.items())) for b in models.STACKED_BASES])


def test_stacking_in_many_tasks(lines, monkeypatch):
    """Fits one after the other on many tasks are those that run at once on one."""
    bases = [{"n_estimators": 2, "max_depth": 2}, {"n_estimators": 1, "max_depth": 1}]
    one = models.stack(lines, ["a", "b"], bases=bases)
    monkeypatch.setattr(models, "STACK_ROWS", 10)
    many = models.stack(lines.repartition(8), ["a", "b"], bases=bases)
    assert np.allclose([*one.weights, one.intercept], [*many.weights, many.intercept], rtol=1e-6)


def test_search_lists_every_setting(lines):
    model, results = models.search(lines, ["a", "b"], grid={"max_depth": [1, 3], "n_estimators": [3]})
    rows = results.collect()
    assert len(rows) == 2 and rows[0]["settings"]["max_depth"] == 3.0
    assert model.transform(lines).count() == 400


def test_one_fit_serves_all_numbers_of_trees(lines):
    grid = {"max_depth": [1, 2], "n_estimators": [2, 5, 3], "learning_rate": [0.3]}
    _, results = models.search(lines, ["a", "b"], grid=grid, folds=3)
    rows = {(r["settings"]["max_depth"], r["settings"]["n_estimators"]): r for r in results.collect()}
    assert len(rows) == 6 == models.grid_size(grid)
    for depth, trees in ((1, 2), (2, 3), (2, 5)):
        settings = {"max_depth": depth, "n_estimators": trees, "learning_rate": 0.3}
        found = models.cross_validate(lines, ["a", "b"], settings, folds=3).first()
        assert rows[depth, trees]["rmse"] == pytest.approx(found["rmse_mean"], rel=1e-9)
        assert rows[depth, trees]["std"] == pytest.approx(found["rmse_std"], rel=1e-6, abs=1e-9)


def test_stages_equal_separate_fits_of_sampled_rows(lines):
    train, held = (models.assembled(["a", "b"]).transform(x).cache() for x in halves(lines))
    settings = {"max_depth": 2, "learning_rate": 0.3, "subsample": 0.7, "colsample_bytree": 0.5}
    staged = models.staged_errors(train, held, settings, [1, 3, 4], "amount")
    for n, rmse in zip((1, 3, 4), staged):
        alone = models.boosted_trees({**settings, "n_estimators": n}).fit(train).transform(held)
        want = alone.selectExpr("sqrt(avg(pow(amount - predicted_amount, 2)))").first()[0]
        assert rmse == pytest.approx(want, rel=1e-9)


def test_full_grids_are_listed_by_a_third_of_the_fits():
    staged = models.staged_settings(models.TRAINING_GRID)
    assert len(staged) == 324 and sum(len(t) for _, t in staged) == 972
    staged = models.staged_settings(models.COMPARISON_GRID)
    assert len(staged) == 64 and sum(len(t) for _, t in staged) == 128


@pytest.mark.parametrize("penalty", [0.0, 0.5])
def test_validation_in_time_equals_separate_fits(spark, penalty):
    rng = np.random.default_rng(4)
    n = 900
    day = rng.integers(0, 400, n)
    x = rng.normal(size=(n, 3)) * [1, 100, 0.01] + [0, 5000, 1]
    y = x @ [2.0, 0.3, -40.0] + rng.normal(size=n) + day / 50
    start = dt.datetime(2023, 11, 5)
    rows = [(start + dt.timedelta(days=int(d)), *map(float, v), 7.0, float(t)) for d, v, t in zip(day, x, y)]
    rows += [(start, None, 1.0, 1.0, 7.0, 5.0), (start, 1.0, 1.0, 1.0, 7.0, None), (None, 1.0, 1.0, 1.0, 7.0, 1.0)]
    df = spark.createDataFrame(rows, "close_ts timestamp, a double, b double, c double, flat double, amount double")
    got = {(r["fold"], r["horizon"]): r for r in
           temporal.validate_in_time(df, ["a", "b", "c", "flat"], penalty=penalty, horizons=2).collect()}
    month = np.array([(start + dt.timedelta(days=int(d))).year * 12 + (start + dt.timedelta(days=int(d))).month for d in day])
    months = sorted(set(month))
    want = 0
    for fold, first in enumerate(months[1:]):
        train = month < first
        mean = x[train].mean(axis=0)
        centred = x[train] - mean
        left = centred.T @ centred
        w = np.linalg.solve(left + penalty * np.diag(np.diag(left)), centred.T @ (y[train] - y[train].mean()))
        for horizon in (1, 2):
            test = month == first - 1 + horizon
            if test.any():
                error = y[test] - y[train].mean() - (x[test] - mean) @ w
                row = got[fold, horizon]
                assert (row["train_rows"], row["n"]) == (train.sum(), test.sum())
                assert row["rmse"] == pytest.approx(np.sqrt((error**2).mean()), rel=1e-6)
                assert row["mae"] == pytest.approx(np.abs(error).mean(), rel=1e-6)
                want += 1
    assert len(got) == want
    assert temporal.validate_in_time(df.limit(0), ["a"]).collect() == []


def test_grid_sizes():
    assert models.grid_size(models.TRAINING_GRID) == 972
    assert models.grid_size(models.COMPARISON_GRID) == 128


def test_scorer_round_trip_and_refusal(spark, lines, tmp_path):
    train, batch = halves(lines)
    scorer = models.Scorer.train(train, ["a", "b"], FAST)
    scorer.save(spark, str(tmp_path / "m"))
    again = models.Scorer.load(spark, str(tmp_path / "m"))
    now = F.lit(dt.datetime(2024, 1, 1))
    gaps = batch.withColumn("a", F.when(F.col("op_id") % 7 != 0, F.col("a")))
    one, two = (s.score(gaps, now).orderBy("op_id").collect() for s in (scorer, again))
    assert one == two and len(one) == batch.count()
    assert all(r["predicted_amount"] is not None for r in one)
    with pytest.raises(models.InvalidBatch, match="negative"):
        scorer.score(batch.withColumn("a", -F.col("a")), now)


def test_production_run_stores_predictions_and_record(spark, lines, tmp_path):
    train, batch = halves(lines)
    scorer, ranking = train_chain(train, ["a", "b"], FAST, k=1)
    assert scorer.features == ("a",) and ranking.count() == 2
    out = str(tmp_path / "p")
    base = training_stats(train, scorer.features)
    batch = batch.withColumn("a", F.col("a") + 3)
    scored, record = production_run(batch, scorer, base, out, dt.datetime(2024, 5, 1))
    stored = spark.read.parquet(f"{out}/predictions")
    assert stored.count() == scored.count() == batch.count()
    back = read_metric_records(spark, f"{out}/metrics").first()
    assert back["metrics"] == record.first()["metrics"]
    assert back["drift_results"]["a"]["has_drift"] == 1
    again = evaluate_against(stored, batch).first()
    assert again["rmse"] == pytest.approx(back["metrics"]["rmse"])


def test_forecaster_follows_trend_and_week(spark):
    rows = []
    for i in range(400):
        day = dt.datetime(2023, 1, 1) + dt.timedelta(days=i)
        rows.append((day, (100 + 0.5 * i) * (1.2 if day.weekday() < 5 else 0.7)))
    df = spark.createDataFrame(rows, "ds timestamp, y double")
    model = forecast.Forecaster.fit(df)
    out = model.predict(df).toPandas()
    assert np.mean(np.abs(out["y"] - out["yhat"]) / out["y"]) < 0.05
    inside = ((out["y"] >= out["yhat_lower"]) & (out["y"] <= out["yhat_upper"])).mean()
    assert inside > 0.9


def with_regressor(spark, n=300):
    rng = np.random.default_rng(8)
    days = [dt.datetime(2022, 11, 1) + dt.timedelta(hours=31 * i) for i in range(n)]
    rows = [(d, 200 + 0.4 * i + 9 * float(x), float(x)) for i, (d, x) in enumerate(zip(days, rng.normal(size=n)))]
    return spark.createDataFrame(rows, "ds timestamp, y double, x double")


def test_ridge_of_sums_is_that_of_spark_ml(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df = with_regressor(spark).withColumns({"t": F.unix_seconds("ds") / 1e9, "same": F.lit(3.0)})
    names = ["x", "t", "same"]
    got = forecast._ridge(df, lambda f: (f[names].to_numpy(), f["y"].to_numpy()), names, 0.01, {"x": 2.0})
    scaled = df.withColumn("x", F.col("x") * 2 * np.sqrt(300 * 0.01))
    ready = VectorAssembler(inputCols=names[:2], outputCol="features").transform(scaled)
    want = LinearRegression(labelCol="y", regParam=0.01, standardization=False).fit(ready)
    assert got["same"] == 0 and got["intercept"] == pytest.approx(want.intercept)
    assert got["t"] == pytest.approx(want.coefficients[1])
    assert got["x"] == pytest.approx(want.coefficients[0] * 2 * np.sqrt(300 * 0.01))
    with pytest.raises(ValueError):
        forecast.Forecaster.fit(df.withColumn("ds", F.when(F.col("x") < 0, F.col("ds"))))


def test_forecasts_of_batches_are_those_of_columns(spark):
    df = with_regressor(spark)
    model = forecast.Forecaster.fit(df, regressors=("x",), changepoint_prior=0.05)
    odd = df.withColumn("x", F.when(F.col("x") > 1, None).when(F.col("x") < -1, float("nan")).otherwise(F.col("x")))
    odd = odd.unionByName(odd.limit(1).withColumn("ds", F.lit(None).cast("timestamp")))
    base = model.trend_value()
    want = base * (1 + forecast._dot(model.rest_columns(), model.rest))
    rows = model.predict(model.with_holiday(odd).withColumns({"base": base, "want": want})).collect()
    assert {"null", "nan", "number"} == {
        "null" if r["want"] is None else "nan" if np.isnan(r["want"]) else "number" for r in rows}
    for r in rows:
        for one, two in (("trend", "base"), ("yhat", "want")):
            assert (r[one] is None) == (r[two] is None)
            assert r[one] is None or r[one] == pytest.approx(r[two], rel=1e-9, nan_ok=True)
    off = [r["y"] - r["yhat"] for r in model.predict(df).collect()]
    assert model.residual_std == pytest.approx(np.std(off, ddof=1))


def test_future_frame_keeps_last_values(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), 1.0), (dt.datetime(2024, 1, 2), 2.0), (dt.datetime(2024, 1, 3), None)],
        "close_ts timestamp, amount double")
    rows = forecast.future_frame(df, 3, regressors=["amount"]).orderBy("ds").collect()
    assert [r["ds"].day for r in rows] == [4, 5, 6] and {r["amount"] for r in rows} == {2.0}


def test_client_models_match_least_squares(spark):
    rng = np.random.default_rng(1)
    rows, frames = [], {}
    for client in (1, 2):
        days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=int(d)) for d in range(40)]
        ys = rng.uniform(50, 90, 40)
        frames[client] = (days, ys)
        rows += [(client, d, float(y)) for d, y in zip(days, ys)]
    df = spark.createDataFrame(rows, "client_id bigint, close_ts timestamp, amount double")
    got = {r["client_id"]: r for r in forecast.client_models(df, ridge=1.0).collect()}
    for client, (days, ys) in frames.items():
        n = np.array([(d - dt.datetime(2000, 1, 1)).days for d in days], float)
        turn = n * 2 * np.pi / 7
        x = np.column_stack([np.ones(40), n / 365.25, np.sin(turn), np.cos(turn),
                             np.sin(2 * turn), np.cos(2 * turn)])
        penalty = np.diag([1e-9] + [1.0] * 5)
        w = np.linalg.solve(x.T @ x + penalty, x.T @ ys)
        np.testing.assert_allclose(got[client]["weights"], w, rtol=1e-5)
        std = np.sqrt(np.sum((ys - x @ w) ** 2) / 39)
        assert got[client]["residual_std"] == pytest.approx(std, rel=1e-5)


def test_append_mode_emits_closed_days_only(spark, sf):
    daily = streams.daily_volume_stream(streams.trade_stream(spark, sf))
    appended = streams.run_to_table(spark, daily, streams.append_to)
    batch = streams.daily_volume_stream(
        streams.event_trades(spark.read.schema(streams.EVENT).parquet(f"{sf}/events.parquet")))
    full = {(r["client_id"], r["day_start"]): r["trades"] for r in batch.collect()}
    part = {(r["client_id"], r["day_start"]): r["trades"] for r in appended.collect()}
    assert 0 < len(part) < len(full)
    assert all(full[k] == n for k, n in part.items())


def test_late_rows_update_their_day(spark, tmp_path):
    def events(name, rows):
        data = [(i, ts, 1, "view", v, "") for i, ts, v in rows]
        spark.createDataFrame(data, streams.EVENT).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in"))

    day = dt.datetime(2024, 1, 1, 10)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = streams.trade_stream(spark, str(tmp_path / "in"), "*.parquet")
        streams.upsert_to(streams.daily_volume_stream(stream), out, state).awaitTermination()

    events("a", [(1, day, 5.0), (2, day + dt.timedelta(days=1), 7.0)])
    run()
    events("b", [(3, day, 2.0)])  # late, but within two days
    run()
    table = streams.read_latest(spark, out, ("client_id", "day_start"))
    got = {r["day_start"].day: r["daily_volume"] for r in table.collect()}
    assert got == {1: 7.0, 2: 7.0}


def seasonal(spark, slopes=((0.0, 1.0), (0.5, -3.0)), days=600, noise=0.01, seed=1):
    """Daily values: a trend whose slope changes at given shares of the time, times a week."""
    rng = np.random.default_rng(seed)
    rows = []
    for d in range(days):
        t = d / (days - 1)
        level = 10 + sum(s * max(t - at, 0) for at, s in slopes)
        day = dt.datetime(2022, 1, 1) + dt.timedelta(days=d)
        rows.append((day, float(level * (1 + 0.2 * np.sin(2 * np.pi * d / 7)) + noise * rng.normal()), float(d % 5)))
    return spark.createDataFrame(rows, "ds timestamp, y double, x double")


WEEK = {"weekly": (7.0, 2)}


def test_slope_changes_are_found_and_no_others(spark):
    df = seasonal(spark, ((0.0, 2.0), (0.35, -9.0)), noise=0.1)
    model = joint.JointForecaster.fit(df, regressors=("x",), changepoints=19, seasons=WEEK, changepoint_prior=8e-4)
    changes = {round(k, 3): model.trend[f"_knot_{i}"] for i, k in enumerate(model.knots)}
    assert sum(w == 0 for w in changes.values()) >= 10
    assert sum(w for k, w in changes.items() if abs(k - 0.35) < 0.08) == pytest.approx(-9.0, rel=0.15)
    assert sum(abs(w) for k, w in changes.items() if abs(k - 0.35) >= 0.08) < 0.5
    fit = model.predict(df).selectExpr("sqrt(avg(pow(y - yhat, 2)))").first()[0]
    assert fit < 0.13
    assert max(abs(r["gradient"]) for r in model.certificate(df).collect()) < 1e-9


def test_joint_fit_is_no_worse_than_trend_first(spark):
    df = seasonal(spark, ((0.0, 30.0),), days=45)
    errors = [m.predict(df).selectExpr("avg(pow(y - yhat, 2))").first()[0] for m in (
        joint.JointForecaster.fit(df, seasons=WEEK), forecast.Forecaster.fit(df, seasons=WEEK))]
    assert errors[0] < errors[1]


def test_bounds_widen_with_the_horizon(spark):
    df = seasonal(spark)
    model = joint.JointForecaster.fit(df, seasons=WEEK)
    width = "yhat_upper - yhat_lower"
    inside = model.predict(df).selectExpr(f"min({width})", f"max({width})").first()
    assert inside[0] == pytest.approx(inside[1])
    ahead = forecast.forecast_future(model, df, 365).where("part = 'future'").orderBy("ds")
    widths = [r[0] for r in ahead.selectExpr(width).collect()]
    assert widths[0] < widths[100] < widths[364] and widths[0] == pytest.approx(inside[0], rel=0.01)


def test_lasso_meets_its_conditions():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(80, 12))
    x[:, 5] = 0
    y = x @ np.where(np.arange(12) % 4 == 0, 3.0, 0.0) + rng.normal(size=80)
    gram, right = x.T @ x, x.T @ y
    penalty = np.array([0.0, *[25.0] * 11])
    w = joint.lasso(gram, right, penalty)
    assert joint.lasso(gram, right, penalty * 1e6)[1:].tolist() == [0.0] * 11
    pull = right - gram @ w
    for k in range(12):
        if w[k]:
            assert pull[k] == pytest.approx(penalty[k] * np.sign(w[k]), abs=1e-7)
        else:
            assert abs(pull[k]) <= penalty[k] + 1e-7
    assert (w == 0).any()


def test_joint_fit_of_odd_rows(spark):
    with pytest.raises(ValueError, match="no rows"):
        joint.JointForecaster.fit(seasonal(spark).limit(0), seasons=WEEK)
    rows = [(None, 1.0), (dt.datetime(2022, 1, 1), None), *[(dt.datetime(2022, 1, 1), 5.0)] * 4]
    df = spark.createDataFrame(rows, "ds timestamp, y double")
    model = joint.JointForecaster.fit(df, seasons=WEEK)
    assert model.predict(df.where("y is not null and ds is not null")).first()["yhat"] == pytest.approx(5.0)
