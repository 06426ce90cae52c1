"""Data that used to break: constants, copies, nulls, odd tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from voltide.functions.calendar import is_us_holiday
from voltide.operators import evaluate, forecast, monitor, select, split, stats
from voltide.operators.quantiles import quantiles
from voltide.sources.sinks import remove_old_days
from voltide.operators.scale import StandardScale
from voltide.plans.q_stream import stream_dedup
from voltide.streaming import streams


@pytest.fixture(scope="module")
def odd(spark):
    """A constant, a copy of the target, noise, and a NaN."""
    rows = [(i, float(i % 37), 5.0, float((i * 7919) % 101), float("nan") if i == 3 else float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "op_id long, amount double, flat double, noise double, holed double")
    return df.withColumn("copy", F.col("amount"))


def test_constant_and_copied_columns_have_scores(odd):
    scores = {r["feature"]: r["score"] for r in select.score_features(odd, ["flat", "copy", "noise"]).collect()}
    assert scores["flat"] == 0 and scores["copy"] > 1e12 > scores["noise"] >= 0
    assert select.feature_names(select.score_features(odd, ["flat", "copy", "noise"]), 1) == ["copy"]
    ranked = select.rank_features(odd, ["flat", "copy", "noise"]).collect()
    assert ranked[0]["feature"] == "copy" and all(r["score_mean"] is not None for r in ranked)
    matrix, report = select.selected_matrix(odd, ["flat", "copy", "noise"], k=2)
    assert "copy" in matrix.columns and report.count() == 3


def test_correlations_of_constant_columns_are_null(odd):
    cells = {(r["feature_a"], r["feature_b"]): r["correlation"]
             for r in stats.correlation_matrix(odd, ["amount", "flat", "copy"]).collect()}
    assert cells["amount", "flat"] is None and cells["flat", "flat"] is None
    assert cells["amount", "copy"] == pytest.approx(1.0)
    found = {r["feature"]: r["correlation"] for r in stats.correlations_with(odd, ["flat", "copy"], "amount").collect()}
    assert found["flat"] is None and found["copy"] == pytest.approx(1.0)


def test_constant_and_missing_errors(spark):
    flat = spark.createDataFrame([(1.0,)] * 20, "error double")
    for df, n in ((flat, 20), (flat.where("false"), 0)):
        row = evaluate.normality_ks(df).first()
        assert (row["n"], row["statistic"], row["is_normal"]) == (n, None, False)


def test_quintiles_of_one_value_are_one_bin(spark):
    df = spark.createDataFrame([(7.0, float(i)) for i in range(10)], "amount double, predicted_amount double")
    rows = evaluate.error_by_quintile(df).collect()
    assert [(r["bin"], r["count"]) for r in rows] == [(0, 10)]
    assert evaluate.error_box(df).count() == 1


def test_a_nan_does_not_spoil_its_column(odd):
    scaled = StandardScale.fit(odd, ["holed"]).transform(odd)
    assert scaled.where("holed is null").count() == 1
    assert scaled.where("isnan(holed)").count() == 0


def test_null_ids_have_a_bucket_and_ids_mix(spark):
    df = spark.range(0, 2000).select((F.col("id") * 1009).alias("op_id")).unionByName(
        spark.createDataFrame([(None,)], "op_id long")
    )
    counts = {r["split"]: r["count"] for r in split.hash_split(df).groupBy("split").count().collect()}
    assert counts["train"] + counts["test"] == 2001 and 320 < counts["test"] < 480
    folds = split.cv_folds(df)
    assert folds.where("fold is null").count() == 0 and folds.groupBy("fold").count().count() == 5


def test_holidays_of_any_year(spark):
    days = ["2020-07-03", "2021-12-31", "2024-12-25", "2030-12-25", "2099-07-04", "2024-12-24", "2030-11-28"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(d),) for d in days], "ds timestamp")
    got = [r["h"] for r in df.select(is_us_holiday("ds").alias("h")).collect()]
    assert got == [True, True, True, True, True, False, True]


def test_different_records_of_one_time_are_kept(spark, tmp_path):
    noon = dt.datetime(2024, 5, 1, 12)
    rows = [(noon, {"rmse": float(x)}, {}) for x in (1, 2, 2)]
    monitor.append_history(spark.createDataFrame(rows, monitor.RECORD), str(tmp_path / "h"))
    assert monitor.read_history(spark, str(tmp_path / "h")).count() == 2


def test_null_clients_are_no_client(spark):
    rows = [(None, dt.datetime(2024, 1, d), 1.0 * d) for d in range(1, 9)]
    rows += [(1, dt.datetime(2024, 1, d), 2.0 * d) for d in range(1, 9)]
    df = spark.createDataFrame(rows, "client_id long, close_ts timestamp, amount double")
    assert [r["client_id"] for r in forecast.client_trend(df).collect()] == [1]


def test_columns_share_the_buffer_of_quantiles(odd):
    whole = quantiles(odd, ["amount", "noise", "copy"], [0.1, 0.5])
    assert quantiles(odd, ["amount", "noise", "copy"], [0.1, 0.5], group_rows=900) == whole
    assert quantiles(odd, ["amount", "noise", "copy"], [0.1, 0.5], group_rows=100) == whole


def test_streams_read_a_folder_of_part_files(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    assert stream_dedup(spark, str(tmp_path)).count() == spark.read.parquet(f"{sf}/events.parquet").count()


def test_an_empty_stream_is_an_empty_table(spark, sf, tmp_path):
    os.makedirs(tmp_path / "events.parquet")
    trades = streams.trade_stream(spark, str(tmp_path))
    out = streams.run_to_table(spark, streams.dedup_stream(trades), streams.append_to)
    assert out.count() == 0 and "op_id" in out.columns
    volumes = streams.run_to_table(
        spark, streams.daily_volume_stream(trades), streams.upsert_to, keys=("client_id", "day_start")
    )
    assert volumes.count() == 0


def test_old_days_are_deleted(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = [(dt.datetime(2024, 1, d, 12), {"rmse": 1.0 * d}, {}) for d in (1, 10, 20, 30)]
    monitor.append_history(spark.createDataFrame(rows, monitor.RECORD), path)
    assert remove_old_days(spark, path, dt.datetime(2024, 2, 5), 20) == ["day=2024-01-01", "day=2024-01-10"]
    assert monitor.read_history(spark, path).count() == 2
    assert remove_old_days(spark, str(tmp_path / "none"), dt.datetime(2024, 2, 5)) == []


def test_a_jobs_stored_tables_go_at_its_end(spark):
    from voltide import session

    with session.job(spark):
        stored = session.materialize(spark.range(5), "five")
        path = stored.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert stored.count() == 5 and os.path.isdir(path)
    assert not os.path.exists(path)


def test_cross_validation_and_future_forecast(spark, odd):
    from voltide.operators import models

    rows = models.cross_validate(odd, ["copy", "noise"], {"n_estimators": 3, "max_depth": 3}, folds=3).collect()
    assert len(rows) == 3 and sum(r["rows"] for r in rows) == 400
    assert rows[0]["rmse_mean"] == pytest.approx(sum(r["rmse"] for r in rows) / 3)
    assert rows[0]["rmse_mean"] < 5  # the target varies by 10 about its mean
    days = [(dt.datetime(2023, 1, 1) + dt.timedelta(days=k), 100.0 + k) for k in range(200)]
    df = spark.createDataFrame(days, "ds timestamp, y double")
    free = forecast.Forecaster.fit(df)
    tight = forecast.Forecaster.fit(df, changepoint_prior=1e-6, seasonality_prior=1e-6, holidays_prior=1e-6)
    knots = lambda m: sum(abs(w) for c, w in m.trend.items() if c.startswith("_knot"))
    assert knots(tight) <= knots(free) + 1e-9
    out = forecast.forecast_future(tight, df, 30)
    assert out.groupBy("part").count().collect() and out.where("part = 'future'").count() == 30
    last = out.orderBy(F.desc("ds")).first()
    assert last["yhat"] == pytest.approx(329, abs=8)


def test_batch_and_stream_are_prepared_alike(spark, odd):
    from voltide.operators import models

    scorer = models.Scorer.train(odd, ["noise", "holed"], {"n_estimators": 2, "max_depth": 2})
    gaps = odd.withColumn("noise", F.when(F.col("op_id") % 5 == 0, None).otherwise(F.col("noise")))
    at = F.lit("2024-01-01").cast("timestamp")
    batch = scorer.score(gaps, at).select("op_id", "predicted_amount").orderBy("op_id").collect()
    stream = scorer.score_stream(gaps, at).select("op_id", "predicted_amount").orderBy("op_id").collect()
    assert batch == stream
