"""Hand-made frames: nulls, constants, zero denominators, ties, empty input."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from voltide.functions import ratios
from voltide.functions.calendar import us_holidays
from voltide.functions.errors import lilliefors_p, t_quantile
from voltide.operators import clean, evaluate, monitor, split, stats
from voltide.operators.encode import OneHotVectors, one_hot
from voltide.operators.privacy import decrypt_columns, encrypt_columns
from voltide.operators.scale import RobustScale, StandardScale
from voltide.plans.cleaning import clean_g1, clean_g2, load_trades
from voltide.plans.features import feature_report, features_g1a, features_g1b
from voltide.schema import MissingColumns, drop_unused, numeric_columns, rename_raw
from voltide.sources import files


@pytest.fixture(scope="module")
def raw(spark):
    rows = []
    for i in range(60):
        rows.append((
            i, None if i % 12 == 5 else i % 4, dt.datetime(2024, 1, 1) + dt.timedelta(days=i // 2),
            None if i % 9 == 4 else float(1000 + 37 * i % 900) * (-1 if i == 30 else 1),
            None if i % 7 == 0 else 0.01 * (i % 5), "ABC"[i % 3],
        ))
    rows[50] = rows[50][:3] + (1e6,) + rows[50][4:]
    schema = ("op_id bigint, client_id bigint, close_ts timestamp, amount double, "
              "spread double, category string")
    return spark.createDataFrame(rows, schema)


def test_clean_keeps_rows_and_leaves_no_gaps(raw):
    out = clean_g1(load_trades(raw))
    assert out.count() == raw.count()
    numbers = numeric_columns(out)
    bad = out.agg(*[F.count_if(F.col(c).isNull() | (F.col(c) < 0)).alias(c) for c in numbers])
    assert sum(bad.first()) == 0


def test_chains_join_up(raw):
    cleaned = clean_g1(load_trades(raw))
    scaled, scaler = features_g1a(cleaned)
    assert scaled.count() == raw.count()
    means = scaled.agg(*[F.avg(c).alias(c) for c in scaler.parameters]).first()
    assert all(v is None or abs(v) < 1e-9 for v in means)
    assert features_g1b(cleaned).count() == raw.count()


def test_clean_by_class_drops_outliers_and_duplicates(raw):
    out = clean_g2(raw.union(raw)).toPandas()
    assert len(out) < 60 and out["op_id"].is_unique
    assert out["amount"].max() < 1e6 and not out["spread"].isna().any()


def test_missing_columns_are_reported(raw):
    with pytest.raises(MissingColumns, match="amount"):
        clean_g2(raw.drop("amount"))
    assert clean.check_batch(raw, ["amount", "nope"]) == ["missing columns: ['nope']"]


def test_batch_checks(spark):
    schema = "amount double, spread double"
    nulls = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (None, 3.0)], schema)
    assert clean.check_batch(nulls, ["amount", "spread"]) == []
    assert clean.check_batch(nulls, ["amount", "spread"], nulls_fail=True)
    negative = spark.createDataFrame([(-1.0, 1.0), (2.0, 2.0)], schema)
    assert "negative" in clean.check_batch(negative, ["amount", "spread"])[0]
    report = {r["column_name"]: r for r in clean.validate_batch(negative, ["amount"]).collect()}
    assert report["amount"]["negatives"] == 1 and not report["amount"]["is_valid"]
    assert clean.check_batch(spark.createDataFrame([], "x double"), ["amount"])


def test_not_finite_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,)], "x double")
    assert [r["x"] for r in clean.null_if_not_finite(df).collect()] == [None, None, 1.0]


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(3.0, None), (3.0, None)], "x double, y double")
    scaled = StandardScale.fit(df, ["x", "y"]).transform(df).collect()
    assert [tuple(r) for r in scaled] == [(0.0, None)] * 2
    robust = RobustScale.fit(df, ["x", "y"]).transform(df).collect()
    assert [tuple(r) for r in robust] == [(0.0, 0.0)] * 2
    assert stats.mad(df, "y") == (None, None)
    assert clean.iqr_filter(df, "y").count() == 0
    assert [r["y"] for r in clean.impute_mean(df, ["y"]).collect()] == [0.0, 0.0]
    assert evaluate.histogram(df, "x").count() == 1


def test_empty_frame(spark, raw):
    empty = raw.where("false")
    assert clean.winsorize(empty, ["amount"]).count() == 0
    assert clean.impute_median(empty, ["amount"]).count() == 0
    assert split.temporal_folds(empty).count() == 0
    out, _ = features_g1a(load_trades(empty))
    assert out.count() == 0


def test_scaler_survives_storage(spark, raw, tmp_path):
    fitted = StandardScale.fit(raw, ["amount", "spread"])
    fitted.save(spark, str(tmp_path / "s"))
    assert StandardScale.load(spark, str(tmp_path / "s")) == fitted


def test_zero_denominators_are_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(ratios.ratio("a", "b")).collect()] == [None, 0.25]


def test_metrics_skip_zero_actuals_and_missing_pairs(spark):
    df = spark.createDataFrame(
        [(0.0, 1.0), (10.0, 8.0), (None, 3.0), (4.0, None)], "amount double, predicted_amount double")
    r = evaluate.evaluate(df).first()
    assert (r["n"], r["zero_actuals"], r["mae"], r["mape"]) == (2, 1, 1.5, 20.0)


def test_equal_quantile_edges_merge(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0)] * 8 + [(2.0, 1.0), (3.0, 5.0)], "amount double, predicted_amount double")
    rows = evaluate.error_by_quintile(df).collect()
    assert sum(r["count"] for r in rows) == 10
    assert all(r["range_lo"] < r["range_hi"] for r in rows)


def test_bias_flag_decides_on_the_maximum(spark):
    df = spark.createDataFrame(
        [(float(i), float(i + 1)) for i in range(9)], "amount double, predicted_amount double")
    closed, opened = (evaluate.bias_by_range(df, include_max=f) for f in (True, False))
    assert closed.agg(F.sum("rows")).first()[0] == 9
    assert opened.agg(F.sum("rows")).first()[0] == 8


def test_drift_with_negative_and_zero_base(spark):
    train = spark.createDataFrame([(-10.0, 0.0), (-12.0, 0.0)], "a double, z double")
    now = spark.createDataFrame([(-20.0, 1.0), (-22.0, 1.0)], "a double, z double")
    got = {r["feature"]: r for r in monitor.drift_report(train, now, ["a", "z"]).collect()}
    assert got["a"]["mean_drift"] == pytest.approx(10 / 11) and got["a"]["has_drift"] == 1
    assert got["z"]["mean_drift"] is None and got["z"]["has_drift"] == 0


def test_metric_record_round_trip(spark, tmp_path):
    ts = dt.datetime(2024, 3, 20, 10)
    record = files.metric_record(
        spark, ts, {"rmse": 120.0, "mae": 80.0, "mape": 1.0, "r2": 0.95},
        {"amount": {"mean_drift": 0.5, "std_drift": 0.0, "has_drift": True}})
    files.write_metric_records(record, str(tmp_path / "m"), "r1")
    back = files.read_metric_records(spark, str(tmp_path / "m"))
    alerts = [r["message"] for r in monitor.metric_alerts(back).collect()]
    assert alerts == ["RMSE (120.00) excede el umbral (100.0)", "MAE (80.00) excede el umbral (50.0)",
                      "Drift detectado en feature amount: 0.50"]
    pretty = tmp_path / "p"
    pretty.mkdir()
    (pretty / "metrics_1.json").write_text(
        '{\n "timestamp": "2024-03-20T10:00:00",\n "metrics": {"rmse": 1.0},\n'
        ' "drift_results": {}\n}')
    assert files.read_metric_records(spark, str(pretty), pretty=True).first()["metrics"] == {"rmse": 1.0}


def test_history_keeps_every_run_once_and_prunes_old_days(spark, tmp_path):
    path = str(tmp_path / "h")
    for day in (1, 15, 30, 30):
        monitor.append_history(
            files.metric_record(spark, dt.datetime(2024, 1, day), {"rmse": 1.0}, {}), path)
    noon = dt.datetime(2024, 1, 30, 12)
    monitor.append_history(files.metric_record(spark, noon, {"rmse": 2.0}, {}), path)
    now = F.lit(dt.datetime(2024, 1, 31))
    assert monitor.read_history(spark, path).count() == 4
    assert monitor.read_history(spark, path, now, days=20).count() == 3


def test_one_hot_takes_any_number_of_levels(spark):
    df = spark.createDataFrame([(f"{i:04d}", "x") for i in range(1200)] + [(None, None)], "v string, w string")
    out = one_hot(df, ["v", "w"])
    assert len(out.columns) == 2 + 1200 + 1
    row = out.where("v = '0007'").first()
    assert row["v_0007"] == 1 and row["v_0008"] == 0 and row["w_x"] == 1
    assert one_hot(df, ["w"], {"w": ["x", "y"]}).columns == ["v", "w", "w_x", "w_y"]


def test_vectors_equal_the_dense_columns(spark, tmp_path):
    rows = [("b", "x", 1), ("a", None, 2), (None, "y", 3), ("b", "y", None), (None, None, 4), ("a b", "x", 1)]
    df = spark.createDataFrame(rows, "v string, w string, n int").withColumn("none", F.lit(None).cast("string"))
    encoder = OneHotVectors.fit(df, ["w", "v", "none", "n", "gone"])
    assert encoder.columns == ("w", "v", "none", "n") and encoder.sizes == (2, 3, 0, 4)
    encoder.save(str(tmp_path / "e"))
    out = OneHotVectors.load(spark, str(tmp_path / "e")).transform(df)
    dense = one_hot(df, ["w", "v", "n"])
    names = ["w_x", "w_y", "v_a", "v_a b", "v_b", "n_1", "n_2", "n_3", "n_4"]

    def key(r):
        return str((r["v"], r["w"], r["n"]))

    got = sorted(((key(r), [int(x) for x in r["one_hot"].toArray()]) for r in out.collect()))
    assert got == sorted((key(r), [r[n] for n in names]) for r in dense.collect())
    # values that the dictionary does not hold are 0 everywhere
    new = encoder.transform(spark.createDataFrame([("z", "x", 9, None)], df.schema)).first()["one_hot"]
    assert new.indices.tolist() == [0]
    with pytest.raises(ValueError, match="no column has a value"):
        OneHotVectors.fit(df, ["none"]).transform(df)


def test_a_million_values(spark):
    n = 1_000_000
    df = spark.range(n).selectExpr("id", "lpad(string(id), 7, '0') AS v", "string(id % 3) AS w")
    encoder = OneHotVectors.fit(df, ["w", "v"])
    assert encoder.sizes == (3, n)
    out = encoder.transform(df)
    assert out.schema["one_hot"].dataType.typeName() == "vectorudt"
    # the place of a value is its rank; every row has two ones
    text = F.regexp_extract(F.col("one_hot").cast("string"), r"^\((\d+),\[(\d+),(\d+)\],\[1.0,1.0\]\)$", 3)
    assert out.where(text.cast("bigint") == F.col("id") + 3).count() == n


def test_raw_names(spark):
    df = spark.createDataFrame([(1, 2.0, 3, 4)], "`Unnamed: 49` int, `Importe FX` double, bbva int, x int")
    assert rename_raw(drop_unused(df)).columns == ["amount", "x"]


def test_two_header_export(spark, tmp_path, raw):
    path = str(tmp_path / "e")
    files.write_two_header_export(raw.select("op_id", "category").coalesce(1), path)
    assert files.read_two_header_export(spark, path, ["op_id", "category"]).count() == 60
    one = tmp_path / "one.csv"
    one.write_text("junk,,\nop_id,Importe FX,\n1,2.5,\n2,x,\n")
    df = files.read_two_header_export(spark, str(one))
    assert df.columns == ["op_id", "Importe FX", "Unnamed: 2"] and df.count() == 2


def test_prediction_files_carry_their_name(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"predictions_{i}.csv").write_text(f"op_id,amount\n{i},1.5\n")
    df = files.read_prediction_files(spark, str(tmp_path / "predictions_*.csv"))
    assert sorted(r["file_name"] for r in df.collect()) == ["predictions_1.csv", "predictions_2.csv"]


def test_observed_holidays(spark):
    days = {str(r["day"]) for r in us_holidays(spark, 2021, 2022).collect()}
    assert {"2021-07-04", "2021-07-05", "2021-11-25", "2021-12-24", "2022-05-30"} <= days


def test_keys_stay_in_their_table(spark):
    from voltide.operators import privacy

    keys = privacy.new_keys(spark, ["2023", "2024"]).cache()
    df = spark.createDataFrame([(1, "A", "2023"), (2, "A", "2024"), (3, None, "2024")], "id int, c string, key_id string")
    hidden = privacy.encrypt_by_key_id(df, ["c"], keys).cache()
    assert hidden.columns == df.columns and hidden.where("c = 'A'").count() == 0
    plan = hidden._jdf.queryExecution().toString()
    assert not any(bytes(k["key"]).hex() in plan.lower() for k in keys.collect())
    back = privacy.decrypt_by_key_id(hidden, ["c"], keys)
    assert sorted(back.collect()) == sorted(df.collect())
    with pytest.raises(Exception, match="no key 2025"):
        privacy.encrypt_by_key_id(df.withColumn("key_id", F.lit("2025")), ["c"], keys).collect()


def test_encryption_hides_and_restores(spark, raw):
    key = F.lit("0123456789abcdef")
    hidden = encrypt_columns(raw, ["category"], key)
    assert hidden.where(F.col("category").isin("A", "B", "C")).count() == 0
    back = decrypt_columns(hidden, ["category"], key)
    assert back.groupBy("category").count().count() == 3


def test_error_helpers():
    assert t_quantile(0.975, 9) == pytest.approx(2.262157, abs=1e-5)
    assert t_quantile(0.975, 10**6) == pytest.approx(1.959964, abs=1e-5)
    normal = 1.959963984540054
    for dof in (99_999, 100_000, 100_001, 10**9, 10**13):
        want = normal + (normal**3 + normal) / (4 * dof)
        assert t_quantile(0.975, dof) == pytest.approx(want, abs=1e-8)
    assert 0.04 < lilliefors_p(0.0886, 100) < 0.06
    assert math.isfinite(lilliefors_p(0.5, 10**6))


def test_feature_report(raw):
    got = {r["section"]: r["total"] for r in feature_report(raw).collect()}
    assert got["total"] == 6 and got["datetime"] == 1
