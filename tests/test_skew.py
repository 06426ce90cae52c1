"""Large groups, null keys and whole-table frames, with limits set tiny."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltide.operators import quantiles as q
from voltide.operators.encode import category_codes
from voltide.operators.evaluate import autocorrelation
from voltide.operators.ordering import fill_missing, windowed, with_row_index
from voltide.operators.skew import group_sizes
from voltide.operators.stats import with_group_stats
from voltide.operators.windows import Rolling, previous_mean, rolling


@pytest.fixture(scope="module")
def trades(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        # one client holds a third of the rows, a tenth have no client
        client = 1 if i % 3 == 0 else None if i % 10 == 1 else 2 + rng.randrange(25)
        amount = None if rng.random() < 0.05 else float(rng.choice([5.0, rng.uniform(1, 99)]))
        rows.append((i, client, 1_600_000_000 + rng.randrange(200) * 3600, amount))
    schema = "op_id bigint, client_id bigint, at bigint, amount double"
    df = spark.createDataFrame(rows, schema)
    return df.select("op_id", "client_id", F.timestamp_seconds("at").alias("close_ts"), "amount")


@pytest.fixture(scope="module")
def frame(trades):
    pdf = trades.toPandas().sort_values(["close_ts", "op_id"]).reset_index(drop=True)
    return pdf


def test_group_sizes_lists_large_groups(trades):
    sizes = group_sizes(trades, ["client_id"], 50)
    assert sizes.rows == 600 and sizes.null_rows > 0
    assert [r["client_id"] for r in sizes.large.collect()] == [1]
    assert group_sizes(trades, ["client_id"], 1000).large is None


@pytest.mark.parametrize("group_rows,chunk_rows", [(10_000, 100), (50, 7), (3, 10), (3, 1000)])
def test_rolling_matches_pandas(trades, frame, group_rows, chunk_rows):
    specs = [Rolling("m", "amount", "mean", 5), Rolling("s", "amount", "std", 7),
             Rolling("x", "amount", "max", 3)]
    out = rolling(trades, specs, group_rows=group_rows, chunk_rows=chunk_rows)
    got = out.toPandas().set_index("op_id").sort_index()
    assert len(got) == 600
    by = frame.groupby("client_id")["amount"]
    want = pd.DataFrame({
        "op_id": frame["op_id"],
        "m": by.transform(lambda x: x.rolling(5, min_periods=1).mean()),
        "s": by.transform(lambda x: x.rolling(7, min_periods=1).std()),
        "x": by.transform(lambda x: x.rolling(3, min_periods=1).max()),
    }).set_index("op_id").sort_index()
    for c in ("m", "s", "x"):
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), atol=1e-6)


def test_previous_mean_never_sees_the_row(trades, frame):
    got = previous_mean(trades, group_rows=50, chunk_rows=8).toPandas().set_index("op_id")
    by = frame.groupby("client_id")["amount"]
    want = by.transform(lambda x: x.shift(1).rolling(5, min_periods=1).mean())
    want.index = frame["op_id"]
    got, want = got["predicted_amount"].sort_index(), want.sort_index()
    np.testing.assert_allclose(got.astype(float), want.astype(float), atol=1e-9)


def test_frames_look_ahead_across_chunks(trades, frame):
    out = windowed(trades, lambda w: {"n": F.sum("op_id").over(w.rowsBetween(-2, 3))},
                   back=2, ahead=3, by=(), chunk_rows=11)
    got = out.toPandas().set_index("op_id")["n"]
    ids = frame["op_id"].tolist()
    want = {ids[i]: sum(ids[max(0, i - 2): i + 4]) for i in range(len(ids))}
    assert got.to_dict() == want


def test_row_index_is_gap_free(trades, frame):
    got = with_row_index(trades, ["close_ts", "op_id"]).toPandas().sort_values("row_index")
    assert got["row_index"].tolist() == list(range(600))
    assert got["op_id"].tolist() == frame["op_id"].tolist()


def test_table_rolling_matches_pandas(trades, frame):
    out = rolling(trades, [Rolling("m", "amount", "mean", 30)], by=(), chunk_rows=40)
    got = out.toPandas().set_index("op_id")["m"].sort_index()
    want = frame["amount"].rolling(30, min_periods=1).mean()
    want.index = frame["op_id"]
    np.testing.assert_allclose(got.astype(float), want.sort_index().astype(float), atol=1e-9)


@pytest.mark.parametrize("chunk_rows", [5, 64, 1000])
def test_fill_missing_matches_pandas(trades, frame, chunk_rows):
    sparse = trades.withColumn("v", F.when(F.col("op_id") % 40 == 17, F.col("op_id")))
    got = fill_missing(sparse, ["v"], chunk_rows=chunk_rows).toPandas().set_index("op_id")["v"]
    v = frame["op_id"].where(frame["op_id"] % 40 == 17).ffill().bfill()
    v.index = frame["op_id"]
    assert got.sort_index().astype(float).tolist() == v.sort_index().tolist()


@pytest.mark.parametrize("bits", [13, 16, 64])
def test_searched_quantiles_match_pandas(trades, frame, monkeypatch, bits):
    monkeypatch.setattr(q, "DIGIT_BITS", bits)
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = q.quantiles(trades, ["amount", "op_id"], probs, group_rows=1)
    for c in ("amount", "op_id"):
        np.testing.assert_allclose(got[c], frame[c].quantile(probs), rtol=1e-12)
    assert got == q.quantiles(trades, ["amount", "op_id"], probs)


@pytest.mark.parametrize("group_rows", [1, 10, 50, 10_000])
def test_grouped_quantiles_match_pandas(trades, frame, group_rows):
    found = q.grouped_quantiles(trades, ["amount"], [0.25, 0.5], ["client_id"], group_rows)
    got = {r["client_id"]: r["amount"] for r in found.collect()}
    want = frame.groupby("client_id")["amount"].quantile([0.25, 0.5]).unstack()
    assert set(got) == {int(k) for k in want.index}
    for k, row in want.iterrows():
        np.testing.assert_allclose(got[int(k)], row.to_numpy(), rtol=1e-12)


def test_search_when_one_value_dominates(spark):
    xs = [7.0] * 500 + [float(i) for i in range(100)] + [float("inf")]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = q.quantiles(df, ["x"], [0.0, 0.02, 0.5, 0.9, 1.0], group_rows=1)["x"]
    finite = pd.Series(xs[:-1] + [1e9])  # numpy cannot interpolate at an infinity
    assert got[:4] == pytest.approx(list(finite.quantile([0, 0.02, 0.5, 0.9])))
    assert got[4] == float("inf")


def test_group_stats_leave_null_keys_null(trades, frame):
    out = with_group_stats(trades, ["client_id"], {"s": F.sum("amount")}, {"m": "amount"},
                           group_rows=50)
    got = out.toPandas().set_index("op_id").sort_index()
    sums = frame.groupby("client_id")["amount"].transform("sum")
    mids = frame.groupby("client_id")["amount"].transform("median")
    sums.index = mids.index = frame["op_id"]
    np.testing.assert_allclose(got["s"].astype(float), sums.sort_index(), atol=1e-9)
    np.testing.assert_allclose(got["m"].astype(float), mids.sort_index(), atol=1e-12)


def test_codes_beyond_the_small_table_limit(spark):
    df = spark.createDataFrame([(v,) for v in ["b", None, "a", "c", "a"]], "v string")
    for limit in (1, 100):
        got = category_codes(df, "v", small_values=limit).collect()
        assert {(r["v"], r["v_code"]) for r in got} == {("a", 0), ("b", 1), ("c", 2), (None, -1)}


def test_autocorrelation_over_chunks(trades, frame):
    got = autocorrelation(trades, "amount", lags=3, chunk_rows=9).orderBy("lag").collect()
    x = frame["amount"].dropna().to_numpy()
    d = x - x.mean()
    want = [np.sum(d[: len(d) - k] * d[k:]) / np.sum(d * d) for k in range(4)]
    np.testing.assert_allclose([r["acf"] for r in got], want, atol=1e-12)


def test_codes_sort_as_doubles_do(spark):
    import struct

    rng = np.random.default_rng(2)
    bits = rng.integers(0, 2**63, 3000, dtype=np.int64)
    xs = [struct.unpack("<d", struct.pack("<q", int(b)))[0] for b in bits]
    powers = [2.0**e for e in range(-1074, 1024, 7)] + [2.0**-1022, 2.0**1023]
    xs += powers + [np.nextafter(p, 0) for p in powers] + [np.nextafter(p, np.inf) for p in powers]
    xs += [0.0, 1.0, 0.1, 0.2, 1.7976931348623157e308, 5e-324, 2.2250738585072009e-308, float("inf")]
    xs = [x for x in xs if x == x]
    xs += [-x for x in xs] + [float("nan")]
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = {struct.pack("<d", r[0]): r[1] for r in df.select("x", q.value_code(F.col("x"))).collect()}

    def want(x):
        if x != x:
            return (2048 << 52) - 1
        code = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        return -code if x < 0 else code

    assert all(got[struct.pack("<d", float(x))] == want(float(x)) for x in xs)


def test_many_large_groups(spark):
    """10,000 groups above the limit: state is a table, results equal those of one buffer."""
    df = spark.range(60_000).selectExpr(
        "id % 10000 AS g", "CASE WHEN id % 7 > 0 THEN (hash(id) % 1000) / 8.0D END AS x",
        "CASE WHEN id % 10000 <> 5 THEN double(id) END AS y")
    small = q.grouped_quantiles(df, ["x", "y"], [0.25, 0.5], ["g"])
    large = q.grouped_quantiles(df, ["x", "y"], [0.25, 0.5], ["g"], group_rows=1)
    both = small.exceptAll(large).count(), large.exceptAll(small).count(), large.count()
    assert both == (0, 0, 10_000)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan and "SinglePartition" not in plan


def test_searched_quantiles_of_one_table_take_four_passes(spark, monkeypatch):
    stored = []
    real = q.materialize
    monkeypatch.setattr(q, "materialize", lambda df, label: stored.append(label) or real(df, label))
    df = spark.range(5000).selectExpr("double(hash(id)) * 1e-3 AS x")
    probs = [k / 100 for k in range(101)]
    assert q.quantiles(df, ["x"], probs, group_rows=1) == q.quantiles(df, ["x"], probs)
    assert stored.count("ranks") <= 4


@pytest.mark.parametrize("fan", [2, 3, 1000])
def test_chunks_of_chunks(spark, trades, frame, fan):
    sparse = trades.withColumn("v", F.when(F.col("op_id") % 40 == 17, F.col("op_id")))
    got = fill_missing(sparse, ["v"], chunk_rows=5, fan=fan).toPandas().set_index("op_id")["v"]
    v = frame["op_id"].where(frame["op_id"] % 40 == 17).ffill().bfill()
    v.index = frame["op_id"]
    assert got.sort_index().astype(float).tolist() == v.sort_index().tolist()
    by = fill_missing(sparse, ["v"], ["client_id"], chunk_rows=4, fan=fan).toPandas().set_index("op_id")["v"]
    whole = fill_missing(sparse, ["v"], ["client_id"]).toPandas().set_index("op_id")["v"]
    pd.testing.assert_series_equal(by.sort_index(), whole.sort_index())


@pytest.mark.parametrize("fan", [2, 1000])
def test_running_counts(spark, fan):
    from voltide.operators.ordering import running_count

    df = spark.range(500).selectExpr("id * 7 % 500 AS x", "id % 5 + 1 AS k")
    got = {r["x"]: r["c"] for r in running_count(df, "x", "k", "c", chunk_rows=9, fan=fan).collect()}
    want = df.toPandas().sort_values("x").set_index("x")["k"].cumsum()
    assert got == want.to_dict()


def test_fill_has_no_window_over_one_partition(spark, trades, monkeypatch):
    from voltide.operators import ordering

    plans = []
    real = ordering.materialize

    def stored(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(ordering, "materialize", stored)
    out = fill_missing(trades, ["amount"], chunk_rows=5, fan=3)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    for text in plans:
        assert "Exchange SinglePartition" not in text


def test_distance_to_the_normal(spark):
    import math

    from statistics import NormalDist

    from voltide.functions.errors import normal_cdf_sql
    from voltide.operators.evaluate import normality_ks

    zs = [k / 8 for k in range(-320, 321)] + [0.0, 7.0710678, 7.0711, 1e-9]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for z, f in df.selectExpr("z", f"{normal_cdf_sql('z')} AS f").collect():
        assert f == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), abs=1e-14)
    rng = np.random.default_rng(8)
    x = np.round(rng.gamma(3, size=700), 2)  # with ties
    values, counts = np.unique(x, return_counts=True)
    upto = np.cumsum(counts)
    f = np.array([NormalDist(x.mean(), x.std(ddof=1)).cdf(v) for v in values])
    want = max((upto / len(x) - f).max(), (f - (upto - counts) / len(x)).max())
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "error double")
    got = normality_ks(df, chunk_rows=11, fan=3).first()
    assert got["n"] == 700 and got["statistic"] == pytest.approx(want, abs=1e-12)
