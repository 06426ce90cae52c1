"""Prediction metrics, error distribution and error patterns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.functions.errors import (
    error_columns,
    lilliefors_p,
    normal_cdf_sql,
    normal_quantile,
    t_quantile,
)
from voltide.operators.ordering import running_count, windowed
from voltide.operators.quantiles import grouped_quantiles, quantiles
from voltide.operators.stats import correlations_with
from voltide.schema import ORDER, numeric_columns
from voltide.session import materialize

# Default alert limits.
ALERT_LIMITS = {"rmse": 100.0, "mae": 50.0, "mape": 5.0, "drift": 0.1}


def metric_columns(actual: str = "amount", predicted: str = "predicted_amount") -> dict:
    """Aggregates over rows that have both values; zero actuals leave MAPE out."""
    both = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    a = F.when(both, F.col(actual).cast("double"))
    e = F.when(both, F.col(actual) - F.col(predicted))
    return {
        "n": F.count(e),
        "rmse": F.sqrt(F.avg(e * e)),
        "mae": F.avg(F.abs(e)),
        "r2": 1 - F.try_divide(F.sum(e * e), F.var_pop(a) * F.count(a)),
        "mape": F.avg(F.try_divide(F.abs(e), F.abs(a))) * 100,
        "zero_actuals": F.count_if(a == 0),
    }


def evaluate(
    df: DataFrame,
    by: Sequence[str] = (),
    actual: str = "amount",
    predicted: str = "predicted_amount",
    limits: dict[str, float] = ALERT_LIMITS,
) -> DataFrame:
    """RMSE, MAE, R2, MAPE and alert flags, over all rows or per group."""
    aggs = [c.alias(n) for n, c in metric_columns(actual, predicted).items()]
    out = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return out.withColumns(
        {f"{m}_alert": (F.col(m) > limits[m]).cast("int") for m in ("rmse", "mae")}
    )


def _once(df: DataFrame, columns: Sequence[str], store: bool) -> DataFrame:
    """The columns of an input that is read several times, written once.

    ``store=False`` is for a table that is stored already.
    """
    narrow = df.select(*dict.fromkeys(columns))
    return materialize(narrow, "evaluated") if store else narrow


def evaluate_extended(
    df: DataFrame,
    actual: str = "amount",
    predicted: str = "predicted_amount",
    t: float | None = None,
    store: bool = True,
    **limits,
) -> DataFrame:
    """Adds MSE, extremes, median error, population std and the mean's interval."""
    errors = _once(df, [actual, predicted], store).withColumns(error_columns(actual, predicted))
    median = quantiles(errors, ["abs_error"], [0.5], **limits)["abs_error"][0]
    base = metric_columns(actual, predicted)
    out = errors.agg(
        *[base[n].alias(n) for n in ("n", "rmse", "mae", "r2", "mape")],
        F.avg(F.col("error") * F.col("error")).alias("mse"),
        F.max("abs_error").alias("max_error"),
        F.lit(median).cast("double").alias("median_error"),
        F.stddev_pop("error").alias("error_std"),
        F.avg("error").alias("_mean"),
        F.stddev_samp("error").alias("_std"),
    )
    if t is None:
        n = errors.select(F.count("error")).first()[0]
        t = t_quantile(0.975, n - 1) if n > 1 else 0.0
    half = F.lit(t) * F.try_divide(F.col("_std"), F.sqrt("n"))
    return out.withColumns(
        {"error_ci_lower": F.col("_mean") - half, "error_ci_upper": F.col("_mean") + half}
    ).drop("_mean", "_std")


def error_moments_biased(df: DataFrame, column: str = "error") -> DataFrame:
    """Mean, population std, biased skewness and excess kurtosis."""
    return df.agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_pop(column).alias("std"),
        F.skewness(column).alias("skewness"),
        F.kurtosis(column).alias("kurtosis"),
    )


def error_moments(
    df: DataFrame, column: str = "error", store: bool = True, **limits
) -> DataFrame:
    """Sample std, bias-corrected skewness and kurtosis, median and quartiles."""
    df = _once(df, [column], store)
    q1, q2, q3 = quantiles(df, [column], [0.25, 0.5, 0.75], **limits)[column]
    n = F.col("n").cast("double")
    return (
        df.agg(
            F.count(column).alias("n"),
            F.avg(column).alias("mean_error"),
            F.stddev_samp(column).alias("std_error"),
            F.skewness(column).alias("g1"),
            F.kurtosis(column).alias("g2"),
        )
        .select(
            "n",
            "mean_error",
            "std_error",
            F.lit(q2).cast("double").alias("median_error"),
            (F.col("g1") * F.try_divide(F.sqrt(n * (n - 1)), n - 2)).alias("skewness"),
            (
                F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)
            ).alias("kurtosis"),
            F.lit(q1).cast("double").alias("q1_error"),
            F.lit(q3).cast("double").alias("q3_error"),
        )
    )


def normality_jb(df: DataFrame, column: str = "error", level: float = 0.05) -> DataFrame:
    """Jarque-Bera test from the biased moments."""
    m = error_moments_biased(df, column)
    jb = F.col("n") / 6 * (F.pow("skewness", 2) + F.pow("kurtosis", 2) / 4)
    return m.select("n", jb.alias("statistic")).withColumns(
        {
            "p_value": F.exp(-F.col("statistic") / 2),
            "is_normal": F.exp(-F.col("statistic") / 2) > level,
        }
    )


def normality_ks(df: DataFrame, column: str = "error", **limits) -> DataFrame:
    """Kolmogorov-Smirnov distance to the fitted normal, with Lilliefors p-value.

    Different values are counted, put in order and given their running counts chunk by
    chunk; the distance is the largest gap at a value, from above or below.
    """
    x = df.select((F.col(column).cast("double") + F.lit(0.0)).alias("x")).where("x is not null")
    counted = materialize(x.groupBy("x").agg(F.count(F.lit(1)).alias("rows")), "counted")
    n, mean, std = _once(x, ["x"], True).agg(F.count("x"), F.avg("x"), F.stddev_samp("x")).first()
    row = [(n, None, None, False)]
    if std and math.isfinite(std):  # errors that do not vary, or none, have no distance
        upto = running_count(counted, "x", "rows", "upto", **limits).withColumn(
            "z", (F.col("x") - F.lit(mean)) / F.lit(std)
        )
        share = upto.withColumn("share", F.expr(normal_cdf_sql("z")))
        d = share.agg(
            F.max(F.greatest(
                F.col("upto") / n - F.col("share"), F.col("share") - (F.col("upto") - F.col("rows")) / n
            ))
        ).first()[0]
        p = lilliefors_p(d, n)
        row = [(n, float(d), p, p > 0.05)]
    return df.sparkSession.createDataFrame(
        row, "n bigint, statistic double, p_value double, is_normal boolean"
    )


def qq_points(
    df: DataFrame, column: str = "error", points: int = 99, store: bool = True, **limits
) -> DataFrame:
    """Sample quantiles against normal quantiles at i / (points + 1)."""
    df = _once(df, [column], store)
    probs = [(i + 1) / (points + 1) for i in range(points)]
    found = quantiles(df, [column], probs, **limits)[column]
    rows = [(p, normal_quantile(p), v) for p, v in zip(probs, found)]
    return df.sparkSession.createDataFrame(rows, "p double, theoretical double, sample double")


def _ladder(x: Column, edges: Sequence[float], closed: str) -> Column:
    """Index of the interval of x among ``edges``; null outside."""
    last = len(edges) - 2
    out = None
    for k in range(last + 1):
        lo, hi = F.lit(edges[k]), F.lit(edges[k + 1])
        if closed == "left":
            test = (x >= lo) & (x < hi)
        elif closed == "left+max":
            test = (x >= lo) & ((x <= hi) if k == last else (x < hi))
        else:  # right-closed, lowest included
            test = ((x >= lo) if k == 0 else (x > lo)) & (x <= hi)
        out = F.when(test, k) if out is None else out.when(test, k)
    return out if out is not None else F.lit(None).cast("int")


def _bounds(edges: Sequence[float], index: str) -> dict[str, Column]:
    los = F.array(*[F.lit(e) for e in edges[:-1]])
    his = F.array(*[F.lit(e) for e in edges[1:]])
    return {"range_lo": F.get(los, F.col(index)), "range_hi": F.get(his, F.col(index))}


def bias_by_range(
    df: DataFrame,
    actual: str = "amount",
    predicted: str = "predicted_amount",
    include_max: bool = True,
    store: bool = True,
    **limits,
) -> DataFrame:
    """Mean of prediction minus actual per quartile range of the actual.

    ``include_max=False`` leaves the largest actual out of every range.
    """
    df = _once(df, [actual, predicted], store)
    edges = quantiles(df, [actual], [0.0, 0.25, 0.5, 0.75, 1.0], **limits)[actual]
    closed = "left+max" if include_max else "left"
    return (
        df.withColumn("bin", _ladder(F.col(actual), edges, closed))
        .where("bin is not null")
        .groupBy("bin")
        .agg(
            F.avg(F.col(predicted) - F.col(actual)).alias("bias"),
            F.count(F.lit(1)).alias("rows"),
        )
        .withColumns(_bounds(edges, "bin"))
        .withColumn("range", F.format_string("%.2f-%.2f", "range_lo", "range_hi"))
    )


def with_quantile_bin(
    df: DataFrame, column: str, bins: int = 5, name: str = "bin", **limits
) -> tuple[DataFrame, list[float]]:
    """Right-closed quantile bins; equal edges are merged."""
    grid = [i / bins for i in range(bins + 1)]
    edges = sorted({e for e in quantiles(df, [column], grid, **limits)[column] if e is not None})
    if len(edges) == 1:
        edges = edges * 2  # one value is one bin
    return df.withColumn(name, _ladder(F.col(column), edges, "right")), edges


def error_by_quintile(
    df: DataFrame,
    actual: str = "amount",
    predicted: str = "predicted_amount",
    store: bool = True,
    **limits,
) -> DataFrame:
    """Mean, std and count of the absolute error per fifth of the actuals."""
    binned, edges = with_quantile_bin(
        _once(df, [actual, predicted], store).withColumns(error_columns(actual, predicted)), actual, **limits
    )
    return (
        binned.where("bin is not null")
        .groupBy("bin")
        .agg(
            F.avg("abs_error").alias("mean"),
            F.stddev_samp("abs_error").alias("std"),
            F.count("abs_error").alias("count"),
        )
        .withColumns(_bounds(edges, "bin"))
    )


def error_box(
    df: DataFrame,
    actual: str = "amount",
    predicted: str = "predicted_amount",
    store: bool = True,
    **limits,
) -> DataFrame:
    """Five-number summary of the error per fifth of the actuals."""
    binned, edges = with_quantile_bin(
        _once(df, [actual, predicted], store).withColumns(error_columns(actual, predicted)), actual, **limits
    )
    five = grouped_quantiles(binned, ["error"], [0.0, 0.25, 0.5, 0.75, 1.0], ["bin"], **limits)
    names = ("low", "q1", "median", "q3", "high")
    return five.select(
        "bin", *[F.col("error")[i].alias(n) for i, n in enumerate(names)]
    ).withColumns(_bounds(edges, "bin"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts of equal-width bins; the maximum belongs to the last bin."""
    x = F.col(column).cast("double")
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    if lo is None:
        lo, hi = 0.0, 1.0
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    place = F.least(F.floor((x - F.lit(lo)) / F.lit(width)) + 1, F.lit(bins))
    return (
        df.where(x.isNotNull())
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("bin_lo", F.lit(lo) + (F.col("bin") - 1) * F.lit(width))
    )


def autocorrelation(
    df: DataFrame, column: str = "error", lags: int = 20, order: Sequence[str] = ORDER, **limits
) -> DataFrame:
    """Autocorrelation of the whole table in row order, lags 0 to ``lags``."""
    series = df.select(*order, F.col(column).cast("double").alias("x")).where("x is not null")
    mean = series.agg(F.avg("x")).first()[0]
    off = series.select(*order, (F.col("x") - F.lit(mean)).alias("x"))
    lagged = windowed(
        off,
        lambda w: {f"lag_{k}": F.lag("x", k).over(w) for k in range(1, lags + 1)},
        back=lags,
        by=(),
        order=order,
        **limits,
    ).withColumn("lag_0", F.col("x"))
    sums = lagged.agg(
        *[F.sum(F.col("x") * F.col(f"lag_{k}")).alias(f"s{k}") for k in range(lags + 1)]
    )
    rows = [
        F.struct(F.lit(k).alias("lag"), F.try_divide(f"s{k}", "s0").alias("acf"))
        for k in range(lags + 1)
    ]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def feature_error_correlation(
    df: DataFrame,
    features: Sequence[str] | None = None,
    actual: str = "amount",
    predicted: str = "predicted_amount",
) -> DataFrame:
    """Correlation of each numeric column with the absolute error."""
    names = features or [c for c in numeric_columns(df) if c not in ("error", "abs_error")]
    with_error = df.withColumn("abs_error", F.abs(F.col(actual) - F.col(predicted)))
    return correlations_with(with_error, names, "abs_error")


def prediction_summary(df: DataFrame, ts: str = "prediction_timestamp") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.min(ts).alias("first_prediction"),
        F.max(ts).alias("last_prediction"),
    )


def compare_models(
    df: DataFrame, models: Sequence[str], actual: str = "amount"
) -> DataFrame:
    """RMSE, MAE and R2 of several prediction columns, one row per model."""
    pairs = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(m).alias("p")) for m in models]
    )
    long = df.select(F.col(actual).alias("a"), F.explode(pairs).alias("m")).select(
        "a", "m.model", "m.p"
    )
    metrics = metric_columns("a", "p")
    return long.groupBy("model").agg(
        *[metrics[n].alias(n) for n in ("n", "rmse", "mae", "r2")]
    )


def metrics_by_horizon(
    df: DataFrame,
    cut_micros: float,
    days: int = 7,
    actual: str = "amount",
    predicted: str = "predicted_amount",
    ts: str = "close_ts",
) -> DataFrame:
    """Metrics of rows after the cut, per block of ``days`` days ahead."""
    ahead = F.unix_micros(ts) - F.lit(cut_micros)
    block = F.floor(ahead / F.lit(days * 86_400_000_000.0))
    later = df.where(ahead > 0).withColumn("horizon", block)
    m = metric_columns(actual, predicted)
    return later.groupBy("horizon").agg(*[m[n].alias(n) for n in ("n", "rmse", "mae")])

