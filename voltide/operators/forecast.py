"""Additive forecasts: one for the whole table, one per client."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.functions.calendar import is_us_holiday
from voltide.functions.errors import normal_quantile
from voltide.session import materialize

DAY = 86_400.0
# Default regressors and model settings.
REGRESSORS = ("amount", "client_mean_amount", "amount_ma_5", "spread")
CHANGEPOINTS = 15
CHANGEPOINT_RANGE = 0.7
SEASONS = {"yearly": (365.25, 10), "weekly": (7.0, 3), "daily": (1.0, 4)}
INTERVAL = 0.95


def seconds(ts: str) -> Column:
    return F.unix_micros(ts) / F.lit(1_000_000.0)


def fourier(ts: str, period: float, order: int, name: str) -> dict[str, Column]:
    turn = seconds(ts) * F.lit(2 * math.pi / (period * DAY))
    out = {}
    for k in range(1, order + 1):
        out[f"{name}_sin_{k}"] = F.sin(turn * k)
        out[f"{name}_cos_{k}"] = F.cos(turn * k)
    return out


@dataclass(frozen=True)
class Forecaster:
    """Linear trend with changepoints, times one plus seasons and regressors.

    The trend is fitted first, then the relative rest; both are ridge regressions on sums
    of products that tasks make of Arrow batches, as generated code of so many waves is too
    long for the JVM to compile. Forecasts are made of batches too.
    """

    start: float
    length: float
    knots: tuple[float, ...]
    regressors: tuple[str, ...]
    trend: dict[str, float]
    rest: dict[str, float]
    residual_std: float
    seasons: dict[str, tuple[float, int]] = field(default_factory=lambda: dict(SEASONS))

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        ts: str = "ds",
        y: str = "y",
        regressors: Sequence[str] = (),
        ridge: float = 1e-4,
        changepoint_prior: float | None = None,
        seasonality_prior: float | None = None,
        holidays_prior: float | None = None,
        changepoints: int = CHANGEPOINTS,
        changepoint_range: float = CHANGEPOINT_RANGE,
        seasons: dict[str, tuple[float, int]] | None = None,
    ) -> Forecaster:
        """Fit trend, then the relative rest.

        A component's prior scale sets its penalty, 1 / scale squared a row; without
        one it takes ``ridge``.
        """
        seasons = dict(SEASONS if seasons is None else seasons)
        priors = {"_knot": changepoint_prior, "_holiday": holidays_prior}
        priors.update({f"_{name}": seasonality_prior for name in seasons})

        def scales(columns) -> dict[str, float]:
            return {
                c: s for c in columns for prefix, s in priors.items() if s and c.startswith(prefix)
            }

        rows = materialize(
            df.select(
                F.col(ts).alias("ds"),
                F.col(y).cast("double").alias("y"),
                *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in regressors],
            ).where("y is not null"),
            "forecast",
        )
        lo, hi = rows.agg(F.min(seconds("ds")), F.max(seconds("ds"))).first()
        length = (hi - lo) or 1.0
        step = changepoint_range / (changepoints + 1)
        knots = tuple(step * (k + 1) for k in range(changepoints))
        shape = cls(lo, length, knots, tuple(regressors), {}, {}, 0.0, seasons)
        facts = materialize(rows.select(*shape.facts(), "y"), "facts")
        names = list(shape.trend_columns())
        trend = _ridge(facts, lambda f: (shape.trend_terms(f), f["y"].to_numpy()), names, ridge, scales(names))
        shape = cls(lo, length, knots, tuple(regressors), trend, {}, 0.0, seasons)

        def relative(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
            base = shape.trend_of(frame)
            known = base != 0
            return shape.rest_terms(frame[known]), frame["y"].to_numpy()[known] / base[known] - 1

        names = list(shape.rest_columns())
        rest = _ridge(facts, relative, names, ridge, scales(names))
        model = cls(lo, length, knots, tuple(regressors), trend, rest, 0.0, seasons)

        def left(frame: pd.DataFrame) -> np.ndarray:
            off = frame["y"].to_numpy() - model.values_of(frame)[1]
            return np.stack([np.ones(len(off)), off], axis=1)

        (n, total), (_, square) = sums_of(facts, left, 2)[0]
        std = math.sqrt(max(square - total * total / n, 0.0) / (n - 1)) if n > 1 else 0.0
        return cls(lo, length, knots, tuple(regressors), trend, rest, std, seasons)

    def facts(self) -> list[Column]:
        """What the terms are made of: seconds, holiday and regressors."""
        known = [F.col(c).cast("double").alias(f"_r{i}") for i, c in enumerate(self.regressors)]
        return [seconds("ds").alias("_s"), is_us_holiday("ds").cast("double").alias("_h"), *known]

    def trend_terms(self, facts: pd.DataFrame) -> np.ndarray:
        """The values of ``trend_columns`` for a batch of facts."""
        t = (facts["_s"].to_numpy() - self.start) / self.length
        return np.stack([t, *[np.maximum(t - k, 0.0) for k in self.knots]], axis=1)

    def rest_terms(self, facts: pd.DataFrame) -> np.ndarray:
        """The values of ``rest_columns`` for a batch of facts."""
        at = facts["_s"].to_numpy()
        waves = [
            wave(at * (2 * math.pi / (period * DAY)) * k)
            for period, order in self.seasons.values() for k in range(1, order + 1) for wave in (np.sin, np.cos)
        ]
        known = [facts[f"_r{i}"].to_numpy() for i in range(len(self.regressors))]
        return np.stack([facts["_h"].to_numpy(), *waves, *known], axis=1)

    def trend_of(self, facts: pd.DataFrame) -> np.ndarray:
        weights = [self.trend[c] for c in ("_t", *[f"_knot_{i}" for i in range(len(self.knots))])]
        return self.trend["intercept"] + self.trend_terms(facts) @ np.array(weights)

    def values_of(self, facts: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Trend and forecast for a batch of facts."""
        trend = self.trend_of(facts)
        waves = [
            f"_{name}_{wave}_{k}"
            for name, (_, order) in self.seasons.items() for k in range(1, order + 1) for wave in ("sin", "cos")
        ]
        weights = [self.rest[c] for c in ("_holiday", *waves, *[f"_x_{c}" for c in self.regressors])]
        return trend, trend * (1 + self.rest["intercept"] + self.rest_terms(facts) @ np.array(weights))

    def trend_columns(self) -> dict[str, Column]:
        t = (seconds("ds") - F.lit(self.start)) / F.lit(self.length)
        hinges = {
            f"_knot_{i}": F.greatest(t - F.lit(k), F.lit(0.0)) for i, k in enumerate(self.knots)
        }
        return {"_t": t, **hinges}

    def trend_value(self) -> Column:
        return _dot(self.trend_columns(), self.trend)

    def rest_columns(self) -> dict[str, Column]:
        out: dict[str, Column] = {"_holiday": F.col("_is_holiday").cast("double")}
        for name, (period, order) in self.seasons.items():
            out.update(fourier("ds", period, order, f"_{name}"))
        out.update({f"_x_{c}": F.col(c) for c in self.regressors})
        return out

    def with_holiday(self, df: DataFrame) -> DataFrame:
        """Mark holidays; the rule covers every year."""
        return df.withColumn("_is_holiday", is_us_holiday("ds").cast("int"))

    def predict(self, df: DataFrame, interval: float = INTERVAL) -> DataFrame:
        names, facts = df.columns, self.facts()

        @F.pandas_udf("trend double, yhat double")
        def values(*known: pd.Series) -> pd.DataFrame:
            frame = pd.concat([k.astype(float) for k in known], axis=1)
            frame.columns = ["_s", "_h", *[f"_r{i}" for i in range(len(known) - 2)]]
            return pd.DataFrame(dict(zip(("trend", "yhat"), self.values_of(frame))))

        half = F.lit(normal_quantile(0.5 + interval / 2) * self.residual_std)
        # Arrow batches do not tell null from NaN
        dated = F.col("ds").isNotNull()
        whole = dated
        for c in self.regressors:
            whole = whole & F.col(c).isNotNull()
        out = df.withColumn("_found", values(*facts)).withColumns({
            "trend": F.when(dated, F.coalesce("_found.trend", F.lit(math.nan))),
            "yhat": F.when(whole, F.coalesce("_found.yhat", F.lit(math.nan))),
        })
        return out.select(
            *names,
            "trend",
            "yhat",
            (F.col("yhat") - half).alias("yhat_lower"),
            (F.col("yhat") + half).alias("yhat_upper"),
            F.lit(interval).alias("confidence"),
        )


def _dot(columns: dict[str, Column], weights: dict[str, float]) -> Column:
    total = F.lit(weights["intercept"])
    for name, c in columns.items():
        total = total + c * F.lit(weights[name])
    return total


def sums_of(
    df: DataFrame, build: Callable[[pd.DataFrame], np.ndarray], width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The sums over all rows of products of all pairs of the ``width`` columns that ``build`` makes of a
    batch, and each column's range. One number per pair comes to the driver."""

    def added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        low, high = np.full(width, np.inf), np.full(width, -np.inf)
        for frame in frames:
            if len(frame):
                x = build(frame)
                total += x.T @ x
                low = np.minimum(low, x.min(axis=0, initial=np.inf))
                high = np.maximum(high, x.max(axis=0, initial=-np.inf))
        at, v = np.arange(width * width), total.ravel()
        # Arrow batches do not tell null from NaN, and a sum passes over nulls
        yield pd.DataFrame(
            {"at": at, "v": v, "bad": ~np.isfinite(v), "low": low[at // width], "high": high[at // width]}
        )

    parts = df.mapInPandas(added, "at int, v double, bad boolean, low double, high double")
    found = parts.groupBy("at").agg(
        F.sum("v").alias("v"), F.max("bad").alias("bad"), (F.max("high") - F.min("low")).alias("span")
    )
    sums, span = np.zeros(width * width), np.zeros(width)
    for r in found.collect():
        sums[r["at"]] = math.nan if r["bad"] else r["v"]
        span[r["at"] // width] = math.nan if r["span"] is None else r["span"]
    return sums.reshape(width, width), span


def _ridge(
    df: DataFrame, build: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]], columns: Sequence[str],
    ridge: float, scales: dict[str, float] | None = None,
) -> dict:
    """Ridge weights of the columns and for the label that ``build`` makes of a batch, from one pass.

    The penalty is ``ridge`` over the label's deviation, as in ``spark.ml``; a column with a scale s is
    penalised by 1 / (rows * s * s). That is the common penalty for the column times s * sqrt(rows * ridge).
    """

    def with_one(frame: pd.DataFrame) -> np.ndarray:
        x, label = build(frame)
        return np.concatenate([np.ones((len(label), 1)), x, label[:, None]], axis=1)

    sums, span = sums_of(df, with_one, len(columns) + 2)
    if not np.isfinite(sums).all():
        raise ValueError("a time, label or regressor is missing or not finite")
    rows = sums[0, 0]
    weights = dict.fromkeys(columns, 0.0)
    if not rows:
        return {"intercept": 0.0, **weights}
    scales = scales or {}
    factor = np.array([scales[c] * math.sqrt(rows * ridge) if c in scales else 1.0 for c in columns])
    mean = sums[0, 1:] / rows
    around = sums[1:, 1:] / rows - np.outer(mean, mean)
    # a column that (nearly) never changes makes the normal equations singular: no weight
    used = np.flatnonzero((span[1:-1] * factor > 1e-8) & (np.diag(around)[:-1] > 0))
    spread = math.sqrt(max(around[-1, -1], 0.0))
    if not len(used) or not spread:
        return {"intercept": float(mean[-1]), **weights}
    size = np.sqrt(np.diag(around)[used])
    gram = around[np.ix_(used, used)] / np.outer(size, size)
    gram += np.diag(ridge / spread / (factor[used] * size) ** 2)
    found = np.linalg.solve(gram, around[used, -1] / size) / size
    weights |= {columns[i]: float(w) for i, w in zip(used, found)}
    return {"intercept": float(mean[-1] - mean[:-1][used] @ found), **weights}


def forecast_input(df: DataFrame, regressors: Sequence[str] = REGRESSORS) -> DataFrame:
    """``ds``, ``y`` and the regressors that are present."""
    present = [c for c in regressors if c in df.columns]
    return df.select(F.col("close_ts").alias("ds"), F.col("daily_volume").alias("y"), *present)


def forecast_future(model: Forecaster, history: DataFrame, periods: int = 30) -> DataFrame:
    """Forecast of the rows of ``history`` (``ds`` and regressors) and the days after it.

    ``part`` says which; regressors keep their last known value in the future.
    """
    known = history.select("ds", *model.regressors).withColumn("part", F.lit("history"))
    ahead = future_frame(history, periods, "ds", model.regressors).withColumn("part", F.lit("future"))
    return model.predict(known.unionByName(ahead.select(*known.columns)))


def future_frame(
    df: DataFrame, periods: int = 30, ts: str = "close_ts", regressors: Sequence[str] = ()
) -> DataFrame:
    """The days after the last one; regressors keep their last known value."""
    last = df.agg(
        F.to_date(F.max(ts)).alias("_last"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(c) for c in regressors],
    )
    days = F.sequence(F.date_add("_last", 1), F.date_add("_last", periods))
    return last.select(F.explode(days).alias("ds"), *regressors).withColumn(
        "ds", F.col("ds").cast("timestamp")
    )


# ---- per client

CLIENT_TERMS = ("one", "t", "sin_1", "cos_1", "sin_2", "cos_2")


def client_terms(day: str) -> dict[str, Column]:
    """Intercept, days since 2000-01-01 in years, and two weekly harmonics."""
    n = F.datediff(day, F.lit("2000-01-01").cast("date")).cast("double")
    turn = n * F.lit(2 * math.pi / 7)
    return {
        "one": F.lit(1.0),
        "t": n / 365.25,
        "sin_1": F.sin(turn),
        "cos_1": F.cos(turn),
        "sin_2": F.sin(turn * 2),
        "cos_2": F.cos(turn * 2),
    }


def client_daily(df: DataFrame) -> DataFrame:
    return df.groupBy("client_id", F.to_date("close_ts").alias("day")).agg(
        F.sum("amount").alias("y")
    )


def client_trend(df: DataFrame) -> DataFrame:
    """Slope per day and intercept of each client's amounts."""
    at = F.unix_seconds("close_ts") / 86_400
    return df.where(F.col("client_id").isNotNull()).groupBy("client_id").agg(
        F.regr_slope("amount", at).alias("slope"),
        F.regr_intercept("amount", at).alias("intercept"),
        F.count(F.lit(1)).alias("rows"),
    )


def client_models(df: DataFrame, ridge: float = 1.0) -> DataFrame:
    """Ridge regression of every client's daily volume.

    Only sums of products leave the rows, so a client's size does not matter;
    the small linear systems are solved in Arrow batches.
    """
    p = len(CLIENT_TERMS)
    daily = client_daily(df.where(F.col("client_id").isNotNull())).withColumns(
        client_terms("day")
    )
    grams = [(i, j) for i in range(p) for j in range(i, p)]
    sums = daily.groupBy("client_id").agg(
        F.array(
            *[F.sum(F.col(CLIENT_TERMS[i]) * F.col(CLIENT_TERMS[j])) for i, j in grams]
        ).alias("xx"),
        F.array(*[F.sum(F.col(c) * F.col("y")) for c in CLIENT_TERMS]).alias("xy"),
        F.sum(F.col("y") * F.col("y")).alias("yy"),
        F.count("y").alias("days"),
        F.max("day").alias("last_day"),
    )

    @F.pandas_udf("weights array<double>, residual_std double")
    def solve(xx: pd.Series, xy: pd.Series, yy: pd.Series, days: pd.Series) -> pd.DataFrame:
        n = len(xx)
        gram = np.zeros((n, p, p))
        flat = np.array(xx.tolist(), dtype=float).reshape(n, len(grams))
        for at, (i, j) in enumerate(grams):
            gram[:, i, j] = gram[:, j, i] = flat[:, at]
        right = np.array(xy.tolist(), dtype=float).reshape(n, p)
        penalty = ridge * np.eye(p)
        penalty[0, 0] = 1e-9  # the intercept is not shrunk
        w = np.linalg.solve(gram + penalty, right[..., None])[..., 0]
        sse = (
            yy.to_numpy()
            - 2 * np.einsum("np,np->n", w, right)
            + np.einsum("np,npq,nq->n", w, gram, w)
        )
        std = np.sqrt(np.maximum(sse, 0) / np.maximum(days.to_numpy() - 1, 1))
        return pd.DataFrame({"weights": list(w), "residual_std": std})

    return sums.withColumn("m", solve("xx", "xy", "yy", "days")).select(
        "client_id", "days", "last_day", "m.*"
    )


def forecast_clients(
    df: DataFrame, periods: int = 7, ridge: float = 1.0, interval: float = INTERVAL
) -> DataFrame:
    """``periods`` days after each client's last day, with bounds."""
    days = F.sequence(F.date_add("last_day", 1), F.date_add("last_day", periods))
    ahead = client_models(df, ridge).withColumn("ds", F.explode(days))
    terms = client_terms("ds")
    yhat = F.lit(0.0)
    for i, name in enumerate(CLIENT_TERMS):
        yhat = yhat + F.col("weights")[i] * terms[name]
    half = F.col("residual_std") * normal_quantile(0.5 + interval / 2)
    return ahead.withColumn("yhat", yhat).select(
        "client_id",
        "ds",
        "yhat",
        (F.col("yhat") - half).alias("yhat_lower"),
        (F.col("yhat") + half).alias("yhat_upper"),
        F.lit(interval).alias("confidence"),
    )
