"""The additive forecaster with trend and relative rest fitted together.

``y = trend * (1 + rest)``. With the rest held, the trend is a regression whose slope
changes carry an L1 penalty, so most of them are none; with the trend held, the rest is
a ridge regression. The two take turns on a stored table: a turn is one pass that adds
up products of the model's columns, a task's batches first, and what comes to the driver
is one number per pair of columns. Bounds widen beyond the history by the variance of
further slope changes, as many and as large as those found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.functions.errors import normal_quantile
from voltide.operators.forecast import (
    CHANGEPOINT_RANGE,
    CHANGEPOINTS,
    DAY,
    INTERVAL,
    SEASONS,
    Forecaster,
    _dot,
    seconds,
)
from voltide.session import materialize

#: Turns of trend and rest.
ROUNDS = 4


def products(df: DataFrame, build: Callable[[pd.DataFrame], np.ndarray], width: int) -> np.ndarray:
    """The sums over all rows of products of all pairs of the ``width`` columns that ``build``
    makes of a batch."""

    def added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for frame in frames:
            if len(frame):
                x = build(frame)
                total = total + x.T @ x
        yield pd.DataFrame({"sums": [total.ravel()]})

    parts = df.mapInPandas(added, "sums array<double>").select(F.posexplode("sums").alias("at", "v"))
    out = np.zeros(width * width)
    for r in parts.groupBy("at").agg(F.sum("v").alias("v")).collect():  # one number per pair
        out[r["at"]] = r["v"]
    return out.reshape(width, width)


def lasso(gram: np.ndarray, right: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Minimum of ``w'Gw / 2 - c'w + sum(penalty * |w|)``; a zero penalty leaves a weight free.

    The minimum is a line between the penalties at which a weight starts or stops being
    zero, so it is followed from the largest penalty down to the wanted one.
    """
    w, own = np.zeros(len(right)), np.diag(gram)
    free, bound = np.flatnonzero((penalty == 0) & (own > 0)), np.flatnonzero((penalty > 0) & (own > 0))
    # what the free weights explain is taken out first
    cross = np.linalg.lstsq(gram[np.ix_(free, free)], np.c_[gram[np.ix_(free, bound)], right[free]], rcond=1e-13)[0]
    scale = penalty[bound]
    g = (gram[np.ix_(bound, bound)] - gram[np.ix_(bound, free)] @ cross[:, :-1]) / np.outer(scale, scale)
    c = (right[bound] - gram[np.ix_(bound, free)] @ cross[:, -1]) / scale
    own = np.diag(g).copy()
    usable = own > 1e-12 * np.abs(np.diag(gram)[bound] / scale**2)
    v, active, at = np.zeros(len(bound)), [], np.abs(np.where(usable, c, 0.0)).max(initial=0.0)
    if at > 1:
        active = [int(np.argmax(np.abs(np.where(usable, c, 0.0))))]
    for _ in range(50 * len(bound)):
        if at <= 1 or not active:
            break
        pull = c - g @ v
        signs = np.sign(pull[active])
        move = np.linalg.lstsq(g[np.ix_(active, active)], signs, rcond=1e-13)[0]
        fall = g[:, active] @ move  # how fast the others' pull changes while the penalty falls by 1
        step, event = at - 1, None
        for j in np.flatnonzero(usable):
            if j in active:
                k = active.index(j)
                cut = -v[j] / move[k] if move[k] else np.inf
                if 1e-12 * at < cut < step:
                    step, event = cut, ("out", k)
            else:
                for sign in (1, -1):
                    rate = 1 - sign * fall[j]
                    gap = (at - sign * pull[j]) / rate if rate > 1e-12 else np.inf
                    if -1e-9 * at <= gap < step:
                        step, event = max(gap, 0.0), ("in", int(j))
        v[active] += step * move
        at -= step
        if event is None:
            break
        if event[0] == "out":
            v[active.pop(event[1])] = 0.0
        else:
            active.append(event[1])
    w[bound] = v / scale
    w[free] = cross[:, -1] - cross[:, :-1] @ w[bound]
    return w


@dataclass(frozen=True)
class JointForecaster(Forecaster):
    """See the module; ``change_rate`` slope changes per history, of mean size ``change_size``."""

    change_rate: float = 0.0
    change_size: float = 0.0
    #: ``variance / scale^2`` of each term of the rest: its ridge penalty.
    penalties: tuple[float, ...] = ()

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        ts: str = "ds",
        y: str = "y",
        regressors: Sequence[str] = (),
        changepoint_prior: float = 0.05,
        seasonality_prior: float = 10.0,
        holidays_prior: float = 10.0,
        regressor_prior: float = 10.0,
        changepoints: int = CHANGEPOINTS,
        changepoint_range: float = CHANGEPOINT_RANGE,
        seasons: dict[str, tuple[float, int]] | None = None,
        rounds: int = ROUNDS,
    ) -> JointForecaster:
        """Priors are the scales that weights are expected to have, for a label of size 1."""
        seasons = dict(SEASONS if seasons is None else seasons)
        rows = materialize(
            df.select(
                F.col(ts).alias("ds"), F.col(y).cast("double").alias("y"),
                *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in regressors],
            ).where("y is not null AND ds is not null"),
            "forecast",
        )
        spreads = [F.stddev_pop(c) for c in regressors]
        lo, hi, size, n, *spread = rows.agg(
            F.min(seconds("ds")), F.max(seconds("ds")), F.max(F.abs("y")), F.count("y"), *spreads
        ).first()
        if not n:
            raise ValueError("no rows to fit")
        size = size or 1.0
        step = changepoint_range / (changepoints + 1)
        knots = tuple(step * (k + 1) for k in range(changepoints))
        bare = cls(lo, (hi - lo) or 1.0, knots, tuple(regressors), {}, {}, 0.0, seasons)
        trend_names, rest_names = ["intercept", *bare.trend_columns()], list(bare.rest_columns())
        scales = {"_holiday": holidays_prior}
        scales |= {f"_x_{c}": regressor_prior / (s or 1.0) for c, s in zip(regressors, spread)}
        prior = np.array([scales.get(c, seasonality_prior) for c in rest_names])
        facts = ["_s", "_h", *[f"_r{i}" for i in range(len(regressors))], "y"]
        rows = materialize(
            bare.with_holiday(rows).select(
                seconds("ds").alias("_s"), F.col("_is_holiday").cast("double").alias("_h"),
                *[F.col(c).alias(f"_r{i}") for i, c in enumerate(regressors)], "y",
            ).select(facts),
            "facts",
        )

        def sides(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
            """The columns of trend and rest, as ``trend_columns`` and ``rest_columns`` have them."""
            at = frame["_s"].to_numpy()
            t = (at - bare.start) / bare.length
            waves = [
                wave(at * (2 * np.pi / (period * DAY)) * k)
                for period, order in seasons.values() for k in range(1, order + 1) for wave in (np.sin, np.cos)
            ]
            known = [frame[f"_r{i}"].to_numpy() for i in range(len(regressors))]
            trend = [np.ones(len(t)), t, *[np.maximum(t - k, 0.0) for k in knots]]
            return np.stack(trend, axis=1), np.stack([frame["_h"].to_numpy(), *waves, *known], axis=1)

        trend, rest = dict.fromkeys(trend_names, 0.0), {"intercept": 0.0, **dict.fromkeys(rest_names, 0.0)}
        w, b = np.zeros(len(trend_names)), np.zeros(len(rest_names))
        for _ in range(rounds):

            def of_trend(frame: pd.DataFrame, b=b) -> np.ndarray:
                one, two = sides(frame)
                return np.c_[(1 + two @ b)[:, None] * one, frame["y"].to_numpy()]

            sums = products(rows, of_trend, len(trend_names) + 1)
            gram, right, square = sums[:-1, :-1], sums[:-1, -1] / size, sums[-1, -1] / size**2
            # the noise: what a trend without a penalty leaves, beside the rest so far
            w = np.linalg.lstsq(gram, right, rcond=1e-10)[0]
            variance = max(square - w @ right, 1e-12 * square) / n
            penalty = np.array([0.0, 0.0, *[variance / changepoint_prior] * len(knots)])
            w = lasso(gram, right, penalty)
            trend = dict(zip(trend_names, (w * size).tolist()))

            def of_rest(frame: pd.DataFrame, w=w * size) -> np.ndarray:
                one, two = sides(frame)
                base = one @ w
                return np.c_[base[:, None] * two, frame["y"].to_numpy() - base]

            sums = products(rows, of_rest, len(rest_names) + 1)
            gram, right, square = sums[:-1, :-1] / size**2, sums[:-1, -1] / size**2, sums[-1, -1] / size**2
            penalties = variance / prior**2
            b = np.linalg.solve(gram + np.diag(penalties), right)
            rest = {"intercept": 0.0, **dict(zip(rest_names, b.tolist()))}
        left = max(square - 2 * b @ right + b @ gram @ b, 0.0) / n
        changes = [abs(trend[f"_knot_{k}"]) for k in range(len(knots))]
        return cls(
            lo, bare.length, knots, tuple(regressors), trend, rest, size * left**0.5, seasons,
            float(len(knots)), float(np.mean(changes)) if changes else 0.0, tuple(penalties * size**2),
        )

    def predict(self, df: DataFrame, interval: float = INTERVAL) -> DataFrame:
        names = df.columns
        known = self.with_holiday(df)
        factor = 1 + _dot(self.rest_columns(), self.rest)
        ahead = F.greatest((seconds("ds") - F.lit(self.start)) / F.lit(self.length) - 1, F.lit(0.0))
        # Laplace changes of mean size s, r of them a unit of time: 2 s^2 r h^3 / 3 at h
        drift = F.lit(2 * self.change_size**2 * self.change_rate / 3) * ahead * ahead * ahead
        half = F.lit(normal_quantile(0.5 + interval / 2)) * F.sqrt(
            F.lit(self.residual_std**2) + drift * factor * factor
        )
        out = known.withColumns({"trend": self.trend_value(), "_half": half}).withColumn(
            "yhat", F.col("trend") * factor
        )
        return out.select(
            *names, "trend", "yhat", (F.col("yhat") - F.col("_half")).alias("yhat_lower"),
            (F.col("yhat") + F.col("_half")).alias("yhat_upper"), F.lit(interval).alias("confidence"),
        )

    def certificate(self, df: DataFrame) -> DataFrame:
        """``name, gradient``: of the ridge objective at the rest's weights, by another pass.

        A gradient is relative to the sizes of its column and of the label; all are 0 at
        the minimum.
        """
        columns = self.rest_columns()
        known = self.with_holiday(df).where("y IS NOT NULL AND ds IS NOT NULL").withColumns(
            {"_held": self.trend_value(), "_rest": _dot(columns, self.rest)}
        ).withColumn("_left", F.col("y") - F.col("_held") * (1 + F.col("_rest")))
        left, base = F.col("_left"), F.col("_held")
        sums = [
            F.struct(
                F.lit(n).alias("name"),
                (F.sum(left * base * c) - F.lit(k * self.rest[n])).alias("g"),
                (F.sqrt(F.sum(base * c * base * c)) * F.sqrt(F.sum(F.col("y") * F.col("y")))).alias("size"),
            ).alias(f"c{i}")
            for i, ((n, c), k) in enumerate(zip(columns.items(), self.penalties))
        ]
        row = known.agg(*sums)
        each = row.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(columns))])).alias("c"))
        return each.select("c.name", F.coalesce(F.try_divide("c.g", "c.size"), F.lit(0.0)).alias("gradient"))
