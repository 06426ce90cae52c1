"""Ridge regression validated in time order: every month by a model of the months before.

All expanding-window fits come from one pass over the rows. A month is reduced to its
sums of products, which are combined before the shuffle; running sums over the months
are the normal equations of every fold. The fitted weights, a row per month and horizon,
are joined back to score the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide.operators.split import month_index
from voltide.session import materialize

WEIGHTS = "fold int, train_until int, train_rows long, intercept double, weights array<double>"


def month_products(df: DataFrame, features: Sequence[str], label: str, ts: str = "close_ts") -> DataFrame:
    """``month_index, rows, sums, products`` of rows without missing values, less ``shift``.

    ``sums`` and ``products`` are over the features and then the label; ``products`` lists
    the pairs of ``combinations_with_replacement``.
    """
    names = [*features, label]
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    values = [F.col(f"_x{i}") for i in range(len(names))]
    known = df.select(month_index(ts), *[F.col(n).cast("double").alias(f"_x{i}") for i, n in enumerate(names)]).dropna()
    return known.groupBy("month_index").agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(*[F.sum(v) for v in values]).alias("sums"),
        F.array(*[F.sum(values[i] * values[j]) for i, j in pairs]).alias("products"),
    )


def solve(rows: int, sums: np.ndarray, products: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Intercept and weights of the ridge regression with these sums.

    The penalty is a share of each feature's own variance, so units do not matter. A
    feature that does not vary has no weight.
    """
    d = len(sums)
    whole = np.zeros((d, d))
    whole[np.triu_indices(d)] = products
    whole = whole + np.triu(whole, 1).T
    spread = whole - np.outer(sums, sums) / rows
    own = np.diag(spread)[:-1]
    varies = own > 1e-12 * np.diag(whole)[:-1]
    left = spread[:-1, :-1] + penalty * np.diag(own)
    weights = np.zeros(d - 1)
    if varies.any():
        keep = np.ix_(varies, varies)
        scale = np.sqrt(own[varies])
        # in units of the features' own spread the system is well conditioned
        weights[varies] = np.linalg.lstsq(
            left[keep] / np.outer(scale, scale), spread[:-1, -1][varies] / scale, rcond=1e-12
        )[0] / scale
    return float((sums[-1] - weights @ sums[:-1]) / rows), weights


def expanding_fits(months: DataFrame, penalty: float) -> DataFrame:
    """A model per month, fitted to all months before it: see ``WEIGHTS``.

    ``fold`` counts the months from the first that has one before it.
    """
    # one row per calendar month
    before = Window.partitionBy(F.lit(0)).orderBy("month_index").rowsBetween(Window.unboundedPreceding, -1)
    width = {c: len(months.first()[c]) if not months.isEmpty() else 0 for c in ("sums", "products")}
    running = months.select(
        F.col("month_index").alias("train_until"),
        (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("month_index")) - 2).alias("fold"),
        F.sum("rows").over(before).alias("rows"),
        *[F.array(*[F.sum(F.col(c)[i]).over(before) for i in range(n)]).alias(c) for c, n in width.items()],
    ).where("rows is not null")

    def fitted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                intercept, weights = solve(r.rows, np.array(r.sums), np.array(r.products), penalty)
                out.append((r.fold, r.train_until - 1, r.rows, intercept, weights.tolist()))
            yield pd.DataFrame(out, columns=["fold", "train_until", "train_rows", "intercept", "weights"])

    return running.mapInPandas(fitted, WEIGHTS)


def validate_in_time(
    df: DataFrame,
    features: Sequence[str],
    label: str = "amount",
    ts: str = "close_ts",
    penalty: float = 0.01,
    horizons: int = 3,
) -> DataFrame:
    """``fold, horizon, train_rows, n, rmse, mae``: the error of each month's model in the
    month after its training rows (horizon 1) and in those after that.

    Rows with a missing value are left out; so are months without rows to predict.
    """
    rows = materialize(df.select(ts, label, *features), "in-time")
    fits = materialize(expanding_fits(materialize(month_products(rows, features, label, ts), "months"), penalty), "fits")
    ahead = F.explode(F.sequence(F.lit(1), F.lit(horizons)))
    models = fits.withColumn("horizon", ahead).withColumn("_month", F.col("train_until") + F.col("horizon"))
    known = rows.dropna(subset=[label, *features]).withColumn("_month", month_index(ts))
    predicted = F.col("intercept")
    for i, f in enumerate(features):
        predicted = predicted + F.col("weights")[i] * F.col(f)
    error = F.col(label) - predicted
    return (
        known.join(models, "_month")
        .groupBy("fold", "horizon", "train_rows")
        .agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"))
    )
