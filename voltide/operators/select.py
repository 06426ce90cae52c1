"""Feature scores, rankings and the selected matrix."""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide.operators.clean import impute_median
from voltide.operators.quantiles import quantiles
from voltide.operators.scale import StandardScale
from voltide.operators.stats import correlation
from voltide.schema import numeric_columns

Score = Callable[[Column, Column], Column]

# Calendar and key columns that say nothing about an amount by themselves.
UNRANKED = (
    "op_id", "client_id", "epoch_seconds", "year", "month", "day", "weekday", "quarter",
    "usd_at_closed_rate", "usd_at_pool_rate",
)


def candidate_features(df: DataFrame, target: str = "amount", exclude=UNRANKED) -> list[str]:
    return numeric_columns(df, (*exclude, target))


def f_regression(x: Column, y: Column) -> Column:
    """F statistic of the univariate linear regression of y on x.

    A column that does not vary scores 0, a perfect one the largest double.
    """
    both = x.isNotNull() & y.isNotNull()
    r2 = F.coalesce(F.pow(correlation(x, y), 2), F.lit(0.0))
    score = F.try_divide(r2 * F.greatest(F.count_if(both) - 2, F.lit(0)), 1 - r2)
    return F.coalesce(score, F.lit(sys.float_info.max))


def score_features(
    df: DataFrame, features: Sequence[str], target: str = "amount", score: Score = f_regression
) -> DataFrame:
    """``score(feature, target)`` of every feature from one aggregate."""
    y = F.col(target).cast("double")
    row = df.agg(*[score(F.col(c).cast("double"), y).alias(f"{i}") for i, c in enumerate(features)])
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.col(f"{i}").alias("score"))
        for i, c in enumerate(features)
    ]
    return row.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def mutual_information(
    df: DataFrame, features: Sequence[str], target: str = "amount", bins: int = 16, **limits
) -> DataFrame:
    """Plug-in mutual information (nats) over equal-frequency bins.

    Rows collapse to at most bins * bins counts per feature before the shuffle.
    """
    grid = [i / bins for i in range(1, bins)]
    edges = quantiles(df, [*features, target], grid, **limits)

    def place(c: str) -> Column:
        x = F.col(c).cast("double")
        above = [(x > F.lit(e)).cast("int") for e in edges[c] if e is not None]
        return reduce(add, above, F.lit(0))

    pairs = F.array(
        *[
            F.when(
                F.col(c).isNotNull() & F.col(target).isNotNull(),
                F.struct(F.lit(c).alias("feature"), place(c).alias("a"), place(target).alias("b")),
            )
            for c in features
        ]
    )
    cells = (
        df.select(F.explode(F.array_compact(pairs)).alias("p"))
        .groupBy("p.feature", "p.a", "p.b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    of = Window.partitionBy("feature")
    total = F.sum("n").over(of)
    of_a = F.sum("n").over(Window.partitionBy("feature", "a"))
    of_b = F.sum("n").over(Window.partitionBy("feature", "b"))
    terms = cells.withColumns({"total": total, "na": of_a, "nb": of_b})
    return terms.groupBy("feature").agg(
        F.sum(
            F.col("n") / F.col("total")
            * F.log(F.col("n").cast("double") * F.col("total") / (F.col("na") * F.col("nb")))
        ).alias("score")
    )


def rank_features(
    df: DataFrame, features: Sequence[str], target: str = "amount", bins: int = 16, **limits
) -> DataFrame:
    """F and mutual-information scores, their mean, and the mean of their ranks."""
    f = score_features(df, features, target).withColumnRenamed("score", "score_f")
    mi = mutual_information(df, features, target, bins, **limits)
    both = f.join(mi.withColumnRenamed("score", "score_mi"), "feature")
    # one row per feature
    by_f = F.rank().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("score_f")))
    by_mi = F.rank().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("score_mi")))
    return both.withColumns(
        {
            "score_mean": (F.col("score_f") + F.col("score_mi")) / 2,
            "rank_mean": (by_f + by_mi) / 2,
        }
    ).orderBy(F.desc("score_mean"), "feature")


def top_features(scores: DataFrame, k: int, score: str = "score") -> DataFrame:
    return scores.orderBy(F.desc_nulls_last(score), "feature").limit(k)


def feature_names(scores: DataFrame, k: int, score: str = "score") -> list[str]:
    return [r["feature"] for r in top_features(scores, k, score).collect()]


def selected_matrix(
    df: DataFrame,
    features: Sequence[str],
    k: int = 20,
    target: str = "amount",
    keys: Sequence[str] = ("op_id",),
    **limits,
) -> tuple[DataFrame, DataFrame]:
    """The k best features, imputed and scaled, with the target; and the report.

    Scores do not change under scaling, so only chosen columns are scaled.
    """
    filled = impute_median(df.select(*keys, target, *features), features, **limits)
    scores = score_features(filled, features, target)
    chosen = feature_names(scores, k)
    scaled = StandardScale.fit(filled, chosen).transform(filled)
    report = scores.withColumns(
        {
            "selected": F.col("feature").isin(chosen),
            "features_before": F.lit(len(features)),
        }
    )
    return scaled.select(*keys, *chosen, target), report
