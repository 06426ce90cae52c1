"""The performance report of a scored table in long form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.functions.errors import error_columns
from voltide.operators import evaluate as ev
from voltide.schema import numeric_columns
from voltide.session import materialize


def _long(df: DataFrame, section: str, key=None) -> DataFrame:
    """Numeric columns of ``df`` as (section, name, value) rows."""
    names = [c for c in df.columns if key is None or c != key]
    pairs = [
        F.struct(
            (F.lit(c) if key is None else F.concat_ws(".", key, F.lit(c))).alias("name"),
            F.col(c).cast("double").alias("value"),
        )
        for c in names
    ]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select(
        F.lit(section).alias("section"), "p.name", "p.value"
    )


def performance_report(scored: DataFrame, ts: str = "prediction_timestamp") -> DataFrame:
    """Summary, error distribution, error by range, autocorrelation, correlations.

    The scored rows are read by seven passes, so they are written once.
    """
    features = [c for c in numeric_columns(scored) if c not in ("error", "abs_error")]
    scored = materialize(scored, "scored")
    errors = scored.withColumns(error_columns())
    summary = ev.prediction_summary(scored, ts)
    summary = summary.withColumns(
        {c: F.unix_seconds(c) for c in ("first_prediction", "last_prediction")}
    )
    acf = ev.autocorrelation(errors)
    correlation = ev.feature_error_correlation(scored, features)
    parts = [
        _long(summary, "data_summary"),
        _long(ev.error_moments(errors, store=False).drop("n"), "error_distribution"),
        _long(
            ev.error_by_quintile(scored, store=False).select("bin", "mean", "std", "count"),
            "error_by_range",
            "bin",
        ),
        acf.select(
            F.lit("autocorrelation").alias("section"),
            F.concat(F.lit("lag_"), "lag").alias("name"),
            F.col("acf").alias("value"),
        ),
        correlation.select(
            F.lit("error_correlation").alias("section"),
            F.col("feature").alias("name"),
            F.col("correlation").alias("value"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
