"""The three feature chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.functions import ratios
from voltide.functions.calendar import calendar, cyclic, days_since_start
from voltide.operators.clean import impute_median
from voltide.operators.encode import OneHotVectors, category_codes, one_hot
from voltide.operators.ordering import windowed
from voltide.operators.scale import StandardScale
from voltide.operators.skew import GROUP_ROWS, GroupSizes, group_sizes
from voltide.operators.stats import with_client_stats, with_group_stats
from voltide.operators.windows import (
    Rolling,
    client_amount_stats,
    rolling,
    table_rate_stats,
    volume_means,
    volume_stds,
)
from voltide.schema import CATEGORICAL_COLUMNS, numeric_columns
from voltide.session import materialize


def pick(columns: dict, *names: str) -> dict:
    return {n: columns[n] for n in names}


def volume_features(df: DataFrame, sizes: GroupSizes | None = None) -> DataFrame:
    """Volume ratios and all rolling volume columns over one sort."""
    return rolling(
        df.withColumns(ratios.volume_ratios()), volume_means() + volume_stds(), sizes=sizes
    )


def statistical_features(
    df: DataFrame, sizes: GroupSizes | None = None, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Per-client spread, extremes, medians and count, and the volume trend."""
    sizes = sizes or group_sizes(df, ["client_id"], group_rows)
    short, long = Rolling("", "amount", "mean", 30), Rolling("", "amount", "mean", 90)
    df = windowed(
        df,
        lambda w: {"volume_trend": F.try_divide(short.over(w), long.over(w))},
        back=long.back,
        sizes=sizes,
    )
    return with_group_stats(
        df,
        ["client_id"],
        {
            "amount_std": F.stddev_samp("amount"),
            "amount_max": F.max("amount"),
            "amount_min": F.min("amount"),
            "spread_std": F.stddev_samp("spread"),
            "spread_max": F.max("spread"),
            "spread_min": F.min("spread"),
            "client_trades": F.count("amount"),
        },
        {"amount_median": "amount", "spread_median": "spread"},
        sizes=sizes,
        group_rows=group_rows,
    )


def ratio_features(df: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Ratios with missing values filled by the ratio's median."""
    new = ratios.trend_ratios()
    return impute_median(df.withColumns(new), list(new), group_rows=group_rows)


def features_g1a(
    df: DataFrame, group_rows: int = GROUP_ROWS, scale: bool = True
) -> tuple[DataFrame, StandardScale | None]:
    """Calendar, volume and client features, then standard scaling."""
    sizes = group_sizes(df, ["client_id"], group_rows)
    parts = pick(
        calendar(), "year", "month", "day", "weekday", "quarter",
        "is_weekend", "is_month_start", "is_month_end",
    )
    # codes and client statistics come from the input, before it is windowed
    df = category_codes(with_client_stats(df), "category")
    df = volume_features(df.withColumns(parts).withColumns(cyclic()), sizes)
    if not scale:
        return df, None
    df = materialize(df, "features")
    fitted = StandardScale.fit(df, numeric_columns(df))
    return fitted.transform(df), fitted


def features_g1b(df: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Calendar, per-client statistics and ratio features."""
    parts = pick(
        calendar(), "year", "month", "day", "weekday", "quarter",
        "is_last_day", "is_weekend", "epoch_seconds",
    )
    df = df.withColumns(parts).withColumns(cyclic())
    df = materialize(statistical_features(df, group_rows=group_rows), "statistics")
    return ratio_features(df, group_rows)


def features_g2(
    df: DataFrame, group_rows: int = GROUP_ROWS, vectors: OneHotVectors | None = None
) -> DataFrame:
    """Calendar, rolling, one-hot and interaction features.

    Categories become a 0/1 column per value, or with ``vectors`` one sparse vector, for
    columns of many values.
    """
    parts = pick(
        calendar(), "year", "month", "day", "weekday", "day_name",
        "is_weekend", "is_month_start", "is_month_end",
    )
    # levels and the first date come from the input, before it is windowed
    df = days_since_start(df)
    df = vectors.transform(df) if vectors else one_hot(df, CATEGORICAL_COLUMNS)
    df = df.withColumns(parts)
    df = rolling(df, client_amount_stats(), group_rows=group_rows)
    df = rolling(df, table_rate_stats(), by=())
    return df.withColumns(ratios.rate_interactions())


def feature_report(df: DataFrame) -> DataFrame:
    """Column totals by kind and the columns of each feature family."""
    kinds = dict(df.dtypes)
    numeric = numeric_columns(df, ())
    # Name parts that mark a feature family.
    families = {
        "time": ("year", "month", "day", "week", "quarter"),
        "rolling": ("_mean_", "_std_", "_max_", "_min_", "_ma_"),
        "categorical": tuple(f"{c}_" for c in CATEGORICAL_COLUMNS),
        "interaction": ("_x_", "signed_", "_ratio"),
    }
    rows = [("total", len(df.columns), list(df.columns))]
    rows.append(("numeric", len(numeric), numeric))
    for kind, test in (("text", "string"), ("datetime", "timestamp")):
        names = [c for c, t in kinds.items() if t.startswith(test)]
        rows.append((kind, len(names), names))
    for family, marks in families.items():
        names = [c for c in df.columns if any(m in c for m in marks)]
        rows.append((family, len(names), names))
    return df.sparkSession.createDataFrame(
        rows, "section string, total int, columns array<string>"
    )
