"""Rolling and lagged columns in trade order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide.operators.ordering import windowed
from voltide.schema import ORDER

AGGREGATES = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "max": F.max,
    "min": F.min,
    "sum": F.sum,
    "count": F.count,
}


@dataclass(frozen=True)
class Rolling:
    """``how`` of ``column`` over the last ``rows`` rows, ending ``shift`` rows back."""

    name: str
    column: str
    how: str
    rows: int
    shift: int = 0

    def over(self, window: WindowSpec) -> Column:
        first, last = -(self.rows - 1) - self.shift, -self.shift
        return AGGREGATES[self.how](self.column).over(window.rowsBetween(first, last))

    @property
    def back(self) -> int:
        return self.rows - 1 + self.shift


def rolling(
    df: DataFrame,
    specs: Sequence[Rolling],
    by: Sequence[str] = ("client_id",),
    order: Sequence[str] = ORDER,
    **limits,
) -> DataFrame:
    """Add every spec in one pass over one sort; short history uses what there is."""
    return windowed(
        df,
        lambda w: {s.name: s.over(w) for s in specs},
        back=max(s.back for s in specs),
        by=by,
        order=order,
        **limits,
    )


def mean_of_last_5(name: str = "amount_ma_5", column: str = "amount") -> list[Rolling]:
    return [Rolling(name, column, "mean", 5)]


def volume_means() -> list[Rolling]:
    return [
        Rolling(f"{prefix}_avg_{n}", column, "mean", n)
        for n in (3, 5, 7, 14)
        for prefix, column in (("volume", "daily_volume"), ("amount", "amount"))
    ]


def volume_stds() -> list[Rolling]:
    return [Rolling(f"volume_std_{n}", "daily_volume", "std", n) for n in (3, 5, 7)]


def client_amount_stats() -> list[Rolling]:
    return [
        Rolling(f"amount_{how}_{n}", "amount", how, n)
        for n in (7, 14, 30)
        for how in ("mean", "std", "max", "min")
    ]


def table_rate_stats(column: str = "closed_rate", prefix: str = "rate") -> list[Rolling]:
    return [
        Rolling(f"{prefix}_{how}_{n}", column, how, n)
        for n in (7, 14, 30)
        for how in ("mean", "std")
    ]


def volume_trend(
    df: DataFrame, column: str = "amount", name: str = "volume_trend", **limits
) -> DataFrame:
    """Mean of the last 30 rows over mean of the last 90, per client."""
    short, long = Rolling("", column, "mean", 30), Rolling("", column, "mean", 90)
    return windowed(
        df, lambda w: {name: F.try_divide(short.over(w), long.over(w))}, back=long.back, **limits
    )


def previous_mean(
    df: DataFrame, column: str = "amount", name: str = "predicted_amount", rows: int = 5, **limits
) -> DataFrame:
    """A naive prediction: the mean of the client's previous rows."""
    return rolling(df, [Rolling(name, column, "mean", rows, shift=1)], **limits)


def rolling_days(
    df: DataFrame, days: Sequence[int] = (7, 14, 30), by: Sequence[str] = ("client_id",)
) -> DataFrame:
    """Calendar-day windows over daily totals: one row per group and trading day.

    A group has at most one row per calendar day here, whatever its trade count.
    """
    daily = df.groupBy(*by, F.to_date("close_ts").alias("day")).agg(
        F.sum("amount").alias("daily_volume")
    )
    at = F.datediff("day", F.lit("1970-01-01").cast("date"))
    window = Window.partitionBy(*by).orderBy(at)
    frames = {
        f"volume_{n}d_{how}": AGGREGATES[how]("daily_volume").over(window.rangeBetween(1 - n, 0))
        for n in days
        for how in ("sum", "mean", "std")
    }
    return daily.withColumns(frames)


def rolling_days_rate(df: DataFrame, days: Sequence[int] = (7, 14, 30)) -> DataFrame:
    """Calendar-day mean and std of the daily mean rate over all clients."""
    daily = df.groupBy(F.to_date("close_ts").alias("day")).agg(
        F.avg("closed_rate").alias("daily_rate")
    )
    at = F.datediff("day", F.lit("1970-01-01").cast("date"))
    # one row per calendar day of the table
    window = Window.partitionBy(F.lit(0)).orderBy(at)
    frames = {
        f"rate_{n}d_{how}": AGGREGATES[how]("daily_rate").over(window.rangeBetween(1 - n, 0))
        for n in days
        for how in ("mean", "std")
    }
    return daily.withColumns(frames)


def daily_rate_stats(df: DataFrame) -> DataFrame:
    """Per day: trades, spread of the rate, standard deviation of the amount."""
    return df.groupBy(F.to_date("close_ts").alias("day")).agg(
        F.count(F.lit(1)).alias("trades"),
        F.stddev_samp("closed_rate").alias("rate_std"),
        (F.max("closed_rate") - F.min("closed_rate")).alias("rate_range"),
        F.stddev_samp("amount").alias("amount_std"),
    )
