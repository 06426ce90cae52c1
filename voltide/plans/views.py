"""Views that several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.functions.errors import error_columns
from voltide.operators.monitor import daily_metric_records
from voltide.operators.split import temporal_split
from voltide.operators.windows import previous_mean
from voltide.sources.tables import trades_from_events, trades_from_orders


def naive_scores(trades: DataFrame) -> DataFrame:
    """Trades with a naive prediction; a client's first trade has none and drops out."""
    return previous_mean(trades).where(F.col("predicted_amount").isNotNull())


def scored_orders(spark, sf, columns=("op_id", "client_id", "close_ts", "amount")) -> DataFrame:
    return naive_scores(trades_from_orders(spark, sf, list(columns)))


def scored_events(spark, sf) -> DataFrame:
    columns = ("op_id", "client_id", "close_ts", "amount")
    return naive_scores(trades_from_events(spark, sf).select(*columns))


def event_errors(spark, sf) -> DataFrame:
    return scored_events(spark, sf).withColumns(error_columns())


def train_and_current(trades: DataFrame) -> tuple[DataFrame, DataFrame]:
    marked = temporal_split(trades)
    return marked.where("split = 'train'"), marked.where("split = 'test'")


def event_metric_records(spark, sf) -> DataFrame:
    """One metric record per day of scored events; drift against the first 80 %."""
    trades = trades_from_events(spark, sf).select("op_id", "client_id", "close_ts", "amount")
    train, _ = train_and_current(trades)
    return daily_metric_records(naive_scores(trades), train)
