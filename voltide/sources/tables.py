"""Trade views over the order, line and event tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.session import materialize

MARKET = ("spread", "closed_rate")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades_from_orders(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One trade per order.

    ``columns`` names the columns wanted; a join that feeds none of them is
    left out of the plan. Orders without lines keep a null spread and rate.
    """
    wanted = set(columns) if columns else None
    o = read_table(spark, sf_dir, "orders")
    df = o.select(
        F.col("o_orderkey").alias("op_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderdate").cast("timestamp").alias("close_ts"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("product"),
        F.when(F.col("o_orderstatus") == "F", "buy")
        .when(F.col("o_orderstatus") == "O", "sell")
        .alias("op_type"),
    )
    if wanted is None or "category" in wanted:
        customers = read_table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("client_id"), F.col("c_mktsegment").alias("category")
        )
        df = df.join(customers, "client_id", "left")
    if wanted is None or wanted.intersection(MARKET):
        lines = (
            read_table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("op_id"))
            .agg(
                F.round(F.avg("l_discount"), 6).alias("spread"),
                F.round(1 + F.avg("l_tax"), 6).alias("closed_rate"),
            )
        )
        df = df.join(lines, "op_id", "left")
    names = columns or (
        "op_id", "client_id", "close_ts", "amount", "category", "product",
        "op_type", "spread", "closed_rate",
    )
    return df.select(*names)


def stored_trades(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """``trades_from_orders`` written once, for operators that read it several times."""
    return materialize(trades_from_orders(spark, sf_dir, columns), "trades")


def trades_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trade per event."""
    return event_trades(read_table(spark, sf_dir, "events"))


def event_trades(events: DataFrame) -> DataFrame:
    """Map event rows, batch or stream, to trades."""
    return events.select(
        F.col("event_id").alias("op_id"),
        F.col("user_id").alias("client_id"),
        F.col("ts").cast("timestamp").alias("close_ts"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("category"),
        F.when(F.col("event_type") == "purchase", "buy")
        .when(F.col("event_type") == "click", "sell")
        .alias("op_type"),
    )
