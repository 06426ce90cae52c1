"""Structured Streaming counterparts of daily volume, dedup, drift and alerts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from voltide.operators.evaluate import ALERT_LIMITS
from voltide.operators.monitor import RECORD, drift_columns, metric_alerts
from voltide.session import scratch_path
from voltide.sources.tables import event_trades

EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def trade_stream(spark: SparkSession, folder: str, pattern: str = "events*.parquet") -> DataFrame:
    """Event tables of a folder as a stream of trades; a table is a file or a folder of files."""
    events = spark.readStream.schema(EVENT).parquet(f"{folder}/{pattern}")
    return event_trades(events)


def metric_stream(spark: SparkSession, folder: str, pretty: bool = False) -> DataFrame:
    return spark.readStream.schema(RECORD).option("multiLine", pretty).json(folder)


# ---- transformations, all usable on batch frames too


def alert_stream(records: DataFrame, limits=ALERT_LIMITS) -> DataFrame:
    return metric_alerts(records, limits)


def daily_volume_stream(trades: DataFrame, late: str = "2 days") -> DataFrame:
    """Volume per client and day; rows later than ``late`` are dropped."""
    return (
        trades.withWatermark("close_ts", late)
        .groupBy(F.window("close_ts", "1 day").alias("w"), "client_id")
        .agg(F.sum("amount").alias("daily_volume"), F.count(F.lit(1)).alias("trades"))
        .select(F.col("w.start").alias("day_start"), "client_id", "daily_volume", "trades")
    )


def dedup_stream(trades: DataFrame, key: Sequence[str] = ("op_id",), late: str = "2 days"):
    return trades.withWatermark("close_ts", late).dropDuplicatesWithinWatermark(list(key))


def drift_stream(
    trades: DataFrame,
    training: DataFrame,
    feature: str = "amount",
    window: str = "1 day",
    late: str = "2 days",
    limit: float = ALERT_LIMITS["drift"],
) -> DataFrame:
    """Drift of each window against stored training statistics (one row per feature)."""
    current = (
        trades.withWatermark("close_ts", late)
        .groupBy(F.window("close_ts", window).alias("w"))
        .agg(
            F.avg(feature).alias("current_mean"),
            F.stddev_samp(feature).alias("current_std"),
            F.count(feature).alias("rows"),
        )
        .select(F.col("w.start").alias("window_start"), F.lit(feature).alias("feature"),
                "current_mean", "current_std", "rows")
    )
    base = training.select(
        "feature", F.col("mean").alias("train_mean"), F.col("std").alias("train_std")
    )
    return current.join(F.broadcast(base), "feature").withColumns(drift_columns(limit=limit))


# ---- sinks


def append_to(
    stream: DataFrame, path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Closed rows to a Parquet folder."""
    writer = stream.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def upsert_to(
    stream: DataFrame, path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Changed groups of each batch to a folder of their own.

    A batch that runs twice replaces its folder, so the table stays exact.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest version of every group that ``upsert_to`` wrote."""
    return newest_of(spark.read.parquet(path), keys)


def newest_of(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in table.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*values), "batch_id").alias("v")
    return table.groupBy(*keys).agg(newest).select(*keys, "v.*")


def run_to_table(
    spark: SparkSession,
    stream: DataFrame,
    sink: Callable[..., StreamingQuery],
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Process what is there, then return the sink as a batch table."""
    path = scratch_path(spark, "stream-out")
    sink(stream, path, scratch_path(spark, "stream-state")).awaitTermination()
    schema = T.StructType(
        [*stream.schema.fields, *([T.StructField("batch_id", T.LongType())] if keys else [])]
    )
    try:
        table = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], schema)  # no row ever came
    return newest_of(table, keys) if keys else table
