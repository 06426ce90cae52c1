"""File sources and sinks: CSV, multi-file batches, JSON records, lists."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltide.operators.monitor import RECORD, keep_recent
from voltide.schema import missing_columns
from voltide.sources.by_name import read_csv_by_name
from voltide.sources.sinks import remove_old_days, replace_run


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with one header line and declared types, columns in any order.

    A bad value fails the job, a file without one of the columns is an error, further
    columns are left out.
    """
    return read_csv_by_name(spark, path, schema, extra=False, missing=False)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_table(df: DataFrame, path: str, month_of: str | None = None) -> None:
    """Parquet, split by month of ``month_of`` if given."""
    if month_of is None:
        df.write.mode("overwrite").parquet(path)
        return
    df.withColumn("month_of", F.date_format(month_of, "yyyy-MM")).write.mode(
        "overwrite"
    ).partitionBy("month_of").parquet(path)


def export_names(spark: SparkSession, path: str) -> list[str]:
    """Column names of an export: its second line."""
    line = spark.read.text(path).head(2)[1][0]
    return [n or f"Unnamed: {i}" for i, n in enumerate(next(csv.reader([line])))]


def read_two_header_export(
    spark: SparkSession, path: str, names: Sequence[str] | None = None
) -> DataFrame:
    """An export with a junk first line and the column names in the second.

    Columns stay text, to be cast later. The reader skips the first line of
    every file; the row of names is dropped wherever a split starts.
    """
    names = list(names or export_names(spark, path))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = spark.read.schema(schema).option("header", True).csv(path)
    is_label = F.lit(True)
    for n in names:
        if not n.startswith("Unnamed"):
            is_label = is_label & F.col(f"`{n}`").eqNullSafe(F.lit(n))
    return rows.where(~is_label)


def write_two_header_export(df: DataFrame, path: str, junk: str = "OPES") -> None:
    """The same layout: every file gets a junk line, the first one the row of names."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    labels = text.sparkSession.createDataFrame([tuple(df.columns)], text.schema)
    headed = labels.coalesce(1).union(text)
    first, rest = df.columns[0], df.columns[1:]
    headed.select(
        F.col(f"`{first}`").alias(junk), *[F.col(f"`{c}`").alias(f"_{c}") for c in rest]
    ).write.option("header", True).csv(path)


def read_prediction_files(spark: SparkSession, pattern: str, schema=None) -> DataFrame:
    """All prediction files of a pattern, by column name, with the file each row came from."""
    return read_csv_by_name(spark, pattern, schema, file_name="file_name")


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """Rows of all batches; columns a batch lacks are null."""
    if not batches:
        raise ValueError("no batches to read")
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def append_predictions(
    df: DataFrame, path: str, run: str, ts: str = "prediction_timestamp"
) -> None:
    """Add the scored rows of a run to the prediction table; the same run replaces its own."""
    replace_run(df, path, run, ts, day="prediction_date")


def write_metric_records(records: DataFrame, path: str, run: str) -> None:
    """Add the metric records of a run as JSON; the same run replaces its own."""
    replace_run(records, path, run, "timestamp", kind="json")


def read_metric_records(spark: SparkSession, path: str, pretty: bool = False) -> DataFrame:
    """Metric records, one object per line, or ``pretty`` with one object per file."""
    return spark.read.schema(RECORD).option("multiLine", pretty).json(path).select(*RECORD.names)


def metric_record(
    spark: SparkSession,
    timestamp,
    metrics: Mapping[str, float | int | bool],
    drift: Mapping[str, Mapping[str, float | int | bool]],
) -> DataFrame:
    """One metric record; flags become 0 and 1."""
    values = {k: float(v) for k, v in metrics.items()}
    drifts = {
        f: (
            None if d.get("mean_drift") is None else float(d["mean_drift"]),
            None if d.get("std_drift") is None else float(d["std_drift"]),
            int(d["has_drift"]),
        )
        for f, d in drift.items()
    }
    return spark.createDataFrame([(timestamp, values, drifts)], RECORD)


def write_report(report: DataFrame, path: str) -> None:
    """A report as JSON lines in one file; a report has few rows, whatever it is made from."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_feature_list(spark: SparkSession, path: str) -> DataFrame:
    """One feature name per line."""
    return spark.read.text(path).select(F.trim("value").alias("feature")).where("feature != ''")


def read_importance(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, "feature string, importance double")


EVENT_COLUMNS = ("timestamp", "event_type", "status", "details")


def append_audit_events(
    events: DataFrame, path: str, run: str, now: Column | None = None, days: int = 30
) -> None:
    """Audit events of a run as JSON lines; the same run replaces its own.

    With ``now``, days more than ``days`` days before it are deleted.
    """
    gone = missing_columns(events, EVENT_COLUMNS)
    if gone:
        raise ValueError(f"audit events lack {gone}")
    replace_run(events, path, run, "timestamp", kind="json")
    if now is not None:
        remove_old_days(events.sparkSession, path, now, days)


def read_audit_events(spark: SparkSession, path: str, now: Column, days: int = 30) -> DataFrame:
    """Audit events of the last days; older folders are not read."""
    schema = "timestamp timestamp, event_type string, status string, details string, day date, run_id string"
    events = spark.read.schema(schema).json(path)
    oldest = F.to_date(now - F.make_dt_interval(F.lit(days)))
    return keep_recent(events.where(F.col("day") >= oldest), now, days).drop("day", "run_id")
