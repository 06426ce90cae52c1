"""Sinks by day and run: what is written twice is there once, old days go.

A sink is a folder of ``day=.../run_id=...`` folders. A run replaces its own folders
and no others, so a job that is run again, or that died half way, leaves the same
rows; days that the run had written before and has no rows for now are removed too.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.session import folder_names, remove_path

#: Where rows without a time go; Spark's own name for it.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def replace_run(
    df: DataFrame, path: str, run: str, ts: str, day: str = "day", kind: str = "parquet"
) -> None:
    """Write the rows of ``run``, one folder per day of ``ts``."""
    if not run or not set(run) <= set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_."):
        raise ValueError(f"a run is named by letters, digits, '-', '_' and '.': {run!r}")
    spark = df.sparkSession
    df.withColumns({day: F.to_date(ts), "run_id": F.lit(run)}).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).format(kind).partitionBy(day, "run_id").save(path)
    # one name a day; a day of this run that the write has not touched is older than it
    days = [n for n in folder_names(spark, path) if f"run_id={run}" in folder_names(spark, f"{path}/{n}")]
    if not days:
        return
    kept = {
        f"{day}={r[0].isoformat() if r[0] else NO_DAY}"
        for r in df.select(F.to_date(ts).alias("d")).distinct().collect()
    }
    for name in days:
        if name not in kept:
            remove_path(spark, f"{path}/{name}/run_id={run}")


def moment(spark: SparkSession, now: Column | dt.datetime) -> dt.datetime:
    return now if isinstance(now, dt.datetime) else spark.range(1).select(now.cast("timestamp")).first()[0]


def remove_old_days(
    spark: SparkSession, path: str, now: Column | dt.datetime, days: int = 30, day: str = "day"
) -> list[str]:
    """Delete the day folders that lie wholly more than ``days`` days before ``now``."""
    oldest = moment(spark, now).date() - dt.timedelta(days=days)
    head = f"{day}="
    gone = [
        n for n in folder_names(spark, path)
        if n.startswith(head) and n[len(head):] != NO_DAY and n[len(head):] < oldest.isoformat()
    ]
    for name in gone:
        remove_path(spark, f"{path}/{name}")
    return sorted(gone)
