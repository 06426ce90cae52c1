"""Train and test splits that do not depend on how rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide.operators.ordering import with_row_index
from voltide.operators.quantiles import quantiles
from voltide.schema import ORDER


def id_bucket(buckets: int, key: str = "op_id") -> Column:
    """A fixed pseudo-random bucket per id, from the id's digest; no id is one id."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    number = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(buckets)).cast("int")


def hash_split(df: DataFrame, test_share: float = 0.2, key: str = "op_id") -> DataFrame:
    train = id_bucket(100, key) < round((1 - test_share) * 100)
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def cv_folds(df: DataFrame, folds: int = 5, key: str = "op_id") -> DataFrame:
    return df.withColumn("fold", id_bucket(folds, key))


def temporal_cut(df: DataFrame, share: float = 0.8, ts: str = "close_ts", **limits) -> float:
    """The ``share`` quantile of the dates, in microseconds since 1970."""
    at = df.select(F.unix_micros(ts).cast("double").alias("at"))
    return quantiles(at, ["at"], [share], **limits)["at"][0]


def temporal_split(
    df: DataFrame, share: float = 0.8, ts: str = "close_ts", **limits
) -> DataFrame:
    """Rows up to the date quantile train, later rows test."""
    cut = temporal_cut(df, share, ts, **limits)
    train = F.unix_micros(ts) <= F.lit(cut)
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def split_report(marked: DataFrame, ts: str = "close_ts") -> DataFrame:
    """Rows, share and date range of each part of a split."""
    parts = marked.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    # one row per part
    return parts.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy(F.lit(0))))


def positional_split(
    df: DataFrame, share: float = 0.8, order: Sequence[str] = ORDER
) -> DataFrame:
    """The first ``share`` of the rows in order train, the rest test."""
    indexed = with_row_index(df, order)
    size = int(df.count() * share)
    return indexed.withColumn(
        "split", F.when(F.col("row_index") < size, "train").otherwise("test")
    )


def month_index(ts: str = "close_ts") -> Column:
    return (F.year(ts) * 12 + F.month(ts) - 1).alias("month_index")


def temporal_folds(df: DataFrame, ts: str = "close_ts") -> DataFrame:
    """Expanding-window folds: each month is tested on all months before it."""
    months = df.groupBy(month_index(ts)).agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.min(ts).alias("test_start"),
        F.max(ts).alias("test_end"),
    )
    # one row per calendar month
    ordered = Window.partitionBy(F.lit(0)).orderBy("month_index")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return (
        months.withColumns(
            {
                "fold": F.row_number().over(ordered) - 1,
                "train_rows": F.sum("test_rows").over(earlier),
            }
        )
        .where("train_rows is not null")
    )
