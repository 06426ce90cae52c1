"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.session import materialize, scratch_path

__all__ = ["materialize", "scratch_path", "table", "text_or_empty", "words_of",
           "as_text", "with_type", "shuffle_parts", "freed_shuffles"]

#: Characters that separate words: [\x20\x09-\x0D]. ``bytes.split()`` uses the same set.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z in lower case."""
    return text.encode().lower().split()


def as_text(column: str):
    """An id for Python workers: pandas turns whole numbers beside a null into doubles."""
    return F.col(column).cast("string").alias(column)


def with_type(df: DataFrame, column: str, kind: str) -> DataFrame:
    """The id as it was."""
    return df if kind == "string" else df.withColumn(column, F.col(column).cast(kind))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside leave no shuffle files, which else stay until the driver collects
    its garbage. For frames that are run once, as by ``materialize``."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
