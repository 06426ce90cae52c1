"""The registry of named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its SQL equivalent, if it has one."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def rounded(df: DataFrame, digits: int = 6, **by_column: int) -> DataFrame:
    """Round doubles: sums taken in another order differ in their last bits."""
    return df.select(
        *[
            F.round(F.col(f"`{n}`"), by_column.get(n, digits)).alias(n) if t == "double"
            else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


def text_time(ts: str):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def text_day(ts: str):
    return F.date_format(ts, "yyyy-MM-dd")
