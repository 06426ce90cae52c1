"""Column statistics taken in one pass and returned as plain numbers or rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltide.operators.quantiles import grouped_quantiles, quantiles
from voltide.schema import numeric_columns
from voltide.session import materialize

ONE_VALUE = {
    "count": F.count,
    "mean": F.avg,
    "std": F.stddev_samp,
    "std_pop": F.stddev_pop,
    "min": F.min,
    "max": F.max,
    "nulls": lambda c: F.count_if(F.col(c).isNull()),
}


def collect_stats(
    df: DataFrame, columns: Sequence[str], wanted: Sequence[str]
) -> dict[str, dict[str, float | int | None]]:
    """``{column: {statistic: value}}`` for all columns from one aggregate."""
    aggs = [
        ONE_VALUE[s](c).alias(f"{i}_{s}") for i, c in enumerate(columns) for s in wanted
    ]
    row = df.agg(*aggs).first()
    return {c: {s: row[f"{i}_{s}"] for s in wanted} for i, c in enumerate(columns)}


def _stack(df: DataFrame, names: Sequence[str], fields: dict[str, list[Column]]) -> DataFrame:
    """One row holding all aggregates -> one row per column name."""
    rows = [
        F.struct(F.lit(n).alias("column_name"), *[v[i].alias(k) for k, v in fields.items()])
        for i, n in enumerate(names)
    ]
    return df.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _one_pass(df: DataFrame, columns: Sequence[str], wanted: dict) -> DataFrame:
    aggs = [fn(c).alias(f"{i}_{k}") for i, c in enumerate(columns) for k, fn in wanted.items()]
    fields = {k: [F.col(f"{i}_{k}") for i in range(len(columns))] for k in wanted}
    return _stack(df.agg(*aggs), columns, fields)


def column_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean, sample std and null count of each numeric column."""
    names = columns or numeric_columns(df)
    return _one_pass(
        df, names, {"mean": F.avg, "std": F.stddev_samp, "nulls": ONE_VALUE["nulls"]}
    )


def describe_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, quartiles and max of each column."""
    quartiles = quantiles(df, columns, [0.25, 0.5, 0.75])
    base = _one_pass(
        df.select(*[F.col(c).cast("double").alias(c) for c in columns]),
        columns,
        {k: ONE_VALUE[k] for k in ("count", "mean", "std", "min", "max")},
    )

    def of(i: int) -> Column:
        cases = [x for c in columns for x in (F.lit(c), F.lit(quartiles[c][i]).cast("double"))]
        return F.element_at(F.create_map(*cases), F.col("column_name"))

    return base.withColumns({"p25": of(0), "p50": of(1), "p75": of(2)})


def value_text(df: DataFrame, column: str) -> Column:
    """A column's value as text that differs if the values differ; null if it is null."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (c + F.lit(0).cast(kind)).cast("string")  # -0.0 is 0.0
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")  # local times may come twice
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c)))
    return c.cast("string")


def data_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column: type, rows, nulls, distinct non-null values, from one pass over the rows.

    Exact counts turn rows into (column, value) pairs that are counted before the
    shuffle, so what moves is each task's different values; pairs meet by hash, so a
    column of any number of values is spread over all tasks. ``approximate`` moves one
    sketch a column instead.
    """
    names = df.columns
    if approximate:
        wanted = {"rows": lambda c: F.count(F.lit(1)), "nulls": ONE_VALUE["nulls"],
                  "distinct_values": F.approx_count_distinct}
        out = _one_pass(df, names, wanted)
    else:
        pairs = [F.struct(F.lit(i).alias("i"), value_text(df, c).alias("v")) for i, c in enumerate(names)]
        counted = (
            df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").groupBy("i", "v")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        found = counted.groupBy("i").agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("v").alias("distinct_values"),
        )
        # one row per column; an empty table has no pairs
        every = df.sparkSession.createDataFrame(list(enumerate(names)), "i int, column_name string")
        out = every.join(found, "i", "left").drop("i").na.fill(0, ["rows", "nulls", "distinct_values"])
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return out.withColumn("data_type", F.element_at(types, F.col("column_name")))


def profile_issues(df: DataFrame, required: Sequence[str] = ("amount", "close_ts")) -> list[str]:
    return [f"column '{c}' not found" for c in required if c not in df.columns]


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations in long form, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[_corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        value = F.col(f"{i}").alias("correlation")
        cells.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), value))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("feature_a"), F.lit(a).alias("feature_b"), value))
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def _corr(a: str, b: str) -> Column:
    return correlation(F.col(a).cast("double"), F.col(b).cast("double"))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation of complete pairs; null if either does not vary."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    r = F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
    # rounding may lead past 1
    return F.when(r > 1, 1.0).when(r < -1, -1.0).otherwise(r)


def correlations_with(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with ``target``."""
    row = df.agg(*[_corr(c, target).alias(f"{i}") for i, c in enumerate(columns)])
    fields = {"correlation": [F.col(f"{i}") for i in range(len(columns))]}
    return _stack(row, columns, fields).withColumnRenamed("column_name", "feature")


def mad(df: DataFrame, column: str, **limits) -> tuple[float | None, float | None]:
    """Median and median absolute deviation (unscaled)."""
    median = quantiles(df, [column], [0.5], **limits)[column][0]
    if median is None:
        return None, None
    off = df.select(F.abs(F.col(column) - F.lit(median)).alias("off"))
    return median, quantiles(off, ["off"], [0.5], **limits)["off"][0]


def iqr_fences(
    df: DataFrame, columns: Sequence[str], factor: float = 1.5, **limits
) -> dict[str, tuple[float, float] | None]:
    """``(Q1 - factor*IQR, Q3 + factor*IQR)`` per column; None if it has no values."""
    found = quantiles(df, columns, [0.25, 0.75], **limits)
    return {
        c: None if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
        for c, (q1, q3) in found.items()
    }


def client_stats(df: DataFrame, by: str = "client_id") -> DataFrame:
    """Wide per-client statistics of volume, amount and spread."""
    full = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}
    aggs = [
        fn(column).alias(f"client_{name}_{how}")
        for name, column, chosen in (
            ("volume", "daily_volume", full),
            ("amount", "amount", full),
            ("spread", "spread", {"mean": F.avg, "std": F.stddev_samp}),
        )
        for how, fn in chosen.items()
    ]
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(*aggs)


def attach(df: DataFrame, table: DataFrame, by: Sequence[str], label: str = "groups") -> DataFrame:
    """Left join of rows to one row per group.

    The group table is written first, so that Spark plans with its true size: it
    is broadcast under the session's threshold, and rows then stay where they
    are. Above it the rows are shuffled, and AQE splits hot keys.
    """
    return df.join(materialize(table, label), list(by), "left")


def with_client_stats(df: DataFrame) -> DataFrame:
    """Trades with their client's statistics."""
    return attach(df, client_stats(df), ["client_id"])


def with_group_stats(
    df: DataFrame,
    by: Sequence[str],
    aggregates: dict[str, Column],
    medians: dict[str, str] | None = None,
    store: bool = True,
    **limits,
) -> DataFrame:
    """Attach group aggregates (and medians) to rows; null groups get nulls.

    Aggregates combine before the shuffle, so a hot group is no hot task as it
    would be with a window. ``store=False`` skips writing the group table, for
    groups nearly as many as the rows.
    """
    keyed = df
    for name in by:
        keyed = keyed.where(F.col(name).isNotNull())
    table = None
    if aggregates:
        table = keyed.groupBy(*by).agg(*[c.alias(n) for n, c in aggregates.items()])
    if medians:
        found = grouped_quantiles(df, list(medians.values()), [0.5], by, **limits)
        named = found.select(*by, *[F.col(c)[0].alias(n) for n, c in medians.items()])
        table = named if table is None else table.join(named, list(by))
    if table is None:
        return df
    return attach(df, table, by) if store else df.join(table, list(by), "left")
