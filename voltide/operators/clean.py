"""Row filters, imputation, clipping and batch checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.operators.quantiles import grouped_quantiles, quantiles
from voltide.operators.skew import GroupSizes
from voltide.operators.stats import attach, collect_stats, iqr_fences
from voltide.schema import (
    DECLARED_TYPES,
    LEGAL_RANGES,
    missing_columns,
    numeric_columns,
    require_columns,
)


def null_if_not_finite(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN and infinities become null, the one marker for a missing number."""
    floats = {n for n, t in df.dtypes if t in ("double", "float")}
    names = [c for c in (columns or df.columns) if c in floats]
    bad = {
        c: F.when(F.isnan(c) | (F.abs(F.col(c)) == float("inf")), None).otherwise(F.col(c))
        for c in names
    }
    return df.withColumns(bad) if bad else df


def cast_lenient(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast to double; text that is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def cast_strict(df: DataFrame, types: Mapping[str, str] = DECLARED_TYPES) -> DataFrame:
    """Cast to the declared types; a value that does not fit fails the job."""
    present = {c: F.col(c).cast(t) for c, t in types.items() if c in df.columns}
    return df.withColumns(present) if present else df


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows before and after whole-row duplicate removal."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(
        F.sum("n").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        (F.sum("n") - F.count(F.lit(1))).alias("removed"),
    )


def iqr_filter(df: DataFrame, column: str = "amount", factor: float = 1.5, **limits) -> DataFrame:
    """Keep rows inside the IQR fences; rows with no value drop out.

    The fences are literals, so the filter reaches the file scan.
    """
    fences = iqr_fences(df, [column], factor, **limits)[column]
    if fences is None:
        return df.where(F.lit(False))
    return df.where(F.col(column).between(*map(F.lit, fences)))


def iqr_report(df: DataFrame, column: str = "amount", factor: float = 1.5, **limits) -> DataFrame:
    """Count and range before and after the IQR filter, in one aggregate."""
    x = F.col(column)
    fences = iqr_fences(df, [column], factor, **limits)[column]
    lo, hi = (F.lit(None).cast("double"),) * 2 if fences is None else map(F.lit, fences)
    kept = F.when(x.between(lo, hi), x)
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count(kept).alias("rows_after"),
        F.count_if((x < lo) | (x > hi)).alias("outliers"),
        F.min(x).alias("min_before"),
        F.max(x).alias("max_before"),
        F.min(kept).alias("min_after"),
        F.max(kept).alias("max_after"),
    )


def range_repair(
    df: DataFrame,
    ranges: Mapping[str, tuple[float | None, float | None]] = LEGAL_RANGES,
    **limits,
) -> DataFrame:
    """Values outside their legal range become the column median."""
    present = [c for c in ranges if c in df.columns]
    outside = {c: _outside(c, *ranges[c]) for c in present}
    bad = df.agg(*[F.count_if(t).alias(c) for c, t in outside.items()]).first()
    broken = [c for c in present if bad[c]]
    if not broken:
        return df
    medians = quantiles(df, broken, [0.5], **limits)
    types = dict(df.dtypes)
    return df.withColumns(
        {
            c: F.when(outside[c], F.lit(medians[c][0]).cast(types[c])).otherwise(F.col(c))
            for c in broken
        }
    )


def _outside(column: str, lo: float | None, hi: float | None) -> Column:
    test = F.lit(False)
    if lo is not None:
        test = test | (F.col(column) < lo)
    if hi is not None:
        test = test | (F.col(column) > hi)
    return test


def clip_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    # greatest() skips nulls, so a null needs its own branch
    return df.withColumns(
        {c: F.when(F.col(c) < 0, F.lit(0).cast(t)).otherwise(F.col(c))
         for c, t in df.dtypes if c in columns}
    )


def winsorize(
    df: DataFrame, columns: Sequence[str], factor: float = 1.5, lower_zero: bool = False, **limits
) -> DataFrame:
    """Clip columns to their IQR fences, optionally after clipping negatives to 0."""
    if lower_zero:
        df = clip_negative(df, columns)
    fences = iqr_fences(df, columns, factor, **limits)
    return df.withColumns({c: clip(F.col(c), *f) for c, f in fences.items() if f})


def clip(x: Column, lo: float, hi: float) -> Column:
    x = x.cast("double")
    return F.when(x < lo, F.lit(lo)).when(x > hi, F.lit(hi)).otherwise(x)


def columns_with_nulls(df: DataFrame, columns: Sequence[str]) -> list[str]:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c]]


def impute_median(df: DataFrame, columns: Sequence[str], **limits) -> DataFrame:
    """Missing values become the column median; complete columns are left alone."""
    gaps = columns_with_nulls(df, columns)
    if not gaps:
        return df
    medians = quantiles(df, gaps, [0.5], **limits)
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0]).cast("double"))
         for c in gaps}
    )


def impute_mean(df: DataFrame, columns: Sequence[str], default: float = 0.0) -> DataFrame:
    """Missing values become the mean, or ``default`` in an empty column."""
    means = collect_stats(df, columns, ["mean"])
    fill = {c: default if means[c]["mean"] is None else means[c]["mean"] for c in columns}
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(float(fill[c]))) for c in columns}
    )


def impute_group_median(
    df: DataFrame, columns: Sequence[str], by: Sequence[str], **limits
) -> DataFrame:
    """Missing values become the median of their group."""
    columns = columns_with_nulls(df, columns)
    if not columns:
        return df
    medians = grouped_quantiles(df, columns, [0.5], by, **limits).select(
        *by, *[F.col(c)[0].alias(f"_median_{c}") for c in columns]
    )
    names = df.columns
    out = attach(df, medians, by)
    filled = {
        c: F.coalesce(F.col(c).cast("double"), F.col(f"_median_{c}")).alias(c) for c in columns
    }
    return out.select(*[filled.get(n, F.col(n)) for n in names])


def impute_client_median(
    df: DataFrame, columns: Sequence[str], sizes: GroupSizes | None = None, **limits
) -> DataFrame:
    """Client median first, then the median of the column as filled so far."""
    by_client = impute_group_median(df, columns, ["client_id"], sizes=sizes, **limits)
    return impute_median(by_client, columns, **limits)


def impute_weekday_median(df: DataFrame, column: str = "amount", **limits) -> DataFrame:
    require_columns(df, ["close_ts", column])
    keyed = df.withColumn("weekday", F.weekday("close_ts"))
    return impute_group_median(keyed, [column], ["weekday"], **limits)


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in names]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def validate_batch(
    df: DataFrame, columns: Sequence[str], factor: float = 1.5, **limits
) -> DataFrame:
    """Negatives, nulls and IQR outliers per required column.

    A column passes if it is numeric and has no negative value; nulls and
    outliers are reported only.
    """
    require_columns(df, columns)
    numeric = set(numeric_columns(df, ()))
    fences = iqr_fences(df, [c for c in columns if c in numeric], factor, **limits)
    aggs = []
    for i, c in enumerate(columns):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{i}_nulls"))
        if c in numeric:
            aggs.append(F.count_if(F.col(c) < 0).alias(f"{i}_negatives"))
            lo, hi = fences[c] or (0.0, 0.0)
            aggs.append(F.count_if(~F.col(c).between(lo, hi)).alias(f"{i}_outliers"))
    rows = []
    for i, c in enumerate(columns):
        known = c in numeric
        zero = F.lit(0).cast("bigint")
        negatives = F.col(f"{i}_negatives") if known else zero
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                negatives.alias("negatives"),
                F.col(f"{i}_nulls").alias("nulls"),
                (F.col(f"{i}_outliers") if known else zero).alias("outliers"),
                F.lit(known).alias("is_numeric"),
                (F.lit(known) & (negatives == 0)).alias("is_valid"),
            )
        )
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def check_batch(df: DataFrame, columns: Sequence[str], nulls_fail: bool = False) -> list[str]:
    """Problems that make a scoring batch invalid; empty if it may be scored."""
    missing = missing_columns(df, columns)
    if missing:
        return [f"missing columns: {missing}"]
    if not columns:
        return ["no columns to score"]
    numeric = set(numeric_columns(df, ()))
    problems = [f"column {c} is not numeric" for c in columns if c not in numeric]
    known = [c for c in columns if c in numeric]
    tests = [(c, "negative", F.col(c) < 0) for c in known]
    if nulls_fail:
        tests += [(c, "null", F.col(c).isNull()) for c in columns]
    if tests:
        row = df.agg(*[F.count_if(t) for _, _, t in tests]).first()
        problems += [f"{n} {what} values in {c}" for (c, what, _), n in zip(tests, row) if n]
    return problems

