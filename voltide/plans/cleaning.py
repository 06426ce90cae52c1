"""The two cleaning chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide.operators import clean
from voltide.operators.skew import GROUP_ROWS, GroupSizes, group_sizes
from voltide.operators.stats import data_profile, profile_issues, with_group_stats
from voltide.operators.windows import mean_of_last_5, rolling
from voltide.schema import ORDER, RATE_COLUMNS, drop_unused, numeric_columns, rename_raw, require_columns
from voltide.session import materialize


def with_daily_volume(df: DataFrame) -> DataFrame:
    """Sum of the client's amounts at the same closing date, on every trade."""
    return with_group_stats(
        df, ["client_id", "close_ts"], {"daily_volume": F.sum("amount")}, store=False
    )


def _client_columns(df: DataFrame, nulls: bool) -> DataFrame:
    """Rolling mean, client mean and daily volume of ordinary clients from one shuffle.

    All three windows partition by the client, so they share its clustering and
    sort. Rows without a client are spread and get nulls.
    """
    names, keys = df.columns, ["client_id"]
    if nulls:
        spread = F.pmod(F.xxhash64(*ORDER), F.lit(4096))
        df = df.withColumn("_spread", F.when(F.col("client_id").isNull(), spread))
        keys.append("_spread")
    by_client = Window.partitionBy(*keys)
    known = F.col("client_id").isNotNull()
    frame = {s.name: s.over(by_client.orderBy(*ORDER)) for s in mean_of_last_5()}
    frame["client_mean_amount"] = F.avg("amount").over(by_client)
    dated = known & F.col("close_ts").isNotNull()
    day = F.sum("amount").over(Window.partitionBy(*keys, "close_ts"))
    new = {n: F.when(known, c) for n, c in frame.items()} if nulls else frame
    return df.select(
        *names, *[c.alias(n) for n, c in new.items()], F.when(dated, day).alias("daily_volume")
    )


def load_trades(
    df: DataFrame, sizes: GroupSizes | None = None, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Derived columns every later stage of the script chain expects."""
    df = rename_raw(drop_unused(df))
    require_columns(df, ["client_id", "close_ts", "amount", "op_id"])
    sizes = sizes or group_sizes(df, ["client_id"], group_rows)
    ordinary, large = sizes.split(df, ["client_id"])
    out = _client_columns(ordinary, bool(sizes.null_rows))
    if large is not None:
        # a client too large for one task: chunks, and combined sums joined back
        more = rolling(large, mean_of_last_5(), group_rows=group_rows)
        more = with_group_stats(more, ["client_id"], {"client_mean_amount": F.avg("amount")})
        out = out.unionByName(with_daily_volume(more))
    return out.withColumns(
        {
            "month": F.month("close_ts"),
            "day_name": F.date_format("close_ts", "EEEE"),
            "next_ts": F.col("close_ts") + F.expr("INTERVAL 7 DAYS"),
        }
    )


def clean_g1(df: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Impute, clip negatives, winsorize, cast and repair ranges; keeps every row."""
    sizes = group_sizes(df, ["client_id"], group_rows)
    numbers = numeric_columns(df)
    df = clean.null_if_not_finite(df)
    filled = clean.impute_group_median(
        df, numbers, ["client_id"], sizes=sizes, group_rows=group_rows
    )
    # three statistics passes follow: take them from a written table
    filled = materialize(filled, "imputed")
    filled = clean.impute_median(filled, numbers, group_rows=group_rows)
    clipped = clean.winsorize(filled, numbers, lower_zero=True, group_rows=group_rows)
    return clean.range_repair(clean.cast_strict(clipped), group_rows=group_rows)


def clean_g2(df: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Deduplicate, impute the amount by weekday, drop outliers, fill rates."""
    require_columns(df, ["close_ts", "amount"])
    df = clean.drop_duplicate_rows(drop_unused(df))
    df = clean.null_if_not_finite(clean.cast_lenient(df, ["amount"]))
    df = materialize(df, "deduplicated")
    df = clean.impute_weekday_median(df, group_rows=group_rows).drop("weekday")
    df = clean.iqr_filter(df, group_rows=group_rows)
    rates = [c for c in RATE_COLUMNS if c in df.columns]
    if rates:
        df = clean.impute_median(clean.cast_lenient(df, rates), rates, group_rows=group_rows)
    return df


def validation_report(df: DataFrame) -> DataFrame:
    """Rows, nulls, distinct values and type per column, plus missing columns."""
    issues = F.array(*[F.lit(i) for i in profile_issues(df)]).cast("array<string>")
    return data_profile(df).withColumn("issues", issues)
