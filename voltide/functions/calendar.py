"""Calendar columns of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar(ts: str = "close_ts") -> dict[str, Column]:
    """Date parts and flags; the weekday counts from Monday = 0."""
    day, weekday = F.day(ts), F.weekday(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": day,
        "quarter": F.quarter(ts),
        "weekday": weekday,
        "day_name": F.date_format(ts, "EEEE"),
        "is_weekend": weekday.isin(5, 6).cast("int"),
        "is_month_start": (day <= 5).cast("int"),
        "is_month_end": (day >= 25).cast("int"),
        "is_last_day": (F.to_date(ts) == F.last_day(ts)).cast("int"),
        "next_ts": F.col(ts) + F.expr("INTERVAL 7 DAYS"),
        "epoch_seconds": F.unix_timestamp(ts),
    }


def cyclic(ts: str = "close_ts") -> dict[str, Column]:
    """Month and weekday on the unit circle."""
    month = F.month(ts) * F.lit(2.0) * F.pi() / 12
    weekday = F.weekday(ts) * F.lit(2.0) * F.pi() / 7
    return {
        "month_sin": F.sin(month),
        "month_cos": F.cos(month),
        "weekday_sin": F.sin(weekday),
        "weekday_cos": F.cos(weekday),
    }


def intraday(ts: str = "close_ts", opening: int = 9, closing: int = 18) -> dict[str, Column]:
    hour = F.hour(ts)
    weekday = F.weekday(ts) < 5
    return {
        "hour": hour,
        "minute": F.minute(ts),
        "is_business_hours": (weekday & (hour >= opening) & (hour < closing)).cast("int"),
    }


def days_since_start(df: DataFrame, ts: str = "close_ts", name: str = "days_since_start"):
    """Whole 24-hour periods since the first trade of the table."""
    first = df.agg(F.unix_micros(F.min(ts))).first()[0]
    elapsed = F.unix_micros(ts) - F.lit(first)
    return df.withColumn(name, F.floor(elapsed / 86_400_000_000))


def _holiday_dates(year: Column) -> list[tuple[str, Column]]:
    """Names and dates of the US federal holidays of a year, observed days included."""

    def on(month: int, day: int) -> Column:
        return F.make_date(year, F.lit(month), F.lit(day))

    def nth(month: int, weekday: int, which: int) -> Column:
        first = on(month, 1)
        skip = F.pmod(F.lit(weekday) - F.weekday(first), F.lit(7))
        return F.date_add(first, skip + 7 * (which - 1))

    last_may = on(5, 31)
    # Holiday names and their dates.
    fixed = [
        ("New Year's Day", on(1, 1)),
        ("Juneteenth National Independence Day", F.when(year >= 2021, on(6, 19))),
        ("Independence Day", on(7, 4)),
        ("Veterans Day", on(11, 11)),
        ("Christmas Day", on(12, 25)),
    ]
    floating = [
        ("Martin Luther King Jr. Day", nth(1, 0, 3)),
        ("Washington's Birthday", nth(2, 0, 3)),
        ("Memorial Day", F.date_sub(last_may, F.weekday(last_may))),
        ("Labor Day", nth(9, 0, 1)),
        ("Columbus Day", nth(10, 0, 2)),
        ("Thanksgiving", nth(11, 3, 4)),
    ]
    observed = [
        (
            f"{name} (observed)",
            F.when(F.weekday(day) == 5, F.date_sub(day, 1)).when(
                F.weekday(day) == 6, F.date_add(day, 1)
            ),
        )
        for name, day in fixed
    ]
    return fixed + floating + observed


def us_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """US federal holidays by rule, with the observed day of fixed dates."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("y"))
    rows = [
        F.struct(F.lit(n).alias("holiday"), d.alias("day")) for n, d in _holiday_dates(F.col("y"))
    ]
    return (
        years.select(F.explode(F.array(*rows)).alias("h"))
        .select("h.day", "h.holiday")
        .where("day is not null")
    )


def is_us_holiday(ts: str = "close_ts") -> Column:
    """True on a US federal holiday of any year, from the date alone."""
    day = F.to_date(ts)
    own = [d for _, d in _holiday_dates(F.year(day))]
    # New Year's Day on a Saturday is observed in the year before
    following = F.make_date(F.year(day) + 1, F.lit(1), F.lit(1))
    own.append(F.when(F.weekday(following) == 5, F.date_sub(following, 1)))
    hit = F.lit(False)
    for d in own:
        hit = hit | F.coalesce(day == d, F.lit(False))
    return hit


def with_holidays(df: DataFrame, ts: str = "close_ts") -> DataFrame:
    """Flag trades on US federal holidays: about 16 calendar rows per year."""
    first, last = df.agg(F.min(F.year(ts)), F.max(F.year(ts))).first()
    if first is None:
        return df.withColumns(
            {"holiday": F.lit(None).cast("string"), "is_holiday": F.lit(0)}
        )
    days = us_holidays(df.sparkSession, first - 1, last + 1)
    days = days.groupBy("day").agg(F.min("holiday").alias("holiday"))
    flagged = df.withColumn("_day", F.to_date(ts)).join(
        F.broadcast(days.withColumnRenamed("day", "_day")), "_day", "left"
    )
    return flagged.withColumn("is_holiday", F.col("holiday").isNotNull().cast("int")).drop("_day")
