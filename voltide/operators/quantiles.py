"""Exact interpolated quantiles that never gather a large group in one task.

An ordinary group is sorted in one buffer, which its row limit bounds. The ranks of
larger groups are found digit by digit in the order-preserving code of the values:
every pass is a count over the rows that share the digits known so far.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide.operators.skew import GROUP_ROWS, GroupSizes, any_null, group_sizes
from voltide.session import materialize

#: Bits of a value's code that one pass counts by: four passes at most.
DIGIT_BITS = 16
#: Exponent of the smallest doubles.
LEAST_EXPONENT = -1022


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], group_rows: int = GROUP_ROWS
) -> dict[str, list[float | None]]:
    """Quantiles of whole columns as plain numbers: ``{column: [value, ...]}``."""
    wanted = [F.col(c).cast("double").alias(c) for c in columns]
    narrow = df.select(*wanted)
    counts = narrow.agg(*[F.count(c).alias(c) for c in columns]).first()
    # the values of all these columns share one row of one task
    small, held = [], 0
    for c in sorted(dict.fromkeys(columns), key=lambda c: counts[c]):
        if held + counts[c] > group_rows:
            break
        small.append(c)
        held += counts[c]
    found: dict[str, list[float | None]] = {}
    if small:
        ordered = narrow.agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in small])
        row = ordered.select(*[_interpolated(c, probs).alias(c) for c in small]).first()
        found = {c: list(row[c]) for c in small}
    large = [c for c in dict.fromkeys(columns) if c not in small]
    if large:
        long = _long(narrow, large, ())
        for row in _select(long, (), probs).collect():  # one row per column
            found[row["_column"]] = list(row["_found"])
    return {c: found[c] for c in columns}


def grouped_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str],
    group_rows: int = GROUP_ROWS,
    sizes: GroupSizes | None = None,
) -> DataFrame:
    """One row per non-null group; each column becomes an array of quantiles."""
    narrow = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns if c not in by])
    sizes = sizes or group_sizes(narrow, by, group_rows)
    ordinary, large = sizes.split(narrow.where(~any_null(by)), by)
    ordered = ordinary.groupBy(*by).agg(
        *[F.sort_array(F.collect_list(c)).alias(c) for c in columns]
    )
    out = ordered.select(*by, *[_interpolated(c, probs).alias(c) for c in columns])
    if large is None:
        return out
    selected = _select(_long(large, columns, by), by, probs)
    empty = F.array_repeat(F.lit(None).cast("double"), len(probs))
    wide = selected.groupBy(*by).agg(
        *[F.first(F.when(F.col("_column") == c, F.col("_found")), ignorenulls=True).alias(c) for c in columns]
    )
    # groups without any value have a row too
    whole = sizes.large.select(*by).join(wide, list(by), "left")
    return out.unionByName(whole.select(*by, *[F.coalesce(c, empty).alias(c) for c in columns]))


def _between(at: Column, low: Column, high: Column, a: Column, b: Column) -> Column:
    return F.when(a == b, a).otherwise((high - at) * a + (at - low) * b)


def _interpolated(ordered: str, probs: Sequence[float]) -> Column:
    """Quantiles of a sorted array, as an array; nulls if it is empty."""
    n = F.size(ordered)
    grid = F.array(*[F.lit(float(p)) for p in probs])

    def one(p: Column) -> Column:
        at = p * (n - 1)
        low, high = F.floor(at).cast("int"), F.ceil(at).cast("int")
        return _between(at, low, high, F.get(ordered, low), F.get(ordered, high))

    empty = F.array_repeat(F.lit(None).cast("double"), len(probs))
    return F.when(n > 0, F.transform(grid, one)).otherwise(empty)


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("x")) for c in columns]
    )
    return df.select(*by, F.explode(pairs).alias("p")).select(*by, "p.*").where("x is not null")


def value_code(x: Column) -> Column:
    """A whole number per double that sorts as the doubles do; -0.0 as 0.0, NaN last.

    It is the number's exponent and fraction: ``|x| = f * 2^e`` with ``f`` below 2 and
    not below 1, but for numbers too small for that, which have the least exponent.
    """
    a = F.when(F.abs(x) < math.inf, F.abs(x))
    guess = F.floor(F.log2(a))
    # the logarithm of a number next to a power of two may round to the other side
    scaled = a * F.pow(F.lit(2.0), -F.greatest(guess, F.lit(LEAST_EXPONENT)))
    fixed = guess + F.when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0)
    e = F.greatest(fixed, F.lit(LEAST_EXPONENT))
    fraction = (a * F.pow(F.lit(2.0), -e) * F.lit(2.0**52)).cast("bigint")
    size = (e - LEAST_EXPONENT) * F.lit(1 << 52) + fraction
    code = (
        F.when(F.isnan(x), F.lit((2048 << 52) - 1))
        .when(F.abs(x) == math.inf, F.lit(2047 << 52))
        .when(a == 0, F.lit(0))
        .otherwise(size)
    )
    return F.when((x < 0) & ~F.isnan(x), -code).otherwise(code).cast("bigint")


def _select(long: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``by, _column, _found``: the quantiles of each group and column of ``long``.

    Ranks are found digit by digit of the values' codes. A pass counts rows by the
    next ``DIGIT_BITS`` bits, combined before the shuffle, and keeps for each wanted
    rank the digits it has so far. These tables are stored and joined by key, so
    neither the driver nor a task holds more than one group's counts of one digit.
    """
    keys = [*by, "_column"]
    rows = materialize(
        long.withColumnRenamed("column", "_column").withColumn("_code", value_code(F.col("x"))), "values"
    )
    grid = ", ".join(f"{float(p)!r}D" for p in probs)
    state, found, bits = None, [], 0
    while bits < 64:
        bits = min(64, bits + DIGIT_BITS)
        digits = F.shiftright("_code", 64 - bits)
        if state is None:
            counted = rows.groupBy(*keys, digits.alias("_at"))
            within = keys
        else:
            known = F.shiftright("_code", 64 - state[1])
            counted = rows.withColumn("_known", known).join(state[0], [*keys, "_known"]).groupBy(
                *keys, "_known", "_n", "_wanted", digits.alias("_at")
            )
            within = [*keys, "_known"]
        counted = counted.agg(F.count(F.lit(1)).alias("_rows"), F.min("x").alias("_lo"), F.max("x").alias("_hi"))
        if state is None:
            counted = counted.withColumn("_n", F.sum("_rows").over(Window.partitionBy(*within))).withColumn(
                "_wanted",
                F.expr(
                    "transform(array_distinct(flatten(transform("
                    f"array({grid}), p -> array(floor(p * (_n - 1)), ceil(p * (_n - 1)))))),"
                    " r -> named_struct('rank', r, 'rest', r))"
                ),
            )
        upto = F.sum("_rows").over(Window.partitionBy(*within).orderBy("_at"))
        hits = counted.withColumn("_upto", upto).withColumn(
            "_wanted",
            F.expr(
                "transform(filter(_wanted, w -> w.rest < _upto AND w.rest >= _upto - _rows),"
                " w -> named_struct('rank', w.rank, 'rest', w.rest - (_upto - _rows)))"
            ),
        ).where(F.size("_wanted") > 0)
        hits = materialize(
            hits.select(*keys, F.col("_at").alias("_known"), "_n", "_wanted", "_lo", "_hi"), "ranks"
        )
        same = (F.col("_lo") == F.col("_hi")) if bits < 64 else F.lit(True)
        found.append(hits.where(same).select(*keys, "_n", F.explode("_wanted.rank").alias("_rank"), "_lo"))
        rest = hits.where(~same).select(*keys, "_known", "_n", "_wanted")
        if rest.isEmpty():
            break
        state = (rest, bits)

    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    # two ranks at most for each probability
    ranked = every.groupBy(*keys).agg(
        F.first("_n").alias("_n"), F.map_from_entries(F.collect_list(F.struct("_rank", "_lo"))).alias("_ranked")
    )

    def one(p: Column) -> Column:
        at = p * (F.col("_n") - 1)
        low, high = F.floor(at), F.ceil(at)
        return _between(at, low, high, F.col("_ranked")[low], F.col("_ranked")[high])

    return ranked.select(*keys, F.transform(F.array(*[F.lit(float(p)) for p in probs]), one).alias("_found"))
