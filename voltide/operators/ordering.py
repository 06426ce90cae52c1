"""Row order over a whole table, and row-frame windows that split any group.

A window over one client, or over the whole table, would sit in one task. Here
the rows are range-sorted and numbered once; fixed-length chunks of the
numbering then carry copies of the neighbouring rows their frames reach into,
and the window runs per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide.operators.skew import GROUP_ROWS, GroupSizes, any_null, group_sizes
from voltide.schema import ORDER
from voltide.session import materialize

CHUNK_ROWS = 100_000
#: Chunks that make a larger one.
FAN = 1_000

WindowColumns = Callable[[WindowSpec], dict[str, Column]]


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Number rows 0..n-1 in ``order`` without a single-partition window.

    The range-sorted rows are written out before they are counted: sampling may
    choose other ranges when a lost task is run again.
    """
    spark = df.sparkSession
    slot = F.monotonically_increasing_id()
    ranged = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", slot)
    )
    stored = materialize(ranged, "row-index").withColumns(
        {"_part": F.shiftright("_slot", 33), "_at": F.col("_slot").bitwiseAND((1 << 33) - 1)}
    )
    # one row per range partition
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    offsets = spark.createDataFrame(starts, "_part bigint, _start bigint")
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_start") + F.col("_at"))
        .drop("_part", "_at", "_slot", "_start")
    )


def windowed(
    df: DataFrame,
    columns: WindowColumns,
    back: int,
    ahead: int = 0,
    by: Sequence[str] = ("client_id",),
    order: Sequence[str] = ORDER,
    sizes: GroupSizes | None = None,
    group_rows: int = GROUP_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add row-frame window columns that look ``back`` rows back, ``ahead`` ahead.

    With ``by`` empty the frame runs over the whole table. Rows whose key is
    null get null results. Ordinary groups use a plain window; groups larger
    than ``group_rows`` are cut into chunks.
    """
    if not by:
        return _chunked(df, columns, back, ahead, (), order, chunk_rows)
    sizes = sizes or group_sizes(df, by, group_rows)
    ordinary, large = sizes.split(df, by)
    keys: list = list(by)
    if sizes.null_rows:
        # rows without a key would all meet in one task: spread them
        ordinary = ordinary.withColumn(
            "_spread", F.when(any_null(by), F.pmod(F.xxhash64(*order), F.lit(4096)))
        )
        keys.append("_spread")
    frame = columns(Window.partitionBy(*keys).orderBy(*order))
    if sizes.null_rows:
        frame = {name: F.when(~any_null(by), c) for name, c in frame.items()}
    out = ordinary.select("*", *[c.alias(n) for n, c in frame.items()]).drop("_spread")
    if large is None:
        return out
    return out.unionByName(_chunked(large, columns, back, ahead, by, order, chunk_rows))


def _chunked(
    df: DataFrame,
    columns: WindowColumns,
    back: int,
    ahead: int,
    by: Sequence[str],
    order: Sequence[str],
    chunk_rows: int,
) -> DataFrame:
    chunk_rows = max(chunk_rows, back, ahead, 1)
    names = df.columns
    rows = with_row_index(df, [*by, *order], "_row")
    at = F.col("_row") % chunk_rows
    chunk = F.expr(f"_row div {chunk_rows}")
    homes = [F.array(chunk)]
    if back:
        homes.append(F.when(at >= chunk_rows - back, F.array(chunk + 1)))
    if ahead:
        homes.append(F.when(at < ahead, F.array(chunk - 1)))
    none = F.array().cast("array<bigint>")
    copies = F.concat(homes[0], *[F.coalesce(h, none) for h in homes[1:]])
    spread = rows.withColumns({"_home": chunk, "_chunk": copies}).withColumn(
        "_chunk", F.explode("_chunk")
    )
    frame = columns(Window.partitionBy("_chunk", *by).orderBy("_row"))
    return (
        spread.select("*", *[c.alias(n) for n, c in frame.items()])
        .where("_chunk = _home")
        .select(*names, *frame)
    )


@dataclass(frozen=True)
class Carried:
    """What a chunk learns from the others: ``how`` is ``last`` (the latest known value of
    ``column`` in the chunks before), ``next`` (the nearest known one in the chunks behind)
    or ``sum`` (the total of the chunks before)."""

    name: str
    column: str
    how: str


def carry(
    chunks: DataFrame, wanted: Sequence[Carried], last: int, by: Sequence[str] = (), fan: int = FAN
) -> DataFrame:
    """Add what ``wanted`` names to chunk summaries, rows of ``by`` and ``_chunk`` (0 to ``last``).

    ``fan`` chunks make a larger one, which learns from the others of its size in the
    same way first; so a window holds ``fan`` rows, however long the table is.
    """
    up = chunks.withColumn("_up", F.expr(f"_chunk div {fan}"))
    keys = ["_up", *by]
    here = Window.partitionBy(*keys)
    order = {"last": F.col("_chunk").asc(), "sum": F.col("_chunk").asc(), "next": F.col("_chunk").desc()}

    def within(c: Carried) -> Column:
        frame = here.orderBy(order[c.how]).rowsBetween(Window.unboundedPreceding, -1)
        if c.how == "sum":
            return F.coalesce(F.sum(c.column).over(frame), F.lit(0))
        return F.last(c.column, ignorenulls=True).over(frame)

    out = up.select("*", *[within(c).alias(c.name) for c in wanted])
    if last < fan:
        return out.drop("_up")
    known = {c.column: F.when(F.col(c.column).isNotNull(), F.col("_chunk")) for c in wanted}
    whole = {
        "last": lambda c: F.max_by(c.column, known[c.column]),
        "next": lambda c: F.min_by(c.column, known[c.column]),
        "sum": lambda c: F.sum(c.column),
    }
    larger = up.groupBy(*keys).agg(*[whole[c.how](c).alias(c.column) for c in wanted])
    above = carry(larger.withColumnRenamed("_up", "_chunk"), wanted, last // fan, by, fan).select(
        F.col("_chunk").alias("_k_up"), *[F.col(k).alias(f"_k_{k}") for k in by],
        *[F.col(c.name).alias(f"_a_{c.name}") for c in wanted],
    )
    same = [out["_up"] == F.col("_k_up"), *[out[k].eqNullSafe(F.col(f"_k_{k}")) for k in by]]
    joined = out.join(above, same)
    merged = [
        (F.col(c.name) + F.col(f"_a_{c.name}") if c.how == "sum" else F.coalesce(c.name, f"_a_{c.name}")).alias(c.name)
        for c in wanted
    ]
    return joined.select(*chunks.columns, *merged)


def fill_missing(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    order: Sequence[str] = ORDER,
    chunk_rows: int = CHUNK_ROWS,
    fan: int = FAN,
) -> DataFrame:
    """Forward fill, then backward fill, in row order over the table or per group.

    Frames are unbounded, so each chunk is summarised to its first and last
    known values, the summaries learn from each other, and chunks take what is
    missing from them.
    """
    names = df.columns
    rows = with_row_index(df, [*by, *order], "_row").withColumn(
        "_chunk", F.expr(f"_row div {chunk_rows}")
    )
    keys = ["_chunk", *by]

    known = {}
    for c in columns:
        present = F.when(F.col(c).isNotNull(), F.col("_row"))
        known[f"_first_{c}"] = F.min_by(c, present)
        known[f"_last_{c}"] = F.max_by(c, present)
    # one row per chunk (and group): the table shrunk by chunk_rows
    summary = materialize(rows.groupBy(*keys).agg(*[v.alias(k) for k, v in known.items()]), "chunks")
    last = summary.agg(F.max("_chunk")).first()[0] or 0
    wanted = [Carried(f"_before_{c}", f"_last_{c}", "last") for c in columns]
    wanted += [Carried(f"_after_{c}", f"_first_{c}", "next") for c in columns]
    carried = carry(summary, wanted, last, by, fan).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[w.name for w in wanted]
    )
    joined = rows.join(carried, [rows[k].eqNullSafe(F.col(f"_k_{k}")) for k in keys])

    def latest(column: str, sort: Column) -> Column:
        # backward fill reads the rows in reverse: a growing frame is linear,
        # a shrinking one would rescan its rows
        window = Window.partitionBy(*keys).orderBy(sort).rowsBetween(Window.unboundedPreceding, 0)
        return F.last(column, ignorenulls=True).over(window)

    filled = {
        c: F.coalesce(
            latest(c, F.col("_row").asc()),
            F.col(f"_before_{c}"),
            latest(c, F.col("_row").desc()),
            F.col(f"_after_{c}"),
        )
        for c in columns
    }
    return joined.select(*[filled.get(n, F.col(n)).alias(n) for n in names])


def running_count(df: DataFrame, order: str, count: str, name: str, chunk_rows: int = CHUNK_ROWS, fan: int = FAN) -> DataFrame:
    """Add the sum of ``count`` over all rows up to this one in ``order``, whose values differ."""
    rows = with_row_index(df, [order], "_row").withColumn("_chunk", F.expr(f"_row div {chunk_rows}"))
    chunks = materialize(rows.groupBy("_chunk").agg(F.sum(count).alias("_total")), "chunks")
    last = chunks.agg(F.max("_chunk")).first()[0] or 0
    before = carry(chunks, [Carried("_before", "_total", "sum")], last, (), fan).select("_chunk", "_before")
    here = Window.partitionBy("_chunk").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.join(before, "_chunk")
        .withColumn(name, F.col("_before") + F.sum(count).over(here))
        .select(*df.columns, name)
    )
