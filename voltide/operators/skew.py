"""Find the groups too large for one task, so that they can be split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.session import materialize

# A group of up to this many rows is handled whole by one task.
GROUP_ROWS = 1_000_000


@dataclass(frozen=True)
class GroupSizes:
    rows: int
    null_rows: int
    large_rows: int
    large: DataFrame | None  # key columns and ``rows`` of each large group

    def split(self, df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
        """Rows of ordinary groups (null keys included) and of large groups."""
        if self.large is None:
            return df, None
        keys = self.large.select(*by)
        return df.join(keys, list(by), "left_anti"), df.join(keys, list(by), "left_semi")


def any_null(by: Sequence[str]):
    test = F.col(by[0]).isNull()
    for name in by[1:]:
        test = test | F.col(name).isNull()
    return test


def group_sizes(df: DataFrame, by: Sequence[str], group_rows: int = GROUP_ROWS) -> GroupSizes:
    """Count rows per group (combined before the shuffle) and list large groups."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    null_key = any_null(by)
    total, nulls, largest = counts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)),
        F.coalesce(F.sum(F.when(null_key, F.col("rows"))), F.lit(0)),
        F.coalesce(F.max(F.when(~null_key, F.col("rows"))), F.lit(0)),
    ).first()
    if largest <= group_rows:
        return GroupSizes(total, nulls, 0, None)
    # stored, so that joins are planned by its true size; nothing is broadcast unchecked
    large = materialize(counts.where(~null_key & (F.col("rows") > group_rows)), "large-groups")
    return GroupSizes(total, nulls, large.agg(F.sum("rows")).first()[0], large)
