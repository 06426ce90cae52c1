"""Scalers whose fitted parameters are a small table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.operators.clean import clip, null_if_not_finite
from voltide.operators.quantiles import quantiles
from voltide.operators.stats import collect_stats, iqr_fences

#: Columns whose statistics are taken in one pass.
AT_ONCE = 8


@dataclass(frozen=True)
class StandardScale:
    """``(x - mean) / population std``; nulls stay, a zero std divides by 1."""

    parameters: dict[str, tuple[float | None, float | None]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> StandardScale:
        # a few columns a pass, which reads no others: the code Spark makes for many at once is
        # too long for the JVM to compile, and is interpreted
        stats = {}
        for at in range(0, len(columns), AT_ONCE):
            some = list(columns[at : at + AT_ONCE])
            stats |= collect_stats(null_if_not_finite(df.select(*some)), some, ["mean", "std_pop"])
        return cls({c: (stats[c]["mean"], stats[c]["std_pop"]) for c in columns})

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (mean, std) in self.parameters.items():
            if mean is None:
                out[c] = F.lit(None).cast("double")
            else:
                out[c] = (F.col(c).cast("double") - F.lit(mean)) / F.lit(std or 1.0)
        return null_if_not_finite(df, list(out)).withColumns(out)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, m, s) for c, (m, s) in self.parameters.items()]
        return spark.createDataFrame(rows, "feature string, mean double, std double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> StandardScale:
        rows = spark.read.parquet(path).collect()  # one row per feature
        return cls({r["feature"]: (r["mean"], r["std"]) for r in rows})


@dataclass(frozen=True)
class RobustScale:
    """Clip to IQR fences, then ``(x - median) / MAD``; missing or MAD 0 gives 0."""

    parameters: dict[str, tuple[float, float, float, float] | None]  # lo, hi, median, mad

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], **limits) -> RobustScale:
        fences = iqr_fences(df, columns, **limits)
        known = [c for c in columns if fences[c]]
        clipped = df.select(*[clip(F.col(c), *fences[c]).alias(c) for c in known])
        medians = quantiles(clipped, known, [0.5], **limits) if known else {}
        off = clipped.select(*[F.abs(F.col(c) - F.lit(medians[c][0])).alias(c) for c in known])
        mads = quantiles(off, known, [0.5], **limits) if known else {}
        return cls(
            {
                c: (*fences[c], medians[c][0], mads[c][0]) if fences[c] else None
                for c in columns
            }
        )

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, fitted in self.parameters.items():
            if fitted is None:
                out[c] = F.lit(0.0)
                continue
            lo, hi, median, spread = fitted
            z = F.try_divide(clip(F.col(c), lo, hi) - F.lit(median), F.lit(spread))
            out[c] = F.coalesce(z, F.lit(0.0))
        return df.withColumns(out)

