"""Category codes, one-hot columns and one-hot vectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide.operators.ordering import with_row_index
from voltide.session import materialize

SMALL_VALUES = 100_000  # values numbered in one task


def category_codes(
    df: DataFrame, column: str, name: str | None = None, small_values: int = SMALL_VALUES
) -> DataFrame:
    """Position of each value among the sorted distinct values; missing is -1."""
    values = materialize(df.select(column).where(F.col(column).isNotNull()).distinct(), "values")
    name = name or f"{column}_code"
    if values.count() <= small_values:
        place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(column)) - 1
        codes = values.withColumn("_code", place.cast("bigint"))
    else:
        codes = with_row_index(values, [column], "_code")
    joined = df.join(codes, column, "left")
    return joined.withColumn(name, F.coalesce("_code", F.lit(-1)).cast("int")).drop("_code")


def levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct values of each column, all from one pass."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]
    )
    found = df.select(F.explode(pairs).alias("p")).select("p.*").where("v is not null").distinct()
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in found.collect():  # one row per new column
        out[r["c"]].append(r["v"])
    return {c: sorted(v) for c, v in out.items()}


def one_hot(
    df: DataFrame, columns: Sequence[str], values: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """A 0/1 column ``column_value`` per value; missing values are 0 everywhere.

    ``values`` gives the values of a column; without it they are read from ``df``.
    """
    present = [c for c in columns if c in df.columns]
    values = values or {}
    unknown = [c for c in present if c not in values]
    found = {**(levels(df, unknown) if unknown else {}), **values}
    new = {
        f"{c}_{v}": F.coalesce(F.col(c).cast("string") == v, F.lit(False)).cast("int")
        for c in present
        for v in found[c]
    }
    return df.withColumns(new) if new else df


@dataclass(frozen=True)
class OneHotVectors:
    """One-hot encoding into sparse vectors, for columns of any number of values.

    ``dictionary`` lists ``column_name, value, position``: the columns in the order given,
    the values of each sorted. It is a stored table that rows are joined to; only the
    number of values per column comes to the driver. Missing values, and values that the
    dictionary does not hold, are 0 everywhere.
    """

    columns: tuple[str, ...]
    sizes: tuple[int, ...]
    dictionary: DataFrame

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> OneHotVectors:
        present = [c for c in columns if c in df.columns]
        pairs = F.array(*[
            F.struct(F.lit(i).alias("place"), F.col(f"`{c}`").cast("string").alias("value"))
            for i, c in enumerate(present)
        ]) if present else F.array().cast("array<struct<place:int,value:string>>")
        values = (
            df.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null").distinct()
        )
        numbered = materialize(with_row_index(values, ["place", "value"], "position"), "dictionary")
        counts = {r["place"]: r["count"] for r in numbered.groupBy("place").count().collect()}
        names = F.array(*[F.lit(c) for c in present]) if present else F.array().cast("array<string>")
        return cls(
            tuple(present), tuple(counts.get(i, 0) for i in range(len(present))),
            numbered.select(F.get(names, F.col("place")).alias("column_name"), "value", "position"),
        )

    def transform(self, df: DataFrame, name: str = "one_hot") -> DataFrame:
        """``df`` and a sparse vector; rows keep their number."""
        encoded, kept, start = df, [], 0
        for i, (column, size) in enumerate(zip(self.columns, self.sizes)):
            if size:
                codes = self.dictionary.where(F.col("column_name") == column).select(
                    F.col("value").alias(f"_value_{i}"), (F.col("position") - start).cast("double").alias(f"_code_{i}")
                )
                # the code behind the last is an unknown value, which has no place of its own
                known = F.coalesce(f"_code_{i}", F.lit(float(size)))
                encoded = encoded.join(
                    codes, F.col(f"`{column}`").cast("string") == F.col(f"_value_{i}"), "left"
                ).withColumn(f"_code_{i}", known)
                encoded = encoded.withMetadata(
                    f"_code_{i}", {"ml_attr": {"type": "nominal", "num_vals": size}}
                )
                kept.append(i)
            start += size
        if not kept:
            raise ValueError("no column has a value to encode")
        encoder = OneHotEncoder(
            inputCols=[f"_code_{i}" for i in kept], outputCols=[f"_hot_{i}" for i in kept],
            handleInvalid="keep", dropLast=True,
        )
        hot = encoder.fit(encoded).transform(encoded)  # sizes come from the columns' metadata
        joined = VectorAssembler(inputCols=[f"_hot_{i}" for i in kept], outputCol="_hot").transform(hot)
        return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.col("_hot").alias(name))

    def save(self, path: str) -> None:
        self.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")
        rows = list(zip(range(len(self.columns)), self.columns, self.sizes))
        self.dictionary.sparkSession.createDataFrame(
            rows, "place int, column_name string, values long"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> OneHotVectors:
        rows = spark.read.parquet(f"{path}/columns").orderBy("place").collect()
        return cls(
            tuple(r["column_name"] for r in rows), tuple(r["values"] for r in rows),
            spark.read.parquet(f"{path}/dictionary"),
        )
