"""Whitening of embeddings by principal components, on distributed blocks.

Each component of a vector becomes a whole number, so sums over all rows are exact.
Centred rows are indexed and cut into a ``BlockMatrix``; its transpose times itself
is the scatter matrix, whose size is that of one vector squared and no more. That one
matrix is decomposed on the driver, and the blocks are multiplied by the whitening
matrix. Products are split along the rows, so no task sees more than its blocks. The
covariance of the result is taken the same way and compared with the identity.

Blocks grow with the table so that Spark's plan of a product, which lists the blocks,
stays below ``MOST_BLOCKS`` entries.

Cases: rows whose vector is null, empty, or holds null or non-finite entries are left
out. Of vectors of different lengths those of the most frequent length take part (the
larger one in a tie). Entries beyond 2^52 / 64 count as that bound. A component
without variance (a constant table, one row, fewer rows than dimensions) has null in
``whitened``; ``explained`` is null if nothing varies. ``deviation`` is null where it
does not fit a long. Repeated rows and null ids are rows like others; other columns
are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.common import materialize, shuffle_parts

COMPONENTS = 32
#: Whole numbers per unit, and what is added to each.
SCALE, SHIFT = 64, 1_000_000
BOUND = 2.0**52
ROWS_PER_BLOCK, COLUMNS_PER_BLOCK = 2048, 1024
MOST_BLOCKS = 100_000


def _codes(df: DataFrame) -> DataFrame:
    """``vec_id, x``: sound vectors of the most frequent length as whole numbers."""
    vectors = df.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(
        "v IS NOT NULL AND size(v) > 0 AND forall(v, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))"
    )
    most = vectors.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return vectors.where(F.size("v") == (most["size"] if most else 0)).select(
        "vec_id",
        F.expr(
            f"transform(v, c -> CAST(floor(greatest(least({SCALE} * c, {BOUND}D), {-BOUND}D)) AS BIGINT) + {SHIFT})"
        ).alias("x"),
    )


def _indexed(df: DataFrame) -> DataFrame:
    """Stored rows with numbers 0 to n-1 in ``index``, without moving them."""
    stored = materialize(df.withColumn("_slot", F.monotonically_increasing_id()), "codes").withColumns(
        {"_part": F.shiftright("_slot", 33), "_at": F.col("_slot").bitwiseAND((1 << 33) - 1)}
    )
    # one row per file
    sizes = stored.groupBy("_part").count().orderBy("_part").collect()
    starts = np.cumsum([0, *[r["count"] for r in sizes]]).tolist()
    offsets = df.sparkSession.createDataFrame(
        [(r["_part"], a) for r, a in zip(sizes, starts)], "_part long, _start long"
    )
    return stored.join(offsets, "_part").withColumn("index", F.col("_start") + F.col("_at")).drop(
        "_part", "_start", "_at", "_slot"
    )


def block_matrix(rows: DataFrame, n: int, width: int, rows_per_block: int = ROWS_PER_BLOCK) -> BlockMatrix:
    """``index, values`` (an array of doubles) as blocks."""
    vectors = rows.select("index", array_to_vector("values").alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, width)
    return matrix.toBlockMatrix(max(rows_per_block, -(-n // MOST_BLOCKS)), min(width, COLUMNS_PER_BLOCK))


def scatter(matrix: BlockMatrix, n: int) -> np.ndarray:
    """The matrix' transpose times itself, its row blocks dealt to many tasks."""
    blocks = -(-n // matrix.rowsPerBlock)
    spark_parts = max(1, min(blocks, max(matrix.blocks.getNumPartitions(), blocks // 16)))
    left = matrix.transpose()
    product = left._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, spark_parts)
    local = BlockMatrix(product, left.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()
    return (local + local.T) / 2


def _rows(matrix: BlockMatrix) -> DataFrame:
    """The rows of a block matrix as ``index, values``."""
    java = matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model
    found = MLUtils.convertVectorColumnsToML(callMLlibFunc("getIndexedRows", java), "vector")
    return found.select("index", vector_to_array("vector").alias("values"))


def _whitening(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The matrix that whitens, the explained shares and which components vary."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    varies = values > max(values[0], 0.0) * len(covariance) * np.finfo(float).eps
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]
    vectors = vectors * np.where(largest < 0, -1.0, 1.0)
    matrix = np.where(varies, vectors / np.sqrt(np.where(varies, values, 1.0)), 0.0)
    trace = np.trace(covariance)
    return matrix, values / trace if trace > 0 else np.full(len(values), np.nan), varies


def whiten(df: DataFrame, components: int = COMPONENTS, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``vec_id, n, deviation, whitened, explained, identity_error``: a row per vector,
    with arrays of its whitened components and of the variances they explain."""
    spark = df.sparkSession
    codes = _indexed(_codes(df))
    bounds = codes.agg(
        F.count(F.lit(1)), F.first(F.size("x")), F.max(F.array_max("x")), F.min(F.array_min("x"))
    ).first()
    n, width, high, low = bounds
    id_type = df.schema["vec_id"].dataType.simpleString()
    if not n:
        return spark.createDataFrame([], f"vec_id {id_type}, n long, deviation long, whitened array<double>,"
                                     " explained array<double>, identity_error double")
    # longs where they surely hold every sum, else decimals: the same numbers
    largest = max(abs(high), abs(low))
    kind = "BIGINT" if n * largest < 2**62 else "DECIMAL(38, 0)"
    sums = (
        codes.select(F.posexplode("x").alias("i", "c")).groupBy("i")
        .agg(F.sum(F.expr(f"CAST(c AS {kind if kind == 'BIGINT' else 'DECIMAL(20, 0)'})")).alias("s"))
        .orderBy("i").collect()
    )
    listed = ", ".join(f"CAST('{r['s']}' AS {kind})" for r in sums)
    apart = f"transform(x, (c, i) -> CAST(CAST(c AS {kind}) * CAST({n} AS {kind}) - array({listed})[i] AS {kind}))"
    fits = width * (n * (high - low)) ** 2 < 2**63
    square = "BIGINT" if fits else "DECIMAL(38, 0)"
    summed = (
        f"aggregate(apart, CAST(0 AS {square}), (a, c) -> "
        + ("a + c * c)" if fits else f"CAST(a + try_multiply(CAST(c AS {square}), CAST(c AS {square})) AS {square}))")
    )
    centred = materialize(
        codes.withColumn("apart", F.expr(apart)).select(
            "index", "vec_id", F.expr(f"try_cast({summed} AS BIGINT)").alias("deviation"),
            F.expr(f"transform(apart, c -> CAST(c AS DOUBLE) / {n}D)").alias("values"),
        ),
        "centred",
    )
    blocks = block_matrix(centred, n, width, rows_per_block)
    k = min(components, width)
    matrix, explained, varies = _whitening(scatter(blocks, n) / n, k)

    step = blocks.colsPerBlock
    parts = [((no, 0), Matrices.dense(len(p), k, p.T.ravel().tolist()))
             for no, p in enumerate(np.split(matrix, range(step, width, step)))]
    whitener = BlockMatrix(spark.sparkContext.parallelize(parts, 1), step, k, width, k)
    projected = materialize(_rows(blocks.multiply(whitener)), "whitened")

    means = [r["m"] for r in projected.select(F.posexplode("values").alias("i", "c")).groupBy("i")
             .agg(F.avg("c").alias("m")).orderBy("i").collect()]
    again = projected.select("index", F.zip_with(
        "values", F.array(*map(F.lit, means)), lambda c, m: c - m).alias("values"))
    off = scatter(block_matrix(again, n, k, rows_per_block), n) / n - np.diag(varies.astype(float))
    return centred.select("index", "vec_id", "deviation").join(projected, "index").select(
        "vec_id", F.lit(n).cast("long").alias("n"), "deviation",
        F.zip_with("values", F.array(*[F.lit(bool(v)) for v in varies]), lambda c, v: F.when(v, c)).alias("whitened"),
        F.array(*[F.lit(None if np.isnan(e) else max(0.0, float(e))).cast("double") for e in explained]).alias("explained"),
        F.lit(float(np.abs(off).max())).alias("identity_error"),
    )
