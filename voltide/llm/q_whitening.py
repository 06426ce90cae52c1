"""Embedding whitening query; eigenvectors are beyond SQL, tests compare with numpy."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltide.llm.catalog import query
from voltide.llm.common import table
from voltide.llm.whitening import whiten


@query("op12_block_whitening")
def block_whitening(spark, sf):
    rows = whiten(table(spark, sf, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return rows.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )
