"""Queries: files written from the tables and read back."""

from pyspark.sql import functions as F

from voltide.functions.errors import error_columns
from voltide.operators.clean import cast_lenient
from voltide.plans.catalog import query, rounded
from voltide.plans.oracle import r, sql
from voltide.plans.views import scored_events
from voltide.schema import rename_raw
from voltide.session import materialize, scratch_path
from voltide.sources import files
from voltide.sources.tables import read_table, trades_from_events, trades_from_orders

EXPORT = {
    "op_id": "op_id", "client_id": "Codigo del Cliente (IBS)", "close_ts": "Fecha de cierre",
    "amount": "Importe FX", "op_type": "Tipo de Operación", "spread": "Spread",
}


@query("src_two_header", sql("""
SELECT op_id, client_id, strftime(close_ts, '%Y-%m-%d') AS close_day, amount, op_type, spread
FROM ops_orders"""))
def src_two_header(spark, sf):
    t = trades_from_orders(spark, sf, list(EXPORT))
    path = scratch_path(spark, "export")
    files.write_two_header_export(t.withColumnsRenamed(EXPORT), path)
    back = rename_raw(files.read_two_header_export(spark, path, list(EXPORT.values())))
    back = cast_lenient(back, ["amount", "spread"])
    return back.select(
        F.col("op_id").cast("bigint").alias("op_id"),
        F.col("client_id").cast("bigint").alias("client_id"),
        F.date_format(F.to_timestamp("close_ts"), "yyyy-MM-dd").alias("close_day"),
        "amount", "op_type", "spread")


@query("src_csv_roundtrip", """
SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem""")
def src_csv_roundtrip(spark, sf):
    t = read_table(spark, sf, "lineitem")
    path = scratch_path(spark, "csv")
    files.write_csv(t, path)
    back = files.read_csv(spark, path, t.schema)
    return back.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query("src_multi_file", sql(f"""
SELECT op_id, client_id, amount, {r('predicted_amount', 'predicted_amount', 8)},
       TRUE AS has_file FROM scored_events""", "scored_events"))
def src_multi_file(spark, sf):
    t = scored_events(spark, sf).select("op_id", "client_id", "amount", "predicted_amount")
    root = scratch_path(spark, "predictions")
    t.repartition(4, "op_id").write.option("header", True).csv(f"{root}/predictions_1")
    schema = t.schema
    back = files.read_prediction_files(spark, f"{root}/predictions_*", schema)
    has_file = F.length("file_name") > 0
    return rounded(back.withColumn("has_file", has_file).drop("file_name"), 8, amount=6)


@query("src_csv_by_name", sql(f"""
SELECT op_id, CASE WHEN op_id % 3 <> 1 THEN client_id END AS client_id, amount,
  {r('predicted_amount', 'predicted_amount', 8)}, CASE WHEN op_id % 3 = 2 THEN 'late' END AS note,
  op_id % 3 AS batch FROM scored_events""", "scored_events"))
def src_csv_by_name(spark, sf):
    """Three batches of files: one in order, one shuffled and short of a column, one with more."""
    t = materialize(
        scored_events(spark, sf).select("op_id", "client_id", "amount", "predicted_amount"), "scored")
    root = scratch_path(spark, "by-name")
    batches = (["op_id", "client_id", "amount", "predicted_amount"],
               ["predicted_amount", "amount", "op_id"],
               ["client_id", "note", "op_id", "predicted_amount", "amount"])
    for k, names in enumerate(batches):
        part = t.where(F.col("op_id") % 3 == k).withColumn("note", F.lit("late"))
        part.select(*names).repartition(2, "op_id").write.option("header", True).csv(f"{root}/batch={k}")
    back = files.read_prediction_files(spark, f"{root}/batch=*", t.schema).drop("file_name")
    parts = back.withColumn("batch", F.col("op_id") % 3)
    return rounded(parts, 8, amount=6)


@query("union_batches", sql("""
SELECT op_id, amount, category, NULL::DOUBLE AS spread FROM ops_events
UNION ALL SELECT op_id, amount, NULL, spread FROM ops_orders"""))
def union_batches(spark, sf):
    events = trades_from_events(spark, sf).select("op_id", "amount", "category")
    orders = trades_from_orders(spark, sf, ["op_id", "amount", "spread"])
    return files.union_batches([events, orders])


@query("prediction_table", sql(f"""
SELECT strftime(CAST(close_ts AS DATE), '%Y-%m-%d') AS prediction_date, count(*) AS rows,
  {r('avg(abs(amount - predicted_amount))', 'mae', 8)} FROM scored_events GROUP BY 1""",
    "scored_events"))
def prediction_table(spark, sf):
    t = scored_events(spark, sf).withColumns(error_columns())
    path = scratch_path(spark, "prediction-table")
    files.append_predictions(t, path, "first", ts="close_ts")
    stored = spark.read.parquet(path)
    daily = stored.groupBy("prediction_date").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("abs_error").alias("mae"))
    return rounded(
        daily.withColumn("prediction_date", F.col("prediction_date").cast("string")), 8)


@query("prediction_reruns", sql("""
SELECT strftime(CAST(close_ts AS DATE), '%Y-%m-%d') AS prediction_date, 'daily' AS run_id, count(*) AS rows
FROM scored_events GROUP BY ALL
UNION ALL SELECT strftime(CAST(close_ts AS DATE), '%Y-%m-%d'), 'late', count(*)
FROM scored_events, (SELECT min(CAST(close_ts AS DATE)) + 5 AS d FROM scored_events)
WHERE CAST(close_ts AS DATE) > d GROUP BY ALL""", "scored_events"))
def prediction_reruns(spark, sf):
    """A run that is repeated, and one that is repeated with fewer days."""
    t = materialize(scored_events(spark, sf), "scored")
    path = scratch_path(spark, "prediction-table")
    first = t.agg(F.date_add(F.to_date(F.min("close_ts")), 5)).first()[0]
    late = t.where(F.to_date("close_ts") > F.lit(first))
    for run, rows in (("daily", t), ("late", t), ("daily", t), ("late", late)):
        files.append_predictions(rows, path, run, ts="close_ts")
    stored = spark.read.parquet(path).groupBy("prediction_date", "run_id")
    return stored.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "prediction_date", F.col("prediction_date").cast("string"))


@query("month_table", sql("""
SELECT strftime(close_ts, '%Y-%m') AS month_of, count(*) AS rows, round(sum(amount), 2) AS amount
FROM ops_orders WHERE close_ts >= TIMESTAMP '1998-01-01' GROUP BY ALL"""))
def month_table(spark, sf):
    """A table split by month; whole months are left out by folder."""
    path = scratch_path(spark, "months")
    trades = trades_from_orders(spark, sf, ["op_id", "close_ts", "amount"])
    files.write_table(trades, path, month_of="close_ts")
    recent = spark.read.parquet(path).where(F.col("month_of").cast("string") >= "1998-01")
    out = recent.groupBy(F.col("month_of").cast("string").alias("month_of")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount"))
    return rounded(out, 2)
