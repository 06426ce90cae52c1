"""Queries: feature scores, rankings, splits and folds."""

from pyspark.sql import functions as F

from voltide.operators import select, split
from voltide.plans.catalog import query, rounded, text_day
from voltide.plans.cleaning import load_trades
from voltide.plans.oracle import r, sql
from voltide.session import materialize, scratch_path
from voltide.sources import files
from voltide.sources.tables import trades_from_events, trades_from_orders

FEATURES = ("spread", "closed_rate", "amount_ma_5", "client_mean_amount", "daily_volume")


def _f_sql(view: str = "loaded") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, r2 * (n - 2) / (1 - r2) AS score FROM ("
        f"SELECT power(corr({c}, amount), 2) AS r2, count({c}) AS n FROM {view})"
        for c in FEATURES)


def _mi_sql(bins: int = 16) -> str:
    grid = "[" + ", ".join(str(i / bins) for i in range(1, bins)) + "]"
    names = (*FEATURES, "amount")
    edges = ", ".join(f"quantile_cont({c}, {grid}) AS {c}_e" for c in names)
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, len(list_filter({c}_e, lambda e: {c} > e)) AS a, "
        f"len(list_filter(amount_e, lambda e: amount > e)) AS b, count(*) AS n "
        f"FROM loaded, edges WHERE {c} IS NOT NULL GROUP BY 1, 2, 3" for c in FEATURES)
    return f"""
edges AS (SELECT {edges} FROM loaded),
cells AS ({cells}),
mi AS (SELECT feature, sum(n / total * ln(CAST(n AS DOUBLE) * total / (na * nb))) AS score FROM (
  SELECT *, sum(n) OVER (PARTITION BY feature) AS total,
         sum(n) OVER (PARTITION BY feature, a) AS na,
         sum(n) OVER (PARTITION BY feature, b) AS nb FROM cells) GROUP BY feature)"""


def loaded(spark, sf):
    return load_trades(trades_from_orders(spark, sf)).select("op_id", "amount", *FEATURES)


def stored(spark, sf):
    """Read several times by the operators that fit quantiles first."""
    return materialize(loaded(spark, sf), "loaded")


@query("f_scores", sql(f"SELECT feature, {r('score', 'score', 4)} FROM ({_f_sql()})", "loaded"))
def f_scores(spark, sf):
    return rounded(select.score_features(loaded(spark, sf), FEATURES), 4)


@query("mi_scores", sql(f"SELECT feature, {r('score', 'score')} FROM mi", "loaded",
                        extra=_mi_sql()))
def mi_scores(spark, sf):
    return rounded(select.mutual_information(stored(spark, sf), FEATURES))


@query("feature_ranking", sql(f"""
SELECT feature, {r('f.score', 'score_f', 4)}, {r('mi.score', 'score_mi')},
  {r('(f.score + mi.score) / 2', 'score_mean', 4)},
  (rank() OVER (ORDER BY f.score DESC) + rank() OVER (ORDER BY mi.score DESC)) / 2 AS rank_mean
FROM ({_f_sql()}) f JOIN mi USING (feature)""", "loaded", extra=_mi_sql()))
def feature_ranking(spark, sf):
    out = select.rank_features(stored(spark, sf), FEATURES)
    return rounded(out, score_f=4, score_mean=4)


@query("top_features", sql(
    f"SELECT feature, {r('score', 'score', 4)} FROM ({_f_sql()}) "
    "ORDER BY score DESC, feature LIMIT 3", "loaded"))
def top_features(spark, sf):
    scores = select.score_features(loaded(spark, sf), FEATURES)
    return rounded(select.top_features(scores, 3), 4)


def _matrix_sql() -> str:
    # the three best features are chosen per table, so the check lists every
    # feature's scaled value and the rank decides which are kept
    filled = ", ".join(f"coalesce({c}, median({c}) OVER ()) AS {c}" for c in FEATURES)
    values = " UNION ALL ".join(
        f"SELECT op_id, amount, '{c}' AS feature, ({c} - avg({c}) OVER ()) / "
        f"coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS z FROM filled" for c in FEATURES)
    return sql(f"""
SELECT op_id, amount, feature, {r('z', 'z')} FROM ({values}) WHERE feature IN (
  SELECT feature FROM ({_f_sql('filled')}) ORDER BY score DESC, feature LIMIT 3)""",
        "loaded", extra=f"filled AS (SELECT op_id, amount, {filled} FROM loaded)")


@query("selected_matrix", _matrix_sql())
def selected_matrix(spark, sf):
    matrix, _ = select.selected_matrix(stored(spark, sf), FEATURES, k=3)
    names = [c for c in matrix.columns if c not in ("op_id", "amount")]
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("z")) for c in names])
    long = matrix.select("op_id", "amount", F.explode(pairs).alias("p"))
    return rounded(long.select("op_id", "amount", "p.*"))


@query("selection_report", sql(
    f"SELECT feature, {r('score', 'score', 4)}, "
    "row_number() OVER (ORDER BY score DESC, feature) <= 3 AS selected, "
    f"{len(FEATURES)} AS features_before FROM ({_f_sql('filled')})", "loaded",
    extra="filled AS (SELECT op_id, amount, "
          + ", ".join(f"coalesce({c}, median({c}) OVER ()) AS {c}" for c in FEATURES)
          + " FROM loaded)"))
def selection_report(spark, sf):
    _, report = select.selected_matrix(stored(spark, sf), FEATURES, k=3)
    return rounded(report, 4)


_DIGIT = "(strpos('0123456789abcdef', substr(md5(CAST(op_id AS VARCHAR)), {0}, 1)) - 1)"
BUCKET = "(" + " + ".join(f"{_DIGIT.format(i)} * {16 ** (12 - i)}" for i in range(1, 13)) + ")"


@query("hash_split", sql(
    f"SELECT op_id, CASE WHEN {BUCKET} % 100 < 80 THEN 'train' ELSE 'test' END AS split "
    "FROM ops_orders"))
def hash_split(spark, sf):
    return split.hash_split(trades_from_orders(spark, sf, ["op_id"]))


@query("cv_folds", sql(f"SELECT op_id, CAST({BUCKET} % 5 AS INT) AS fold FROM ops_orders"))
def cv_folds(spark, sf):
    return split.cv_folds(trades_from_orders(spark, sf, ["op_id"]))


@query("temporal_split", sql("""
SELECT op_id, CASE WHEN epoch_us(close_ts) <= (
  SELECT quantile_cont(CAST(epoch_us(close_ts) AS DOUBLE), 0.8) FROM ops_events)
  THEN 'train' ELSE 'test' END AS split FROM ops_events"""))
def temporal_split(spark, sf):
    t = trades_from_events(spark, sf).select("op_id", "close_ts")
    return split.temporal_split(t).select("op_id", "split")


@query("split_report", sql("""
SELECT split, count(*) AS rows, strftime(min(close_ts), '%Y-%m-%d %H:%M:%S') AS first_ts,
  strftime(max(close_ts), '%Y-%m-%d %H:%M:%S') AS last_ts, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM (SELECT close_ts, CASE WHEN epoch_us(close_ts) <= (
  SELECT quantile_cont(CAST(epoch_us(close_ts) AS DOUBLE), 0.8) FROM ops_events)
  THEN 'train' ELSE 'test' END AS split FROM ops_events) GROUP BY split"""))
def split_report(spark, sf):
    t = trades_from_events(spark, sf).select("op_id", "close_ts")
    out = split.split_report(split.temporal_split(t))
    at = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_ts", "last_ts")}
    return rounded(out.withColumns(at))


@query("artifact_roundtrip", sql(
    f"SELECT feature, {r('score', 'importance', 4)} FROM ({_f_sql()})", "loaded"))
def artifact_roundtrip(spark, sf):
    """Scores to an importance file and a feature list, then back and joined."""
    scores = rounded(select.score_features(loaded(spark, sf), FEATURES), 4)
    path = scratch_path(spark, "artifacts")
    files.write_csv(scores.select("feature", F.col("score").alias("importance")), f"{path}/importance")
    scores.select("feature").write.text(f"{path}/features")
    listed = files.read_feature_list(spark, f"{path}/features")
    return listed.join(files.read_importance(spark, f"{path}/importance"), "feature")


@query("positional_split", sql("""
SELECT op_id, row_index, CASE WHEN row_index < floor(n * 0.8) THEN 'train' ELSE 'test' END
  AS split
FROM (SELECT op_id, row_number() OVER (ORDER BY close_ts, op_id) - 1 AS row_index,
             count(*) OVER () AS n FROM ops_orders)"""))
def positional_split(spark, sf):
    t = trades_from_orders(spark, sf, ["op_id", "close_ts"])
    return split.positional_split(t).select("op_id", "row_index", "split")


@query("temporal_folds", sql("""
SELECT CAST(fold AS INT) AS fold, CAST(m AS INT) AS month_index, n AS test_rows, train_rows,
  strftime(first, '%Y-%m-%d') AS test_start, strftime(last, '%Y-%m-%d') AS test_end
FROM (SELECT *, row_number() OVER (ORDER BY m) - 1 AS fold, CAST(sum(n) OVER (
        ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS train_rows
      FROM (SELECT year(close_ts) * 12 + month(close_ts) - 1 AS m, count(*) AS n,
                   min(close_ts) AS first, max(close_ts) AS last FROM ops_orders GROUP BY 1))
WHERE train_rows IS NOT NULL"""))
def temporal_folds(spark, sf):
    t = split.temporal_folds(trades_from_orders(spark, sf, ["op_id", "close_ts"]))
    return t.withColumns({"test_start": text_day("test_start"), "test_end": text_day("test_end")})
