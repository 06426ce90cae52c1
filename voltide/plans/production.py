"""Training chain and production run as whole jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.operators import evaluate as ev
from voltide.operators import monitor
from voltide.operators.models import Scorer
from voltide.operators.select import feature_names, rank_features
from voltide.schema import require_columns
from voltide.session import materialize
from voltide.sources.files import append_predictions, metric_record, write_metric_records

TOP_FEATURES = 15


def train_chain(
    features: DataFrame,
    candidates: Sequence[str],
    settings: Mapping[str, float],
    k: int = TOP_FEATURES,
    label: str = "amount",
    **limits,
) -> tuple[Scorer, DataFrame]:
    """Rank candidates, keep the best ``k``, fit scaler and model on them."""
    rows = materialize(features.select("op_id", label, *candidates), "candidates")
    ranking = rank_features(rows, candidates, label, **limits)
    chosen = feature_names(ranking, k, "score_mean")
    return Scorer.train(rows, chosen, settings, label, **limits), ranking


def evaluate_against(predictions: DataFrame, actuals: DataFrame, key: str = "op_id") -> DataFrame:
    """Metrics of predictions whose actual values arrive in another table."""
    require_columns(predictions, [key, "predicted_amount"])
    paired = predictions.select(key, "predicted_amount").join(
        actuals.select(key, "amount"), key
    )
    return ev.evaluate(paired)


def production_run(
    batch: DataFrame,
    scorer: Scorer,
    training: DataFrame,
    out: str,
    run_ts,
    limits: Mapping[str, float] = ev.ALERT_LIMITS,
) -> tuple[DataFrame, DataFrame]:
    """Score a batch, measure drift and error, store predictions and the record.

    A run is named by its time: run again, it replaces what it stored. ``training`` holds the training mean and std per feature. Returns the scored
    rows as stored and the metric record.
    """
    spark = batch.sparkSession
    scored = materialize(scorer.score(batch, F.lit(run_ts).cast("timestamp")), "scored")
    run = run_ts.strftime("%Y%m%dT%H%M%S.%f")
    append_predictions(scored, f"{out}/predictions", run)
    base = training.where(F.col("feature").isin(list(scorer.features)))
    now = monitor.training_stats(scored, scorer.features)
    drift = monitor.compare_stats(base, now, limits["drift"]).collect()  # one row per feature
    metrics = ev.evaluate(scored, limits=limits).first().asDict()
    wanted = ("rmse", "mae", "r2", "mape", "rmse_alert", "mae_alert")
    record = metric_record(
        spark,
        run_ts,
        {m: metrics[m] for m in wanted if metrics[m] is not None},
        {r["feature"]: r.asDict() for r in drift},
    )
    write_metric_records(record, f"{out}/metrics", run)
    return scored, record

