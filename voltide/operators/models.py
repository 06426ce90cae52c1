"""Boosted trees, grid search, stacking and batch scoring with spark.ml."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import product
from math import prod

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide.operators.clean import check_batch, impute_median, null_if_not_finite
from voltide.operators.evaluate import evaluate
from voltide.operators.quantiles import quantiles
from voltide.operators.scale import StandardScale
from voltide.operators.split import id_bucket
from voltide.session import checkpoint_folder, materialize

# The two search grids.
TRAINING_GRID = {
    "max_depth": [3, 5, 7, 9],
    "learning_rate": [0.01, 0.05, 0.1],
    "n_estimators": [100, 200, 300],
    "min_child_weight": [1, 3, 5],
    "subsample": [0.8, 0.9, 1.0],
    "colsample_bytree": [0.8, 0.9, 1.0],
}
COMPARISON_GRID = {
    "n_estimators": [500, 1000],
    "max_depth": [5, 7],
    "learning_rate": [0.01, 0.05],
    "subsample": [0.8, 0.9],
    "colsample_bytree": [0.8, 0.9],
    "min_child_weight": [1, 3],
    "gamma": [0, 0.1],
}
STACKED_BASES = (
    {"n_estimators": 1000, "learning_rate": 0.01, "max_depth": 7, "subsample": 0.8,
     "colsample_bytree": 0.8, "seed": 42},
    {"n_estimators": 1000, "learning_rate": 0.05, "max_depth": 5, "subsample": 0.9,
     "colsample_bytree": 0.9, "seed": 43},
)
SMALL_GRID = {"max_depth": [2, 3], "n_estimators": [5]}

# Names of boosted-tree settings -> GBTRegressor parameters.
SETTINGS = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "min_child_weight": "minInstancesPerNode",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "gamma": "minInfoGain",
    "seed": "seed",
}


def boosted_trees(
    settings: Mapping[str, float], label: str = "amount", output: str = "predicted_amount"
) -> GBTRegressor:
    """A booster; rows keep the tree node they are in, and its lineage is cut every ten trees.

    That needs a checkpoint folder, the one of ``spark.checkpoint.dir``.
    """
    checkpoint_folder(SparkSession.active())
    model = GBTRegressor(
        featuresCol="features", labelCol=label, predictionCol=output, seed=42,
        cacheNodeIds=True, checkpointInterval=10,
    )
    return model.copy(_param_map(model, settings))


def _param_map(model: GBTRegressor, settings: Mapping[str, float]) -> dict:
    out = {}
    for name, value in settings.items():
        if name == "colsample_bytree":
            value = str(float(value))
        elif name == "gamma":
            value = float(value)
        out[model.getParam(SETTINGS[name])] = value
    return out


# Penalties of the blend that are tried.
BLEND_ALPHAS = (0.1, 1.0, 10.0)

#: Rows of a task of a stacked fit: each tree takes a job for every level, so a small
#: table in many tasks spends its time on starting them.
STACK_ROWS = 100_000


def grid_size(grid: Mapping[str, Sequence]) -> int:
    return prod(len(v) for v in grid.values())


def assembled(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def with_folds(df: DataFrame, columns: Sequence[str], folds: int, label: str) -> DataFrame:
    """Ids, ``columns`` and the fold of each row, stored: every pass of every fit reads the
    fold, and its digest costs more than the rest of the row."""
    return materialize(df.select("op_id", *columns).withColumn("fold", id_bucket(folds)), label)


def staged_settings(grid: Mapping[str, Sequence]) -> list[tuple[dict, list[int]]]:
    """The settings of a grid without the number of trees, each with the numbers wanted."""
    trees = sorted(grid.get("n_estimators", [20]))
    rest = {k: v for k, v in grid.items() if k != "n_estimators"}
    return [(dict(zip(rest, values)), trees) for values in product(*rest.values())]


def staged_errors(
    ready: DataFrame, held: DataFrame, settings: Mapping[str, float], trees: Sequence[int], label: str
) -> list[float]:
    """RMSE on ``held`` after each of ``trees`` trees, from one fit of the largest number.

    The first trees of a booster do not depend on how many follow.
    """
    model = boosted_trees({**settings, "n_estimators": max(trees)}, label).fit(ready)
    squares = model.evaluateEachIteration(held, "squared")
    return [squares[n - 1] ** 0.5 for n in trees]


def search(
    df: DataFrame,
    features: Sequence[str],
    label: str = "amount",
    grid: Mapping[str, Sequence] = SMALL_GRID,
    folds: int = 3,
    parallelism: int = 4,
    base: Mapping[str, float] | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Cross-validated grid search: best model, and one result row per setting.

    One fit per fold serves all numbers of trees, so ``TRAINING_GRID`` takes 324 fits a
    fold for its 972 rows. Folds are fixed by id, so a lost task sees the same folds
    again. A fold without rows counts for nothing.
    """
    spark = df.sparkSession
    stored = with_folds(df, [label, *features], folds, "search")
    ready = assembled(features).transform(stored).select("fold", label, "features")
    sizes = {r["fold"]: r["count"] for r in ready.groupBy("fold").count().collect()}
    used = [k for k in range(folds) if 0 < sizes.get(k, 0) < sum(sizes.values())]
    staged = staged_settings(grid)

    def errors(job: tuple[int, int]) -> list[float]:
        at, fold = job
        settings, trees = staged[at]
        rest, held = ready.where(F.col("fold") != fold), ready.where(F.col("fold") == fold)
        return staged_errors(rest, held, {**(base or {}), **settings}, trees, label)

    jobs = [(at, fold) for at in range(len(staged)) for fold in used]
    with ThreadPoolExecutor(parallelism) as pool:
        found = dict(zip(jobs, pool.map(inheritable_thread_target(spark)(errors), jobs)))
    rows = []
    for at, (settings, trees) in enumerate(staged):
        for k, n in enumerate(trees):
            scores = [found[at, fold][k] for fold in used]
            mean = sum(scores) / len(scores)
            spread = (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5
            rows.append(({**settings, "n_estimators": n}, mean, spread))
    rows.sort(key=lambda r: r[1])
    best = fit(stored, features, {**(base or {}), **rows[0][0]}, label)
    results = spark.createDataFrame(
        [({k: float(v) for k, v in s.items()}, m, d) for s, m, d in rows],
        "settings map<string,double>, rmse double, std double",
    )
    return best, results


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    settings: Mapping[str, float],
    label: str = "amount",
    folds: int = 5,
) -> DataFrame:
    """RMSE of one setting on each fold held out, with mean and spread over the folds."""
    rows = with_folds(df, [label, *features], folds, "folds")
    found = []
    for k in range(folds):
        model = fit(rows.where(F.col("fold") != k), features, settings, label)
        held = model.transform(rows.where(F.col("fold") == k))
        square = F.pow(F.col(label) - F.col("predicted_amount"), 2)
        found.append((k, *held.agg(F.count(F.lit(1)), F.sqrt(F.avg(square))).first()))
    table = df.sparkSession.createDataFrame(found, "fold int, rows bigint, rmse double")
    # one row per fold
    every = Window.partitionBy(F.lit(0))
    return table.withColumns(
        {"rmse_mean": F.avg("rmse").over(every), "rmse_std": F.stddev_pop("rmse").over(every)}
    )


def fit(
    df: DataFrame,
    features: Sequence[str],
    settings: Mapping[str, float],
    label: str = "amount",
    output: str = "predicted_amount",
) -> PipelineModel:
    return Pipeline(stages=[assembled(features), boosted_trees(settings, label, output)]).fit(df)


def holdout_metrics(model: PipelineModel, test: DataFrame, label: str = "amount") -> DataFrame:
    return evaluate(model.transform(test), actual=label)


def importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Model importance per feature, largest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(f, "boosted_trees", float(v)) for f, v in zip(features, values)]
    spark = SparkSession.active()
    return spark.createDataFrame(rows, "feature string, method string, score double").orderBy(
        F.desc("score"), "feature"
    )


@dataclass(frozen=True)
class Stacked:
    """Boosted models whose out-of-fold predictions feed a ridge regression."""

    bases: list[PipelineModel]
    weights: list[float]
    intercept: float

    def transform(self, df: DataFrame, output: str = "predicted_amount") -> DataFrame:
        names = df.columns
        for model in self.bases:
            df = model.transform(df).drop("features")
        blend = F.lit(self.intercept)
        for i, w in enumerate(self.weights):
            blend = blend + F.lit(w) * F.col(f"base_{i}")
        return df.select(*names, blend.alias(output))


def stack(
    df: DataFrame,
    features: Sequence[str],
    label: str = "amount",
    bases: Sequence[Mapping[str, float]] = STACKED_BASES,
    folds: int = 3,
    alphas: Sequence[float] = BLEND_ALPHAS,
) -> Stacked:
    """Fit on all rows but one fold, predict that fold, then blend and refit.

    The blend's penalty is the one of ``alphas`` with the least error over folds.
    Fits do not depend on each other, so as many run at once as there are cores for.
    """
    spark = df.sparkSession
    rows = with_folds(df, [label, *features], folds, "stack")
    tasks = -(-max(rows.count(), 1) // STACK_ROWS)
    rows = rows.coalesce(tasks)
    # small tables leave cores to other fits, large ones are fitted one after the other
    at_once = max(1, spark.sparkContext.defaultParallelism // tasks)

    def fitted(job: tuple[int, int]) -> PipelineModel:
        k, i = job
        return fit(rows.where(F.col("fold") != k), features, bases[i], label, f"base_{i}")

    # no row is in fold ``folds``: the last fits are those on all rows
    jobs = [(k, i) for k in range(folds + 1) for i in range(len(bases))]
    parts = []
    with ThreadPoolExecutor(min(at_once, len(jobs))) as pool:
        found = pool.map(inheritable_thread_target(spark)(fitted), jobs)
        for k in range(folds):
            held = rows.where(F.col("fold") == k)
            for _ in bases:
                held = next(found).transform(held).drop("features")
            # stored at once, as the models of a fold are large and not needed again
            parts.append(materialize(
                held.select("fold", label, *[f"base_{i}" for i in range(len(bases))]), "out-of-fold"
            ))
        refit = list(found)
    out_of_fold = parts[0]
    for p in parts[1:]:
        out_of_fold = out_of_fold.unionByName(p)
    n = max(out_of_fold.count(), 1)
    ready = assembled([f"base_{i}" for i in range(len(bases))]).transform(out_of_fold)
    ridge = LinearRegression(
        featuresCol="features", labelCol=label, elasticNetParam=0.0, standardization=False
    )
    if len(alphas) > 1:
        blend = CrossValidator(
            estimator=ridge,
            estimatorParamMaps=[{ridge.regParam: a / n} for a in alphas],
            evaluator=RegressionEvaluator(labelCol=label, metricName="rmse"),
            numFolds=folds,
            foldCol="fold",
        ).fit(ready).bestModel
    else:
        blend = ridge.copy({ridge.regParam: alphas[0] / n}).fit(ready)
    return Stacked(refit, [float(w) for w in blend.coefficients], float(blend.intercept))


class InvalidBatch(ValueError):
    """A batch that may not be scored."""


@dataclass(frozen=True)
class Scorer:
    """Features, scaler and model that score validated batches."""

    features: tuple[str, ...]
    scaler: StandardScale
    model: PipelineModel
    medians: dict[str, float | None] = field(default_factory=dict)

    @classmethod
    def train(
        cls, df: DataFrame, features: Sequence[str], settings: Mapping[str, float],
        label: str = "amount", **limits,
    ) -> Scorer:
        """Scaler and model see training rows only."""
        rows = null_if_not_finite(materialize(df.select(label, *features), "train"))
        filled = impute_median(rows, features, **limits)
        scaler = StandardScale.fit(filled, features)
        found = quantiles(rows, features, [0.5], **limits)
        model = fit(scaler.transform(filled), features, settings, label)
        return cls(tuple(features), scaler, model, {f: found[f][0] for f in features})

    def prepare(self, batch: DataFrame) -> DataFrame:
        """Impute with the training medians, then scale; the raw columns keep their values.

        A batch and a stream of the same rows are prepared alike.
        """
        names = {f: f"_raw_{f}" for f in self.features}
        kept = batch.withColumns({raw: F.col(f) for f, raw in names.items()})
        doubles = kept.withColumns({f: F.col(f).cast("double") for f in self.features})
        filled = null_if_not_finite(doubles, self.features).withColumns(
            {f: F.coalesce(F.col(f), F.lit(m).cast("double")) for f, m in self.medians.items()}
        )
        return self.scaler.transform(filled)

    def score(self, batch: DataFrame, run_ts, nulls_fail: bool = False) -> DataFrame:
        problems = check_batch(batch, self.features, nulls_fail)
        if problems:
            raise InvalidBatch("; ".join(problems))
        return self._predict(self.prepare(batch), batch.columns, run_ts)

    def score_stream(self, batch: DataFrame, run_ts) -> DataFrame:
        """Score a stream; columns are checked before it starts."""
        missing = [f for f in self.features if f not in batch.columns]
        if missing:
            raise InvalidBatch(f"missing columns: {', '.join(missing)}")
        return self._predict(self.prepare(batch), batch.columns, run_ts)

    def _predict(self, prepared: DataFrame, columns: Sequence[str], run_ts) -> DataFrame:
        scored = self.model.transform(prepared)
        back = [
            F.col(f"_raw_{c}").alias(c) if c in self.features else F.col(c) for c in columns
        ]
        return scored.select(*back, "predicted_amount", run_ts.alias("prediction_timestamp"))

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        self.scaler.save(spark, f"{path}/scaler")
        order = [(i, f, self.medians.get(f)) for i, f in enumerate(self.features)]
        spark.createDataFrame(order, "position int, feature string, median double").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Scorer:
        rows = spark.read.parquet(f"{path}/features").orderBy("position").collect()
        return cls(
            tuple(r["feature"] for r in rows),
            StandardScale.load(spark, f"{path}/scaler"),
            PipelineModel.load(f"{path}/model"),
            {r["feature"]: r["median"] for r in rows},
        )
