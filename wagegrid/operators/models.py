"""Classifiers, cross-validation, importances and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagegrid import fixed_values, settings
from wagegrid.operators import stats
from wagegrid.operators.boosting import SecondOrderTrees
from wagegrid.operators.forest import Forest
from wagegrid.operators.linear import Logistic, Svm
from wagegrid.operators.neural import RectifiedNet
from wagegrid.operators.stages import FourierFeatures, NystroemFeatures

#: (rows to train on, places of the feature vector) -> estimator
Maker = Callable[[int, int], Estimator]

#: Runs that ``compare_models`` trains side by side, each with folds side by side.
RUNS_AT_ONCE = 3


def random_forest(
    trees: int = fixed_values.TREES, max_depth: int = 30, seed: int = 0, **options
) -> Maker:
    """Trees grown to a depth that is near enough to growing them out.

    Spark's forest keeps all nodes on the driver; it is taken for its own ``options`` alone.
    """
    if options:
        return lambda n, d: RandomForestClassifier(numTrees=trees, maxDepth=max_depth, seed=seed, **options)
    return lambda n, d: Forest(numInputs=d, numTrees=trees, maxDepth=max_depth, seed=seed)


def logistic(c: float = 1.0, elastic_net: float = 0.0, max_iter: int = 100) -> Maker:
    """Penalty ``1/(c n)`` per row; ``elastic_net=1`` makes it an L1 penalty."""
    return lambda n, d: Logistic(
        regParam=1.0 / (c * n), elasticNetParam=elastic_net, standardization=False,
        maxIter=max_iter,
    )


def linear_svm(c: float = 1.0, max_iter: int = 100) -> Maker:
    return lambda n, d: Svm(
        regParam=1.0 / (c * n), standardization=False, maxIter=max_iter
    )


def rbf_svm(
    c: float = 1.0, gamma: float | None = None, features: int = 128, seed: int = 1,
    max_iter: int = 100, landmarks: bool = True,
) -> Maker:
    """A radial machine, near enough: kernel features and a linear machine.

    Features come from ``features`` landmarks of the data, or at random without ``landmarks``.
    """

    def make(n: int, d: int) -> Estimator:
        if landmarks:
            lift = NystroemFeatures(landmarks=features, gamma=1.0 / max(d, 1) if gamma is None else gamma, seed=seed)
        else:
            lift = FourierFeatures(numInputs=d, numOutputs=features, gamma=gamma, seed=seed)
        flat = Svm(
            featuresCol=lift.getOutputCol(), regParam=1.0 / (c * n), standardization=False,
            maxIter=max_iter,
        )
        return Pipeline(stages=[lift, flat])

    return make


def gradient_boosting(rounds: int = 100, rate: float = 1.0, seed: int = 0) -> Maker:
    """Boosted stumps."""
    return lambda n, d: GBTClassifier(maxIter=rounds, stepSize=rate, maxDepth=1, seed=seed)


def boosted_trees(
    rounds: int = 100, rate: float = 0.1, max_depth: int = 3, penalty: float = 1.0
) -> Maker:
    """Trees boosted by gradients and curvatures, leaves with a penalty."""
    return lambda n, d: SecondOrderTrees(rounds=rounds, rate=rate, maxDepth=max_depth, penalty=penalty)


def neural_net(
    hidden: int = 100, rate: float = 0.01, max_iter: int = 200, seed: int = 1, alpha: float = 1e-4
) -> Maker:
    """One hidden layer of rectified units, a penalty on squared weights."""
    return lambda n, d: RectifiedNet(
        numInputs=d, hidden=hidden, alpha=alpha, rate=rate, maxIter=max_iter, seed=seed
    )


def _sizes(df: DataFrame) -> tuple[int, int]:
    first = df.select("features").first()
    return df.count(), 0 if first is None else first[0].size


def fit(df: DataFrame, maker: Maker, label: str = "label") -> Model:
    """Fit on all rows of ``features`` and ``label``."""
    n, d = _sizes(df)
    estimator = maker(n, d)
    _last_stage(estimator).setLabelCol(label)
    return estimator.fit(df)


def predictions(model: Model, df: DataFrame) -> DataFrame:
    """``df`` with a ``prediction`` column; columns made on the way are left out."""
    return model.transform(df).select(*df.columns, "prediction")


def _last_stage(estimator: Estimator) -> Estimator:
    return estimator.getStages()[-1] if isinstance(estimator, Pipeline) else estimator


def _trained_together(
    df: DataFrame, estimators: dict[int, Estimator], label: str, fold: str, parallelism: int
) -> dict[int, Model] | None:
    """Models of all folds by estimators that train them in the same jobs (``fit_folds``), or None.

    Stages in front of the last are fitted fold by fold, side by side; the last gets their rows
    with the number of the fold that is left out.
    """
    first = next(iter(estimators.values()), None)
    if not hasattr(_last_stage(first), "fit_folds"):
        return None
    if not isinstance(first, Pipeline):
        return first.fit_folds(df, fold, estimators)

    def lifted(number: int) -> PipelineModel:
        return Pipeline(stages=estimators[number].getStages()[:-1]).fit(df.where(F.col(fold) != number))

    lifts, lasts = _side_by_side(df, lifted, estimators, parallelism), {n: _last_stage(e) for n, e in estimators.items()}
    rows = reduce(DataFrame.unionByName, [
        lift.transform(df.where(F.col(fold) != n)).select(label, lasts[n].getFeaturesCol(), F.lit(n).alias("_left_out"))
        for n, lift in lifts.items()
    ])
    made = next(iter(lasts.values())).fit_folds(rows, "_left_out", lasts, own=True)
    return made and {n: PipelineModel(stages=[*lifts[n].stages, model]) for n, model in made.items()}


def _side_by_side(df: DataFrame, one: Callable[[int], Model], numbers: Iterable[int], parallelism: int) -> dict[int, Model]:
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        jobs = {n: pool.submit(inheritable_thread_target(df.sparkSession)(one), n) for n in numbers}
        return {n: job.result() for n, job in jobs.items()}


def cross_validate(
    df: DataFrame, maker: Maker, *, label: str = "label", fold: str = "fold",
    parallelism: int = 4,
) -> DataFrame:
    """Accuracy of every fold by a model trained on the others: ``fold``, ``n``, ``accuracy``.

    Folds are trained in the same jobs by an estimator that can (``fit_folds``), or else side by
    side, so that the small jobs of one do not wait for those of another.  Only fold numbers and sizes come to the driver;
    predictions are counted where they are made.
    """
    _, d = _sizes(df)
    counts = {r[fold]: r.n for r in df.groupBy(fold).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())

    estimators = {number: maker(total - counts[number], d) for number in sorted(counts)}
    for estimator in estimators.values():
        _last_stage(estimator).setLabelCol(label)

    def trained(number: int) -> Model:
        return estimators[number].fit(df.where(F.col(fold) != number))

    made = _trained_together(df, estimators, label, fold, parallelism)
    if made is None:
        made = _side_by_side(df, trained, estimators, parallelism)
    scored = [predictions(model, df.where(F.col(fold) == number)) for number, model in made.items()]
    right = (F.col("prediction") == F.col(label)).cast("int")
    return (
        reduce(DataFrame.unionByName, [s.select(fold, label, "prediction") for s in scored])
        .groupBy(fold)
        .agg(F.count("*").alias("n"), F.avg(right).alias("accuracy"))
    )


def compare_models(
    frames: dict[str, DataFrame], runs: list[tuple[str, str, Maker]], **options
) -> DataFrame:
    """``model``, ``features``, mean and sd of accuracy for (model, feature set, maker) runs.

    ``RUNS_AT_ONCE`` runs go on side by side, as the jobs of a step are too short to fill the cores.
    """

    def one(name: str, feature_set: str, maker: Maker) -> DataFrame:
        return cross_validate(frames[feature_set], maker, **options).select(
            F.lit(name).alias("model"), F.lit(feature_set).alias("features"), "accuracy"
        )

    with ThreadPoolExecutor(max_workers=RUNS_AT_ONCE) as pool:
        session = next(iter(frames.values())).sparkSession
        jobs = [pool.submit(inheritable_thread_target(session)(one), *run) for run in runs]
        scored = [job.result() for job in jobs]
    return stats.fold_summary(stats.append_all(scored), "accuracy", by=("model", "features"))


def _last(model: Model) -> Model:
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def _named(spark, names: list[str], values: list[float], column: str) -> DataFrame:
    rows = [(name, float(value)) for name, value in zip(names, values, strict=True)]
    return spark.createDataFrame(rows, f"name string, {column} double")


def feature_importance(spark, model: Model, names: list[str]) -> DataFrame:
    """``name`` and ``importance`` by a tree model, one row per feature."""
    return _named(spark, names, _last(model).featureImportances.toArray(), "importance")


def coefficients(spark, model: Model, names: list[str]) -> DataFrame:
    """``name`` and signed ``weight`` by a linear model, lowest first."""
    weights = _named(spark, names, _last(model).coefficients.toArray(), "weight")
    return weights.orderBy("weight", "name")


def study(
    labelled: DataFrame, stages: list, maker: Maker, label: str = "label"
) -> PipelineModel:
    """One pipeline from posting rows to predictions, so that scoring rows
    without a salary uses the vocabularies and places of training.
    """
    features = Pipeline(stages=stages).fit(labelled)
    rows = features.transform(labelled).select(label, "features")
    model = fit(settings.written(rows, "study", compact=True), maker, label)
    return PipelineModel(stages=[*features.stages, model])


def score_postings(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Predicted class of postings."""
    return predictions(model, rows)
