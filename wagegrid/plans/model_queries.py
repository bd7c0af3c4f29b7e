"""Classifiers on labelled documents (longer than the median stands in for paid above it).

SQL cannot train a model.  It states which rows every fold holds, which features there are
and which postings get a class; that the models tell the classes better than the bigger
class does is a column of the result.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagegrid import fixed_values, settings
from wagegrid.operators import features, models, positions, stats
from wagegrid.plans import standins
from wagegrid.plans.registry import query
from wagegrid.plans.term_queries import KEPT, PAIRS

#: Steps of a trainer that runs a job for each; its maker's default takes more.
QUICK_NET = models.neural_net(rate=0.05, max_iter=30)

#: Folds trained side by side: each keeps its own share of the rows.
PARALLEL = 3


def _postings(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled postings, joined once and written, as fitting reads them several times."""
    return settings.spread(
        settings.written(standins.labelled_postings(spark, folder), "postings")
    )


def training_rows(
    spark: SparkSession, folder: str, feature_set: str, k: int = fixed_values.FOLDS
) -> tuple[DataFrame, list[str]]:
    """doc_id, label, fold and features, written once for the many jobs of training."""
    rows = _postings(spark, folder)
    model = features.assemble(rows, feature_set)
    folded = positions.stratified_folds(rows.select("doc_id", "label"), "label", "doc_id", k)
    made = model.transform(rows).select("doc_id", "features").join(folded, "doc_id")
    return settings.written(made, "training", compact=True), features.feature_names(model)


def _folds_sql(k: int = fixed_values.FOLDS) -> str:
    return (
        f"SELECT fold, COUNT(*) AS n, true AS beats_baseline FROM (SELECT CAST(ntile({k}) OVER (PARTITION BY label "
        f"ORDER BY doc_id) - 1 AS INTEGER) AS fold FROM {standins.LABELLED}) GROUP BY fold"
    )


def _scored(spark, folder, feature_set, maker, k=fixed_values.FOLDS):
    """fold, n and whether the mean accuracy is above the share of the biggest class."""
    rows, _ = training_rows(spark, folder, feature_set, k)
    scored = settings.written(models.cross_validate(rows, maker, parallelism=PARALLEL), "scores")
    base = stats.baseline_accuracy(rows, "label").scalar()
    mean = stats.fold_summary(scored, "accuracy").select("mean_score").scalar()
    return scored.select("fold", "n", (mean > base).alias("beats_baseline"))


@query(
    "cross_validate",
    f"SELECT COUNT(DISTINCT fold) AS folds, true AS is_share, true AS beats_baseline FROM ({_folds_sql()})",
)
def cross_validate(spark, folder):
    """Mean and spread over the folds, told by what must hold of them."""
    rows, _ = training_rows(spark, folder, "synopses")
    scored = settings.written(models.cross_validate(rows, models.logistic(), parallelism=PARALLEL), "scores")
    base = stats.baseline_accuracy(rows, "label").scalar()
    found = stats.fold_summary(scored, "accuracy").crossJoin(F.broadcast(scored.agg(F.count("*").alias("folds"))))
    return found.select(
        "folds", (F.col("mean_score").between(0, 1) & F.col("sd_score").between(0, 0.5)).alias("is_share"),
        (F.col("mean_score") > base).alias("beats_baseline"),
    )


@query("random_forest", _folds_sql())
def random_forest(spark, folder):
    return _scored(spark, folder, "synopses", models.random_forest())


@query("logistic", _folds_sql())
def logistic(spark, folder):
    return _scored(spark, folder, "titles", models.logistic())


@query("linear_svm", _folds_sql())
def linear_svm(spark, folder):
    return _scored(spark, folder, "titles", models.linear_svm())


@query("rbf_svm", _folds_sql())
def rbf_svm(spark, folder):
    return _scored(spark, folder, "synopses", models.rbf_svm())


@query("gradient_boosting", _folds_sql())
def gradient_boosting(spark, folder):
    return _scored(spark, folder, "titles", models.gradient_boosting())


@query("boosted_trees", _folds_sql())
def boosted_trees(spark, folder):
    return _scored(spark, folder, "titles", models.boosted_trees())


@query("neural_net", _folds_sql(fixed_values.FOLDS_NEURAL_NET))
def neural_net(spark, folder):
    return _scored(
        spark, folder, "titles", QUICK_NET, fixed_values.FOLDS_NEURAL_NET
    )


_TITLE_TERMS = f"""
SELECT term FROM (SELECT unnest({PAIRS}) AS term FROM (SELECT {KEPT} AS kept FROM {standins.LABELLED}))
GROUP BY term ORDER BY COUNT(*) DESC, term LIMIT 30"""


@query(
    "feature_importance",
    f"""
WITH d AS (SELECT source, lang, {KEPT} AS kept FROM {standins.LABELLED})
SELECT 'city' AS block, COUNT(DISTINCT source) AS n, true AS is_share FROM d
UNION ALL SELECT 'state', COUNT(DISTINCT lang), true FROM d
UNION ALL SELECT 'title_terms', COUNT(*), true FROM ({_TITLE_TERMS})
UNION ALL SELECT 'synopsis_terms', least(50, COUNT(DISTINCT term)), true FROM (SELECT unnest(kept) AS term FROM d)""",
)
def feature_importance(spark, folder):
    """Importances by block: how many features have one, and that they are shares of one."""
    rows, names = training_rows(spark, folder, "synopses")
    forest = models.fit(rows, models.random_forest())
    found = models.feature_importance(spark, forest, names)
    total = F.lit(round(found.agg(F.sum("importance")).first()[0], 6))
    return found.groupBy(F.substring_index("name", "=", 1).alias("block")).agg(
        F.count("*").alias("n"), F.bool_and(F.col("importance").between(0, 1) & (total == 1)).alias("is_share")
    )


@query(
    "top_importances",
    "SELECT 20 AS n, true AS is_top",
)
def top_importances(spark, folder):
    """The strongest features: none that is left out is stronger than the last."""
    rows, names = training_rows(spark, folder, "synopses")
    found = models.feature_importance(spark, models.fit(rows, models.random_forest()), names)
    top = settings.written(stats.top_importance(found), "top")
    rest = found.join(top.select("name"), "name", "left_anti").agg(F.max("importance").alias("most"))
    held = top.agg(F.count("*").cast("int").alias("n"), F.min("importance").alias("least"))
    return held.crossJoin(F.broadcast(rest)).select("n", (F.col("least") >= F.coalesce("most", F.lit(0.0))).alias("is_top"))


def _weights(spark, folder, feature_set):
    rows, names = training_rows(spark, folder, feature_set)
    found = models.coefficients(spark, models.fit(rows, models.logistic()), names)
    return found.select("name", (~F.isnan("weight") & (F.abs("weight") < 100)).alias("weighed"))


@query("coefficients", f"SELECT 'title_terms=' || term AS name, true AS weighed FROM ({_TITLE_TERMS})")
def coefficients(spark, folder):
    """What each title term adds, of a fit on title terms alone."""
    return _weights(spark, folder, "title_terms")


@query(
    "coefficients_states",
    f"SELECT DISTINCT 'state=' || lang AS name, true AS weighed FROM {standins.LABELLED} WHERE lang IS NOT NULL",
)
def coefficients_states(spark, folder):
    """What each state adds, of a fit on the states alone."""
    return _weights(spark, folder, "states")


@query(
    "score_postings",
    "SELECT doc_id, true AS scored FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def score_postings(spark, folder):
    labelled = _postings(spark, folder)
    stages = features.feature_stages(labelled, "synopses")
    model = models.study(labelled, stages, models.logistic())
    rest = standins.unlabelled_postings(spark, folder)
    return models.score_postings(model, rest).select("doc_id", F.col("prediction").isin(0.0, 1.0).alias("scored"))


#: Smaller forests and fewer rounds, as the comparison trains 82 models.
_FOREST, _STUMPS = models.random_forest(trees=20), models.gradient_boosting(rounds=20)
_TREES, _NET = models.boosted_trees(rounds=5, rate=0.5), models.neural_net(rate=0.1, max_iter=15)

#: The runs of the study: model, features, what makes it, folds.
RUNS = [
    ("random forest", "places", _FOREST, 6),
    ("random forest", "flags", _FOREST, 6),
    ("random forest", "titles", _FOREST, 6),
    ("logistic", "titles", models.logistic(), 6),
    ("rbf svm", "titles", models.rbf_svm(), 6),
    ("linear svm", "titles", models.linear_svm(), 6),
    ("neural net", "titles", _NET, 5),
    ("gradient boosting", "titles", _STUMPS, 6),
    ("boosted trees", "titles", _TREES, 6),
    ("random forest", "synopses", _FOREST, 6),
    ("logistic", "synopses", models.logistic(), 6),
    ("rbf svm", "synopses", models.rbf_svm(), 6),
    ("logistic", "title_terms", models.logistic(), 6),
    ("logistic", "states", models.logistic(), 6),
]


@query(
    "compare_models",
    "SELECT model, features, true AS is_share, features NOT IN ('places', 'flags', 'states') AS beats_baseline FROM (VALUES "
    + ", ".join(f"('{model}', '{name}')" for model, name, _, _ in RUNS)
    + ") AS t(model, features)",
)
def compare_models(spark, folder):
    """All blocks are made once; each feature set puts its own side by side.

    Sets without words are not asked to beat the baseline.
    """
    rows = _postings(spark, folder)
    blocks = ("city", "state", "flags", "title_terms", "synopsis_terms")
    made = Pipeline(stages=features.block_stages(rows, blocks)).fit(rows).transform(rows)
    folded = rows.select("doc_id", "label")
    for k in sorted({k for *_, k in RUNS}):
        folded = positions.stratified_folds(folded, "label", "doc_id", k, name=f"fold{k}")
    stored = settings.written(
        made.select("doc_id", *blocks).join(folded, "doc_id"), "blocks", compact=True
    )
    base = stats.baseline_accuracy(stored, "label").scalar()
    scored = []
    for k in sorted({k for *_, k in RUNS}):
        runs = [(model, name, maker) for model, name, maker, folds in RUNS if folds == k]
        frames = {
            name: settings.written(
                features.assembler(name).transform(stored).select("label", F.col(f"fold{k}").alias("fold"), "features"), "frame"
            )
            for _, name, _ in runs
        }
        scored.append(models.compare_models(frames, runs, parallelism=PARALLEL))
    worded = ~F.col("features").isin("places", "flags", "states")
    return stats.append_all(scored).select(
        "model", "features", F.col("mean_score").between(0, 1).alias("is_share"),
        (worded & (F.col("mean_score") > base)).alias("beats_baseline"),
    )
