"""Features and classifiers on a small table whose classes can be told apart."""

import math
import threading
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from wagegrid.operators import (
    boosting,
    dictionaries,
    features,
    linear,
    models,
    neural,
    positions,
    sparse_rows,
    stages,
    stats,
)
from wagegrid.plans import model_queries


@pytest.fixture(scope="module")
def postings(spark):
    draw = random.Random(3)
    rows = []
    for i in range(120):
        high = i % 2
        title = "Senior machine learning scientist" if high else "Junior data analyst"
        place = draw.choice(["New York", "Austin", None])
        rows.append((i, title, f"work with {'models' if high else 'sheets'} daily", place,
                     " NY" if place == "New York" else " TX", high))
    names = "id int, Title string, Synopsis string, City string, `State Initials` string, label int"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="module")
def training(postings):
    model = features.assemble(postings, "synopses")
    folded = positions.stratified_folds(postings.select("id", "label"), "label", "id", 3)
    made = model.transform(postings).select("id", "features").join(folded, "id").coalesce(1).persist()
    return made, features.feature_names(model)


def test_one_hot(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "c string")
    assert [tuple(r) for r in features.one_hot(df, "c").collect()] == [
        ("b", 0, 1), ("a", 1, 0), (None, 0, 0), ("a", 1, 0),
    ]
    model = Pipeline(stages=features.one_hot_stages("c", "v")).fit(df)
    other = spark.createDataFrame([("a",), (None,), ("new",)], "c string")
    assert [list(r.v.toArray()) for r in model.transform(other).collect()] == [[1, 0], [0, 0], [0, 0]]
    assert features.distinct_values(df, "c") == ["a", "b"]


def test_one_hot_names_and_bounds(spark, monkeypatch):
    df = spark.createDataFrame([("c",), ("x",), ("C",)], "c string")
    made = features.one_hot(df, "c")
    assert made.columns == ["c", "c=C", "c=c", "x"]
    assert [tuple(r) for r in made.collect()] == [("c", 0, 1, 0), ("x", 0, 0, 1), ("C", 1, 0, 0)]
    monkeypatch.setattr(features, "MOST_COLUMNS", 2)
    with pytest.raises(ValueError, match="one_hot_stages"):
        features.one_hot(df, "c")


def test_missing_numbers_are_not_above(spark):
    rows = [(float("nan"),), (None,), (1.0,), (2.0,), (3.0,), (float("inf"),)]
    df = spark.createDataFrame(rows, "`a b` double")
    assert [r["Above Median"] for r in features.above_median(df, "a b").collect()] == [0, 0, 0, 0, 1, 1]


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_dictionary_of_many_values(spark, monkeypatch, tmp_path, broadcast):
    monkeypatch.setattr("wagegrid.settings.BROADCAST_ROWS", broadcast)
    rows = spark.range(4000).selectExpr("id", "if(id % 3 = 0, 'hot', format_string('v%04d', id % 700)) as c").unionByName(
        spark.createDataFrame([(-1, None), (-2, "")], "id long, c string")
    )
    path, size = dictionaries.dictionary(rows, "c", rows_per_slice=100)
    values = sorted({r.c for r in rows.collect() if r.c is not None})
    table = dictionaries.read_dictionary(spark, path)
    assert size == len(values) and sorted((r.number, r.value) for r in table.collect()) == list(enumerate(values))

    model = dictionaries.OneHotDictionary("c", "v").fit(rows)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = dictionaries.OneHotDictionaryModel.load(str(tmp_path / "m"))
    other = rows.unionByName(spark.createDataFrame([(-3, "unknown")], "id long, c string"))
    for made in (model.transform(other), again.transform(other)):
        found = {r.id: (r.c, r.v.size, list(r.v.indices), list(r.v.values)) for r in made.collect()}
        assert len(found) == 4003 and made.columns == ["id", "c", "v"]
        assert all(n == size and (i, w) == (([values.index(c)], [1.0]) if c in values else ([], [])) for c, n, i, w in found.values())
    assert model.transform(rows.limit(0)).count() == 0
    empty = dictionaries.OneHotDictionary("c", "v").fit(rows.where("id < -9"))
    assert {r.v.size for r in empty.transform(rows).collect()} == {0}


def test_missing_texts_have_no_words(spark):
    rows = [("Data analyst", "we use data", "A", "X"), (None, None, None, None), ("Data analyst", None, "B", "Y")] * 3
    df = spark.createDataFrame(rows, ["Title", "Synopsis", "City", "State Initials"])
    made = features.assemble(df, "synopses").transform(df).collect()
    assert len(made) == 9 and all(sum(r.features.toArray()) == 0 for r in made if r.Title is None)


def test_title_flags(spark):
    titles = ["Senior Data Scientist", "International Analyst", "senior manager", "Ünïcode", None]
    df = spark.createDataFrame([(t,) for t in titles], "Title string")
    on = [
        {w for w in r.asDict() if w != "Title" and r[w] == 1}
        for r in features.title_flags(df).collect()
    ]
    assert on == [{"Senior", "Data Scientist"}, {"Intern", "Analyst"}, set(), set(), set()]
    flagged = features.flagged_rows(features.title_flags(df), "Data Scientist")
    assert flagged.count() == 1


@pytest.mark.parametrize("feature_set", list(features.FEATURE_SETS))
def test_names_fit_vectors(postings, feature_set):
    model = features.assemble(postings, feature_set)
    names = features.feature_names(model)
    assert model.transform(postings).first().features.size == len(names) == len(set(names))


@pytest.mark.parametrize(
    "maker",
    [
        models.logistic(), models.logistic(elastic_net=1.0), models.linear_svm(),
        models.rbf_svm(features=32), models.random_forest(trees=10),
        models.gradient_boosting(rounds=3), models.boosted_trees(rounds=3),
        models.neural_net(hidden=8, rate=0.1, max_iter=25), models.rbf_svm(features=64, landmarks=False),
    ],
)
def test_models_beat_the_baseline(training, maker):
    rows, _ = training
    base = stats.baseline_accuracy(rows, "label").first().baseline
    scored = models.cross_validate(rows, maker).collect()
    assert [r.fold for r in sorted(scored)] == [0, 1, 2]
    assert sum(r.n for r in scored) == 120
    assert np.mean([r.accuracy for r in scored]) > base + 0.3


def test_same_seed_same_score(training):
    rows, _ = training
    runs = [
        sorted(map(tuple, models.cross_validate(rows, models.random_forest(trees=5)).collect()))
        for _ in range(2)
    ]
    assert runs[0] == runs[1]


def test_importance_and_weights(spark, training):
    rows, names = training
    forest = models.fit(rows, models.random_forest(trees=10))
    top = stats.top_importance(models.feature_importance(spark, forest, names), n=5).collect()
    assert len(top) == 5 and top[0].importance >= top[-1].importance > 0
    weights = models.coefficients(spark, models.fit(rows, models.logistic()), names).collect()
    signs = {r.name: r.weight for r in weights}
    assert len(weights) == len(names)
    assert signs["synopsis_terms=models"] > 0 > signs["synopsis_terms=sheets"]


def test_compare(training):
    rows, _ = training
    table = models.compare_models(
        {"synopses": rows}, [("a", "synopses", models.logistic()), ("b", "synopses", models.linear_svm())]
    ).collect()
    assert {(r.model, r.features) for r in table} == {("a", "synopses"), ("b", "synopses")}
    assert all(r.mean_score == 1.0 and r.sd_score == 0.0 for r in table)


def _jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        found = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


@pytest.mark.parametrize("maker, most", [
    (models.logistic(), 40), (models.linear_svm(), 130), (models.boosted_trees(rounds=12), 55),
])
def test_folds_are_trained_in_the_same_jobs(spark, maker, most):
    _, _, rows = _mixed_rows(spark)
    rows = rows.withColumn("fold", F.expr("int(id % 6)")).coalesce(2).cache()
    scored, jobs = _jobs(spark, f"folds-{most}", lambda: models.cross_validate(rows, maker).collect())
    assert jobs <= most
    assert sorted(r.fold for r in scored) == list(range(6))
    # the same as a model of its own, but for rows on the edge
    for r in sorted(scored)[-1:]:
        alone = models.fit(rows.where(f"fold <> {r.fold}"), maker)
        right = models.predictions(alone, rows.where(f"fold = {r.fold}")).where("prediction = label").count()
        assert r.n == 50 and abs(right - 50 * r.accuracy) <= 2


def test_hinge_machine_reaches_the_optimum(spark):
    x, y, rows = _mixed_rows(spark)
    held = rows.select("label", sparse_rows.held("features").alias("v"), F.lit(0).alias("fold"))
    w = linear.train(linear.packed(held), {0: 1 / 300}, 5, linear.hinge_loss, 100, 1e-6, own=True)[0]
    value = lambda w: np.maximum(0, 1 - (2 * y - 1) * (x @ w[:-1] + w[-1])).mean() + w[:-1] @ w[:-1] / 600
    draw = np.random.default_rng(4)
    assert all(value(w) < value(w + draw.normal(0, size, 6)) + 0.01 for size in (0.01, 0.1, 1) for _ in range(300))
    found = models.fit(rows, models.linear_svm())
    assert value(w) < value(np.array([*found.coefficients.toArray(), found.intercept])) + 0.01


def test_rows_apart_from_two_classes_are_left_to_the_machines(spark):
    rows = _mixed_rows(spark)[2].withColumn("label", F.col("id") % 3).withColumn("fold", F.expr("int(id % 2)"))
    assert models.logistic()(300, 5).fit_folds(rows, "fold", {0: models.logistic()(150, 5)}) is None
    assert sum(r.n for r in models.cross_validate(rows, models.logistic(max_iter=5)).collect()) == 300


def test_boosted_trees_query_takes_all_rounds(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(model_queries, "_scored", lambda spark, folder, feature_set, maker, *k: seen.append((feature_set, maker(10, 3))))
    model_queries.boosted_trees(spark, "nowhere")
    (feature_set, made), = seen
    assert feature_set == "titles" and [made.getOrDefault(made.getParam(p)) for p in ("rounds", "rate", "maxDepth")] == [100, 0.1, 3]


@pytest.mark.parametrize("driver", [0, 1 << 30])
def test_sums_of_groups_and_of_the_driver_agree(spark, monkeypatch, driver):
    x, y, rows = _mixed_rows(spark)
    monkeypatch.setattr(neural, "DRIVER_NUMBERS", driver)
    monkeypatch.setattr(boosting, "DRIVER_KEYS", driver)
    monkeypatch.setattr(boosting, "SHARE_PLACES", 2)
    edges = boosting.feature_edges(rows.select(sparse_rows.held("features").alias("v")), "v")
    found = boosting.SecondOrderTrees(rounds=3, rate=0.3).fit(rows).transform(rows).orderBy("id").collect()
    assert [r.prediction for r in found] == (_plain_trees(x, y, edges, 3, 0.3, 3, 1.0, 1.0) > 0).astype(float).tolist()
    held = rows.select("label", sparse_rows.held("features").alias("v"), F.lit(0).alias("fold"))
    w = linear.train(linear.packed(held), {0: 1 / 300}, 5, linear.logistic_loss, 100, 1e-9, own=True)[0]
    share = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert np.allclose(x.T @ (share - y) / 300 + w[:-1] / 300, 0, atol=1e-6) and abs((share - y).sum()) < 1e-4


def test_compared_runs_train_side_by_side(training):
    rows, _ = training
    met = threading.Barrier(2, timeout=60)

    def maker(n, d):
        met.wait()  # one run at a time would wait here for ever
        return models.logistic()(n, d)

    table = models.compare_models({"synopses": rows}, [("a", "synopses", maker), ("b", "synopses", maker)], parallelism=1)
    assert sorted(r.model for r in table.collect()) == ["a", "b"]


def test_study_can_be_saved(spark, postings, tmp_path):
    steps = features.feature_stages(postings, "flags")
    model = models.study(postings, steps, models.logistic())
    model.write().overwrite().save(str(tmp_path / "study"))
    again = PipelineModel.load(str(tmp_path / "study"))
    unseen = postings.drop("label").withColumn("City", F.lit("Nowhere"))
    scored = models.score_postings(again, unseen)
    assert scored.count() == 120
    same = models.score_postings(model, unseen)
    assert scored.orderBy("id").collect() == same.orderBy("id").collect()
    right = scored.join(postings.select("id", "label"), "id").where("prediction = label").count()
    assert right >= 110


def test_salary_stage(spark, tmp_path):
    df = spark.createDataFrame([("$10 - $20",)], "Salary string")
    stages.SalaryNumbers().write().overwrite().save(str(tmp_path / "s"))
    assert stages.SalaryNumbers.load(str(tmp_path / "s")).transform(df).first().Average == 15


def test_fourier_features_are_near_the_kernel(spark):
    from pyspark.ml.linalg import Vectors

    draw = np.random.default_rng(5)
    points = [draw.normal(size=4) for _ in range(12)]
    df = spark.createDataFrame([(i, Vectors.dense(p)) for i, p in enumerate(points)], ["id", "features"])
    lift = stages.FourierFeatures(numInputs=4, numOutputs=4096, gamma=0.3)
    z = {r.id: r.fourier.toArray() for r in lift.transform(df.repartition(3)).collect()}
    for i in range(12):
        for j in range(12):
            kernel = math.exp(-0.3 * float(np.sum((points[i] - points[j]) ** 2)))
            assert abs(float(z[i] @ z[j]) - kernel) < 0.12


def _mixed_rows(spark, n=300):
    """Rows of sparse and dense vectors with small counts, negative numbers and zeros; noisy labels."""
    from pyspark.ml.linalg import Vectors

    draw = np.random.default_rng(11)
    x = draw.poisson(0.7, (n, 5)) * draw.choice([1.0, 1.0, -1.5], (n, 5))
    x[:, 4] = draw.normal(size=n).round(2)
    y = ((x[:, 0] + 0.5 * x[:, 4] - x[:, 2] + draw.normal(0, 0.7, n)) > 0).astype(float)
    rows = [
        (i, float(y[i]), Vectors.dense(x[i]) if i % 3 else Vectors.sparse(5, [(j, v) for j, v in enumerate(x[i]) if v]))
        for i in range(n)
    ]
    return x, y, spark.createDataFrame(rows, ["id", "label", "features"]).repartition(4)


def _plain_trees(x, y, edges, rounds, rate, depth, penalty, least):
    """Boosting on dense arrays: log odds after all rounds."""
    odds = np.zeros(len(y))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-odds))
        g, h = p - y, p * (1 - p)

        def grow(rows, left_levels):
            G, H = g[rows].sum(), h[rows].sum()  # noqa: N806
            best = (0.0, None)
            for place in sorted(edges) if left_levels else ():
                for cut in edges[place]:
                    low = x[rows, place] <= cut
                    gl, hl = g[rows][low].sum(), h[rows][low].sum()
                    gain = gl**2 / (hl + penalty) + (G - gl) ** 2 / (H - hl + penalty) - G**2 / (H + penalty)  # noqa: B023
                    if hl >= least and H - hl >= least and round(gain, 9) > best[0]:
                        best = (round(gain, 9), rows[low], rows[~low])
            if best[1] is None:
                odds[rows] -= rate * G / (H + penalty)
            else:
                grow(best[1], left_levels - 1)
                grow(best[2], left_levels - 1)

        grow(np.arange(len(y)), depth)
    return odds


def test_second_order_trees_equal_plain_ones(spark, tmp_path):
    x, y, rows = _mixed_rows(spark)
    stage = boosting.SecondOrderTrees(rounds=11, rate=0.3, maxDepth=3, penalty=1.0, leastCurvature=1.0)
    model = stage.fit(rows)
    edges = boosting.feature_edges(rows.select(sparse_rows.held("features").alias("v")), "v")
    assert set(edges) == set(range(5)) and all(len(c) <= boosting.BINS and 0.0 in c for c in edges.values())
    want = _plain_trees(x, y, edges, 11, 0.3, 3, 1.0, 1.0)
    found = {r.id: r.prediction for r in model.transform(rows).collect()}
    assert [found[i] for i in range(300)] == (want > 0).astype(float).tolist()
    import json

    trees = json.loads(model.getOrDefault(model.trees))
    dense = sparse_rows.Rows(np.tile(np.arange(5), 300), x.ravel(), np.arange(0, 1501, 5))
    assert np.allclose(boosting.margins(dense, trees), want)
    model.write().overwrite().save(str(tmp_path / "t"))
    again = boosting.TreesModel.load(str(tmp_path / "t"))
    assert {r.id: r.prediction for r in again.transform(rows).collect()} == found


def test_gradient_of_the_net(spark):
    x, y, rows = _mixed_rows(spark, 40)
    drawn = neural.Layers.drawn(5, 7, 3).weights
    layers = neural.Layers(drawn + np.random.default_rng(1).normal(0, 0.1, len(drawn)), 5, 7)
    held = rows.selectExpr("label", "features").select("label", sparse_rows.held("features").alias("v"))
    gradient, loss = neural.summed_gradient(held, layers)
    plain = sparse_rows.Rows(np.tile(np.arange(5), 40), x.ravel(), np.arange(0, 201, 5))
    assert math.isclose(loss, layers.gradient(plain, y)[1])
    for i in range(len(layers.weights)):
        moved = layers.weights.copy()
        moved[i] += 1e-6
        slope = (neural.Layers(moved, 5, 7).gradient(plain, y)[1] - loss) / 1e-6
        assert abs(slope - gradient[i]) < 1e-3 * max(1, abs(slope))


def test_net_learns_what_no_line_parts(spark, tmp_path):
    from pyspark.ml.linalg import Vectors

    draw = np.random.default_rng(2)
    x = draw.uniform(-1, 1, (240, 2))
    rows = spark.createDataFrame([(float(a * b > 0), Vectors.dense([a, b])) for a, b in x], ["label", "features"]).repartition(3)
    model = neural.RectifiedNet(numInputs=2, hidden=16, rate=0.08, maxIter=60).fit(rows)
    model.write().overwrite().save(str(tmp_path / "n"))
    found = neural.RectifiedNetModel.load(str(tmp_path / "n")).transform(rows)
    assert found.where("prediction = label").count() >= 0.95 * 240
    assert neural.RectifiedNet(numInputs=2, hidden=3, maxIter=2).fit(rows.limit(0)).transform(rows).count() == 240


def test_landmark_features_are_nearer_to_the_kernel(spark, tmp_path):
    from pyspark.ml.linalg import Vectors

    draw = np.random.default_rng(5)
    middles = draw.normal(size=(6, 4))
    points = [middles[i % 6] + draw.normal(0, 0.3, 4) for i in range(120)]
    df = spark.createDataFrame([
        (i, Vectors.dense(p) if i % 2 else Vectors.sparse(4, list(range(4)), p)) for i, p in enumerate(points)
    ], ["id", "features"]).repartition(3)
    model = stages.NystroemFeatures(landmarks=24, gamma=0.3).fit(df)
    model.write().overwrite().save(str(tmp_path / "l"))
    lifts = {
        "landmarks": stages.NystroemModel.load(str(tmp_path / "l")),
        "random": stages.FourierFeatures(numInputs=4, numOutputs=24, gamma=0.3, outputCol="landmark_features"),
    }
    error = {}
    for name, lift in lifts.items():
        z = {r.id: r.landmark_features.toArray() for r in lift.transform(df).collect()}
        near = [[float(z[i] @ z[j]) for j in range(120)] for i in range(120)]
        kernel = [[math.exp(-0.3 * float(np.sum((a - b) ** 2))) for b in points] for a in points]
        error[name] = float(np.abs(np.array(near) - np.array(kernel)).mean())
    assert error["landmarks"] < 0.03 < error["random"]
