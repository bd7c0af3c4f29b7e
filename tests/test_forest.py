"""The forest: the same trees whichever tasks grow them, none of them on the driver."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from wagegrid.operators import forest, models


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(4)
    x = np.round(draw.normal(size=(400, 6)) * (draw.random((400, 6)) < 0.7), 2)
    label = (x[:, 0] > 0.2).astype(int) + (x[:, 1] * x[:, 2] > 0.1)
    held = [
        (int(c), Vectors.dense(r) if i % 2 else Vectors.sparse(6, np.flatnonzero(r).tolist(), r[r != 0].tolist()))
        for i, (c, r) in enumerate(zip(label, x, strict=True))
    ]
    return spark.createDataFrame(held, ["label", "features"]).repartition(3).cache()


def _predicted(model, rows):
    return [r.prediction for r in models.predictions(model, rows).collect()]


def test_small_and_large_groups_grow_the_same_tree(rows):
    # a single tree looks at all features, so that nothing depends on who grows a node
    made = [models.fit(rows, lambda n, d, g=g: forest.Forest(numInputs=d, numTrees=1, maxDepth=6, groupRows=g)) for g in (10_000, 40)]
    assert made[0].table("parts").count() == 2 < made[1].table("parts").count()
    assert _predicted(made[0], rows) == _predicted(made[1], rows)
    a, b = (m.featureImportances.toArray() for m in made)
    assert np.allclose(a, b) and a.sum() == pytest.approx(1) and a[:3].sum() > 0.7


@pytest.mark.parametrize("group_rows", [10_000, 50])
def test_forest_learns_and_can_be_saved(rows, tmp_path, group_rows):
    model = models.fit(rows, lambda n, d: forest.Forest(numInputs=d, numTrees=15, groupRows=group_rows))
    found = _predicted(model, rows)
    assert np.mean([p == r.label for p, r in zip(found, rows.collect(), strict=True)]) > 0.95
    model.write().overwrite().save(str(tmp_path / "forest"))
    assert _predicted(forest.ForestModel.load(str(tmp_path / "forest")), rows) == found


def test_random_forest_keeps_its_trees_in_a_table(rows):
    model = models.fit(rows, models.random_forest(trees=3))
    assert isinstance(model, forest.ForestModel)
    assert model.table("parts").select("tree").distinct().count() == 3


def test_no_feature_tells_rows_apart(spark):
    same = spark.createDataFrame([(i % 3 == 0, Vectors.dense([0.0, 0.0])) for i in range(30)], ["label", "features"]).selectExpr("int(label) label", "features")
    model = models.fit(same, models.random_forest(trees=4))
    assert set(_predicted(model, same)) == {0.0}
    assert model.featureImportances.toArray().tolist() == [0, 0]
