"""A net with one hidden layer of rectified units, trained on a distributed table.

Every step, each task sums the gradient over its rows and hands it on in pieces; the pieces
are added up in two rounds, the first by a square root of the tasks' number of groups, so that no
task holds more than that many of them.  The driver holds the weights and takes the step (Adam).
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.operators import sparse_rows

#: Numbers in a piece of a gradient.
PIECE = 1 << 14
#: Numbers that the driver takes from all tasks at once, instead of groups: 16 MB.
DRIVER_NUMBERS = 1 << 21
PIECES = "piece int, part int, total binary"


class Layers:
    """The weights as one vector: places x hidden, hidden, hidden, 1."""

    def __init__(self, weights: np.ndarray, places: int, hidden: int):
        self.weights, self.places, self.hidden = weights, places, hidden
        edge = places * hidden
        self.inner = weights[:edge].reshape(places, hidden)
        self.shift, self.outer, self.base = weights[edge : edge + hidden], weights[edge + hidden : edge + 2 * hidden], weights[-1]

    @staticmethod
    def drawn(places: int, hidden: int, seed: int) -> Layers:
        """Normal weights whose variance keeps the size of what passes a rectified layer."""
        draw = np.random.default_rng(seed)
        inner = draw.normal(0, math.sqrt(2 / max(places, 1)), places * hidden)
        outer = draw.normal(0, math.sqrt(1 / hidden), hidden)
        return Layers(np.concatenate([inner, np.zeros(hidden), outer, [0.0]]), places, hidden)

    def scores(self, rows: sparse_rows.Rows) -> tuple[np.ndarray, np.ndarray]:
        """The hidden layer and the log odds of every row."""
        lit = np.maximum(rows.times(self.inner) + self.shift, 0)
        return lit, lit @ self.outer + self.base

    def gradient(self, rows: sparse_rows.Rows, labels: np.ndarray) -> tuple[np.ndarray, float]:
        """Summed gradient and loss over the rows, without the penalty."""
        lit, odds = self.scores(rows)
        off = 1 / (1 + np.exp(-odds)) - labels
        back = off[:, None] * self.outer * (lit > 0)
        parts = [rows.transposed_times(back, self.places).ravel(), back.sum(axis=0), lit.T @ off, [off.sum()]]
        return np.concatenate(parts), float((np.logaddexp(0, odds) - labels * odds).sum())


def _task_gradient(layers: Layers) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, task = np.zeros(len(layers.weights) + 1), TaskContext.get().partitionId()
        for batch in batches:
            found, loss = layers.gradient(sparse_rows.rows_of(batch.column("v")), batch.column("label").to_numpy())
            total[:-1] += found
            total[-1] += loss
        for piece in range(0, len(total), PIECE):
            yield pa.record_batch({
                "piece": pa.array([piece // PIECE], pa.int32()), "part": pa.array([task], pa.int32()),
                "total": pa.array([total[piece : piece + PIECE].tobytes()], pa.binary()),
            })

    return run


def _added(table: pa.Table) -> pa.Table:
    """The sum of the pieces of a group, in order of their parts."""
    table = table.sort_by("part")
    total = np.sum([np.frombuffer(p) for p in table.column("total").to_pylist()], axis=0)
    return table.slice(0, 1).set_column(2, "total", pa.array([total.tobytes()], pa.binary()))


def added(pieces: DataFrame, tasks: int, size: int) -> dict[int, np.ndarray]:
    """The sum of every piece over the ``tasks`` that made it, ``size`` numbers a task in all."""
    if tasks * size <= DRIVER_NUMBERS:
        table = pieces.toArrow()
        sums = [_added(table.filter(pc.equal(table.column("piece"), piece))) for piece in pc.unique(table.column("piece"))]
        return {t.column("piece")[0].as_py(): np.frombuffer(t.column("total")[0].as_py()) for t in sums}
    groups = max(1, math.isqrt(tasks))
    first = pieces.groupBy("piece", F.pmod("part", F.lit(groups))).applyInArrow(_added, PIECES)
    found = first.groupBy("piece").applyInArrow(_added, PIECES).collect()
    return {r.piece: np.frombuffer(bytes(r.total)) for r in found}


def summed_gradient(rows: DataFrame, layers: Layers) -> tuple[np.ndarray, float]:
    """Gradient and loss over all rows."""
    found = added(rows.mapInArrow(_task_gradient(layers), PIECES), rows.rdd.getNumPartitions(), len(layers.weights))
    total = np.concatenate([found[piece] for piece in sorted(found)])
    return total[:-1], float(total[-1])


class RectifiedNet(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """A binary classifier; the loss is the mean log loss and ``alpha / 2`` of the squared weights per row."""

    numInputs = Param(Params._dummy(), "numInputs", "length of the input", TypeConverters.toInt)
    hidden = Param(Params._dummy(), "hidden", "units of the hidden layer", TypeConverters.toInt)
    alpha = Param(Params._dummy(), "alpha", "penalty on squared weights", TypeConverters.toFloat)
    rate = Param(Params._dummy(), "rate", "length of a step", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "steps", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the first weights", TypeConverters.toInt)

    def __init__(self, numInputs=1, hidden=100, alpha=1e-4, rate=0.01, maxIter=200, seed=1):  # noqa: N803
        super().__init__()
        self._set(numInputs=numInputs, hidden=hidden, alpha=alpha, rate=rate, maxIter=maxIter, seed=seed)

    def setLabelCol(self, value):  # noqa: N802
        return self._set(labelCol=value)

    def _fit(self, dataset: DataFrame) -> RectifiedNetModel:
        places, hidden = self.getOrDefault(self.numInputs), self.getOrDefault(self.hidden)
        rows = settings.written(dataset.select(
            F.col(self.getLabelCol()).cast("double").alias("label"), sparse_rows.held(self.getFeaturesCol()).alias("v")
        ), "net", compact=True)
        n, alpha = rows.count(), self.getOrDefault(self.alpha)
        layers = Layers.drawn(places, hidden, self.getOrDefault(self.seed))
        weights = layers.weights
        # shifts are not penalised
        held = np.ones(len(weights))
        held[places * hidden : places * hidden + hidden] = held[-1] = 0
        mean, square = np.zeros(len(weights)), np.zeros(len(weights))
        for step in range(1, self.getOrDefault(self.maxIter) + 1 if n else 1):
            gradient, _ = summed_gradient(rows, Layers(weights, places, hidden))
            gradient = (gradient + alpha * held * weights) / n
            mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
            ahead = (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            weights = weights - self.getOrDefault(self.rate) * ahead
        return RectifiedNetModel(json.dumps(weights.tolist()), places, hidden)._set(
            featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol()
        )


class RectifiedNetModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    weights = Param(Params._dummy(), "weights", "the weights, as JSON", TypeConverters.toString)
    numInputs = Param(Params._dummy(), "numInputs", "length of the input", TypeConverters.toInt)
    hidden = Param(Params._dummy(), "hidden", "units of the hidden layer", TypeConverters.toInt)

    def __init__(self, weights="[0.0]", numInputs=0, hidden=0):  # noqa: N803
        super().__init__()
        self._set(weights=weights, numInputs=numInputs, hidden=hidden)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = np.array(json.loads(self.getOrDefault(self.weights)))
        places, hidden = self.getOrDefault(self.numInputs), self.getOrDefault(self.hidden)

        @F.arrow_udf("double")
        def predict(vectors: pa.Array) -> pa.Array:
            _, odds = Layers(weights, places, hidden).scores(sparse_rows.rows_of(vectors))
            return pa.array((odds > 0).astype(float))

        return dataset.withColumn(self.getPredictionCol(), predict(sparse_rows.held(self.getFeaturesCol())))
