"""Linear machines of several folds, trained in the same jobs on a distributed table.

Both losses are smooth and convex once the hinge is rounded over a small width, so Newton's
steps find the one optimum in a few passes where steps along gradients take hundreds.  In a
pass, every task sums loss, gradient and curvature of all machines over its rows; the sums are
added up (``neural.added``), and the driver takes the step.  Losses at shorter steps come
from the same pass, as the log odds are linear in the step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml import Model
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.operators import neural, sparse_rows

#: Features up to which curvatures (their square) are summed; with more, Spark's own machines are trained.
MOST_FEATURES = 512
#: Cells of a block of rows, and of rows laid out in full at a time.
BLOCK_CELLS = 1 << 18
#: Shares of a step whose losses are told by a pass.
STEPS = np.array([1, 0.5, 0.25, 0.12, 0.06, 0.03, 0.01, 1e-3, 1e-4, 1e-5])
#: Widths that the hinge is rounded over, one after the other; the last is off by half of it at most.
WIDTHS = (2.0, 0.5, 0.1)

_BLOCK = "fold binary, label binary, sizes binary, place binary, value binary, features int, two boolean"
_BLOCK_ARROW = pa.schema([*[(c.split()[0], pa.binary()) for c in _BLOCK.split(", ")[:5]], ("features", pa.int32()), ("two", pa.bool_())])


def logistic_loss(margin: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, slope and curvature of log(1 + exp(-margin))."""
    share = 1 / (1 + np.exp(np.minimum(margin, 500)))
    return np.logaddexp(0, -margin), -share, share * (1 - share)


def hinge_loss(margin: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of max(0, 1 - margin), rounded between margins of 1 - width and 1."""
    short = 1 - margin
    inside = (short > 0) & (short < width)
    loss = np.where(inside, short**2 / (2 * width), np.maximum(short - width / 2, 0))
    return loss, -np.clip(short / width, 0, 1), inside / width


@dataclass
class Machine:
    """One machine on its way: weights (the last is the shift), the step at hand, what is known at the weights."""

    penalty: float
    weights: np.ndarray
    step: np.ndarray
    loss: float = np.inf
    slope: float = 0.0
    done: bool = False
    n: float = field(default=0.0)

    def told(self, sums: np.ndarray, tolerance: float) -> None:
        """Goes ahead by what a pass over the rows has found for the step and its shares."""
        size = len(self.weights)
        self.n, rest = sums[0], sums[1:]
        if not self.n:
            self.done = True
            return
        own = lambda w: self.penalty / 2 * float(w[:-1] @ w[:-1])
        losses = rest[: len(STEPS)] / self.n + [own(self.weights + s * self.step) for s in STEPS]
        enough = losses <= self.loss + 1e-4 * STEPS * self.slope
        if not enough[0] and np.isfinite(self.loss):
            share = STEPS[losses.argmin()] if enough.any() else 0.0
            self.step, self.slope = self.step * share, self.slope * share
            self.done = not share
            return
        gradient = rest[len(STEPS) : len(STEPS) + size] / self.n
        curvature = rest[len(STEPS) + size :].reshape(size, size) / self.n
        self.weights, before, self.loss = self.weights + self.step, self.loss, float(losses[0])
        gradient[:-1] += self.penalty * self.weights[:-1]
        curvature[np.arange(size - 1), np.arange(size - 1)] += self.penalty
        curvature[np.arange(size), np.arange(size)] += 1e-10
        self.step = -np.linalg.solve(curvature, gradient)
        self.slope = float(gradient @ self.step)
        self.done = -self.slope <= tolerance * max(self.loss, 1e-9) or before - self.loss < 0.1 * tolerance * self.loss


def _passing(machines: dict[int, Machine], own: bool, loss: Callable, width: float, features: int) -> Callable:
    """Sums of a task for every machine: rows, losses at the shares of its step, gradient and curvature behind it."""
    numbers = sorted(machines)
    weights = np.stack([m.weights for m in map(machines.get, numbers)], axis=1)
    steps = np.stack([m.step for m in map(machines.get, numbers)], axis=1)
    size = features + 1

    def add(total: np.ndarray, x: np.ndarray, sign: np.ndarray, now: np.ndarray, ahead: np.ndarray) -> None:
        total[0] += len(x)
        for i, share in enumerate(STEPS):
            total[1 + i] += loss(sign * (now + share * ahead), width)[0].sum()
        _, slope, bend = loss(sign * (now + ahead), width)
        first = 1 + len(STEPS)
        total[first : first + size] += x.T @ (slope * sign)
        bent = np.flatnonzero(bend)
        total[first + size :] += (x[bent].T @ (x[bent] * bend[bent, None])).ravel()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(numbers), 1 + len(STEPS) + size + size * size))
        for batch in batches:
            for line in batch.to_pylist():
                fold, label = np.frombuffer(line["fold"], np.int32), np.frombuffer(line["label"])
                sizes, place, value = (np.frombuffer(line[c], k) for c, k in (("sizes", np.int32), ("place", np.int32), ("value", np.float32)))
                ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                for a in range(0, len(fold), max(1, BLOCK_CELLS // size)):
                    b = min(a + max(1, BLOCK_CELLS // size), len(fold))
                    cells = slice(ends[a], ends[b])
                    x = np.zeros((b - a, size))
                    np.add.at(x, (np.repeat(np.arange(b - a), sizes[a:b]), place[cells]), value[cells])
                    x[:, -1] = 1
                    sign, now, ahead = 2 * label[a:b] - 1, x @ weights, x @ steps
                    for i, number in enumerate(numbers):
                        rows = np.flatnonzero((fold[a:b] == number) == own)
                        if len(rows):
                            add(totals[i], x[rows], sign[rows], now[rows, i], ahead[rows, i])
        yield pa.record_batch({
            "piece": pa.array(numbers, pa.int32()), "part": pa.array([TaskContext.get().partitionId()] * len(numbers), pa.int32()),
            "total": pa.array([t.tobytes() for t in totals], pa.binary()),
        })

    return run


def packed(rows: DataFrame) -> DataFrame:
    """Blocks of ``fold``, ``label`` and ``v``, the length of their vectors, and whether all labels are 0 or 1."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "label"))
            held, lengths = sparse_rows.rows_of(batch.column("v")), batch.column("v").field("size")
            sizes, first = np.diff(held.ends).astype(np.int32), 0
            features = max(pc.max(lengths).as_py() or 0, int(sizes[~lengths.is_valid().to_numpy(zero_copy_only=False)].max(initial=0)))
            while first < len(held):
                last = max(first + 1, int(np.searchsorted(held.ends, held.ends[first] + BLOCK_CELLS, side="right")) - 1)
                cells, own = slice(held.ends[first], held.ends[last]), label[first:last].astype(float)
                line = (
                    fold[first:last].astype(np.int32), own, sizes[first:last],
                    held.places[cells].astype(np.int32), held.values[cells].astype(np.float32),
                )
                told = [pa.array([features], pa.int32()), pa.array([bool(np.isin(own, (0, 1)).all())])]
                yield pa.RecordBatch.from_arrays([*[pa.array([v.tobytes()], pa.binary()) for v in line], *told], schema=_BLOCK_ARROW)
                first = last

    return settings.written(rows.mapInArrow(pack, _BLOCK), "linear")


def train(blocks: DataFrame, penalties: dict[int, float], features: int, loss: Callable, max_iter: int, tolerance: float, own: bool) -> dict[int, np.ndarray]:
    """Weights and shift for every number, of the rows of its fold (``own``) or of all others."""
    tasks, numbers = blocks.rdd.getNumPartitions(), 1 + len(STEPS) + (features + 1) * (features + 2)
    start = lambda: np.zeros(features + 1)
    machines = {number: Machine(penalty, start(), start()) for number, penalty in penalties.items()}
    left = max_iter
    for width in WIDTHS if loss is hinge_loss else (0.0,):
        near = tolerance if width in (0.0, WIDTHS[-1]) else max(tolerance, 1e-3)
        machines = {n: Machine(m.penalty, m.weights, start()) for n, m in machines.items()}
        while left > 0:
            going = {n: m for n, m in machines.items() if not m.done}
            if not going:
                break
            sums = blocks.mapInArrow(_passing(going, own, loss, width, features), neural.PIECES)
            found = neural.added(sums, tasks, len(going) * numbers)
            for number, total in found.items():
                going[number].told(total, near)
            for number in going.keys() - found.keys():
                going[number].done = True
            left -= 1
    return {number: machine.weights for number, machine in machines.items()}


class _Folds:
    """What both machines need to be trained for all folds at once."""

    def fit_folds(self, dataset: DataFrame, fold: str, estimators: dict, own: bool = False) -> dict[int, LinearWeights] | None:
        """A model for every number, of the rows of the other folds, or of its ``own``; None if these machines are not for it."""
        column, label = self.getFeaturesCol(), F.col(self.getLabelCol()).cast("double")
        if not self._plain():
            return None
        rows = dataset.select(F.col(fold).alias("fold"), label.alias("label"), sparse_rows.held(column).alias("v")).where(F.col("fold").isNotNull())
        blocks = packed(rows if own else settings.dealt(rows, "v"))
        seen = blocks.agg(F.max("features").alias("features"), F.bool_and("two").alias("two")).first()
        if not seen.two or seen.features > MOST_FEATURES:
            return None
        penalties = {number: e.getRegParam() for number, e in estimators.items()}
        made = train(blocks, penalties, seen.features, self.loss, self.getMaxIter(), self.getTol(), own)
        return {
            number: LinearWeights(w[:-1].tolist(), float(w[-1]))._set(featuresCol=column, predictionCol=self.getPredictionCol())
            for number, w in made.items()
        }


class Logistic(_Folds, LogisticRegression):
    loss = staticmethod(logistic_loss)

    def _plain(self) -> bool:
        return self.getElasticNetParam() == 0 and not self.getStandardization() and self.getFitIntercept()


class Svm(_Folds, LinearSVC):
    loss = staticmethod(hinge_loss)

    def _plain(self) -> bool:
        return not self.getStandardization() and self.getFitIntercept()


class LinearWeights(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Class 1 where the weighted sum is above 0."""

    weights = Param(Params._dummy(), "weights", "weight of every feature", TypeConverters.toListFloat)
    shift = Param(Params._dummy(), "shift", "added to the sum", TypeConverters.toFloat)

    def __init__(self, weights=(), shift=0.0):
        super().__init__()
        self._set(weights=list(weights), shift=shift)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights, shift = np.array(self.getOrDefault(self.weights)), self.getOrDefault(self.shift)

        @F.arrow_udf("double")
        def predict(vectors: pa.Array) -> pa.Array:
            rows = sparse_rows.rows_of(vectors)
            return pa.array((rows.summed(rows.values * weights[rows.places]) + shift > 0).astype(float))

        return dataset.withColumn(self.getPredictionCol(), predict(sparse_rows.held(self.getFeaturesCol())))
