"""Pipeline stages of our own, so that a whole study can be saved and loaded."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from wagegrid import fixed_values
from wagegrid.functions.flags import flag_vector
from wagegrid.functions.salary import parse_salary
from wagegrid.operators import sparse_rows


class TitleFlags(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Title to a vector of 0/1 flags, one per word, in the order of the words."""

    words = Param(Params._dummy(), "words", "words looked for", TypeConverters.toListString)

    def __init__(self, inputCol="Title", outputCol="flags", words=None):
        super().__init__()
        self._setDefault(words=fixed_values.TITLE_WORDS)
        self._set(inputCol=inputCol, outputCol=outputCol)
        if words is not None:
            self._set(words=words)

    def _transform(self, dataset):
        flags = flag_vector(self.getInputCol(), self.getOrDefault(self.words))
        return dataset.withColumn(self.getOutputCol(), flags)


class SalaryNumbers(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``Low``, ``High`` and ``Average`` of a salary text."""

    def __init__(self, inputCol="Salary"):
        super().__init__()
        self._set(inputCol=inputCol)

    def _transform(self, dataset):
        return parse_salary(dataset, self.getInputCol(), keep=True)


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Random Fourier features (Rahimi and Recht, 2007).

    ``sqrt(2/D) cos(xW + b)`` with normal ``W`` of variance ``2 gamma`` has
    inner products near the radial kernel ``exp(-gamma |x - y|^2)``, so a
    linear machine on it stands in for a radial one.  ``W`` comes from the
    seed and has ``numInputs x numOutputs`` entries, whatever the data size.
    """

    numInputs = Param(Params._dummy(), "numInputs", "length of the input", TypeConverters.toInt)
    numOutputs = Param(Params._dummy(), "numOutputs", "length of the output", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the projection", TypeConverters.toInt)

    def __init__(self, inputCol="features", outputCol="fourier", numInputs=1, numOutputs=256,
                 gamma=None, seed=1):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, numInputs=numInputs,
                  numOutputs=numOutputs, seed=seed,
                  gamma=1.0 / numInputs if gamma is None else gamma)

    def _transform(self, dataset):
        d, size = self.getOrDefault(self.numInputs), self.getOrDefault(self.numOutputs)
        gamma, seed = self.getOrDefault(self.gamma), self.getOrDefault(self.seed)

        @F.arrow_udf("array<double>")
        def project(rows: pa.Array) -> pa.Array:
            draw = np.random.default_rng(seed)
            weights = draw.normal(0.0, np.sqrt(2.0 * gamma), (d, size))
            shift = draw.uniform(0.0, 2.0 * np.pi, size)
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), d)
            z = np.sqrt(2.0 / size) * np.cos(x @ weights + shift)
            ends = pa.array(np.arange(0, (len(rows) + 1) * size, size, dtype=np.int32))
            return pa.ListArray.from_arrays(ends, pa.array(z.ravel()))

        values = project(vector_to_array(F.col(self.getInputCol())))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(values))


class NystroemFeatures(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Features whose inner products are near a radial kernel, from landmarks of the data.

    The landmarks are the centres of k-means.  A row becomes its kernel values with the
    landmarks, times the inverse square root of the landmarks' own kernel matrix (Williams and
    Seeger, 2001).  Landmarks lie where the rows are, so that as many features come nearer
    to the kernel than random ones.  The model holds ``landmarks`` vectors of the input's length.
    """

    landmarks = Param(Params._dummy(), "landmarks", "number of landmarks", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the landmarks", TypeConverters.toInt)

    def __init__(self, inputCol="features", outputCol="landmark_features", landmarks=128, gamma=1.0, seed=1):  # noqa: N803
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, landmarks=landmarks, gamma=gamma, seed=seed)

    def _fit(self, dataset):
        means = KMeans(
            k=max(2, self.getOrDefault(self.landmarks)), seed=self.getOrDefault(self.seed), maxIter=10,
            featuresCol=self.getInputCol(), predictionCol="_landmark",
        ).fit(dataset.select(self.getInputCol()))
        centres = np.unique(np.array(means.clusterCenters()), axis=0)
        return NystroemModel(
            self.getInputCol(), self.getOutputCol(), centres.shape[1], centres.ravel().tolist(), self.getOrDefault(self.gamma)
        )


class NystroemModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    numInputs = Param(Params._dummy(), "numInputs", "length of the input", TypeConverters.toInt)
    centres = Param(Params._dummy(), "centres", "landmarks, end to end", TypeConverters.toListFloat)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)

    def __init__(self, inputCol="features", outputCol="landmark_features", numInputs=1, centres=(0.0,), gamma=1.0):  # noqa: N803
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, numInputs=numInputs, centres=list(centres), gamma=gamma)

    def _transform(self, dataset):
        centres = np.array(self.getOrDefault(self.centres)).reshape(-1, self.getOrDefault(self.numInputs))
        gamma, squares = self.getOrDefault(self.gamma), (centres**2).sum(axis=1)
        own = np.exp(-gamma * np.maximum(squares[:, None] + squares - 2 * centres @ centres.T, 0))
        values, vectors = np.linalg.eigh(own)
        # directions in which the landmarks do not differ carry noise only
        kept = values > 1e-9 * values.max()
        root = vectors[:, kept] / np.sqrt(values[kept])

        @F.arrow_udf("array<double>")
        def lift(rows: pa.Array) -> pa.Array:
            held = sparse_rows.rows_of(rows)
            apart = held.summed(held.values**2)[:, None] + squares - 2 * held.times(centres.T)
            lifted = np.exp(-gamma * np.maximum(apart, 0)) @ root
            ends = pa.array(np.arange(0, lifted.size + 1, lifted.shape[1], dtype=np.int32))
            return pa.ListArray.from_arrays(ends, pa.array(lifted.ravel()))

        made = lift(sparse_rows.held(self.getInputCol()))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(made))
