"""Numbers for the values of a column, held in a table and not on the driver.

The distinct values are numbered in their order by as many tasks as they need, and rows get
their number by a join.  A model keeps the path of the table and its size, so that a column
of millions of places costs the driver no more than one of five.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.operators import positions

#: Copies of a dictionary too large to broadcast, over which a hot value's rows are dealt.
COPIES = 16


def dictionary(df: DataFrame, column: str, rows_per_slice: int = positions.ROWS_PER_SLICE) -> tuple[str, int]:
    """Writes ``value``, ``number``: the values of a column in order, numbered from 0, nulls
    left out.  The path of the table and its size.
    """
    values = df.select(F.col(f"`{column}`").cast("string").alias("value")).where("value IS NOT NULL").distinct()
    values = settings.written(values, "values")
    path = settings.new_folder(df.sparkSession, "dictionary")
    numbers = positions.row_numbers(values, "value", name="number", rows_per_slice=rows_per_slice)
    numbers.select("value", "number").write.parquet(path)
    return path, values.count()


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, number long").parquet(path)


def numbered(df: DataFrame, table: DataFrame, size: int, column: str, out: str) -> DataFrame:
    """``df`` with the number of its value in ``out``; ``size`` for a missing or unknown one.

    Up to ``settings.BROADCAST_ROWS`` values go to all tasks.  A larger dictionary is copied
    and the rows are dealt over the copies by their content, so that a value that many rows
    share is no single task.
    """
    facts = table.select(F.col("value").alias("_value"), F.col("number").alias("_number"))
    value = F.col(f"`{column}`").cast("string")
    if size <= settings.BROADCAST_ROWS:
        joined = df.join(F.broadcast(facts), value == F.col("_value"), "left")
    else:
        copies = facts.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
        dealt = df.withColumn("_deal", F.pmod(F.xxhash64(*[f"`{c}`" for c in df.columns]), F.lit(COPIES)).cast("int"))
        joined = dealt.join(copies, (value == F.col("_value")) & (F.col("_deal") == F.col("_copy")), "left").drop("_deal", "_copy")
    return joined.withColumn(out, F.coalesce("_number", F.lit(size)).cast("double")).drop("_value", "_number")


class _Dictionary(HasInputCol, HasOutputCol):
    """Column in, vector out."""

    def _set_columns(self, inputCol, outputCol):  # noqa: N803
        if inputCol is not None:
            self._set(inputCol=inputCol)
        if outputCol is not None:
            self._set(outputCol=outputCol)


class OneHotDictionary(Estimator, _Dictionary, DefaultParamsReadable, DefaultParamsWritable):
    """One place of a sparse vector for every value of a column, in order.

    A missing or unknown value has none: the vector is all 0.
    """

    def __init__(self, inputCol=None, outputCol=None):  # noqa: N803
        super().__init__()
        self._set_columns(inputCol, outputCol)

    def _fit(self, dataset: DataFrame) -> OneHotDictionaryModel:
        path, size = dictionary(dataset, self.getInputCol())
        return OneHotDictionaryModel(self.getInputCol(), self.getOutputCol(), path, size)


class _Writer(DefaultParamsWriter):
    """Saves the dictionary with the model, in its folder."""

    def saveImpl(self, path: str) -> None:  # noqa: N802
        super().saveImpl(path)
        self.instance.table().write.parquet(f"{path}/dictionary")


class _Reader(MLReader):
    def load(self, path: str) -> OneHotDictionaryModel:
        found = DefaultParamsReader(OneHotDictionaryModel).load(path)
        return found._set(path=f"{path}/dictionary")


class OneHotDictionaryModel(Model, _Dictionary, MLWritable, MLReadable):
    path = Param(Params._dummy(), "path", "where the dictionary is", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "number of values", TypeConverters.toInt)

    def __init__(self, inputCol=None, outputCol=None, path="", size=0):  # noqa: N803
        super().__init__()
        self._set(path=path, size=size)
        self._set_columns(inputCol, outputCol)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()

    def table(self) -> DataFrame:
        """``value``, ``number``."""
        return read_dictionary(SparkSession.active(), self.getOrDefault(self.path))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size, out = self.getOrDefault(self.size), self.getOutputCol()
        if size == 0:
            return dataset.withColumn(out, array_to_vector(F.array().cast("array<double>")))
        index = f"_{out}_number"
        placed = numbered(dataset, self.table(), size, self.getInputCol(), index)
        # the size is told with the column: the encoder has no need to look at rows
        known = {"ml_attr": {"type": "nominal", "num_vals": size + 1}}
        placed = placed.withColumn(index, F.col(index).alias(index, metadata=known))
        # the place left out is that of unknown values
        encoder = OneHotEncoder(inputCols=[index], outputCols=[out], dropLast=True, handleInvalid="error")
        return encoder.fit(placed.limit(0)).transform(placed).drop(index)
