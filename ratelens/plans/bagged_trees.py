"""Random forests and bagged trees as pipeline stages, with save and load."""

from __future__ import annotations

import math

from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.operators import forests
from ratelens.operators.trees import Forest, in_units
from ratelens.plans.extra_trees import ExtraTreesModel, ForestReader, ForestSettings


class _BaggedSettings(ForestSettings):
    maxDepth = Param(Params._dummy(), "maxDepth", "most levels below the root", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "most bins of a feature", TypeConverters.toInt)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "a node's features: all, or sqrt of their number", TypeConverters.toString)

    def getNumTrees(self) -> int:
        return self.getOrDefault("numTrees")

    def _settle(self, values: dict) -> None:
        self._setDefault(maxDepth=30, maxBins=forests.BINS, featureSubsetStrategy="all")
        super()._settle(values)


class _BaggedTrees(Estimator, _BaggedSettings, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(
        self, featuresCol=None, labelCol=None, numTrees=None, maxDepth=None, maxBins=None, featureSubsetStrategy=None,
        localRows=None, unit=None, seed=None,
    ):
        super().__init__()
        self._settle({
            "featuresCol": featuresCol, "labelCol": labelCol, "numTrees": numTrees, "maxDepth": maxDepth, "maxBins": maxBins,
            "featureSubsetStrategy": featureSubsetStrategy, "localRows": localRows, "unit": unit, "seed": seed,
        })

    def _grow(self, dataset: DataFrame) -> Forest:
        get = self.getOrDefault
        x = vector_to_array(F.col(get("featuresCol"))).alias("x")
        rows = dataset.select(x, in_units(F.col(get("labelCol")), get("unit")).alias("y")).filter("y IS NOT NULL")
        first = rows.first()
        if first is None:
            raise ValueError("no rows with a label")
        some = math.ceil(math.sqrt(len(first["x"]))) if get("featureSubsetStrategy") == "sqrt" else None
        return forests.grow(rows, get("numTrees"), get("seed"), get("maxDepth"), some, get("maxBins"), get("localRows"))


class BaggedTreesRegressor(_BaggedTrees):
    """Fits ``ratelens.operators.forests`` to a vector column; rows with a NULL label are left out."""

    def _fit(self, dataset: DataFrame) -> BaggedTreesRegressionModel:
        return self._copyValues(BaggedTreesRegressionModel(self._grow(dataset)))


class BaggedTreesClassifier(_BaggedTrees):
    """As the regressor, for labels 0 and 1: the class with the larger mean share in the leaves, or 0 if they are equal."""

    def _fit(self, dataset: DataFrame) -> BaggedTreesClassificationModel:
        label = F.col(self.getOrDefault("labelCol"))
        if not dataset.filter(label.isNotNull() & ~label.cast("double").isin(0.0, 1.0)).isEmpty():
            raise ValueError("labels other than 0 and 1")
        return self._copyValues(BaggedTreesClassificationModel(self._grow(dataset)))


class BaggedTreesRegressionModel(ExtraTreesModel, _BaggedSettings):
    @classmethod
    def read(cls) -> ForestReader:
        return ForestReader(cls)


class BaggedTreesClassificationModel(BaggedTreesRegressionModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        name = self.getOrDefault("predictionCol")
        return super()._transform(dataset).withColumn(name, (F.col(name) > 0.5).cast("double"))
