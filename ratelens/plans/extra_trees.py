"""Extremely randomised trees as a pipeline stage, with save and load."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
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
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.operators.trees import LOCAL_ROWS, UNIT, Forest, grow, in_units, predict
from ratelens.session import stored


class ForestSettings(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    minRows = Param(Params._dummy(), "minRows", "a node with fewer rows is a leaf", TypeConverters.toInt)
    localRows = Param(Params._dummy(), "localRows", "nodes with no more rows are finished by one task", TypeConverters.toInt)
    unit = Param(Params._dummy(), "unit", "labels are rounded to whole numbers of it", TypeConverters.toFloat)

    def _settle(self, values: dict) -> None:
        self._setDefault(numTrees=100, minRows=2, localRows=LOCAL_ROWS, unit=UNIT, seed=42)
        self._set(**{k: v for k, v in values.items() if v is not None})


class ExtraTreesRegressor(Estimator, ForestSettings, DefaultParamsReadable, DefaultParamsWritable):
    """Fits ``ratelens.operators.trees`` to a vector column; rows with a NULL label are left out."""

    def __init__(self, featuresCol=None, labelCol=None, numTrees=None, minRows=None, localRows=None, unit=None, seed=None):
        super().__init__()
        self._settle({
            "featuresCol": featuresCol, "labelCol": labelCol, "numTrees": numTrees, "minRows": minRows,
            "localRows": localRows, "unit": unit, "seed": seed,
        })

    def _fit(self, dataset: DataFrame) -> ExtraTreesModel:
        get = self.getOrDefault
        rows = dataset.select(
            vector_to_array(F.col(get("featuresCol"))).alias("x"), in_units(F.col(get("labelCol")), get("unit")).alias("y")
        ).filter("y IS NOT NULL")
        forest = grow(rows, get("numTrees"), get("seed"), get("minRows"), get("localRows"))
        return self._copyValues(ExtraTreesModel(forest))


class ExtraTreesModel(Model, ForestSettings, MLWritable, MLReadable):
    """Tables of splits and subtrees; a prediction is the mean of the trees' leaves."""

    def __init__(self, forest: Forest | None = None):
        super().__init__()
        self.forest = forest
        self._settle({})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """``dataset`` with predictions; it is stored once with a number for each row, by which these are joined."""
        numbered = stored(dataset.withColumn("__row", F.monotonically_increasing_id()), "to-predict")
        x = vector_to_array(F.col(self.getOrDefault("featuresCol"))).alias("x")
        found = predict(numbered.select(F.col("__row").alias("id"), x), self.forest, self.getOrDefault("unit"))
        named = found.select(F.col("id").alias("__row"), F.col("prediction").alias(self.getOrDefault("predictionCol")))
        return numbered.join(named, "__row").drop("__row")

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return ForestReader(cls)


class _ForestWriter(MLWriter):
    def __init__(self, model: ExtraTreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        forest = self.model.forest
        extra = {"trees": forest.trees, "levels": forest.levels}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=extra)
        forest.splits.write.parquet(f"{path}/splits")
        forest.subtrees.write.parquet(f"{path}/subtrees")


class ForestReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> ExtraTreesModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        tables = (spark.read.parquet(f"{path}/{name}") for name in ("splits", "subtrees"))
        model = self.kind(Forest(*tables, metadata["trees"], metadata["levels"]))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
