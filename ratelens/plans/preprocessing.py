"""Medians, bounds and vocabularies, fitted on training rows and kept beside the model that was trained on them."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
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

from ratelens.operators.encoding import category_indicators
from ratelens.operators.ranking import top_per_group
from ratelens.operators.scaling import fit_columns, impute, scale


class _Columns(Params):
    medianCols = Param(Params._dummy(), "medianCols", "columns whose NULLs take the median", TypeConverters.toListString)
    scaledCols = Param(Params._dummy(), "scaledCols", "columns with a min-max scaled copy", TypeConverters.toListString)
    categoryCols = Param(Params._dummy(), "categoryCols", "columns with an indicator per value", TypeConverters.toListString)
    maxCategories = Param(Params._dummy(), "maxCategories", "most values of a category column", TypeConverters.toInt)

    def _settle(self, values: dict) -> None:
        self._setDefault(medianCols=[], scaledCols=[], categoryCols=[], maxCategories=100)
        self._set(**{k: list(v) if k != "maxCategories" else v for k, v in values.items() if v is not None})


class Preprocessor(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fits exact medians and bounds, and the most frequent values of each category column in one aggregation.

    Equally frequent values are taken in order of their text; NULL is no value.
    """

    def __init__(self, medianCols=None, scaledCols=None, categoryCols=None, maxCategories=None):
        super().__init__()
        self._settle({
            "medianCols": medianCols, "scaledCols": scaledCols, "categoryCols": categoryCols, "maxCategories": maxCategories
        })

    def _fit(self, dataset: DataFrame) -> PreprocessorModel:
        get = self.getOrDefault
        medians, bounds, categories = get("medianCols"), get("scaledCols"), get("categoryCols")
        fitted = {"numbers": {}, "categories": {c: [] for c in categories}}
        if medians or bounds:
            fitted["numbers"] = fit_columns(dataset, medians, bounds).first()["fit"].asDict()
        if categories:
            pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("label")) for c in categories]))
            counts = dataset.select(pairs.alias("p")).select("p.*").filter("label IS NOT NULL").groupBy("column", "label").count()
            top = top_per_group(counts, ["column"], [F.desc("count"), F.asc("label")], get("maxCategories"))
            for r in top.orderBy("column", "rank").collect():  # at most maxCategories a column
                fitted["categories"][r["column"]].append(r["label"])
        return self._copyValues(PreprocessorModel(fitted))


class PreprocessorModel(Model, _Columns, MLWritable, MLReadable):
    """Adds what was fitted: filled columns in place, ``<column>_normalized`` and one indicator for each value.

    Rows outside the fitted bounds are scaled to less than 0 or more than 1; an unseen value has no indicator.
    """

    def __init__(self, fitted: dict | None = None):
        super().__init__()
        self.fitted = fitted or {"numbers": {}, "categories": {}}
        self._settle({})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        medians, bounds = get("medianCols"), get("scaledCols")
        if medians or bounds:
            values = [F.lit(v).alias(name) for name, v in self.fitted["numbers"].items()]
            fit = dataset.sparkSession.range(1).select(F.struct(*values).alias("fit"))
            outputs = [f"{c.lower()}_normalized" for c in bounds]
            dataset = scale(impute(dataset, medians, fit), bounds, outputs, fit)
        flags = [c for name, labels in self.fitted["categories"].items() for c in category_indicators(F.col(f"`{name}`"), labels, name)]
        return dataset.select("*", *flags)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: PreprocessorModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"fitted": self.model.fitted})


class _Reader(MLReader):
    def load(self, path: str) -> PreprocessorModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = PreprocessorModel(metadata["fitted"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
