"""Boosted trees for more than two classes: one model per class against the rest over the same vectors.

Shares of the classes are the sigmoids of the margins, divided by their sum. All of it is built-in expressions over the
margins, so scoring stays in the JVM. Fitting reads the vectors once per class and iteration: hand in cached ones.
The number of models is the number of classes, at most ``MOST_CLASSES``.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: classes beyond this number are an error: each costs a whole boosted model
MOST_CLASSES = 200


class BoostedClasses(Estimator):
    """Fits a boosted model per class; labels are 0, 1, ... and every setting of the two-class trees holds for all of them.

    A class below the largest label that has no rows gets a model that never foretells it.
    """

    def __init__(self, featuresCol: str = "features", labelCol: str = "label", **settings):
        super().__init__()
        self.features, self.label, self.settings = featuresCol, labelCol, settings

    def _fit(self, df: DataFrame) -> BoostedClassesModel:
        last = df.agg(F.max(self.label)).first()[0]
        if last is None:
            raise ValueError("no labelled rows to learn from")
        if last >= MOST_CLASSES:
            raise ValueError(f"{int(last) + 1} classes, at most {MOST_CLASSES} are possible")
        trees = GBTClassifier(featuresCol=self.features, labelCol="_is_class", **self.settings)
        fitted = [trees.fit(df.withColumn("_is_class", (F.col(self.label) == i).cast("double"))) for i in range(int(last) + 1)]
        return BoostedClassesModel.of(fitted)


class _ModelsWriter(DefaultParamsWriter):
    """Saves the parameters and, next to them, the model of each class."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        for i, model in enumerate(self.instance.models):
            model.write().overwrite().save(f"{path}/class_{i}")


class _ModelsReader(DefaultParamsReader):
    """Loads what ``_ModelsWriter`` saved."""

    def load(self, path: str) -> BoostedClassesModel:
        loaded = super().load(path)
        loaded.models = [GBTClassificationModel.load(f"{path}/class_{i}") for i in range(loaded.numClasses)]
        return loaded


class BoostedClassesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability``, one share per class, and ``prediction``, the class with the largest one (the first of equal ones)."""

    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)
    models: list[GBTClassificationModel]

    @classmethod
    def of(cls, models: list[GBTClassificationModel]) -> BoostedClassesModel:
        made = cls()
        made._set(classes=len(models))
        made.models = models
        return made

    @property
    def numClasses(self) -> int:
        return self.getOrDefault(self.classes)

    @property
    def featureImportances(self) -> DenseVector:
        """The mean over the classes."""
        return DenseVector(sum(m.featureImportances.toArray() for m in self.models) / len(self.models))

    def write(self) -> _ModelsWriter:
        return _ModelsWriter(self)

    @classmethod
    def read(cls) -> _ModelsReader:
        return _ModelsReader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        raw = [f"_margin_{i}" for i in range(self.numClasses)]
        for name, model in zip(raw, self.models):
            df = model.copy().setRawPredictionCol(name).setProbabilityCol("").setPredictionCol("").transform(df)
        sigmoids = F.array(*(1 / (1 + F.exp(-2 * vector_to_array(F.col(name))[1])) for name in raw))
        shares = df.withColumn("_sigmoids", sigmoids)
        total = F.aggregate("_sigmoids", F.lit(0.0), lambda a, x: a + x)
        # margins so far below zero that every sigmoid is zero say nothing: equal shares
        even = F.lit(1.0 / self.numClasses)
        shares = shares.withColumn("_total", total).withColumn(
            "_shares", F.transform("_sigmoids", lambda x: F.when(F.col("_total") > 0, x / F.col("_total")).otherwise(even))
        )
        largest = F.array_position("_shares", F.array_max("_shares")) - 1
        made = {"probability": array_to_vector(F.col("_shares")), "prediction": largest.cast("double")}
        return shares.withColumns(made).drop(*raw, "_sigmoids", "_total", "_shares")
