"""Shared parts of the classifiers MLlib does not offer: they are ordinary MLlib estimators over a features vector."""

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import is_numeric


def assemble(df: DataFrame, target: str, features=None) -> DataFrame:
    """Add ``features`` (vector) and ``label`` (double). Missing values are an error, as in training libraries."""
    names = features or [c for c in df.columns if c != target]
    wrong = [c for c in names if not is_numeric(df, c)]
    if wrong:
        raise ValueError(f"feature columns {wrong} are not numeric")
    vectors = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error").transform(df)
    return vectors.withColumn("label", F.col(target).cast("double")) if target in df.columns else vectors


def sigmoid(margin):
    return 1 / (1 + F.exp(-margin))


class Columns(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    pass


class MarginModel(Model, Columns, DefaultParamsReadable, DefaultParamsWritable):
    """A model that gives the log-odds of class 1 as one expression over the feature array ``x``."""

    def margin(self, x):
        raise NotImplementedError

    def _transform(self, df):
        margin, p = F.col("__margin"), F.col("__p")
        scored = (df.withColumn("__x", vector_to_array(F.col(self.getFeaturesCol())))
                  .withColumn("__margin", self.margin(F.col("__x"))).withColumn("__p", sigmoid(margin)))
        return scored.withColumns({
            self.getRawPredictionCol(): array_to_vector(F.array(-margin, margin)),
            self.getProbabilityCol(): array_to_vector(F.array(1 - p, p)),
            self.getPredictionCol(): (margin > 0).cast("double"),
        }).drop("__x", "__margin", "__p")


class BinaryEstimator(Estimator, Columns, DefaultParamsReadable, DefaultParamsWritable):
    def hand_over(self, model):
        """Give the model this estimator's column names."""
        for name in ("featuresCol", "predictionCol", "probabilityCol", "rawPredictionCol"):
            model._set(**{name: self.getOrDefault(name)})
        return model

    def rows(self, df):
        """(y, x) with the features as an array."""
        return df.select(F.col(self.getLabelCol()).cast("int").alias("y"), F.col(self.getFeaturesCol()).alias("v"),
                         vector_to_array(F.col(self.getFeaturesCol())).alias("x"))


def total(array):
    return F.aggregate(array, F.lit(0.0), lambda acc, v: acc + v)


def dot(a, b):
    return total(F.zip_with(a, b, lambda p, q: p * q))


__all__ = [
    "BinaryEstimator", "Columns", "MarginModel", "Param", "Params", "TypeConverters", "HasWeightCol", "assemble", "dot",
    "keyword_only", "sigmoid", "total",
]
