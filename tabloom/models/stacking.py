"""Stacking: base models' probabilities as features of a second model."""

from pyspark.ml import Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.session import materialize

META_TYPES = ("logistic_regression", "gradient_boosting", "neural_network")


def stack_features(models, df: DataFrame, names=None) -> DataFrame:
    """Add per base model the probability of class 1 as a column, and all of them as the vector ``stacked``.

    The models are applied one after another to the same rows, so nothing has to be aligned or joined.
    """
    names = names or [f"base_{i}" for i in range(len(models))]
    for name, model in zip(names, models):
        before = df.columns
        scored = model.transform(df)
        if "probability" not in scored.columns:
            raise ValueError(f"base model '{name}' gives no probability: use its calibrated version")
        df = scored.select(*before, vector_to_array(F.col("probability"))[1].alias(name))
    return VectorAssembler(inputCols=list(names), outputCol="stacked", handleInvalid="error").transform(df)


def meta_model(how: str, n_models: int, seed=0, **params):
    """``neural_network``: one hidden layer of 16, the nearest MLlib has to a small network."""
    if how == "logistic_regression":
        return LogisticRegression(**{"featuresCol": "stacked", "labelCol": "label", "family": "binomial", **params})
    if how == "gradient_boosting":
        return GBTClassifier(**{"featuresCol": "stacked", "labelCol": "label", "maxIter": 100, "stepSize": 0.1, "seed": seed, **params})
    if how == "neural_network":
        return MultilayerPerceptronClassifier(**{
            "featuresCol": "stacked", "labelCol": "label", "layers": [n_models, 16, 2], "maxIter": 100, "seed": seed, **params})
    raise ValueError(f"stacking_model_type must be one of {META_TYPES}")


class StackedModel(Transformer):
    """Base models and the meta model as one."""

    def __init__(self, models, meta):
        super().__init__()
        self.models, self.meta = list(models), meta

    def _transform(self, df):
        return self.meta.transform(stack_features(self.models, df)).drop("stacked", *[f"base_{i}" for i in range(len(self.models))])


def stack_fit(models, train: DataFrame, how="logistic_regression", seed=0, **params) -> StackedModel:
    """The base models score the rows once; the meta model's passes read the written scores."""
    meta = meta_model(how, len(models), seed, **params)
    scores = materialize(stack_features(models, train).select("stacked", "label"), "stacked")
    return StackedModel(models, meta.fit(scores))

