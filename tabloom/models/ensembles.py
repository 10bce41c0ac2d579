"""Boosted stumps, the ridge classifier and isotonic calibration, composed of MLlib models."""

import math

from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import IsotonicRegression, LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from tabloom.functions.expressions import double_array
from tabloom.models.base import BinaryEstimator, Columns, HasWeightCol, keyword_only, sigmoid, total
from tabloom.session import materialize

ROUNDS_PER_TABLE = 8    # boosting rounds between written tables, which keep the plan short


class VoteModel(Model, Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Weighted vote of the columns ``__tree0``, ``__tree1``, ..."""

    alphas = Param(Params._dummy(), "alphas", "weight of each tree", TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()

    def _transform(self, df):
        alphas = self.getOrDefault("alphas")
        names = [f"__tree{i}" for i in range(len(alphas))]
        votes = F.array(*[F.col(n) * 2 - 1 for n in names])
        margin = total(F.zip_with(votes, double_array(alphas), lambda v, a: v * a)) / F.lit(sum(alphas))
        scored = df.withColumn("__margin", margin)
        p = sigmoid(F.col("__margin"))
        scored = scored.withColumns({
            self.getRawPredictionCol(): array_to_vector(F.array(-F.col("__margin"), F.col("__margin"))),
            self.getProbabilityCol(): array_to_vector(F.array(1 - p, p)),
            self.getPredictionCol(): (F.col("__margin") > 0).cast("double"),
        })
        return scored.drop("__margin", *names, *[f"__raw{i}" for i in range(len(alphas))], *[f"__prob{i}" for i in range(len(alphas))])


def with_x(rows):
    return rows.withColumn("x", vector_to_array(F.col("features")))


def tree_label(node, x):
    """The class that a fitted tree gives, as one expression over the feature array ``x``.

    Each round reads the rows several times and weighs them by all rounds since the last table, which MLlib's own columns
    (three functions over vectors a tree) would make the work of."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    cut = node.split()
    value = F.get(x, F.lit(cut.featureIndex()))
    if cut.getClass().getSimpleName() == "ContinuousSplit":
        left = value <= F.lit(float(cut.threshold()))
    else:
        left = value.isin([float(c) for c in cut.leftCategories()])
    return F.when(left, tree_label(node.leftChild(), x)).otherwise(tree_label(node.rightChild(), x))


class AdaBoost(BinaryEstimator, HasWeightCol):
    """Stumps fitted one after another, each on weights raised where the last one erred (SAMME)."""

    numTrees = Param(Params._dummy(), "numTrees", "most trees", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "learning rate", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, numTrees=50, stepSize=1.0, maxDepth=1, seed=0, featuresCol="features", labelCol="label"):
        super().__init__()
        self._setDefault(numTrees=50, stepSize=1.0, maxDepth=1, seed=0)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        label, features = self.getLabelCol(), self.getFeaturesCol()
        start = F.col(self.getWeightCol()) if self.isSet("weightCol") else F.lit(1.0)
        rows = materialize(df.select(F.col(features).alias("features"), F.col(label).cast("double").alias("label"),
                                     start.cast("double").alias("w")), "boost")
        rows = with_x(rows)
        trees, alphas = [], []
        for i in range(self.getOrDefault("numTrees")):
            stump = DecisionTreeClassifier(
                featuresCol="features", labelCol="label", weightCol="w", maxDepth=self.getOrDefault("maxDepth"),
                seed=self.getOrDefault("seed"), predictionCol=f"__tree{i}", rawPredictionCol=f"__raw{i}", probabilityCol=f"__prob{i}")
            tree = stump.fit(rows)
            wrong = tree_label(tree._java_obj.rootNode(), F.col("x")) != F.col("label")
            totals = rows.agg(F.sum("w").alias("all"), F.coalesce(F.sum(F.when(wrong, F.col("w"))), F.lit(0.0)).alias("bad")).first()
            error = totals["bad"] / totals["all"]
            if error >= 0.5:
                if not trees:
                    trees, alphas = [tree], [1e-9]
                break
            alpha = self.getOrDefault("stepSize") * math.log((1 - max(error, 1e-12)) / max(error, 1e-12))
            trees.append(tree)
            alphas.append(alpha)
            if error <= 1e-12:
                break
            # Raised where wrong, and brought back to a total of one row each on average.
            scale = totals["all"] / (totals["all"] - totals["bad"] + totals["bad"] * math.exp(alpha))
            rows = rows.select("features", "x", "label", (F.col("w") * F.when(wrong, math.exp(alpha)).otherwise(1.0) * scale).alias("w"))
            if (i + 1) % ROUNDS_PER_TABLE == 0:
                rows = with_x(materialize(rows.drop("x"), "boost"))
        for tree in trees:
            tree.setFeaturesCol(features)
        vote = VoteModel()
        vote._set(alphas=alphas)
        return PipelineModel(stages=[*trees, self.hand_over(vote)])


class SignModel(Model, Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Class by the sign of a fitted value; there is no probability."""

    valueCol = Param(Params._dummy(), "valueCol", "fitted value", TypeConverters.toString)

    def __init__(self):
        super().__init__()

    def _transform(self, df):
        value = F.col(self.getOrDefault("valueCol"))
        return df.withColumns({
            self.getRawPredictionCol(): array_to_vector(F.array(-value, value)),
            self.getPredictionCol(): (value > 0).cast("double"),
        }).drop(self.getOrDefault("valueCol"))


class RidgeClassifier(BinaryEstimator, HasWeightCol):
    """Least squares on labels -1 and 1 with penalty ``alpha`` on the squared coefficients."""

    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)
    fitIntercept = Param(Params._dummy(), "fitIntercept", "whether to fit a constant", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, alpha=1.0, fitIntercept=True, featuresCol="features", labelCol="label"):
        super().__init__()
        self._setDefault(alpha=1.0, fitIntercept=True)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        weighted = self.isSet("weightCol")
        rows = df.withColumn("__sign", F.col(self.getLabelCol()) * 2.0 - 1.0)
        w = F.col(self.getWeightCol()) if weighted else F.lit(1.0)
        sums = rows.agg(F.sum(w).alias("n"), F.sum(w * F.col("__sign")).alias("s")).first()
        size, mean = sums["n"], sums["s"] / sums["n"]
        # MLlib averages the squared errors and divides the penalty by the label's deviation, which undoes both factors.
        least_squares = LinearRegression(
            featuresCol=self.getFeaturesCol(), labelCol="__sign", predictionCol="__fitted", solver="normal", elasticNetParam=0.0,
            regParam=self.getOrDefault("alpha") / size * math.sqrt(1 - mean * mean), standardization=False, fitIntercept=self.getOrDefault("fitIntercept"))
        if weighted:
            least_squares.setWeightCol(self.getWeightCol())
        sign = SignModel()
        sign._set(valueCol="__fitted")
        return PipelineModel(stages=[least_squares.fit(rows), self.hand_over(sign)])


class ScoreColumn(Transformer, Columns, DefaultParamsReadable, DefaultParamsWritable):
    """The base model's score of class 1 as a plain column: its probability, or its raw value if it has none."""

    def __init__(self):
        super().__init__()

    def _transform(self, df):
        source = self.getProbabilityCol() if self.getProbabilityCol() in df.columns else self.getRawPredictionCol()
        return df.withColumn("__score", vector_to_array(F.col(source))[1])


class CalibratedOutput(Transformer, Columns, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self):
        super().__init__()

    def _transform(self, df):
        p = F.col("__calibrated")
        return df.withColumns({
            self.getProbabilityCol(): array_to_vector(F.array(1 - p, p)),
            self.getRawPredictionCol(): array_to_vector(F.array(1 - p, p)),
            self.getPredictionCol(): (p > 0.5).cast("double"),
        }).drop("__score", "__calibrated")


def calibrate_isotonic(model, train):
    """The fitted model followed by a monotone map from its score to a probability, learned on ``train``.

    Rows are combined per distinct score before the regression, which changes nothing in its result: equal scores get
    one value, weighted by their rows.
    """
    score = ScoreColumn()
    scored = score.transform(model.transform(train))
    points = scored.groupBy("__score").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    isotonic = IsotonicRegression(featuresCol="__score", labelCol="label", weightCol="weight", predictionCol="__calibrated")
    return PipelineModel(stages=[model, score, isotonic.fit(points), CalibratedOutput()])


def is_calibrated(model) -> bool:
    return isinstance(model, PipelineModel) and isinstance(model.stages[-1], CalibratedOutput)
