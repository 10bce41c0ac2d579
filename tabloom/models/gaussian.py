"""Classifiers from class moments: Gaussian naive Bayes, linear and quadratic discriminants.

The data is read by one or two aggregates whose buffers are as large as the moments; only these reach the driver.
"""

import math

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from tabloom.functions.expressions import double_array
from tabloom.models.base import (
    BinaryEstimator, MarginModel, Param, Params, TypeConverters, dot, keyword_only, total,
)


def class_moments(rows):
    """Per class: count, means and population variances of the features."""
    found = rows.groupBy("y").agg(Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s")).collect()
    moments = {}
    for r in found:
        n = r["s"]["count"]
        moments[r["y"]] = (n, r["s"]["mean"].toArray(), r["s"]["variance"].toArray() * (n - 1) / n)
    if sorted(moments) != [0, 1]:
        raise ValueError(f"expected the classes 0 and 1, found {sorted(moments)}")
    return moments


def class_covariances(rows, moments, with_fourth=False):
    """Per class the population covariance matrix; optionally the sum of squared norms of standardised rows, squared.

    Products of centered features are averaged as one long vector, so the plan does not grow with the number of
    features.
    """
    means = F.when(F.col("y") == 1, double_array(moments[1][1])).otherwise(double_array(moments[0][1]))
    centered = rows.select("y", F.zip_with("x", means, lambda a, m: a - m).alias("z"))
    products = F.flatten(F.transform("z", lambda a: F.transform("z", lambda b: a * b)))
    aggregates = [Summarizer.mean(F.col("p")).alias("m")]
    if with_fourth:
        spread = [np.sqrt(np.where(moments[k][2] > 0, moments[k][2], 1.0)) for k in (0, 1)]
        scale = F.when(F.col("y") == 1, double_array(spread[1])).otherwise(double_array(spread[0]))
        centered = centered.withColumn("norm", total(F.zip_with("z", scale, lambda a, s: (a / s) * (a / s))))
        aggregates.append(F.sum(F.col("norm") * F.col("norm")).alias("fourth"))
    found = centered.withColumn("p", array_to_vector(products)).groupBy("y").agg(*aggregates).collect()
    d = len(moments[0][1])
    return {r["y"]: (r["m"].toArray().reshape(d, d), r["fourth"] if with_fourth else None) for r in found}


class GaussianNB(BinaryEstimator):
    """Naive Bayes with normal features; ``varSmoothing`` times the largest feature variance is added to all."""

    varSmoothing = Param(Params._dummy(), "varSmoothing", "share of the largest variance", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, varSmoothing=1e-9, featuresCol="features", labelCol="label"):
        super().__init__()
        self._setDefault(varSmoothing=1e-9)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        moments = class_moments(self.rows(df))
        n = {k: moments[k][0] for k in (0, 1)}
        everything = (n[0] * moments[0][1] + n[1] * moments[1][1]) / (n[0] + n[1])
        spread = sum(n[k] * (moments[k][2] + (moments[k][1] - everything) ** 2) for k in (0, 1)) / (n[0] + n[1])
        extra = self.getOrDefault("varSmoothing") * spread.max()
        variances = {k: moments[k][2] + extra for k in (0, 1)}
        constant = math.log(n[1] / n[0]) - 0.5 * float(np.sum(np.log(variances[1]) - np.log(variances[0])))
        model = QuadraticModel()
        model._set(
            constant=constant, means0=moments[0][1].tolist(), means1=moments[1][1].tolist(),
            weights0=(1 / variances[0]).tolist(), weights1=(1 / variances[1]).tolist())
        return self.hand_over(model)


class QuadraticModel(MarginModel):
    """Log-odds = constant + (d0 - d1) / 2 with d the weighted squared distance to a class mean.

    ``weights`` hold one weight per feature, or a whole matrix row by row.
    """

    constant = Param(Params._dummy(), "constant", "part independent of x", TypeConverters.toFloat)
    means0 = Param(Params._dummy(), "means0", "means of class 0", TypeConverters.toListFloat)
    means1 = Param(Params._dummy(), "means1", "means of class 1", TypeConverters.toListFloat)
    weights0 = Param(Params._dummy(), "weights0", "inverse variances or matrix of class 0", TypeConverters.toListFloat)
    weights1 = Param(Params._dummy(), "weights1", "inverse variances or matrix of class 1", TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()

    def distance(self, x, means, weights):
        z = F.zip_with(x, double_array(means), lambda a, m: a - m)
        if len(weights) == len(means):
            return total(F.zip_with(z, double_array(weights), lambda a, w: a * a * w))
        d = len(means)
        matrix = F.array(*[double_array(weights[i * d:(i + 1) * d]) for i in range(d)])
        return dot(z, F.transform(matrix, lambda row: dot(row, z)))

    def margin(self, x):
        p = {k.name: v for k, v in self.extractParamMap().items()}
        return F.lit(p["constant"]) + (self.distance(x, p["means0"], p["weights0"]) - self.distance(x, p["means1"], p["weights1"])) / 2


class LinearMarginModel(MarginModel):
    coefficients = Param(Params._dummy(), "coefficients", "weights of the features", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "constant part", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()

    def margin(self, x):
        return F.lit(self.getOrDefault("intercept")) + dot(x, double_array(self.getOrDefault("coefficients")))


class LinearDiscriminant(BinaryEstimator):
    """Common covariance of both classes. ``shrinkage``: 0..1 towards a multiple of the identity, -1 for the
    Ledoit-Wolf estimate per class."""

    shrinkage = Param(Params._dummy(), "shrinkage", "0..1, or -1 for automatic", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, shrinkage=0.0, featuresCol="features", labelCol="label"):
        super().__init__()
        self._setDefault(shrinkage=0.0)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        rows, shrinkage = self.rows(df), self.getOrDefault("shrinkage")
        moments = class_moments(rows)
        found = class_covariances(rows, moments, with_fourth=shrinkage < 0)
        n = moments[0][0] + moments[1][0]
        pooled = sum(moments[k][0] / n * shrunk(found[k], moments[k], shrinkage) for k in (0, 1))
        solved = np.linalg.lstsq(pooled, np.stack([moments[0][1], moments[1][1]], axis=1), rcond=None)[0]
        constants = [-0.5 * moments[k][1] @ solved[:, k] + math.log(moments[k][0] / n) for k in (0, 1)]
        model = LinearMarginModel()
        model._set(coefficients=(solved[:, 1] - solved[:, 0]).tolist(), intercept=float(constants[1] - constants[0]))
        return self.hand_over(model)


def shrunk(found, moments, shrinkage):
    covariance, fourth = found
    d = len(covariance)
    if shrinkage >= 0:
        return (1 - shrinkage) * covariance + shrinkage * np.trace(covariance) / d * np.eye(d)
    n, _, variances = moments
    scale = np.sqrt(np.where(variances > 0, variances, 1.0))
    standard = covariance / np.outer(scale, scale)
    amount = ledoit_wolf(standard, fourth, n)
    target = np.trace(standard) / d * np.eye(d)
    return ((1 - amount) * standard + amount * target) * np.outer(scale, scale)


def ledoit_wolf(covariance, fourth, n):
    """Published shrinkage intensity (Ledoit and Wolf 2004) from the covariance and the sum of squared squared norms."""
    d = len(covariance)
    mu = np.trace(covariance) / d
    squares = np.sum(covariance ** 2)
    distance = (squares - d * mu ** 2) / d
    error = min((fourth / n - squares) / (d * n), distance)
    return 0.0 if error <= 0 or distance <= 0 else error / distance


class QuadraticDiscriminant(BinaryEstimator):
    """One covariance per class, moved towards the identity by ``regParam``."""

    regParam = Param(Params._dummy(), "regParam", "0..1", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, regParam=0.0, featuresCol="features", labelCol="label"):
        super().__init__()
        self._setDefault(regParam=0.0)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        rows, reg = self.rows(df), self.getOrDefault("regParam")
        moments = class_moments(rows)
        found = class_covariances(rows, moments)
        inverse, constant = {}, math.log(moments[1][0] / moments[0][0])
        for k, sign in ((0, 0.5), (1, -0.5)):
            n = moments[k][0]
            covariance = (1 - reg) * found[k][0] * n / max(n - 1, 1) + reg * np.eye(len(moments[k][1]))
            inverse[k] = np.linalg.pinv(covariance, hermitian=True)
            constant += sign * float(np.sum(np.log(np.clip(np.linalg.eigvalsh(covariance), 1e-300, None))))
        model = QuadraticModel()
        model._set(constant=constant, means0=moments[0][1].tolist(), means1=moments[1][1].tolist(),
                   weights0=inverse[0].ravel().tolist(), weights1=inverse[1].ravel().tolist())
        return self.hand_over(model)
