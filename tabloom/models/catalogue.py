"""The classifiers by name, their search spaces and what they can do."""

import itertools
import math
import random
import warnings
from dataclasses import dataclass

from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import col
from tabloom.models.ensembles import AdaBoost, RidgeClassifier
from tabloom.models.gaussian import GaussianNB, LinearDiscriminant, QuadraticDiscriminant
from tabloom.models.knn import KNNClassifier

# The search ranges. A value of None leaves the estimator's default.
MAX_ITER = [5, 10, 15, 20, 25, 30, 35, 40, 45, 50, 100, 200, 500, 1000, 2000, 3000, 4000, 5000, 10000]
FOREST = {"impurity": ["gini", "entropy"], "maxDepth": [3, 5, None], "featureSubsetStrategy": ["2", "3", "sqrt"],
          "minInstancesPerNode": [1, 5, 10], "numTrees": [50, 100, 150, 200, 250]}
TENTHS = [i / 10 for i in range(11)]


def logspace(low, high, n):
    return [10 ** (low + (high - low) * i / (n - 1)) for i in range(n)] if n > 1 else [10.0 ** low]


@dataclass(frozen=True)
class Kind:
    """One classifier: how to make it, its grids, and whether it has probabilities, weights and importances."""

    make: object
    grids: object
    probability: bool = True
    weighting: bool = False
    importance: bool = False


def regularised(C, rows):
    """MLlib averages the losses, so the usual inverse strength C becomes 1 / (C rows)."""
    return 1.0 / (C * rows)


def logistic(rows, seed, C=1.0, **params):
    """``penalty`` is l1, l2, elasticnet or None; coefficients are not standardised."""
    penalty = params.pop("penalty", "l2")
    ratio = {"l1": 1.0, "l2": 0.0, None: 0.0}.get(penalty, params.pop("l1_ratio", 0.5))
    params.pop("l1_ratio", None)
    strength = 0.0 if penalty is None else regularised(C, rows)
    return LogisticRegression(elasticNetParam=ratio, regParam=strength, standardization=False, family="binomial", **params)


def bagged(rows, seed, maxFeatures=1.0, maxSamples=1.0, numTrees=10, maxDepth=10, **params):
    """Bootstrap of deep trees; the feature share is drawn per split."""
    share = "all" if maxFeatures == 1 else str(float(maxFeatures))
    return RandomForestClassifier(numTrees=numTrees, featureSubsetStrategy=share, subsamplingRate=float(maxSamples), bootstrap=True, maxDepth=maxDepth, seed=seed, **params)


def mlp(rows, seed, n_features=None, hidden=(100,), **params):
    return MultilayerPerceptronClassifier(layers=[n_features, *hidden, 2], seed=seed, **params)


def plain(estimator, seeded=False):
    def make(rows, seed, **params):
        return estimator(seed=seed, **params) if seeded else estimator(**params)
    return make


def svc(rows, seed, C=1.0, **params):
    return LinearSVC(regParam=regularised(C, rows), standardization=False, **params)


MODELS = {
    "GaussianNB": Kind(plain(GaussianNB), lambda n: [{"varSmoothing": logspace(-15, 0, int(n * 3.5))}]),
    "KNeighborsClassifier": Kind(plain(KNNClassifier), lambda n: [
        {"metric": ["euclidean", "manhattan", "minkowski", "chebyshev"], "k": list(range(1, 11)), "p": [1.0, 2.0, 3.0, 4.0], "weights": ["uniform", "distance"]},
        {"metric": ["mahalanobis"], "k": list(range(1, 11)), "weights": ["uniform", "distance"]}]),
    "LogisticRegression": Kind(logistic, lambda n: [
        {"penalty": ["l1"], "C": logspace(-20, 10, 100), "maxIter": MAX_ITER},
        {"penalty": ["l2"], "C": logspace(-20, 10, 100), "maxIter": MAX_ITER},
        {"penalty": ["elasticnet"], "C": logspace(-20, 10, 100), "l1_ratio": [i / 9 for i in range(10)], "maxIter": MAX_ITER},
        {"penalty": [None], "maxIter": MAX_ITER}], weighting=True, importance=True),
    "LinearDiscriminantAnalysis": Kind(plain(LinearDiscriminant), lambda n: [{"shrinkage": [0.0, -1.0, *TENTHS[1:]]}]),
    "QuadraticDiscriminantAnalysis": Kind(plain(QuadraticDiscriminant), lambda n: [{"regParam": TENTHS}]),
    "SVC": Kind(svc, lambda n: [{"C": [0.1, 1, 10, 20]}], probability=False, weighting=True),
    "RandomForestClassifier": Kind(plain(RandomForestClassifier, True), lambda n: [FOREST], weighting=True, importance=True),
    "XGBClassifier": Kind(plain(GBTClassifier, True), lambda n: [
        {"stepSize": [0.01, 0.1, 1.0], "maxDepth": [3, 5, 10, None], "minInstancesPerNode": [1, 5, 10], "maxIter": [10, 30, 50, 100],
         "subsamplingRate": [0.5, 0.8, 1.0], "featureSubsetStrategy": ["0.5", "0.8", "all"], "minInfoGain": [0.0, 1.0, 5.0]}], weighting=True, importance=True),
    "LGBMClassifier": Kind(plain(GBTClassifier, True), lambda n: [
        {"stepSize": [0.01, 0.05, 0.1, 1.0], "maxDepth": [1, 3, 5, 7], "minInstancesPerNode": [5, 10, 20, 50, 80], "maxIter": [30, 50, 100, 150, 200],
         "subsamplingRate": [0.1, 0.2, 0.5, 0.8], "featureSubsetStrategy": ["0.3", "0.5", "0.8", "all"]}], weighting=True, importance=True),
    "GradientBoostingClassifier": Kind(plain(GBTClassifier, True), lambda n: [
        {"stepSize": [0.1, 1.0], "maxDepth": [3, 5, 7], "minInstancesPerNode": [1, 5, 10, 15], "maxIter": [50, 100, 150]}], importance=True),
    "CatBoostClassifier": Kind(plain(GBTClassifier, True), lambda n: [
        {"maxBins": [16, 32, 64, 128, 256], "stepSize": [0.01, 0.05, 0.1, 0.5, 1.0], "maxDepth": [1, 3, 5, 7], "maxIter": [30, 50, 100, 150, 200]}], weighting=True, importance=True),
    "AdaBoostClassifier": Kind(plain(AdaBoost, True), lambda n: [{"stepSize": [0.001, 0.01, 0.1, 1.0], "numTrees": [10, 30, 50, 100]}], importance=True),
    "MLPClassifier": Kind(mlp, lambda n: [
        {"solver": ["l-bfgs", "gd"], "hidden": [(50,), (100,), (50, 50)], "maxIter": [2000, 5000], "blockSize": [128, 100, 200, 300], "stepSize": [0.001, 0.01, 0.1]}]),
    "RidgeClassifier": Kind(plain(RidgeClassifier), lambda n: [{"alpha": [1.0, 10.0, 100.0, 1000.0], "fitIntercept": [True, False]}], probability=False, weighting=True),
    "BaggingClassifier": Kind(bagged, lambda n: [{"maxFeatures": [0.5, 0.8, 1.0], "maxSamples": [0.5, 0.8, 1.0], "numTrees": [10, 30, 50, 100]}], weighting=True),
    "DecisionTreeClassifier": Kind(plain(DecisionTreeClassifier, True), lambda n: [{"maxDepth": [3, 5, 10]}], weighting=True, importance=True),
}


def kind_of(name: str) -> Kind:
    if name not in MODELS:
        raise ValueError(f"the model '{name}' does not exist; available: {list(MODELS)}")
    return MODELS[name]


def make_model(name, rows, seed=0, n_features=None, weighted=False, **params):
    """A fresh estimator. ``weighted`` reads the column 'weight' where the model can."""
    kind = kind_of(name)
    params = {k: v for k, v in params.items() if v is not None or k == "penalty"}
    if name == "MLPClassifier":
        params["n_features"] = n_features
    estimator = kind.make(rows, seed, **params)
    if weighted and kind.weighting:
        estimator.set(estimator.weightCol, "weight")
    return estimator


def all_settings(name, n_iter=10, grids=None) -> list[dict]:
    return [dict(zip(grid, values)) for grid in (grids or kind_of(name).grids(n_iter)) for values in itertools.product(*grid.values())]


def sampled_settings(name, n_iter, seed=0, grids=None) -> list[dict]:
    """``n_iter`` different settings; a grid is drawn first, then one value per parameter."""
    grids = grids or kind_of(name).grids(n_iter)
    total = sum(math.prod(len(v) for v in g.values()) for g in grids)
    if total <= n_iter:
        return all_settings(name, n_iter, grids)
    draw, seen = random.Random(seed), {}
    while len(seen) < n_iter:
        grid = draw.choice(grids)
        setting = {k: draw.choice(v) for k, v in grid.items()}
        seen.setdefault(repr(setting), setting)
    return list(seen.values())


def class_weights(df: DataFrame, target, ratio=None, name="weight") -> DataFrame:
    """Add a weight: rows / (2 rows of the class), or with ``ratio`` round(ratio) for class 1 and 1 for class 0.

    One small count; the weights become literals, so nothing is joined.
    """
    if ratio is not None:
        return df.withColumn(name, F.when(col(target) == 1, float(round(ratio))).otherwise(1.0))
    counts = {r["y"]: r["n"] for r in df.filter(col(target).isNotNull()).groupBy(col(target).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) != 2:
        raise ValueError(f"expected exactly 2 classes, found {sorted(counts)}")
    total = sum(counts.values())
    weight = None
    for y, n in sorted(counts.items()):
        weight = F.when(col(target) == F.lit(y), total / (2.0 * n)) if weight is None else weight.when(col(target) == F.lit(y), total / (2.0 * n))
    return df.withColumn(name, weight)


def warn_unweighted(names):
    for name in names:
        if not kind_of(name).weighting:
            warnings.warn(f"model {name} does not support class weights, and the classes are imbalanced")
