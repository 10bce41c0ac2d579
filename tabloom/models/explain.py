"""Which features a model leans on, overall and around single rows."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import col
from tabloom.functions.stats import column_stats

RIDGE = 1.0             # penalty of the local linear model
KERNEL_SHARE = 0.75     # kernel width as a share of the root of the number of features


def feature_importance(model, features, spark) -> DataFrame:
    """(feature, importance), largest first: coefficients of linear models, impurity decrease of trees."""
    values = importances(model)
    if values is None:
        raise ValueError(f"{type(model).__name__} has no feature importance")
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def importances(model):
    if isinstance(model, PipelineModel):
        from tabloom.models.ensembles import VoteModel
        last = model.stages[-1]
        if isinstance(last, VoteModel):
            alphas = last.getOrDefault("alphas")
            parts = [a * t.featureImportances.toArray() for a, t in zip(alphas, model.stages)]
            return sum(parts) / sum(alphas)
        for stage in model.stages:      # a calibrated model: the model inside it
            found = importances(stage)
            if found is not None:
                return found
        return None
    if hasattr(model, "featureImportances"):
        return model.featureImportances.toArray()
    if hasattr(model, "coefficients"):
        return model.coefficients.toArray()
    if model.hasParam("coefficients"):
        return model.getOrDefault("coefficients")
    return None


def explain_local(model, rows: DataFrame, reference: DataFrame, features, key, samples=500, seed=0) -> DataFrame:
    """(key, feature, weight, intercept, r2): a weighted linear model of class 1's probability around each row.

    Every row becomes ``samples`` normal perturbations (the first is the row itself), seeded by its key, which the model
    scores as ordinary rows. Each row's scores, a list of that fixed length, are then fitted by ridge regression on the
    same perturbations, made again from the seed. Rows are spread by key once, before they are multiplied, and stay where
    they are. Weights refer to features in units of the reference data's standard deviation.
    """
    stats = column_stats(reference, {f: ["std_pop"] for f in features})
    spread = np.array([stats[f]["std_pop"] or 1.0 for f in features])
    d = len(features)
    width = KERNEL_SHARE * np.sqrt(d)

    def noise(mark):
        z = np.random.default_rng(abs(int(mark))).normal(size=(samples, d))
        z[0] = 0.0
        return z

    @F.arrow_udf("array<array<double>>")
    def perturbed(mark: pa.Array, x: pa.Array) -> pa.Array:
        # flat numbers with offsets: no object for any of the perturbations
        rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), d)
        points = np.empty((len(x), samples, d))
        for point, m, v in zip(points, mark.to_pylist(), rows):
            point[:] = v + noise(m) * spread
        points = pa.ListArray.from_arrays(np.arange(0, points.size + 1, d, dtype=np.int32), points.reshape(-1))
        return pa.ListArray.from_arrays(np.arange(0, len(points) + 1, samples, dtype=np.int32), points)

    def fit(batches):
        for batch in batches:
            out = []
            for k, m, p in zip(batch["key"], batch["mark"], batch["p"]):
                z = noise(m)
                w = np.sqrt(np.exp(-(z ** 2).sum(axis=1) / width ** 2))
                zm, pm = np.average(z, axis=0, weights=w), np.average(p, weights=w)
                zc, pc = z - zm, np.asarray(p) - pm
                weights = np.linalg.solve((zc * w[:, None]).T @ zc + RIDGE * np.eye(d), (zc * w[:, None]).T @ pc)
                rest, whole = np.sum(w * (pc - zc @ weights) ** 2), np.sum(w * pc ** 2)
                r2 = 1 - rest / whole if whole > 0 else 1.0
                out += [(k, f, v, pm - zm @ weights, r2) for f, v in zip(features, weights)]
            yield pd.DataFrame(out, columns=["key", "feature", "weight", "intercept", "r2"])

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.select(col(key).cast("string").alias("key"), F.xxhash64(col(key).cast("string"), F.lit(seed)).alias("mark"),
                        F.array(*[col(f).cast("double") for f in features]).alias("x")).repartition(tasks, "key", "mark").sortWithinPartitions("mark", "key")
    points = keyed.select("key", "mark", F.posexplode(perturbed("mark", "x")).alias("place", "x"))
    scored = model.transform(points.withColumn("features", array_to_vector("x")))
    scored = scored.select("key", "mark", "place", vector_to_array(F.col("probability"))[1].alias("p"))
    # the rows come in this order, so that sorting them for the groups, and in the lists, only passes over them
    lists = scored.groupBy("mark", "key").agg(F.sort_array(F.collect_list(F.struct("place", "p"))).alias("s"))
    return lists.select("key", "mark", F.col("s.p").alias("p")).mapInPandas(
        fit, "key string, feature string, weight double, intercept double, r2 double")
