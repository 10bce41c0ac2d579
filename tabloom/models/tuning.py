"""Hyperparameter search over stratified folds."""

import math
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.models.catalogue import all_settings, kind_of, make_model, sampled_settings
from tabloom.models.ensembles import ScoreColumn
from tabloom.operators.metrics import confusion_metrics, roc_auc
from tabloom.operators.sample import stratified_folds
from tabloom.session import scratch_path, with_row_id

RANKED = ("roc_auc", "gini")
SCORING = ("accuracy", "precision", "recall", "f1", *RANKED)
BY_LABEL = {"precision": "precisionByLabel", "recall": "recallByLabel", "f1": "fMeasureByLabel"}


def evaluator_for(metric: str) -> Evaluator:
    """accuracy, precision, recall and f1 of class 1, roc_auc, gini (which ranks as the AUC)."""
    if metric == "accuracy":
        return MulticlassClassificationEvaluator(metricName="accuracy")
    if metric in BY_LABEL:
        return MulticlassClassificationEvaluator(metricName=BY_LABEL[metric], metricLabel=1.0)
    if metric in ("roc_auc", "gini"):
        return BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)
    raise ValueError(f"unsupported metric '{metric}': use accuracy, precision, recall, f1, roc_auc or gini")


@dataclass(frozen=True)
class Folded:
    """Rows with features, label and a fold, written once in a folder for each fold, so that a fit reads the folds it needs."""

    rows: DataFrame
    folds: int
    count: int
    n_features: int


def fold_rows(train, folds=5, seed=0, key_cols=None) -> Folded:
    """Folds stratified by label and fixed by the row's key (rows are numbered if it has none)."""
    spark = train.sparkSession
    keyed = train if key_cols else with_row_id(train)
    path = scratch_path(spark, "folds")
    folded = stratified_folds(keyed, "label", key_cols or ["__id"], folds, seed)
    folded.write.partitionBy("fold").parquet(path)
    rows = spark.read.schema(folded.schema).parquet(path)
    first = rows.select("features").first()
    return Folded(rows, folds, rows.count(), len(first["features"]))


SCORED = "score double, prediction int, label int, rows long, setting int, fold int"


def cross_scores(folded: Folded, name, settings, seed=0, weighted=False, parallelism=4) -> DataFrame:
    """(setting, fold, score, prediction, label, rows): what the models of every setting say on the fold they have not seen.

    Equal answers are combined, so a table of counts is all that any metric needs. ``parallelism`` fits run at once; each
    writes its part, and a lost executor costs the fits that ran on it.
    """
    spark = folded.rows.sparkSession
    path = scratch_path(spark, "cross-scores")

    def fit(task):
        number, fold = task
        model = make_model(name, folded.count, seed, folded.n_features, weighted, **settings[number]).fit(folded.rows.filter(F.col("fold") != fold))
        done = ScoreColumn().transform(model.transform(folded.rows.filter(F.col("fold") == fold)))
        counts = done.groupBy(F.col("__score").alias("score"), F.col("prediction").cast("int").alias("prediction"),
                              F.col("label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("rows"))
        counts.write.parquet(f"{path}/setting={number}/fold={fold}")

    with ThreadPool(parallelism) as pool:
        tasks = [(number, fold) for number in range(len(settings)) for fold in range(folded.folds)]
        for _ in pool.imap_unordered(inheritable_thread_target(spark)(fit), tasks):
            pass
    return spark.read.schema(SCORED).parquet(path)


def mean_metrics(scores: DataFrame, scoring, folds: int) -> DataFrame:
    """(setting, one column a metric): means over the folds, of class 1; null where a fold leaves a metric undefined."""
    wrong = [m for m in scoring if m not in SCORING]
    if wrong:
        raise ValueError(f"unsupported metrics {wrong}: use {SCORING}")
    by = ["setting", "fold"]
    found = confusion_metrics(scores, "label", "prediction", by, "rows")
    if any(m in RANKED for m in scoring):
        ranked = roc_auc(scores, "label", "score", by, "rows").withColumnRenamed("auc", "roc_auc")
        found = found.join(ranked.withColumn("gini", F.col("roc_auc") * 2 - 1), by, "left")
    return found.groupBy("setting").agg(*[F.when(F.count(m) == folds, F.avg(m)).alias(m) for m in scoring])


@dataclass(frozen=True)
class Search:
    """The best setting's model, refitted on all rows, and the means of every metric for every setting."""

    model: Model
    setting: dict
    settings: list[dict]
    means: list[dict]


def search_folded(folded: Folded, name, scoring, how="grid", n_iter=10, seed=0, weighted=False, parallelism=4, settings=None, grids=None) -> Search:
    """Search over folds that are written already; the first metric of ``scoring`` chooses, the first setting wins a tie."""
    if how not in ("grid", "randomized"):
        raise ValueError("the search must be 'grid' or 'randomized'")
    kind_of(name)
    if settings is None:
        settings = all_settings(name, n_iter, grids) if how == "grid" else sampled_settings(name, n_iter, seed, grids)
    means = mean_metrics(cross_scores(folded, name, settings, seed, weighted, parallelism), scoring, folded.folds)
    rows = {r["setting"]: r.asDict() for r in means.collect()}
    means = [{m: rows[i][m] for m in scoring} for i in range(len(settings))]
    best = max(range(len(settings)), key=lambda i: -math.inf if means[i][scoring[0]] is None else means[i][scoring[0]])
    model = make_model(name, folded.count, seed, folded.n_features, weighted, **settings[best]).fit(folded.rows)
    return Search(model, settings[best], settings, means)


def search(train, name, target_metric="f1", how="grid", n_iter=10, folds=5, seed=0, key_cols=None, weighted=False,
           parallelism=4, settings=None, grids=None):
    """``(best model refitted on all rows, best setting, [(setting, mean score)])``.

    ``train`` holds features and label, and the column weight if ``weighted``. ``settings`` replaces the catalogue's
    candidates.
    """
    if how not in ("grid", "randomized"):
        raise ValueError("the search must be 'grid' or 'randomized'")
    found = search_folded(fold_rows(train, folds, seed, key_cols), name, [target_metric], how, n_iter, seed, weighted, parallelism, settings, grids)
    return found.model, found.setting, [(s, m[target_metric]) for s, m in zip(found.settings, found.means)]
