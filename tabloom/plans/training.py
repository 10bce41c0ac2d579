"""Training runs described by one configuration: search, calibrate, evaluate, compare; or stack saved models."""

import json
import os
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.models.base import assemble
from tabloom.models.catalogue import class_weights, kind_of, warn_unweighted
from tabloom.models.ensembles import ScoreColumn, calibrate_isotonic
from tabloom.models.explain import explain_local, feature_importance
from tabloom.models.stacking import stack_fit
from tabloom.models.tuning import RANKED, SCORING, fold_rows, search_folded
from tabloom.operators.metrics import append_metrics, overfit_flags, train_test_metrics
from tabloom.operators.validate import class_ratio
from tabloom.sources.models import load_models, save_metrics, save_model, save_models
from tabloom.sources.state import write_text


def scored(model, df: DataFrame) -> DataFrame:
    """(label, score, prediction): the probability of class 1, or the raw value where there is none."""
    done = ScoreColumn().transform(model.transform(df))
    return done.select(F.col("label").cast("int"), F.col("__score").alias("score"), F.col("prediction").cast("int"))


def predict(model, df: DataFrame) -> DataFrame:
    """The input with prediction and the probability of class 1 as plain columns."""
    done = model.transform(df)
    return done.select(*df.columns, F.col("prediction").cast("int"), vector_to_array(F.col("probability"))[1].alias("probability"))


def evaluate(name, model, train, test) -> DataFrame:
    """One row of metrics for train and test."""
    both = (scored(model, train).withColumn("split", F.lit("train"))
            .unionByName(scored(model, test).withColumn("split", F.lit("test"))).withColumn("model", F.lit(name)))
    return train_test_metrics(both)


def settled(metrics: DataFrame) -> DataFrame:
    """The few rows of a metrics table, computed once."""
    return metrics.sparkSession.createDataFrame(metrics.collect(), metrics.schema)


def run_training(train: DataFrame, test: DataFrame, config: dict, output: str | None = None, key_cols=None, grids=None,
                 parallelism=4) -> dict:
    """Train as ``config['training']`` says. Returns metrics with overfit flags, the models, every setting's scores and what was written.

    ``grids`` may replace the catalogue's grids per model name.
    """
    training, target = config["training"], config["target_column"]
    key_cols = key_cols or config.get("key_columns")
    features = [c for c in train.columns if c != target and c not in (key_cols or [])]
    ready, ready_test = assemble(train, target, features), assemble(test, target, features)
    if training["approach_type"] == "individual":
        result = train_individual(ready, ready_test, features, config, output, key_cols, grids or {}, parallelism)
    elif training["approach_type"] == "stacking":
        result = train_stacking(ready, ready_test, config, output)
    else:
        raise ValueError(f"unknown approach_type '{training['approach_type']}'")
    result["metrics"] = overfit_flags(result["metrics"], training["overfitting_threshold"])
    if output:
        result["paths"]["metrics"] = save_metrics(result["metrics"], output, config["tag"])
    return result


def train_individual(train, test, features, config, output, key_cols, grids, parallelism):
    training, seed, tag = config["training"], config["random_state"], config["tag"]
    names = training["base_model_names"]
    for name in names:
        kind_of(name)
    scoring = usable_metrics(training["scoring"], names)
    ratio = class_ratio(train, "label").first()["ratio"]
    weighted = not training["data_is_balanced"]
    if weighted:
        warn_unweighted(names)
    metrics, models, importance, explanation, best, paths, searched = None, {}, {}, {}, {}, {}, []
    folded = fold_rows(train, training["num_cv_folds"], seed, key_cols)
    for i, name in enumerate(names):
        rows = folded
        if weighted:
            rows = replace(folded, rows=class_weights(folded.rows, "label", ratio if name in RATIO_WEIGHTED else None))
        found = search_folded(rows, name, scoring[name], training["cross_validation_search_type"], training["num_iter"], seed + i, weighted,
                              parallelism, grids=grids.get(name))
        model, setting = found.model, found.setting
        searched += [(name, json.dumps(s), s == setting, *[m.get(c) for c in SCORING]) for s, m in zip(found.settings, found.means)]
        calibrated = calibrate_isotonic(model, train)
        models[name], best[name] = calibrated, setting
        metrics = append_metrics(metrics, settled(evaluate(name, calibrated, train, test)))
        if kind_of(name).importance:
            importance[name] = feature_importance(model, features, train.sparkSession)
        elif key_cols and len(key_cols) == 1:
            first = train.orderBy(key_cols[0]).limit(1)      # one row is explained, as a sample of the model's behaviour
            explanation[name] = explain_local(calibrated, first, train, features, key_cols[0], seed=seed)
        if output:
            paths[name] = save_models(train.sparkSession, output, name, tag, model, calibrated, setting, kind_of(name).probability)
    scores = train.sparkSession.createDataFrame(searched, f"model string, setting string, is_best boolean, {', '.join(f'{m} double' for m in SCORING)}")
    if output:
        paths["search"] = f"{output}/search_{tag}"
        scores.write.mode("overwrite").parquet(paths["search"])
    return {"metrics": metrics, "models": models, "best": best, "importance": importance, "explanation": explanation,
            "class_ratio": ratio, "search": scores, "paths": paths}


# Boosters that take one weight for the positive class instead of balanced weights.
RATIO_WEIGHTED = ("XGBClassifier", "CatBoostClassifier")


def usable_metrics(scoring, names):
    """The configured metrics each model can be searched by, the first of which chooses: roc_auc and gini need probabilities."""
    wrong = [m for m in scoring if m not in SCORING]
    if wrong:
        raise ValueError(f"unsupported metrics {wrong}: use {SCORING}")
    chosen = {}
    for name in names:
        chosen[name] = [m for m in scoring if kind_of(name).probability or m not in RANKED]
        if not chosen[name]:
            raise ValueError(f"model {name} gives no probabilities: none of {scoring} can be used")
    return chosen


def train_stacking(train, test, config, output):
    training, tag = config["training"], config["tag"]
    spark = train.sparkSession
    bases = load_models(spark, training["base_model_files"])
    stacked = stack_fit([b["model"] for b in bases], train, training["stacking_model_type"], config["random_state"])
    metrics = settled(evaluate("MetaClassifier", stacked, train, test))
    paths = {}
    if output:
        paths["MetaClassifier"] = save_model(stacked.meta, os.path.join(output, f"MetaClassifier_{tag}"))
        paths["used_models"] = write_text(spark, os.path.join(output, f"MetaClassifier_used_models_{tag}"), [b["name"] for b in bases])
    return {"metrics": metrics, "models": {"MetaClassifier": stacked}, "paths": paths}
