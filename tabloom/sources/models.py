"""Fitted models on disk, through MLlib's own writers."""

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tabloom.models.ensembles import is_calibrated
from tabloom.sources.state import path_exists, read_text, write_text


def save_model(model, path: str) -> str:
    """Every model is stored as a pipeline, so that one reader serves all kinds."""
    whole = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    whole.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_models(spark: SparkSession, directory: str, name: str, tag: str, model, calibrated, best_setting: dict,
                has_probability=True) -> dict[str, str]:
    """Calibrated model always, the plain one if it gives probabilities, and the best setting as JSON."""
    paths = {"calibrated": save_model(calibrated, os.path.join(directory, f"{name}_calibrated_model_{tag}")),
             "best_params": os.path.join(directory, f"{name}_best_params_{tag}")}
    if has_probability:
        paths["uncalibrated"] = save_model(model, os.path.join(directory, f"{name}_uncalibrated_model_{tag}"))
    write_text(spark, paths["best_params"], best_setting)
    return paths


def load_models(spark: SparkSession, paths) -> list[dict]:
    """Base models for stacking as ``{'name', 'model', 'calibrated'}``; an absent one is an error."""
    found = []
    for path in paths:
        if not path_exists(spark, path):
            raise FileNotFoundError(f"the model '{path}' does not exist")
        model = load_model(path)
        found.append({"name": path, "model": model, "calibrated": is_calibrated(model)})
    return found


def load_setting(spark: SparkSession, path: str) -> dict:
    return read_text(spark, path)


def save_metrics(metrics: DataFrame, directory: str, tag: str) -> str:
    """One small CSV with header: a row per model."""
    path = os.path.join(directory, f"performance_metrics_{tag}.csv")
    metrics.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path
