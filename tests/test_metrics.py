import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import metrics as G


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(4)
    score = np.where(rng.random(600) < 0.35, 0.5, rng.random(600).round(2))
    label = (rng.random(600) < score).astype(int)
    pdf = pd.DataFrame({"label": label, "score": score, "prediction": (score >= 0.5).astype(int),
                        "model": ["m"] * 300 + ["n"] * 300, "split": ["train", "train", "test"] * 200})
    return spark.createDataFrame(pdf).repartition(7), pdf


def auc(pdf):
    """All pairs, ties half."""
    pos, neg = pdf[pdf.label == 1].score.to_numpy(), pdf[pdf.label == 0].score.to_numpy()
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def test_auc_counts_ties_half(scores):
    df, pdf = scores
    assert G.roc_auc(df).first()["auc"] == pytest.approx(auc(pdf))
    assert G.gini(df).first()["gini"] == pytest.approx(2 * auc(pdf) - 1)
    by = {(r["model"], r["split"]): r["auc"] for r in G.roc_auc(df, by=["model", "split"]).collect()}
    for key, part in pdf.groupby(["model", "split"]):
        assert by[key] == pytest.approx(auc(part))


def test_roc_curve_is_monotone_and_ends_at_one(scores):
    df, pdf = scores
    curve = G.roc_curve(df).toPandas().sort_values("threshold", ascending=False)
    assert len(curve) == pdf.score.nunique()
    assert (np.diff(curve["fpr"]) >= 0).all() and (np.diff(curve["tpr"]) >= 0).all()
    assert curve.iloc[-1][["fpr", "tpr"]].tolist() == [1.0, 1.0]
    area = np.trapezoid(np.r_[0, curve["tpr"]], np.r_[0, curve["fpr"]])
    assert area == pytest.approx(auc(pdf))


def test_undefined_metrics_are_zero(spark):
    df = spark.createDataFrame([(0, 0.1, 0), (0, 0.2, 0)], "label int, score double, prediction int")
    row = G.confusion_metrics(df).first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    assert G.roc_auc(df).first()["auc"] is None


def test_train_test_metrics_and_flags(scores):
    df, pdf = scores
    rows = {r["model"]: r for r in G.train_test_metrics(df).collect()}
    for model, part in pdf.groupby("model"):
        acc = {s: (p.label == p.prediction).mean() for s, p in part.groupby("split")}
        assert rows[model]["accuracy_train"] == round(acc["train"], 3)
        assert rows[model]["auc_test"] == pytest.approx(round(auc(part[part.split == "test"]), 3))
        assert rows[model]["overfit_accuracy"] == round(min(max(acc["train"] - acc["test"], 0), 1), 3)


def test_overfit_flags(spark):
    metrics = spark.createDataFrame(
        [("a", 0.9, 0.8, 0.7, 0.7), ("b", 0.9, 0.9, 0.8, 0.6), ("c", 0.9, 0.8, 0.8, 0.7), ("d", 0.5, 0.9, 0.5, 0.9), ("e", 0.85, 0.8, 0.5, 0.5)],
        "model string, accuracy_train double, accuracy_test double, f1_train double, f1_test double")
    got = {r["model"]: (r["overfit_by"], r["is_overfit"]) for r in G.overfit_flags(metrics, 0.05).collect()}
    assert got == {"a": ("accuracy", True), "b": ("f1", True), "c": ("both", True), "d": ("none", False), "e": ("none", False)}


def test_append_metrics(scores):
    df, _ = scores
    one = G.train_test_metrics(df.filter("model = 'm'"))
    two = G.append_metrics(G.append_metrics(None, one), G.train_test_metrics(df.filter("model = 'n'")))
    assert sorted(r["model"] for r in two.collect()) == ["m", "n"]
    assert math.isclose(two.filter("model = 'm'").first()["auc_train"], one.first()["auc_train"])


def test_curves_of_nothing_and_of_infinite_scores(spark):
    empty = spark.createDataFrame([], "label int, score double")
    assert G.roc_curve(empty).count() == 0 and G.roc_auc(empty).first()["auc"] is None
    inf = float("inf")
    df = spark.createDataFrame([(1, inf), (0, inf), (1, 0.5), (0, -inf), (0, 0.1), (1, None), (0, float("nan"))], "label int, score double")
    assert G.roc_auc(df).first()["auc"] == pytest.approx((0.5 + 1 + 1 + 0 + 1 + 1) / 6)
    points = {r["threshold"]: (r["fpr"], r["tpr"]) for r in G.roc_curve(df).collect()}
    assert points == {inf: (1 / 3, 0.5), 0.5: (1 / 3, 1.0), 0.1: (2 / 3, 1.0), -inf: (1.0, 1.0)}
    groups = df.withColumn("g", F.col("score") > 0.3).filter("g is not null")
    assert G.roc_auc(groups, by=["g"]).count() == 2
