"""Evaluation of binary predictions: plain aggregations over (label, score, prediction)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import col, half_even, num
from tabloom.functions.running import range_edges, running_sums
from tabloom.session import materialize

METRICS = ("accuracy", "precision", "recall", "f1", "auc", "gini")


def ratio_or_zero(part, whole):
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def counted(df: DataFrame, label, score, prediction, by) -> DataFrame:
    """Rows combined per (group, score, prediction, label): everything the metrics need, usually far fewer rows."""
    return df.groupBy(*by, col(score).cast("double").alias("score"), col(prediction).cast("int").alias("prediction"),
                      col(label).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("rows"))


def confusion_metrics(df: DataFrame, label="label", prediction="prediction", by=(), rows=None) -> DataFrame:
    """(tp, fp, fn, tn, accuracy, precision, recall, f1) of class 1, per group of ``by``; 0 where undefined.

    ``rows`` names a column of multiplicities, if the input is counted already.
    """
    y, p, n = col(label).cast("int"), col(prediction).cast("int"), col(rows) if rows else F.lit(1)

    def cell(truth, guess):
        return F.sum(F.when((y == truth) & (p == guess), n).otherwise(0)).cast("bigint")

    counts = df.groupBy(*by).agg(cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by, "tp", "fp", "fn", "tn", ratio_or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"), ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"))


def score_counts(df, label, score, by, rows=None):
    y, n = col(label).cast("int"), col(rows) if rows else F.lit(1)
    return (df.filter(num(score).isNotNull()).groupBy(*by, num(score).alias("threshold"))
            .agg(F.sum(F.when(y == 1, n).otherwise(0)).cast("bigint").alias("pos"),
                 F.sum(F.when(y == 0, n).otherwise(0)).cast("bigint").alias("neg")))


def cumulated(df: DataFrame, label, score, by, rows=None) -> DataFrame:
    """Per distinct score the positives and negatives at or above it, and the group's totals.

    Rows are first combined per distinct score, so ties cost one row, and these counts are written down: the data is read
    once. The order is then walked in ranges of about equally many scores, each on its own task; the range edges come
    from one bounded sketch.
    """
    by = list(by)
    counts = materialize(score_counts(df, label, score, by, rows), "scores")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = range_edges(counts, "threshold", max(2, min(tasks, 5000)))
    running = running_sums(counts, by, "threshold", {"tp": "pos", "fp": "neg"}, edges, small=not by)
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    if by:
        return running.join(totals, by)
    total = totals.first() or {"all_pos": None, "all_neg": None}
    return running.withColumns({"all_pos": F.lit(total["all_pos"]).cast("long"), "all_neg": F.lit(total["all_neg"]).cast("long")})


def roc_curve(df: DataFrame, label="label", score="score", by=()) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, without an ordering of the whole result."""
    points = cumulated(df, label, score, by)
    return points.select(
        *by, "threshold", F.try_divide(F.col("fp").cast("double"), F.col("all_neg").cast("double")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("all_pos").cast("double")).alias("tpr"))


def roc_auc(df: DataFrame, label="label", score="score", by=(), rows=None) -> DataFrame:
    """(auc): chance that a positive scores above a negative, ties half; null with a single class.

    Equal to the trapezoids under the ROC curve: each score's positives meet the negatives below it and half of its
    own. The sum needs no second pass over the order.
    """
    points = cumulated(df, label, score, by, rows)
    below = F.col("all_neg") - F.col("fp")
    won = F.col("pos").cast("double") * (below.cast("double") + F.col("neg").cast("double") / 2)
    pairs = F.max(F.col("all_pos").cast("double") * F.col("all_neg").cast("double"))
    return points.groupBy(*by).agg(F.try_divide(F.sum(won), pairs).alias("auc"))


def gini(df: DataFrame, label="label", score="score", by=()) -> DataFrame:
    return roc_auc(df, label, score, by).select(*by, (F.col("auc") * 2 - 1).alias("gini"))


def overfit(train, test):
    """Gap between train and test, held between 0 and 1."""
    return F.greatest(F.least(train - test, F.lit(1.0)), F.lit(0.0))


def train_test_metrics(df: DataFrame, label="label", score="score", prediction="prediction", model="model",
                       split="split", digits=3) -> DataFrame:
    """One row per model: six metrics for split 'train' and 'test', and the overfit probabilities, rounded half-even.

    All models and both splits are evaluated together; gaps are taken before rounding. The predictions are read once:
    their counts are written down and everything else is computed from them.
    """
    by = [model, split]
    counts = materialize(counted(df, label, score, prediction, by), "score-counts")
    both = confusion_metrics(counts, "label", "prediction", by, "rows").join(roc_auc(counts, "label", "score", by, "rows"), by)
    both = both.withColumn("gini", F.col("auc") * 2 - 1)
    wide = both.groupBy(model).pivot(split, ["train", "test"]).agg(*[F.max(m).alias(m) for m in METRICS])
    return wide.select(
        model, *[half_even(F.col(f"{s}_{m}"), digits).alias(f"{m}_{s}") for s in ("train", "test") for m in METRICS],
        half_even(overfit(F.col("train_accuracy"), F.col("test_accuracy")), digits).alias("overfit_accuracy"),
        half_even(overfit(F.col("train_f1"), F.col("test_f1")), digits).alias("overfit_f1"))


def overfit_probability(df: DataFrame, label="label", prediction="prediction", model="model", split="split") -> DataFrame:
    """(model, overfit_accuracy, overfit_f1), unrounded."""
    both = confusion_metrics(df, label, prediction, [model, split])
    wide = both.groupBy(model).pivot(split, ["train", "test"]).agg(F.max("accuracy").alias("accuracy"), F.max("f1").alias("f1"))
    return wide.select(model, overfit(F.col("train_accuracy"), F.col("test_accuracy")).alias("overfit_accuracy"),
                       overfit(F.col("train_f1"), F.col("test_f1")).alias("overfit_f1"))


def overfit_flags(metrics: DataFrame, threshold: float) -> DataFrame:
    """Add by which measure train exceeds test by more than the threshold: 'accuracy', 'f1', 'both' or 'none'.

    Works on the rounded metrics of ``train_test_metrics``, or on ``overfit_probability``.
    """
    def gap(name):
        if f"{name}_train" in metrics.columns:
            return half_even(F.col(f"{name}_train") - F.col(f"{name}_test"), 9)
        return F.col(f"overfit_{name}")

    a, f = gap("accuracy") > threshold, gap("f1") > threshold
    flag = F.when(a & f, "both").when(a, "accuracy").when(f, "f1").otherwise("none")
    return metrics.withColumns({"overfit_by": flag, "is_overfit": F.coalesce(a | f, F.lit(False))})


def append_metrics(metrics: DataFrame | None, row: DataFrame) -> DataFrame:
    return row if metrics is None else metrics.unionByName(row)
