"""Metrics over (label, score, prediction)."""

from pyspark.sql import functions as F

from tabloom.catalog.registry import FX_SCORES, fx_scores, query, r, rounded
from tabloom.operators import metrics as G

PRICE = f"(SELECT * FROM {FX_SCORES} WHERE model = 'price')"


def price(spark, sf_dir):
    return fx_scores(spark, sf_dir).filter("model = 'price'")


def confusion(by):
    group = f"GROUP BY {', '.join(by)}" if by else ""
    return f"""SELECT {''.join(b + ', ' for b in by)}count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
        count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM {FX_SCORES} {group}"""


RATES = """(tp + tn) / (tp + fp + fn + tn)::DOUBLE AS accuracy, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::DOUBLE END AS precision,
    CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::DOUBLE END AS recall, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END AS f1"""


@query("g01_confusion_metrics", f"SELECT model, split, tp, fp, fn, tn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 "
       f"FROM (SELECT *, {RATES} FROM ({confusion(['model', 'split'])}))")
def g01(spark, sf_dir):
    return rounded(G.confusion_metrics(fx_scores(spark, sf_dir), by=["model", "split"]))


@query("g02_roc_curve", f"""WITH s AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM {PRICE} GROUP BY score)
    SELECT score AS threshold, {r('sum(n) OVER (ORDER BY score DESC) / sum(n) OVER ()::DOUBLE')} AS fpr, {r('sum(p) OVER (ORDER BY score DESC) / sum(p) OVER ()::DOUBLE')} AS tpr FROM s""")
def g02(spark, sf_dir):
    return rounded(G.roc_curve(price(spark, sf_dir)))


def auc_sql(by, source=FX_SCORES):
    """Trapezoids under the curve of cumulated rates."""
    keys = "".join(b + ", " for b in by)
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    group = f"GROUP BY {', '.join(by)}" if by else ""
    return f"""SELECT {keys}sum((fpr - pf) * (tpr + pt) / 2) AS auc FROM (
        SELECT {keys}fpr, tpr, coalesce(lag(fpr) OVER ({part} ORDER BY score DESC), 0) AS pf, coalesce(lag(tpr) OVER ({part} ORDER BY score DESC), 0) AS pt FROM (
            SELECT {keys}score, sum(n) OVER ({part} ORDER BY score DESC) / sum(n) OVER ({part})::DOUBLE AS fpr, sum(p) OVER ({part} ORDER BY score DESC) / sum(p) OVER ({part})::DOUBLE AS tpr
            FROM (SELECT {keys}score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM {source} GROUP BY {keys}score))) {group}"""


@query("g03_roc_auc", f"SELECT model, split, {r('auc')} AS auc FROM ({auc_sql(['model', 'split'])})")
def g03(spark, sf_dir):
    return rounded(G.roc_auc(fx_scores(spark, sf_dir), by=["model", "split"]))


@query("g04_gini", f"SELECT {r('2 * auc - 1')} AS gini FROM ({auc_sql([], PRICE)})")
def g04(spark, sf_dir):
    return rounded(G.gini(price(spark, sf_dir)))


def half_even(x):
    return f"round_even({x}, 3)::DOUBLE"


METRIC_SQL = f"""WITH c AS (SELECT *, {RATES} FROM ({confusion(['model', 'split'])})), a AS ({auc_sql(['model', 'split'])}),
    m AS (SELECT c.*, auc, 2 * auc - 1 AS gini FROM c JOIN a ON c.model = a.model AND c.split = a.split),
    w AS (SELECT t.model AS model, {', '.join(f'{s}.{x} AS {x}_{n}' for s, n in (('t', 'train'), ('e', 'test')) for x in ('accuracy', 'precision', 'recall', 'f1', 'auc', 'gini'))}
        FROM m t JOIN m e ON t.model = e.model AND t.split = 'train' AND e.split = 'test')
    SELECT model, {', '.join(f"{half_even(f'{x}_{n}')} AS {x}_{n}" for n in ('train', 'test') for x in ('accuracy', 'precision', 'recall', 'f1', 'auc', 'gini'))},
        {half_even('greatest(least(accuracy_train - accuracy_test, 1), 0)')} AS overfit_accuracy, {half_even('greatest(least(f1_train - f1_test, 1), 0)')} AS overfit_f1 FROM w"""


@query("g05_train_test_metrics", METRIC_SQL)
def g05(spark, sf_dir):
    return G.train_test_metrics(fx_scores(spark, sf_dir))


GAPS = f"""SELECT model, greatest(least(max(accuracy) FILTER (split = 'train') - max(accuracy) FILTER (split = 'test'), 1), 0) AS overfit_accuracy,
    greatest(least(max(f1) FILTER (split = 'train') - max(f1) FILTER (split = 'test'), 1), 0) AS overfit_f1
    FROM (SELECT *, {RATES} FROM ({confusion(['model', 'split'])})) GROUP BY model"""


@query("g06_overfit_probability", f"SELECT model, {r('overfit_accuracy')} AS overfit_accuracy, {r('overfit_f1')} AS overfit_f1 FROM ({GAPS})")
def g06(spark, sf_dir):
    return rounded(G.overfit_probability(fx_scores(spark, sf_dir)))


FLAGS = """CASE WHEN round(accuracy_train - accuracy_test, 9) > 0.001 AND round(f1_train - f1_test, 9) > 0.001 THEN 'both'
    WHEN round(accuracy_train - accuracy_test, 9) > 0.001 THEN 'accuracy' WHEN round(f1_train - f1_test, 9) > 0.001 THEN 'f1' ELSE 'none' END"""


@query("g07_overfit_flags", f"SELECT *, overfit_by <> 'none' AS is_overfit FROM (SELECT *, {FLAGS} AS overfit_by FROM ({METRIC_SQL}))")
def g07(spark, sf_dir):
    return G.overfit_flags(G.train_test_metrics(fx_scores(spark, sf_dir)), 0.001)


@query("g09_append_metrics", METRIC_SQL)
def g09(spark, sf_dir):
    scores = fx_scores(spark, sf_dir)
    first = G.train_test_metrics(scores.filter("model = 'price'"))
    return G.append_metrics(G.append_metrics(None, first), G.train_test_metrics(scores.filter(F.col("model") == "customer")))
