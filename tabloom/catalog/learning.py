"""Training, tuning, calibration, stacking and explanation of classifiers."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.catalog.registry import fx_events, fx_orders, query, r, rounded, share, table
from tabloom.models.base import assemble
from tabloom.models.catalogue import class_weights, make_model
from tabloom.models.ensembles import calibrate_isotonic
from tabloom.models.explain import explain_local, feature_importance
from tabloom.models.gaussian import GaussianNB
from tabloom.models.knn import knn_join, vote
from tabloom.models.stacking import stack_features, stack_fit
from tabloom.models.tuning import SCORING, fold_rows, search, search_folded
from tabloom.operators.sample import split
from tabloom.plans.training import evaluate, predict, run_training
from tabloom.session import materialize, scratch_path
from tabloom.sources.models import load_model, save_model

FEATURES = ["price", "month", "customer", "is_open"]


def learnable(spark, sf_dir):
    """Orders with numeric features on a similar scale; the label depends on the price and, as noise, on the key."""
    orders = fx_orders(spark, sf_dir)
    return orders.select("o_orderkey", (F.col("o_totalprice") / 100000).alias("price"), F.month("o_orderdate").cast("double").alias("month"),
                         ((F.col("o_custkey") % 100) / 100).alias("customer"), (F.col("o_orderstatus") == "O").cast("double").alias("is_open"), "y")


def learning_parts(spark, sf_dir):
    train, test = split(learnable(spark, sf_dir), 0.3, ["o_orderkey"], 42)
    return assemble(train, "y", FEATURES), assemble(test, "y", FEATURES)


def register_model(key, name, **params):
    """The metrics of one model on train and test, as one row."""
    @query(key)
    def fit_and_measure(spark, sf_dir):
        train, test = learning_parts(spark, sf_dir)
        model = make_model(name, train.count(), 42, len(FEATURES), **params).fit(train)
        return evaluate(name, model, train, test)


register_model("m01_logistic_regression", "LogisticRegression", penalty="l2", C=1.0)
register_model("m01_logistic_regression_l1", "LogisticRegression", penalty="l1", C=0.1)
register_model("m01_logistic_regression_elasticnet", "LogisticRegression", penalty="elasticnet", C=1.0, l1_ratio=0.3)
register_model("m01_logistic_regression_none", "LogisticRegression", penalty=None)
register_model("m04_linear_discriminant", "LinearDiscriminantAnalysis", shrinkage=-1.0)
register_model("m05_quadratic_discriminant", "QuadraticDiscriminantAnalysis", regParam=0.1)
register_model("m06_linear_svm", "SVC", C=1.0)
register_model("m07_random_forest", "RandomForestClassifier", numTrees=20, maxDepth=5)
register_model("m08_gradient_boosted_trees", "GradientBoostingClassifier", maxIter=10, maxDepth=3)
register_model("m09_adaboost", "AdaBoostClassifier", numTrees=10, stepSize=1.0)
register_model("m10_bagged_trees", "BaggingClassifier", numTrees=10, maxSamples=0.8, maxFeatures=0.8)
register_model("m11_mlp", "MLPClassifier", hidden=(16,), maxIter=30)
register_model("m12_ridge_classifier", "RidgeClassifier", alpha=1.0)


def learnable_sql():
    return f"""(SELECT o_orderkey, o_totalprice / 100000 AS price, month(o_orderdate)::DOUBLE AS month, (o_custkey % 100) / 100.0::DOUBLE AS customer,
        CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END::DOUBLE AS is_open, CASE WHEN o_totalprice > 300000 OR o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS y,
        {share('o_orderkey', 42)} < 0.3 AS is_test FROM orders)"""


def naive_bayes_sql(rows="is_test", columns="o_orderkey, y, probability, prediction"):
    """Log-odds from class means and variances, written out."""
    stats = ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) + max(extra) AS v_{f}" for f in FEATURES)
    parts = " + ".join(f"(ln(b.v_{f}) - ln(a.v_{f})) / 2 + pow({f} - b.m_{f}, 2) / (2 * b.v_{f}) - pow({f} - a.m_{f}, 2) / (2 * a.v_{f})" for f in FEATURES)
    return f"""WITH d AS (SELECT * FROM {learnable_sql()}), t AS (SELECT * FROM d WHERE NOT is_test),
        e AS (SELECT 1e-9 * greatest({', '.join(f'var_pop({f})' for f in FEATURES)}) AS extra FROM t),
        c AS (SELECT y, count(*) AS n, {stats} FROM t, e GROUP BY y)
        SELECT {columns} FROM (SELECT o_orderkey, d.y AS y, round(1 / (1 + exp(-(ln(a.n / b.n::DOUBLE) + {parts}))), 5) AS probability,
            CASE WHEN ln(a.n / b.n::DOUBLE) + {parts} > 0 THEN 1 ELSE 0 END AS prediction, CASE WHEN is_test THEN 'test' ELSE 'train' END AS part
        FROM d, (SELECT * FROM c WHERE y = 1) a, (SELECT * FROM c WHERE y = 0) b WHERE {rows})"""


@query("m02_gaussian_nb", naive_bayes_sql())
def m02(spark, sf_dir):
    train, test = learning_parts(spark, sf_dir)
    done = predict(GaussianNB().fit(train), test)
    return done.select("o_orderkey", "y", F.round("probability", 5).alias("probability"), "prediction")


def knn_parts(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), (F.col("label") % 2).alias("y"))
    return split(vectors, 0.2, ["vec_id"], 42)


def knn_sql(distance, k, weights):
    share_of_ones = {"uniform": "avg(y::DOUBLE)", "distance": "sum(y / distance) / sum(1 / distance)"}[weights]
    return f"""WITH v AS (SELECT vec_id, embedding AS x, label % 2 AS y, {share('vec_id', 42)} < 0.2 AS is_query FROM embeddings),
        e AS (SELECT vec_id, y, is_query, i, x[i]::DOUBLE AS x FROM v, (SELECT unnest(range(1, 65)) AS i)),
        d AS (SELECT q.vec_id AS vec_id, t.vec_id AS id, t.y AS y, {distance.replace('@', '(q.x - t.x)')} AS distance
            FROM e q JOIN e t ON q.i = t.i WHERE q.is_query AND NOT t.is_query GROUP BY q.vec_id, t.vec_id, t.y),
        near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, id) AS k FROM d) WHERE k <= {k})
        SELECT vec_id, round({share_of_ones}, 6) AS probability, CASE WHEN round({share_of_ones}, 9) > 0.5 THEN 1 ELSE 0 END AS prediction FROM near GROUP BY vec_id"""


def knn_classify(spark, sf_dir, k, metric, p=2.0, weights="uniform"):
    train, queries = knn_parts(spark, sf_dir)
    near = knn_join(queries.select(F.col("vec_id").alias("qid"), "x"), train.select(F.col("vec_id").alias("id"), "x"), k, metric, p)
    votes = vote(near.join(train.select(F.col("vec_id").alias("id"), "y"), "id"), weights)
    return votes.select(F.col("qid").alias("vec_id"), F.round("__p", 6).alias("probability"), (F.round("__p", 9) > 0.5).cast("int").alias("prediction"))


KNN = {
    "m03_knn_euclidean": (5, "euclidean", 2.0, "uniform", "sqrt(sum(pow(@, 2)))"),
    "m03_knn_manhattan_weighted": (7, "manhattan", 1.0, "distance", "sum(abs(@))"),
    "m03_knn_minkowski": (5, "minkowski", 3.0, "uniform", "pow(sum(pow(abs(@), 3)), 1 / 3.0::DOUBLE)"),
    "m03_knn_chebyshev": (3, "chebyshev", 2.0, "uniform", "max(abs(@))"),
}


def register_knn(name, k, metric, p, weights, distance):
    @query(name, knn_sql(distance, k, weights))
    def classify(spark, sf_dir):
        return knn_classify(spark, sf_dir, k, metric, p, weights)


for _name, _spec in KNN.items():
    register_knn(_name, *_spec)


@query("m03_knn_mahalanobis")
def m03_mahalanobis(spark, sf_dir):
    train, test = learning_parts(spark, sf_dir)
    return predict(make_model("KNeighborsClassifier", 0, k=5, metric="mahalanobis").fit(train), test).select("o_orderkey", "y", "probability", "prediction")


@query("m13_class_weights", """SELECT event_id, y, round(CASE WHEN y = 1 THEN n / (2.0::DOUBLE * p) ELSE n / (2.0::DOUBLE * (n - p)) END, 6) AS weight,
    CASE WHEN y = 1 THEN round_even((n - p) / p::DOUBLE, 0) ELSE 1 END::DOUBLE AS ratio_weight
    FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y FROM events),
         (SELECT count(*) AS n, count(*) FILTER (event_type = 'error') AS p FROM events)""")
def m13(spark, sf_dir):
    from tabloom.operators.validate import class_ratio
    events = fx_events(spark, sf_dir).select("event_id", "y")
    ratio = class_ratio(events, "y").first()["ratio"]
    return rounded(class_weights(class_weights(events, "y"), "y", ratio, "ratio_weight"))


SMALL_GRID = [{"penalty": ["l1", "l2"], "C": [0.01, 1.0], "maxIter": [20]}]


def searched(spark, sf_dir, how, metric):
    train, test = learning_parts(spark, sf_dir)
    model, setting, scores = search(train, "LogisticRegression", metric, how, n_iter=3, folds=3, seed=42, key_cols=["o_orderkey"], grids=SMALL_GRID)
    rows = [(repr(s), float(v), s == setting) for s, v in scores]
    return spark.createDataFrame(rows, "setting string, score double, is_best boolean")


@query("m15_grid_search_cv")
def m15(spark, sf_dir):
    return searched(spark, sf_dir, "grid", "f1")


SMOOTHINGS = (1e-9, 0.01, 0.5)


def search_sql():
    """Every fold's model written out: class means and variances of the other folds, then the metrics of the rows it has not seen."""
    stats = ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) AS v_{f}" for f in FEATURES)
    extra = ", ".join(f"var_pop({f})" for f in FEATURES)
    odds = " + ".join(f"(ln(b.v_{f} + extra) - ln(a.v_{f} + extra)) / 2 + pow({f} - b.m_{f}, 2) / (2 * (b.v_{f} + extra)) - pow({f} - a.m_{f}, 2) / (2 * (a.v_{f} + extra))"
                      for f in FEATURES)
    means = ", ".join(f"{r(f'avg({m})', 4)} AS {m}" for m in SCORING)
    return f"""WITH t AS (SELECT * FROM {learnable_sql()} WHERE NOT is_test),
        h AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('42|' || o_orderkey)) AS place, count(*) OVER (PARTITION BY y) AS n FROM t),
        d AS (SELECT *, CAST(place > n * 1 // 3 AS INT) + CAST(place > n * 2 // 3 AS INT) AS fold FROM h),
        f AS (SELECT unnest([0, 1, 2]) AS left_out),
        s AS (SELECT unnest([0, 1, 2]) AS setting, unnest([{', '.join(f'{x}::DOUBLE' for x in SMOOTHINGS)}]) AS smoothing),
        e AS (SELECT left_out, greatest({extra}) AS widest FROM d JOIN f ON fold <> left_out GROUP BY left_out),
        c AS (SELECT left_out, y, count(*) AS n, {stats} FROM d JOIN f ON fold <> left_out GROUP BY left_out, y),
        scored AS (SELECT setting, smoothing, fold, d.y AS y, smoothing * widest AS extra, ln(a.n / b.n::DOUBLE) + {odds} AS odds
            FROM d JOIN c a ON a.left_out = fold AND a.y = 1 JOIN c b ON b.left_out = fold AND b.y = 0 JOIN e ON e.left_out = fold, s),
        ranked AS (SELECT *, rank() OVER (PARTITION BY setting, fold ORDER BY odds) + (count(*) OVER (PARTITION BY setting, fold, odds) - 1) / 2.0::DOUBLE AS place FROM scored),
        counts AS (SELECT setting, smoothing, fold, count(*) AS n, sum(y) AS p, count(*) FILTER (odds > 0) AS said, count(*) FILTER (odds > 0 AND y = 1) AS tp,
            sum(CASE WHEN y = 1 THEN place ELSE 0 END) AS places FROM ranked GROUP BY setting, smoothing, fold),
        metrics AS (SELECT setting, smoothing, (n - said - p + 2 * tp) / n::DOUBLE AS accuracy, coalesce(tp / nullif(said, 0)::DOUBLE, 0) AS precision, tp / p::DOUBLE AS recall,
            2 * tp / (said + p)::DOUBLE AS f1, (places - p * (p + 1) / 2.0::DOUBLE) / (p * (n - p)) AS roc_auc, 2 * (places - p * (p + 1) / 2.0::DOUBLE) / (p * (n - p)) - 1 AS gini FROM counts),
        means AS (SELECT setting, smoothing, avg(f1) AS target, {means} FROM metrics GROUP BY setting, smoothing)
        SELECT smoothing, {', '.join(SCORING)}, row_number() OVER (ORDER BY target DESC, setting) = 1 AS is_best FROM means"""


@query("m15_search_all_scorers", search_sql())
def m15_all_scorers(spark, sf_dir):
    """Every metric of every setting from one table of cross-validated scores."""
    train, _ = learning_parts(spark, sf_dir)
    folded = fold_rows(train, 3, 42, ["o_orderkey"])
    found = search_folded(folded, "GaussianNB", ["f1", *[m for m in SCORING if m != "f1"]], settings=[{"varSmoothing": v} for v in SMOOTHINGS])
    rows = [(s["varSmoothing"], *[m[c] for c in SCORING], s == found.setting) for s, m in zip(found.settings, found.means)]
    table = spark.createDataFrame(rows, f"smoothing double, {', '.join(f'{c} double' for c in SCORING)}, is_best boolean")
    return table.select("smoothing", *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in SCORING], "is_best")


@query("m16_randomized_search_cv")
def m16(spark, sf_dir):
    return searched(spark, sf_dir, "randomized", "roc_auc")


@query("m17_calibrate_isotonic")
def m17(spark, sf_dir):
    train, test = learning_parts(spark, sf_dir)
    svm = make_model("SVC", train.count()).fit(train)
    return predict(calibrate_isotonic(svm, train), test).select("o_orderkey", "y", "probability", "prediction")


def base_models(train):
    rows = train.count()
    return [make_model("LogisticRegression", rows).fit(train), make_model("GaussianNB", rows).fit(train),
            calibrate_isotonic(make_model("RidgeClassifier", rows).fit(train), train)]


@query("m18_stack_features")
def m18(spark, sf_dir):
    train, test = learning_parts(spark, sf_dir)
    return stack_features(base_models(train), test).select("o_orderkey", "base_0", "base_1", "base_2")


def register_stack(key, how, **params):
    @query(key)
    def stack(spark, sf_dir):
        train, test = learning_parts(spark, sf_dir)
        train = materialize(train.select("features", "label"), "train")      # a dozen passes of the models read it
        return evaluate(how, stack_fit(base_models(train), train, how, 42, **params), train, test)


register_stack("m19_stack_fit_logistic", "logistic_regression")
register_stack("m19_stack_fit_gbt", "gradient_boosting", maxIter=20)
register_stack("m19_stack_fit_neural", "neural_network", maxIter=50)


@query("m20_predict", naive_bayes_sql("true", "o_orderkey, part, y, prediction, probability"))
def m20(spark, sf_dir):
    """Labels and probabilities for train and test, by a model whose scores SQL can state."""
    train, test = learning_parts(spark, sf_dir)
    model = GaussianNB().fit(train)
    both = predict(model, train).withColumn("part", F.lit("train")).unionByName(predict(model, test).withColumn("part", F.lit("test")))
    return both.select("o_orderkey", "part", "y", "prediction", F.round("probability", 5).alias("probability"))


@query("m21_feature_importance")
def m21(spark, sf_dir):
    train, _ = learning_parts(spark, sf_dir)
    return feature_importance(make_model("RandomForestClassifier", 0, 42, numTrees=20).fit(train), FEATURES, spark)


@query("m22_explain_local")
def m22(spark, sf_dir):
    train, test = learning_parts(spark, sf_dir)
    model = make_model("GaussianNB", 0).fit(train)
    return explain_local(model, test, train, FEATURES, "o_orderkey", samples=100, seed=42)


def training_config(**changes):
    return {"tag": "orders", "target_column": "y", "random_state": 42, "key_columns": ["o_orderkey"], "training": {
        "data_is_balanced": False, "approach_type": "individual", "base_model_names": ["LogisticRegression", "GaussianNB"],
        "base_model_files": [], "stacking_model_type": "logistic_regression", "cross_validation_search_type": "randomized",
        "num_cv_folds": 3, "num_iter": 2, "scoring": ["f1"], "overfitting_threshold": 0.05, **changes}}


@query("m23_run_training")
def m23(spark, sf_dir):
    """Two models searched, calibrated, saved and measured, then stacked from the saved files."""
    train, test = split(learnable(spark, sf_dir), 0.3, ["o_orderkey"], 42)
    output = scratch_path(spark, "training")
    grids = {"LogisticRegression": [{"penalty": ["l2"], "C": [0.1, 1.0], "maxIter": [20]}], "GaussianNB": [{"varSmoothing": [1e-9, 1e-3]}]}
    single = run_training(train, test, training_config(), output, grids=grids)
    files = [single["paths"][n]["uncalibrated"] for n in ("LogisticRegression", "GaussianNB")]
    stacked = run_training(train, test, training_config(approach_type="stacking", base_model_files=files), output)
    return single["metrics"].unionByName(stacked["metrics"])


@query("s05_save_load_models", naive_bayes_sql(columns="o_orderkey, probability AS before, probability AS after"))
def s05(spark, sf_dir):
    """Predictions of a model read back from disk beside those of the model that was written."""
    train, test = learning_parts(spark, sf_dir)
    model = make_model("GaussianNB", 0).fit(train)
    back = load_model(save_model(model, scratch_path(spark, "model")))
    before = predict(model, test).select("o_orderkey", F.round("probability", 5).alias("before"))
    after = back.transform(test).select("o_orderkey", F.round(vector_to_array(F.col("probability"))[1], 5).alias("after"))
    return after.join(before, "o_orderkey")
