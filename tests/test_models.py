import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.models import knn as K
from tabloom.models.base import assemble
from tabloom.models.catalogue import MODELS, all_settings, class_weights, make_model, sampled_settings
from tabloom.models.ensembles import calibrate_isotonic, is_calibrated
from tabloom.models.explain import explain_local, feature_importance
from tabloom.models.gaussian import GaussianNB, LinearDiscriminant, QuadraticDiscriminant, ledoit_wolf
from tabloom.models.stacking import stack_features, stack_fit
from tabloom.models.tuning import evaluator_for, fold_rows, mean_metrics, search, search_folded
from tabloom.operators.metrics import roc_auc
from tabloom.plans import training
from tabloom.plans.training import evaluate, predict, run_training, scored
from tabloom.session import scratch_path
from tabloom.sources.models import load_model, load_models, load_setting, save_model

N = 600


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(11)
    y = (rng.random(N) < 0.4).astype(int)
    x = rng.normal(size=(N, 3)) * [1.0, 2.0, 1.0]
    x[:, 0] += 1.5 * y
    x[:, 1] += 2.0 * y
    return pd.DataFrame({"id": range(N), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})


@pytest.fixture(scope="module")
def ready(spark, planted):
    df = assemble(spark.createDataFrame(planted).repartition(3), "y", ["a", "b", "c"])
    return df.cache()


def probabilities(model, df):
    return predict(model, df).orderBy("id").toPandas()["probability"].to_numpy()


def arrays(planted):
    return planted[["a", "b", "c"]].to_numpy(), planted["y"].to_numpy()


SMALL = {
    "LogisticRegression": {}, "GaussianNB": {}, "KNeighborsClassifier": {"k": 9}, "LinearDiscriminantAnalysis": {},
    "QuadraticDiscriminantAnalysis": {}, "SVC": {}, "RandomForestClassifier": {"numTrees": 10, "maxDepth": 4},
    "GradientBoostingClassifier": {"maxIter": 5}, "AdaBoostClassifier": {"numTrees": 10}, "BaggingClassifier": {"numTrees": 5},
    "MLPClassifier": {"hidden": (8,), "maxIter": 40}, "RidgeClassifier": {}, "XGBClassifier": {"maxIter": 4},
    "LGBMClassifier": {"maxIter": 4}, "CatBoostClassifier": {"maxIter": 4},
}


@pytest.mark.parametrize("name", SMALL)
def test_every_model_finds_the_planted_signal(ready, name):
    model = make_model(name, N, 1, 3, **SMALL[name]).fit(ready)
    assert roc_auc(scored(model, ready)).first()["auc"] > 0.8
    assert model.transform(ready).count() == N


def test_gaussian_nb_matches_definition(ready, planted):
    x, y = arrays(planted)
    for smoothing in (1e-9, 0.5):
        extra = smoothing * x.var(axis=0).max()
        log = np.zeros((N, 2))
        for k in (0, 1):
            m, v = x[y == k].mean(axis=0), x[y == k].var(axis=0) + extra
            log[:, k] = math.log((y == k).mean()) - 0.5 * np.sum(np.log(2 * np.pi * v) + (x - m) ** 2 / v, axis=1)
        want = 1 / (1 + np.exp(log[:, 0] - log[:, 1]))
        assert np.allclose(probabilities(GaussianNB(varSmoothing=smoothing).fit(ready), ready), want)


@pytest.mark.parametrize("shrinkage", [0.0, 0.3, -1.0])
def test_linear_discriminant_matches_definition(ready, planted, shrinkage):
    x, y = arrays(planted)
    parts = []
    for k in (0, 1):
        z = x[y == k] - x[y == k].mean(axis=0)
        s = z.T @ z / len(z)
        if shrinkage < 0:
            sd = z.std(axis=0)
            zs = z / sd
            e = zs.T @ zs / len(zs)
            # intensity by its definition: error of the entries against distance from the target
            mu = np.trace(e) / 3
            delta = ((e - mu * np.eye(3)) ** 2).sum() / 3
            beta = sum(((np.outer(r, r) - e) ** 2).sum() for r in zs) / len(zs) ** 2 / 3
            amount = min(beta, delta) / delta
            s = ((1 - amount) * e + amount * mu * np.eye(3)) * np.outer(sd, sd)
        else:
            s = (1 - shrinkage) * s + shrinkage * np.trace(s) / 3 * np.eye(3)
        parts.append((y == k).mean() * s)
    inverse = np.linalg.inv(sum(parts))
    m = [x[y == k].mean(axis=0) for k in (0, 1)]
    margin = x @ inverse @ (m[1] - m[0]) - 0.5 * (m[1] @ inverse @ m[1] - m[0] @ inverse @ m[0]) + math.log(y.mean() / (1 - y.mean()))
    assert np.allclose(probabilities(LinearDiscriminant(shrinkage=shrinkage).fit(ready), ready), 1 / (1 + np.exp(-margin)))


def test_ledoit_wolf_bounds():
    assert ledoit_wolf(np.eye(3), 100.0, 10) == 0.0
    assert 0 < ledoit_wolf(np.array([[1, 0.5], [0.5, 1]]), 200.0, 50) <= 1


@pytest.mark.parametrize("reg", [0.0, 0.4])
def test_quadratic_discriminant_matches_definition(ready, planted, reg):
    x, y = arrays(planted)
    log = np.zeros((N, 2))
    for k in (0, 1):
        z = x[y == k]
        s = (1 - reg) * np.cov(z.T) + reg * np.eye(3)
        d = x - z.mean(axis=0)
        log[:, k] = math.log((y == k).mean()) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.sum(d @ np.linalg.inv(s) * d, axis=1)
    assert np.allclose(probabilities(QuadraticDiscriminant(regParam=reg).fit(ready), ready), 1 / (1 + np.exp(log[:, 0] - log[:, 1])))


@pytest.mark.parametrize("intercept", [True, False])
def test_ridge_matches_closed_form(ready, planted, intercept):
    x, y = arrays(planted)
    t = 2.0 * y - 1
    for alpha in (1.0, 100.0):
        xm, tm = (x.mean(axis=0), t.mean()) if intercept else (np.zeros(3), 0.0)
        w = np.linalg.solve((x - xm).T @ (x - xm) + alpha * np.eye(3), (x - xm).T @ (t - tm))
        want = (x - xm) @ w + tm
        model = make_model("RidgeClassifier", N, alpha=alpha, fitIntercept=intercept).fit(ready)
        got = model.transform(ready).select("id", vector_to_array(F.col("rawPrediction"))[1].alias("v"), "prediction").orderBy("id").toPandas()
        assert np.allclose(got["v"], want, atol=1e-6) and (got["prediction"] == (want > 0)).all()


def test_adaboost_follows_the_weights(ready, planted):
    model = make_model("AdaBoostClassifier", N, 1, numTrees=9).fit(ready)
    stages = model.stages[:-1]
    alphas = model.stages[-1].getOrDefault("alphas")
    x, y = arrays(planted)
    votes = ready.orderBy("id")
    for t in stages:
        votes = t.transform(votes)
    votes = votes.orderBy("id").select([f"__tree{i}" for i in range(len(stages))]).toPandas().to_numpy()
    w = np.ones(N) / N
    for i in range(len(stages)):
        wrong = votes[:, i] != y
        error = w[wrong].sum() / w.sum()
        assert alphas[i] == pytest.approx(math.log((1 - error) / error), rel=1e-6)
        w = w * np.where(wrong, math.exp(alphas[i]), 1.0)
        w /= w.sum()


def brute_force(queries, train, k, metric, p=2.0, inverse=None):
    found = {}
    for qid, q in queries:
        d = []
        for tid, t in train:
            diff = np.asarray(q) - np.asarray(t)
            value = {"euclidean": lambda: math.sqrt((diff ** 2).sum()), "manhattan": lambda: np.abs(diff).sum(), "chebyshev": lambda: np.abs(diff).max(),
                     "minkowski": lambda: (np.abs(diff) ** p).sum() ** (1 / p), "mahalanobis": lambda: math.sqrt(diff @ inverse @ diff)}[metric]()
            d.append((value, tid))
        found[qid] = sorted(d)[:k]
    return found


@pytest.mark.parametrize("metric, p", [("euclidean", 2.0), ("manhattan", 1.0), ("chebyshev", 2.0), ("minkowski", 3.0), ("mahalanobis", 2.0)])
@pytest.mark.parametrize("blocks", [5, 20_000])
def test_knn_join_equals_brute_force(spark, metric, p, blocks):
    """A third of the training rows lie in one cell, and small blocks cut both sides."""
    rng = np.random.default_rng(6)
    train = [(i, (rng.normal(size=3) * (0.01 if i % 3 == 0 else 2)).tolist()) for i in range(150)]
    queries = [(1000 + i, (rng.normal(size=3) * (0.01 if i % 2 else 2)).tolist()) for i in range(40)]
    t, q = spark.createDataFrame(train, "id long, x array<double>").repartition(4), spark.createDataFrame(queries, "qid long, x array<double>")
    whiten = inverse = None
    if metric == "mahalanobis":
        inverse = np.linalg.inv(np.cov(np.array([x for _, x in train]).T))
        whiten = K.whitening(t, "x")
    got = K.knn_join(q, t, 4, metric, p, block_rows=blocks, whiten=whiten).collect()
    want = brute_force(queries, train, 4, metric, p, inverse)
    for qid, near in want.items():
        mine = sorted((r["distance"], r["id"]) for r in got if r["qid"] == qid)
        assert [i for _, i in mine] == [i for _, i in near]
        assert np.allclose([d for d, _ in mine], [d for d, _ in near])


def test_knn_with_fewer_rows_than_neighbours_and_equal_points(spark):
    t = spark.createDataFrame([(1, [0.0]), (2, [0.0]), (3, [1.0])], "id long, x array<double>")
    q = spark.createDataFrame([(9, [0.0])], "qid long, x array<double>")
    assert [r["id"] for r in K.knn_join(q, t, 10).orderBy("distance", "id").collect()] == [1, 2, 3]
    near = K.knn_join(q, t, 3).join(spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "id long, y int"), "id")
    assert K.vote(near, "distance").first()["__p"] == 0.5
    assert K.vote(near, "uniform").first()["__p"] == pytest.approx(1 / 3)


@pytest.mark.parametrize("metric, p, width, most", [("mahalanobis", 2.0, 4, 0.15), ("chebyshev", 2.0, 3, 0.1), ("minkowski", 3.0, 12, 1.0)])
def test_a_block_compares_few_pairs_and_finds_the_nearest(monkeypatch, metric, p, width, most):
    """Copies of a point come in order of place; a limit of infinity or none leaves nothing out."""
    rng = np.random.default_rng(8)
    points, asked = rng.normal(size=(6000, width)), rng.normal(size=(300, width))
    points[50:80], asked[:3] = points[7], points[7]
    plain, compared = K.distances, []

    def counting(a, b, *rest):
        compared.append(len(a) * len(b))
        return plain(a, b, *rest)
    monkeypatch.setattr(K, "distances", counting)
    where, best = K.nearest_rows(points, asked, np.where(np.arange(300) % 2, np.inf, np.nan), 4, metric, p)
    every = plain(asked, points, metric, p)
    want = np.argsort(every, axis=1, kind="stable")[:, :4]
    assert (where == want).all() and np.allclose(best, np.take_along_axis(every, want, axis=1), rtol=1e-12)
    assert where[0].tolist() == [7, 50, 51, 52]
    assert sum(compared) < most * every.size


def test_knn_join_asks_other_cells_and_knows_repeated_queries(spark):
    """Queries at the edge of a cell, a query asked twice and one without a key."""
    train = [(i, [float(i % 40), float(i // 40)]) for i in range(1600)]
    queries = [(1, [19.5, 20.0]), (2, [0.0, 0.0]), (2, [0.0, 0.0]), (None, [39.0, 39.0])]
    t, q = spark.createDataFrame(train, "id long, x array<double>"), spark.createDataFrame(queries, "qid long, x array<double>")
    got = K.knn_join(q, t, 4, "manhattan", cells=64).collect()
    near = {qid: sorted((r["distance"], r["id"]) for r in got if r["qid"] == qid) for qid in (1, 2, None)}
    assert near[1] == [(0.5, 819), (0.5, 820), (1.5, 779), (1.5, 780)]
    assert near[2] == [(0.0, 0), (0.0, 0), (1.0, 1), (1.0, 1)]
    assert near[None] == [(0.0, 1599), (1.0, 1559), (1.0, 1598), (2.0, 1519)]


def test_isotonic_calibration_is_monotone_and_calibrated(ready):
    svm = make_model("SVC", N).fit(ready)
    calibrated = calibrate_isotonic(svm, ready)
    assert is_calibrated(calibrated) and not is_calibrated(svm)
    done = predict(calibrated, ready).join(svm.transform(ready).select("id", vector_to_array(F.col("rawPrediction"))[1].alias("raw")), "id").toPandas().sort_values("raw")
    assert (np.diff(done["probability"]) >= -1e-12).all()
    assert done["probability"].mean() == pytest.approx(done["y"].mean())
    assert ((done["probability"] > 0.5).astype(int) == done["prediction"]).all()


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    assert {r["y"]: r["weight"] for r in class_weights(df, "y").collect()} == {0: pytest.approx(8 / 12), 1: 2.0}
    assert {r["y"]: r["weight"] for r in class_weights(df, "y", 2.5).collect()} == {0: 1.0, 1: 2.0}


def test_weighted_models_move_towards_the_minority(ready):
    plain = make_model("LogisticRegression", N).fit(ready)
    weighted = make_model("LogisticRegression", N, weighted=True).fit(class_weights(ready, "label"))
    assert probabilities(weighted, ready).mean() > probabilities(plain, ready).mean()


def test_catalogue_settings_build_every_model():
    for name in MODELS:
        for setting in sampled_settings(name, 3, seed=1):
            make_model(name, 100, 0, 3, **setting)
    assert len(all_settings("RidgeClassifier")) == 8
    assert len(sampled_settings("LogisticRegression", 5, seed=2)) == 5
    assert sampled_settings("LogisticRegression", 5, seed=2) == sampled_settings("LogisticRegression", 5, seed=2)
    with pytest.raises(ValueError, match="does not exist"):
        make_model("Oracle", 1)


def test_search_picks_the_best_setting(ready):
    grids = [{"C": [1e-9, 1.0], "maxIter": [20], "penalty": ["l2"]}]
    model, setting, scores = search(ready, "LogisticRegression", "f1", "grid", folds=3, seed=1, key_cols=["id"], grids=grids)
    assert setting["C"] == 1.0 and len(scores) == 2 and max(v for _, v in scores) > 0.6
    assert roc_auc(scored(model, ready)).first()["auc"] > 0.8
    _, _, sampled = search(ready.select("features", "label"), "GaussianNB", "gini", "randomized", n_iter=2, folds=3)
    assert len(sampled) == 2
    with pytest.raises(ValueError, match="grid"):
        search(ready, "GaussianNB", how="random")
    with pytest.raises(ValueError, match="unsupported metric"):
        evaluator_for("loss")


def test_evaluators_agree_with_our_metrics(ready):
    model = make_model("GaussianNB", N).fit(ready)
    done = model.transform(ready)
    row = evaluate("m", model, ready, ready).first()
    for metric, name in (("accuracy", "accuracy_train"), ("precision", "precision_train"), ("recall", "recall_train"), ("f1", "f1_train"), ("roc_auc", "auc_train")):
        assert evaluator_for(metric).evaluate(done) == pytest.approx(row[name], abs=6e-4)
    assert row["overfit_accuracy"] == 0.0


def test_stacking(ready):
    bases = [make_model("GaussianNB", N).fit(ready), calibrate_isotonic(make_model("SVC", N).fit(ready), ready)]
    features = stack_features(bases, ready).orderBy("id").toPandas()
    assert np.allclose(features["base_0"], probabilities(bases[0], ready)) and len(features["stacked"][0]) == 2
    for how in ("logistic_regression", "gradient_boosting", "neural_network"):
        extra = {"maxIter": 5} if how == "gradient_boosting" else {}
        assert roc_auc(scored(stack_fit(bases, ready, how, 1, **extra), ready)).first()["auc"] > 0.8
    with pytest.raises(ValueError, match="stacking_model_type"):
        stack_fit(bases, ready, "forest")
    with pytest.raises(ValueError, match="calibrated"):
        stack_features([make_model("SVC", N).fit(ready)], ready)


@pytest.mark.parametrize("name", ["GaussianNB", "LinearDiscriminantAnalysis", "AdaBoostClassifier", "RidgeClassifier", "KNeighborsClassifier", "RandomForestClassifier"])
def test_models_survive_saving(spark, ready, name):
    model = make_model(name, N, 1, 3, **SMALL[name]).fit(ready)
    model = calibrate_isotonic(model, ready) if name == "RidgeClassifier" else model
    back = load_model(save_model(model, scratch_path(spark, "model")))
    assert np.allclose(probabilities(back, ready), probabilities(model, ready))
    with pytest.raises(FileNotFoundError):
        load_models(spark, [scratch_path(spark, "absent")])


def test_feature_importance_and_local_explanation(spark, ready):
    forest = make_model("RandomForestClassifier", N, 1, numTrees=10).fit(ready)
    rows = feature_importance(forest, ["a", "b", "c"], spark).collect()
    assert rows[-1]["feature"] == "c" and sum(r["importance"] for r in rows) == pytest.approx(1.0)
    boosted = make_model("AdaBoostClassifier", N, 1, numTrees=5).fit(ready)
    assert feature_importance(boosted, ["a", "b", "c"], spark).count() == 3
    linear = make_model("LogisticRegression", N).fit(ready)
    assert feature_importance(calibrate_isotonic(linear, ready), ["a", "b", "c"], spark).count() == 3
    with pytest.raises(ValueError, match="no feature importance"):
        feature_importance(make_model("GaussianNB", N).fit(ready), ["a", "b", "c"], spark)
    few = ready.filter("id < 5")
    told = explain_local(linear, few, ready, ["a", "b", "c"], "id", samples=200, seed=3).toPandas()
    assert len(told) == 15
    strength = told.assign(weight=told["weight"].abs()).groupby("feature")["weight"].mean()
    assert strength["c"] < strength["a"] and strength["c"] < strength["b"]
    again = explain_local(linear, few.repartition(5), ready, ["a", "b", "c"], "id", samples=200, seed=3).toPandas()
    assert np.allclose(again.sort_values(["key", "feature"])["weight"], told.sort_values(["key", "feature"])["weight"])


def test_explanation_sorts_scores_by_their_places_without_a_lambda(spark, ready, capsys):
    """Weights are those of the definition, and no list is compared by an interpreted function a pair."""
    model = make_model("LogisticRegression", N).fit(ready)
    told = explain_local(model, ready.filter("id = 7"), ready, ["a", "b", "c"], "id", samples=150, seed=3)
    told.explain()
    assert "lambda" not in capsys.readouterr().out.lower()
    told = {r["feature"]: r for r in told.collect()}
    row = ready.filter("id = 7").selectExpr("a", "b", "c", "xxhash64(cast(id as string), 3) AS mark").first()
    spread = ready.agg(*[F.stddev_pop(c) for c in "abc"]).first()
    z = np.random.default_rng(abs(row["mark"])).normal(size=(150, 3))
    z[0] = 0.0
    x = np.array(row[:3]) + z * np.array(spread)
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    w = np.sqrt(np.exp(-(z ** 2).sum(axis=1) / (0.75 ** 2 * 3)))
    zc, pc = z - np.average(z, axis=0, weights=w), p - np.average(p, weights=w)
    want = np.linalg.solve((zc * w[:, None]).T @ zc + np.eye(3), (zc * w[:, None]).T @ pc)
    assert np.allclose([told[c]["weight"] for c in "abc"], want)


@pytest.mark.parametrize("depth", [1, 3])
def test_a_trees_label_as_an_expression_is_its_prediction(ready, depth):
    from pyspark.ml.classification import DecisionTreeClassifier
    from tabloom.models.ensembles import tree_label, with_x
    tree = DecisionTreeClassifier(maxDepth=depth).fit(ready)
    both = tree.transform(with_x(ready)).withColumn("mine", tree_label(tree._java_obj.rootNode(), F.col("x")))
    assert both.filter("NOT mine <=> prediction").count() == 0 and both.select("mine").distinct().count() == 2


def test_training_run_individual_then_stacking(spark, planted):
    df = spark.createDataFrame(planted)
    train, test = df.filter("id % 4 <> 0"), df.filter("id % 4 = 0")
    config = {"tag": "t", "target_column": "y", "random_state": 1, "key_columns": ["id"], "training": {
        "data_is_balanced": False, "approach_type": "individual", "base_model_names": ["LogisticRegression", "GaussianNB", "SVC"], "base_model_files": [],
        "stacking_model_type": "logistic_regression", "cross_validation_search_type": "grid", "num_cv_folds": 2, "num_iter": 2,
        "scoring": ["roc_auc", "f1"], "overfitting_threshold": 0.05}}
    grids = {"LogisticRegression": [{"C": [1.0], "penalty": ["l2"]}], "GaussianNB": [{"varSmoothing": [1e-9]}], "SVC": [{"C": [1.0]}]}
    out = scratch_path(spark, "run")
    with pytest.warns(UserWarning, match="GaussianNB does not support class weights"):
        done = run_training(train, test, config, out, grids=grids)
    metrics = {r["model"]: r for r in done["metrics"].collect()}
    assert set(metrics) == {"LogisticRegression", "GaussianNB", "SVC"} and all(r["auc_test"] > 0.8 for r in metrics.values())
    assert "uncalibrated" not in done["paths"]["SVC"] and set(done["importance"]) == {"LogisticRegression"}
    assert done["explanation"]["GaussianNB"].count() == 3
    assert load_setting(spark, done["paths"]["LogisticRegression"]["best_params"]) == {"C": 1.0, "penalty": "l2"}
    files = [done["paths"]["LogisticRegression"]["uncalibrated"], done["paths"]["SVC"]["calibrated"]]
    assert [b["calibrated"] for b in load_models(spark, files)] == [False, True]
    config["training"].update(approach_type="stacking", base_model_files=files)
    stacked = run_training(train, test, config, out)
    row = stacked["metrics"].first()
    assert row["model"] == "MetaClassifier" and row["auc_test"] > 0.8
    config["training"]["approach_type"] = "other"
    with pytest.raises(ValueError, match="approach_type"):
        run_training(train, test, config)


def test_search_scores_every_metric_on_unseen_folds(spark, ready):
    folded = fold_rows(ready, 3, 1, ["id"])
    found = search_folded(folded, "GaussianNB", ["roc_auc", "accuracy", "precision", "recall", "f1", "gini"], settings=[{"varSmoothing": 1e3}, {"varSmoothing": 1e-9}, {"varSmoothing": 1e-9}])
    assert found.setting == {"varSmoothing": 1e-9} and found.means[1] == found.means[2]
    by_hand = []
    for fold in range(3):
        model = make_model("GaussianNB", N, varSmoothing=1e-9).fit(folded.rows.filter(F.col("fold") != fold))
        told = scored(model, folded.rows.filter(F.col("fold") == fold)).toPandas()
        y, p, s = told["label"].to_numpy(), told["prediction"].to_numpy(), told["score"].to_numpy()
        tp, precision, recall = (y & p).sum(), (y & p).sum() / p.sum(), (y & p).sum() / y.sum()
        auc = np.mean([(a > b) + (a == b) / 2 for a in s[y == 1] for b in s[y == 0]])
        by_hand.append([auc, (y == p).mean(), precision, recall, 2 * tp / (p.sum() + y.sum()), 2 * auc - 1])
    assert np.allclose(list(found.means[1].values()), np.mean(by_hand, axis=0))


def test_undefined_metrics_are_null(spark):
    """A fold of one class has no AUC, and so no mean."""
    scores = spark.createDataFrame([(0.4, 0, 1, 5, s, f) for s in range(2) for f in range(2)], "score double, prediction int, label int, rows long, setting int, fold int")
    rows = mean_metrics(scores, ["roc_auc", "recall"], 2).collect()
    assert [(r["roc_auc"], r["recall"]) for r in rows] == [(None, 0.0)] * 2
    with pytest.raises(ValueError, match="unsupported metrics"):
        mean_metrics(scores, ["loss"], 2)


def test_run_writes_the_folds_once(spark, planted, monkeypatch):
    calls = []
    monkeypatch.setattr(training, "fold_rows", lambda *a: calls.append(a) or fold_rows(*a))
    df = spark.createDataFrame(planted)
    config = {"tag": "t", "target_column": "y", "random_state": 1, "key_columns": ["id"], "training": {
        "data_is_balanced": True, "approach_type": "individual", "base_model_names": ["LogisticRegression", "GaussianNB", "SVC"], "base_model_files": [],
        "stacking_model_type": "logistic_regression", "cross_validation_search_type": "grid", "num_cv_folds": 2, "num_iter": 2,
        "scoring": ["gini", "f1", "recall"], "overfitting_threshold": 0.05}}
    grids = {"LogisticRegression": [{"C": [1.0, 0.1], "penalty": ["l2"]}], "GaussianNB": [{"varSmoothing": [1e-9]}], "SVC": [{"C": [1.0]}]}
    done = run_training(df.filter("id % 4 <> 0"), df.filter("id % 4 = 0"), config, grids=grids)
    rows = done["search"].collect()
    assert len(calls) == 1 and [r["model"] for r in rows] == ["LogisticRegression"] * 2 + ["GaussianNB", "SVC"]
    assert sum(r["is_best"] for r in rows) == 3 and all((r["gini"] is None) == (r["model"] == "SVC") and r["accuracy"] is None and r["f1"] > 0.5 for r in rows)


def test_stacked_models_read_their_rows_written_once(spark, monkeypatch):
    """The split is computed and written once; the models' passes do not go back to the source."""
    from tabloom.catalog import QUERIES, learning
    files, fit = [], learning.base_models
    monkeypatch.setattr(learning, "base_models", lambda train: files.extend(train.inputFiles()) or fit(train))
    assert len(QUERIES["m19_stack_fit_logistic"](spark, "/root/testdata/sf0.001").collect()) == 1
    assert files and not any("/testdata/" in f for f in files)
