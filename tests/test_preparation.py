import math

import numpy as np
import pandas as pd
import pytest

from tabloom.operators.fill import FillNumeric, FillText, FillZero, fill_zero
from tabloom.operators.outliers import RemoveOutliers, ReplaceOutliers
from tabloom.operators.transform import ConvertToNumber, Scale, Transform


def run(step, df, rules, test=None):
    action = {step.kind: rules}
    done, learned = step.fit_apply(df, action)
    return (done, learned) if test is None else (done, learned, step.apply(test, action, learned))


def values(df, name):
    return [r[name] for r in df.collect()]


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame([(1, 1.0, "b"), (2, None, "a"), (None, 3.0, None), (2, 3.0, "b"), (7, float("nan"), "a")], "n int, x double, s string")


def test_fill_zero(gaps):
    assert values(fill_zero(gaps, ["n", "x"]), "x") == [1.0, 0.0, 3.0, 3.0, 0.0]
    assert fill_zero(gaps, ["n"]).schema["n"].dataType.simpleString() == "int"
    with pytest.raises(ValueError, match="not found"):
        fill_zero(gaps, ["zzz"])
    assert FillZero().kind.endswith("zeroes")


def test_fill_numeric_methods(gaps):
    for method, want in (("mode", 3.0), ("median", 3.0), ("mean", 7 / 3)):
        done, learned = run(FillNumeric(), gaps, [{"column": "x", "fill_missing_values_method": method}])
        assert learned["x"] == pytest.approx(want)
        assert values(done, "x")[1] == pytest.approx(want)
    done, learned = run(FillNumeric(), gaps, [{"column": "n", "fill_missing_values_method": "mode"}])
    assert learned == {"n": 2} and done.schema["n"].dataType.simpleString() == "int"
    done, learned = run(FillNumeric(), gaps, [{"column": "n", "fill_missing_values_method": "mean"}])
    assert values(done, "n")[2] == 3.0


def test_fill_is_replayed_on_other_data(spark, gaps):
    test = spark.createDataFrame([(None, None, None)], gaps.schema)
    _, _, replay = run(FillNumeric(), gaps, [{"column": "x", "fill_missing_values_method": "median"}, {"column": "n", "fill_missing_values_method": "mode"}], test)
    assert replay.first()[:2] == (2, 3.0)
    _, _, replay = run(FillText(), gaps, [{"column": "s", "fill_missing_values_method": "mode"}], test)
    assert replay.first()["s"] == "a"       # tie between a and b


def test_fill_skips_empty_rules_and_checks_parameters(spark, gaps):
    done, learned = run(FillNumeric(), gaps, [{}, {"column": "x", "fill_missing_values_method": ""}, {"column": "n", "fill_missing_values_method": "mode"}])
    assert learned == {"n": 2} and values(done, "x")[1] is None
    with pytest.raises(ValueError, match="placeholder"):
        run(FillText(), gaps, [{"column": "s", "fill_missing_values_method": "placeholder", "placeholder": ""}])
    with pytest.raises(ValueError, match="must be one of"):
        run(FillNumeric(), gaps, [{"column": "x", "fill_missing_values_method": "max"}])
    with pytest.raises(ValueError, match="lacks the keys"):
        run(FillNumeric(), gaps, [{"column": "x"}])
    with pytest.raises(ValueError, match="no value"):
        run(FillText(), spark.createDataFrame([(None,)], "s string"), [{"column": "s", "fill_missing_values_method": "mode"}])


@pytest.fixture(scope="module")
def tail(spark):
    numbers = [1.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0, 100.0, -50.0, None]
    return spark.createDataFrame([(v, float(i)) for i, v in enumerate(numbers)], "x double, k double"), pd.Series(numbers, dtype="float64")


@pytest.mark.parametrize("rule", [{"search_method": "z_score", "threshold": 1.5}, {"search_method": "iqr"}, {"search_method": "tukey_fences"}, {"search_method": "iqr", "k": 10.0}])
def test_remove_outliers(tail, rule):
    df, s = tail
    if rule["search_method"] == "z_score":
        want = s[((s - s.mean()) / s.std()).abs() < 1.5]
    else:
        k = rule.get("k", 1.5 if rule["search_method"] == "iqr" else 3.0)
        q1, q3 = s.quantile(0.25), s.quantile(0.75)
        want = s[(s > q1 - k * (q3 - q1)) & (s < q3 + k * (q3 - q1))]
    done, learned, replay = run(RemoveOutliers(), df, [{"column": "x", **rule}], df)
    assert sorted(values(done, "x")) == sorted(want) == sorted(values(replay, "x"))


def test_removal_rules_see_earlier_removals(spark):
    df = spark.createDataFrame([(float(v), float(w)) for v, w in zip([1, 2, 3, 4, 1000], [1, 2, 3, 4, 5])], "a double, b double")
    rules = [{"column": "a", "search_method": "iqr"}, {"column": "b", "search_method": "z_score", "threshold": 1.0}]
    done, learned = run(RemoveOutliers(), df, rules)
    s = pd.Series([1.0, 2, 3, 4])
    assert values(done, "b") == [v for v in s if abs((v - s.mean()) / s.std()) < 1.0]


@pytest.mark.parametrize("how", ["mean", "median", "mode", "quantile_25", "quantile_75", "lower_bound", "upper_bound", "clip"])
def test_replace_outliers(tail, how):
    df, s = tail
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    if how == "clip":
        want = s.clip(lo, hi)
    else:
        value = {"mean": s.mean(), "median": s.median(), "mode": 2.0, "quantile_25": q1, "quantile_75": q3, "lower_bound": lo, "upper_bound": hi}[how]
        want = s.where(~((s < lo) | (s > hi)), value)
    done, _, replay = run(ReplaceOutliers(), df, [{"column": "x", "search_method": "iqr", "replacement_method": how}], df)
    got = pd.Series(values(done, "x"), dtype="float64")
    assert np.allclose(got, want, equal_nan=True)
    assert np.allclose(pd.Series(values(replay, "x"), dtype="float64"), want, equal_nan=True)


def test_replace_learns_independent_columns_in_one_action(tail, actions):
    df, _ = tail
    action = {ReplaceOutliers.kind: [{"column": c, "search_method": "iqr", "replacement_method": "median"} for c in ("x", "k")]}
    with actions() as seen:
        ReplaceOutliers().fit(df, action, rows=10)
    assert seen.count == 1
    with pytest.raises(ValueError, match="search_method"):
        ReplaceOutliers().fit(df, {ReplaceOutliers.kind: [{"column": "x", "search_method": "magic", "replacement_method": "mean"}]})


def test_outliers_of_empty_and_missing_columns(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert run(RemoveOutliers(), empty, [{"column": "x", "search_method": "iqr"}])[0].count() == 0
    assert values(run(ReplaceOutliers(), empty, [{"column": "x", "search_method": "z_score", "replacement_method": "mean"}])[0], "x") == [None]


def test_transforms_and_their_domains(spark):
    df = spark.createDataFrame([(v,) for v in (-4.0, -1.0, 0.0, 3.0, None)], "x double")
    log = values(run(Transform(), df, [{"column": "x", "transformation_method": "log"}])[0], "x")
    assert log[:2] == [None, None] and log[2] == 0.0 and log[3] == pytest.approx(math.log(4))
    assert values(run(Transform(), df, [{"column": "x", "transformation_method": "sqrt"}])[0], "x") == [None, None, 0.0, pytest.approx(3 ** 0.5), None]
    assert values(run(Transform(), df, [{"column": "x", "transformation_method": "power", "power": 2}])[0], "x") == [16.0, 1.0, 0.0, 9.0, None]
    assert values(run(Transform(), df, [{"column": "x", "transformation_method": "power", "power": -1}])[0], "x")[2] is None
    with pytest.raises(ValueError, match="power"):
        run(Transform(), df, [{"column": "x", "transformation_method": "power"}])
    with pytest.raises(ValueError, match="transformation_method"):
        run(Transform(), df, [{"column": "x", "transformation_method": "exp"}])


@pytest.mark.parametrize("how", ["standard", "robust", "minmax", "none"])
def test_scaling(spark, how):
    s = pd.Series([1.0, 2.0, 4.0, 9.0])
    df = spark.createDataFrame([(float(v), 5.0, None) for v in s], "x double, one double, nothing double")
    done, learned, replay = run(Scale(), df, {"scaler_type": how, "columns": ["x", "one", "nothing"]}, df)
    want = {"standard": (s - s.mean()) / s.std(ddof=0), "robust": (s - s.median()) / (s.quantile(0.75) - s.quantile(0.25)),
            "minmax": (s - 1) / 8, "none": s}[how]
    assert np.allclose(values(done, "x"), want) and np.allclose(values(replay, "x"), want)
    assert set(values(done, "one")) == ({5.0} if how == "none" else {0.0}) and set(values(done, "nothing")) == {None}
    with pytest.raises(ValueError, match="scaler_type"):
        run(Scale(), df, {"scaler_type": "odd", "columns": ["x"]})


def test_converting(spark):
    df = spark.createDataFrame([("3", "4.5")], "a string, b string")
    done, _ = run(ConvertToNumber(), df, [{"column": "a", "to_type": "int"}, {"column": "b", "to_type": "float"}])
    assert done.first() == (3, 4.5)
