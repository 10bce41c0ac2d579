import math
import warnings

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.functions import lookup
from tabloom.operators import binning as B
from tabloom.operators import encode as E


def run(step, df, rules, full=None, test=None):
    action = {step.kind: rules}
    done, learned = step.fit_apply(df, action, full)
    return (done, learned) if test is None else (done, learned, step.apply(test, action, learned))


def column(df, name):
    return [r[name] for r in df.collect()]


def numbers(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


def test_one_hot_names_order_and_unseen(spark):
    full = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "s string")
    train = full.limit(2)
    done, learned, test = run(E.OneHot(), train, [{"column": "s", "drop_first": False}], full,
                              spark.createDataFrame([("c",), ("zzz",), (None,)], "s string"))
    assert learned["s"]["values"] == ["a", "b", "c"] and done.columns == ["s_a", "s_b", "s_c"]
    assert [tuple(r) for r in test.collect()] == [(0, 0, 1), (0, 0, 0), (0, 0, 0)]
    done, learned = run(E.OneHot(), train, [{"column": "s", "drop_first": True}], full)
    assert learned["s"]["dropped"] == "b" and done.columns == ["s_a", "s_c"]


def test_one_hot_of_numbers_and_ties(spark):
    df = spark.createDataFrame([(10,), (9,), (9,), (10,), (1,)], "k int")
    done, learned = run(E.OneHot(), df, [{"column": "k", "drop_first": True}])
    assert learned["k"] == {"values": [1, 9, 10], "dropped": 9} and done.columns == ["k_1", "k_10"]


def test_one_hot_refuses_runaway_width(spark, monkeypatch):
    monkeypatch.setattr(E, "WIDEST_TABLE", 5)
    df = spark.range(10).withColumn("s", F.col("id").cast("string"))
    with pytest.raises(ValueError, match="max_categories"):
        run(E.OneHot(), df, [{"column": "s", "drop_first": False}])
    assert len(run(E.OneHot(), df, [{"column": "s", "drop_first": False, "max_categories": 20}])[0].columns) == 11


def test_ordinal(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    assert column(run(E.Ordinal(), df, [{"column": "k", "mapping": {"3": 1, "2": 2, "1": 3}}])[0], "k") == [1, 3, 2]
    with pytest.raises(Exception, match="without a code"):
        run(E.Ordinal(), df, [{"column": "k", "mapping": {"3": 1, "2": 2}}])[0].collect()
    with pytest.raises(Exception, match="without a code"):
        run(E.Ordinal(), spark.createDataFrame([(None,)], "k int"), [{"column": "k", "mapping": {"3": 1}}])[0].collect()
    with pytest.raises(ValueError, match="more than one"):
        run(E.Ordinal(), df, [{"column": "k", "mapping": {"3": 1, "2": 1, "1": 2}}])
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        run(E.Ordinal(), df, [{"column": "k", "mapping": {"3": 0, "2": 1, "1": 4}}])
    assert any("code 0" in str(w.message) for w in seen) and any("[2, 3]" in str(w.message) for w in seen)


def test_manual_bins(spark):
    df = numbers(spark, [0, 1, 1.5, 2, 5])
    binned, _ = B.bin_columns(df, [{"column": "x", "binning_method": "manual", "bins": [0, 1, 2, 5]}])
    assert column(binned, "x") == [0, 0, 1, 1, 2]
    for bins, message in (([], "needs bins"), ([0, 2, 1, 5], "increasing"), ([0, 0, 5], "unique"), ([1, 5], "not covered"), ([0, 3], "not covered"), ([0, 2, 3, 4, 5], "hold no value")):
        with pytest.raises(ValueError, match=message):
            B.fit_bins(df, [{"column": "x", "binning_method": "manual", "bins": bins}])
    # Emptiness is tested with both ends included: 2 lies in both neighbours.
    B.fit_bins(df, [{"column": "x", "binning_method": "manual", "bins": [0, 2, 3, 5]}])


def test_equal_width_covers_full_data(spark):
    train, full = numbers(spark, [2, 3, 5]), numbers(spark, [0, 2, 3, 5, 10])
    learned = B.fit_bins(train, [{"column": "x", "bins": 5}], full)
    assert learned["x"]["bins"] == [0, 2, 4, 6, 8, 10]
    assert column(B.apply_bins(full, learned), "x") == [0, 0, 1, 2, 4]
    for bins in (0, -1, "3", None, True):
        with pytest.raises(ValueError, match="positive integer"):
            B.fit_bins(train, [{"column": "x", "bins": bins}])
    with pytest.raises(ValueError, match="binning_method"):
        B.fit_bins(train, [{"column": "x", "binning_method": "odd"}])
    with pytest.raises(ValueError, match="not numeric"):
        B.fit_bins(train.select(F.lit("a").alias("x")), [{"column": "x", "bins": 2}])


@pytest.mark.parametrize("q", [1, 2, 3, 4, 10])
def test_quantile_bins_match_pandas(spark, q):
    values = [1, 1, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, None]
    df = numbers(spark, values)
    learned = B.fit_bins(df, [{"column": "x", "binning_method": "equal_size", "quantiles": q}])
    want, edges = pd.qcut(pd.Series(values, dtype="float64"), q, labels=False, retbins=True, duplicates="drop")
    assert np.allclose(learned["x"]["bins"], edges)
    got = pd.Series(column(B.apply_bins(df, learned), "x"), dtype="float64")
    assert (got.fillna(-1) == want.fillna(-1)).all()


def test_quantile_edges_are_widened_to_full_range(spark):
    train, full = numbers(spark, range(10)), numbers(spark, [-5, *range(10), 99])
    learned = B.fit_bins(train, [{"column": "x", "binning_method": "equal_size", "quantiles": 3}], full)
    assert learned["x"]["bins"] == [-5, 3, 6, 99]


def test_constant_after_binning_is_refused(spark):
    with pytest.raises(ValueError, match="constant"):
        B.bin_columns(numbers(spark, [3, 3, 3]), [{"column": "x", "binning_method": "equal_size", "quantiles": 2}])
    with pytest.raises(ValueError, match="constant"):
        B.bin_columns(numbers(spark, [1, 1.1, 1.2]), [{"column": "x", "binning_method": "manual", "bins": [0, 9]}])
    # A missing value is a second value.
    B.bin_columns(numbers(spark, [3, 3, None]), [{"column": "x", "binning_method": "equal_size", "quantiles": 2}])


def reference_search(values):
    """The search in pandas, from its definition."""
    s = pd.Series(values, dtype="float64")
    wanted = B.bin_size_bounds(int(s.count()))[0]
    for q in range(len(s) // wanted, 0, -1):
        if pd.qcut(s, q, duplicates="drop").value_counts().min() >= wanted:
            return q
    return 1


@pytest.mark.parametrize("kind", ["normal", "discrete", "atom", "gaps", "few"])
def test_largest_quantile_number_matches_definition(spark, kind):
    rng = np.random.default_rng(5)
    values = {"normal": rng.normal(size=900).round(3), "discrete": rng.integers(0, 7, 800).astype(float),
              "atom": np.where(rng.random(900) < 0.35, 0.0, rng.exponential(size=900)),
              "gaps": np.where(rng.random(700) < 0.3, np.nan, rng.integers(0, 60, 700)), "few": rng.random(30)}[kind]
    df = numbers(spark, [None if np.isnan(v) else v for v in values])
    found = B.best_quantiles(df, ["x"])["x"]
    assert found["quantiles"] == reference_search(values)


@pytest.mark.parametrize("kind", ["three", "one", "atoms", "continuous", "few"])
def test_largest_quantile_number_of_mostly_null_columns(spark, monkeypatch, kind):
    rng = np.random.default_rng(6)
    rows, values = {"three": (40_000, np.repeat([0.0, 1.0, 2.0], [667, 666, 667])), "one": (9_000, np.repeat(4.0, 80)),
                    "atoms": (8_000, np.concatenate([np.repeat([0.0, 3.0], [150, 130]), rng.random(3), 5 + rng.random(2)])),
                    "continuous": (5_000, rng.random(300).round(6)), "few": (4_000, rng.random(12))}[kind]
    every = np.concatenate([values, np.full(rows - len(values), np.nan)])
    df = numbers(spark, [None if np.isnan(v) else float(v) for v in every])
    want = reference_search(every)
    assert kind != "three" or want > 100
    edges = pd.qcut(pd.Series(every), want, retbins=True, duplicates="drop")[1] if kind != "one" else [4.0]
    for fetched in (B.FETCHED, 0)[:1 if kind == "three" else 2]:
        monkeypatch.setattr(B, "FETCHED", fetched)
        found = B.best_quantiles(df, ["x"])["x"]
        assert found["quantiles"] == want and np.allclose(found["bins"], edges) and set(found) == {"bins", "quantiles"}


def test_quantile_search_takes_two_actions_after_sizing(spark, actions):
    df = numbers(spark, [i % 50 for i in range(2000)])
    with actions() as seen:
        B.best_quantiles(df, ["x"])
    assert seen.count <= 3


@pytest.mark.parametrize("n, want", [(0, (20, 0, 0)), (891, (30, 18, 89)), (100, (20, 2, 10)), (125, (20, 2, 12)), (10**6, (20000, 20000, 100000)), (2500, (50, 50, 250))])
def test_bin_size_bounds(spark, n, want):
    assert B.bin_size_bounds(n) == want


def test_reports(spark):
    df = spark.createDataFrame([(0,)] * 5 + [(1,)] * 95 + [(None,)] * 7, "b int")
    assert [(r["bin"], r["n"]) for r in B.bin_count_report(df, "b").collect()] == [(1, 95)]
    assert [(r["value"], r["n"]) for r in B.rare_category_report(df, "b").collect()] == [(0, 5)]


def frame(spark):
    rows = [("a", 1), ("a", 0), ("a", 1), ("b", 0), ("b", 0), ("c", 1), (None, 1), ("b", None)]
    return spark.createDataFrame([(k, None if y is None else float(y)) for k, y in rows], "k string, y double"), pd.DataFrame(rows, columns=["k", "y"])


METHODS = {
    "mean": lambda g, all_: g.mean(), "sum": lambda g, all_: g.sum(), "median": lambda g, all_: g.median(),
    "quantile_25": lambda g, all_: g.quantile(0.25), "quantile_75": lambda g, all_: g.quantile(0.75), "count": lambda g, all_: g.count(),
    "smoothed_target_encoding": lambda g, all_: (g.sum() + 1) / (g.count() + 2),
    "bayesian_target_encoding": lambda g, all_: (g.sum() + all_.mean() * 5) / (g.count() + 5),
}


@pytest.mark.parametrize("inline", [True, False])
@pytest.mark.parametrize("method", METHODS)
def test_target_encoding(spark, monkeypatch, method, inline):
    if not inline:
        monkeypatch.setattr(E, "INLINE_ROWS", 1)
    df, pdf = frame(spark)
    want = METHODS[method](pdf.groupby("k")["y"], pdf["y"]).to_dict()
    done, learned = run(E.TargetEncode(), df, [{"column": "k", "type": "categorical", "target_column": "y", "encoding_method": method}])
    assert ("table" in learned["k"]) != inline
    got = done.withColumn("key", F.lit(1)).toPandas()
    assert sorted(got["k"].dropna()) == pytest.approx(sorted(want[k] for k in pdf["k"].dropna()))
    assert got["k"].isna().sum() == 1


def test_target_quartiles_of_many_target_values(spark, monkeypatch):
    monkeypatch.setattr(E, "COUNTED_TARGETS", 10)
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"k": np.where(rng.random(600) < 0.5, "hot", rng.choice(list("abcd"), 600)), "y": rng.normal(size=600).round(2)})
    stats = E.category_stats(spark.createDataFrame(pdf), [(F.col("k"), "y")], [0]).toPandas().set_index("key")
    for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        assert stats[name].sort_index().tolist() == pytest.approx(pdf.groupby("k")["y"].quantile(p).sort_index().tolist())


@pytest.mark.parametrize("literal_rows, inline_rows", [(64, 10_000), (1, 10_000), (1, 1)])
def test_unseen_values_fail_or_become_null(spark, monkeypatch, literal_rows, inline_rows):
    monkeypatch.setattr(lookup, "LITERAL_ROWS", literal_rows)
    monkeypatch.setattr(E, "INLINE_ROWS", inline_rows)
    df, _ = frame(spark)
    rule = {"column": "k", "type": "categorical", "target_column": "y", "encoding_method": "count"}
    test = spark.createDataFrame([("a", 1.0), (None, 0.0), ("new", 0.0)], "k string, y double")
    _, _, replay = run(E.TargetEncode(), df, [rule], test=test)
    assert sorted(map(str, column(replay.filter("y = 1"), "k"))) == ["3.0"]
    with pytest.raises(Exception, match="not found in the training data"):
        replay.collect()
    _, _, replay = run(E.TargetEncode(), df, [{**rule, "on_unseen": "null"}], test=test)
    assert sorted(column(replay, "k"), key=str) == [3.0, None, None]


def test_hot_and_missing_keys_are_spread_in_the_shuffle_join(spark, monkeypatch):
    monkeypatch.setattr(E, "INLINE_ROWS", 10)
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"),
                                  (F.col("id") % 2).cast("double").alias("y"))
    rule = [{"column": "k", "type": "categorical", "target_column": "y", "encoding_method": "mean"}]
    done, learned = run(E.TargetEncode(), df, rule)
    assert learned["k"]["hot"] == ["hot"]
    assert done.count() == 3000 and done.filter("k is null").count() == 1000
    assert done.filter("k = 0.5").count() == 1000


def test_continuous_target_encoding_and_range_policy(spark):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(100)], "x double, y int")
    rule = {"column": "x", "type": "continuous", "target_column": "y", "encoding_method": "sum", "bins": 4}
    done, learned, replay = run(E.TargetEncode(), df, [rule], test=spark.createDataFrame([(50.0, 1), (None, 0)], "x double, y int"))
    assert sum(v for _, v in learned["x"]["rows"]) == 50.0
    assert column(replay, "x")[1] is None
    outside = spark.createDataFrame([(500.0, 1)], "x double, y int")
    with pytest.raises(Exception, match="outside the bins"):
        run(E.TargetEncode(), df, [rule], test=outside)[2].collect()
    woe = {"column": "x", "type": "continuous", "target_column": "y", "bins": 4}
    assert column(run(E.WoeEncode(), df, [woe], test=outside)[2], "x") == [None]


def test_bin_without_training_rows_is_unseen(spark):
    train = spark.createDataFrame([(0.0, 1), (0.5, 0), (10.0, 1)], "x double, y int")
    rule = {"column": "x", "type": "continuous", "target_column": "y", "encoding_method": "mean", "bins": 5}
    middle = spark.createDataFrame([(5.0, 1)], "x double, y int")
    with pytest.raises(Exception, match="no training data in the bin"):
        run(E.TargetEncode(), train, [rule], test=middle)[2].collect()
    assert column(run(E.TargetEncode(), train, [{**rule, "on_unseen": "null"}], test=middle)[2], "x") == [None]


def test_woe_and_information_value(spark):
    df = spark.createDataFrame([("a", 1)] * 6 + [("a", 0)] * 2 + [("b", 0)] * 9 + [("c", 1)] * 3 + [(None, 1)], "k string, y int")
    positives, negatives = 10, 11
    want = {"a": math.log(7 / positives / (3 / negatives)), "b": math.log(1 / positives / (10 / negatives)), "c": math.log(4 / positives / (1 / negatives))}
    done, learned = run(E.WoeEncode(), df, [{"column": "k", "type": "categorical", "target_column": "y"}])
    assert dict(learned["k"]["rows"]) == pytest.approx(want)
    iv = sum((p / positives - n / negatives) * want[k] for k, p, n in (("a", 7, 3), ("b", 1, 10), ("c", 4, 1)))
    assert learned["k"]["iv"] == round(iv, 3)
    row = E.information_value(df, ["k"], "y").first()
    assert row["iv"] == round(iv, 3) and row["band"] == "suspiciously informative"
    with pytest.raises(ValueError, match="both target classes"):
        run(E.WoeEncode(), df.filter("y = 1"), [{"column": "k", "type": "categorical", "target_column": "y"}])


@pytest.mark.parametrize("iv, band", [(0.01, "not informative"), (0.02, "poorly informative"), (0.1, "poorly informative"), (0.3, "informative"), (0.5, "informative"), (0.51, "suspiciously informative")])
def test_bands(iv, band):
    assert E.iv_band(iv) == band


def test_wrong_encoding_rules(spark):
    df, _ = frame(spark)
    with pytest.raises(ValueError, match="encoding_method"):
        run(E.TargetEncode(), df, [{"column": "k", "type": "categorical", "target_column": "y", "encoding_method": "max"}])
    with pytest.raises(ValueError, match="not found"):
        run(E.TargetEncode(), df, [{"column": "k", "type": "categorical", "target_column": "zzz", "encoding_method": "mean"}])
    assert run(E.TargetEncode(), df, [{}])[0].columns == df.columns
