"""Distributed statistics: exactness, bounds, independence of partitioning."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabloom.functions import quantiles as Q
from tabloom.functions import ranks as R
from tabloom.functions.expressions import bin_index, hash_share, row_hash
from tabloom.functions.frequencies import modes, value_counts
from tabloom.functions.running import range_edges, running_sums

FRACTIONS = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.75, 0.999, 1.0]


def check_quantiles(df, values, **bounds):
    got = Q.exact_quantiles(df, {"x": FRACTIONS}, **bounds)["x"]
    for p in FRACTIONS:
        assert got[p] == pytest.approx(pd.Series(values).quantile(p), rel=1e-12, abs=1e-12)


@pytest.fixture
def tight(monkeypatch):
    """Small bounds, so that small data takes the path of large data."""
    monkeypatch.setattr(Q, "GROUPS", 10)
    monkeypatch.setattr(R, "FETCH_BOUND", 2)


@pytest.mark.parametrize("kind", ["uniform", "heavy", "constant", "tiny", "two", "wide", "signs"])
def test_quantiles_of_many_rounds_are_exact(spark, tight, kind):
    rng = np.random.default_rng(1)
    values = {
        "uniform": rng.random(5000), "heavy": np.where(rng.random(5000) < 0.4, 7.0, rng.normal(size=5000) * 100),
        "constant": np.full(3000, 2.5), "tiny": np.array([4.0]), "two": np.array([1.0] * 700 + [2.0] * 1300),
        "wide": np.exp(rng.normal(size=4000) * 20), "signs": np.concatenate([-np.exp(rng.normal(size=900) * 9), np.zeros(300), rng.random(900) * 1e-300]),
    }[kind]
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(5)
    check_quantiles(df, values)
    check_quantiles(df, values, rows=10**9)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0, 1.0])), min_size=1, max_size=120))
def test_one_round_and_many_rounds_agree(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    counted = Q.exact_quantiles(df, {"x": FRACTIONS}, rows=len(values))["x"]
    check_quantiles(df, values, rows=len(values))
    old, Q.GROUPS = Q.GROUPS, 8
    try:
        assert Q.exact_quantiles(df, {"x": FRACTIONS})["x"] == counted
    finally:
        Q.GROUPS = old


def test_keys_are_in_the_order_of_the_values(spark):
    """Every power of two and its neighbours, of either sign, to the least and the greatest double."""
    powers = 2.0 ** np.arange(-1074, 1024)
    values = np.concatenate([powers, np.nextafter(powers, 0), np.nextafter(powers, np.inf), [0.0, np.inf], np.random.default_rng(2).normal(size=500)])
    values = np.concatenate([values, -values])
    keys = Q.keyed_numbers(spark.createDataFrame([(float(v),) for v in values], "x double"), ["x"]).toArrow().column("key").to_numpy()
    assert (keys == np.abs(values).view(np.int64) * np.where(values < 0, -1, 1)).all()
    assert (Q.values_of(keys) == values).all()


@pytest.mark.parametrize("groups", [4, 1 << 20])
def test_infinite_values_take_their_places(spark, monkeypatch, groups):
    monkeypatch.setattr(Q, "GROUPS", groups)
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in [-inf, 1.0, 2.0, 3.0, inf, inf, inf]], "x double")
    for rows in (None, 7):
        assert Q.exact_quantiles(df, {"x": [0, 1 / 6, 0.25, 0.5, 4 / 6, 1]}, rows)["x"] == {0.0: -inf, 1 / 6: 1.0, 0.25: 1.5, 0.5: 3.0, 4 / 6: inf, 1.0: inf}


def test_many_columns_and_fractions_in_few_rounds(spark, actions):
    """A thousand ranks of each of five columns: as many groups are counted as one round allows, and no plan deals by the column alone."""
    df = spark.range(200_000).select(*[(F.xxhash64(F.col("id") + i) / 2.0 ** 40).alias(f"c{i}") for i in range(5)])
    wanted = {f"c{i}": [k / 1000 for k in range(1001)] for i in range(5)}
    with actions() as seen:
        found = Q.exact_quantiles(df, wanted)
    assert seen.count <= 4
    frame = df.toPandas()
    for c, values in found.items():
        assert np.allclose([values[p] for p in wanted[c]], frame[c].quantile(wanted[c]), rtol=1e-12)
    plan = Q.Descent(Q.keyed_numbers(df, list(wanted)), list(wanted.values()), 16).first_round()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(slot#" in plan and ", part#" in plan.split("hashpartitioning(slot#", 1)[1][:30]


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert Q.exact_quantiles(df, {"x": [0.5]}) == {"x": {0.5: None}}
    assert Q.exact_quantiles(df.limit(0), {"x": [0.5]}, rows=0) == {"x": {0.5: None}}
    assert Q.exact_quantiles(df.crossJoin(spark.createDataFrame([(1.0,), (4.0,)], "y double")), {"x": [0.5], "y": [0.5]}) == {"x": {0.5: None}, "y": {0.5: 2.5}}


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert Q.exact_quantiles(df, {"x": [0.5]})["x"][0.5] == 2.0


def test_mode_takes_smallest_on_ties_and_keeps_large_integers(spark):
    big = 2**53
    df = spark.createDataFrame([(2, "b", big + 1), (2, "a", big + 1), (10, "b", big), (10, "a", None), (3, None, None)],
                               "n int, s string, b bigint")
    assert modes(df, ["n", "s", "b"]) == {"n": 2, "s": "a", "b": big + 1}
    assert value_counts(df, ["b"]).filter("v_long is not null").count() == 2


def test_mode_of_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)], "a string, b double")
    assert modes(df, ["a", "b"]) == {"a": None, "b": 1.0}


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_cuts_hit_exact_ranks(spark, tight, partitions):
    df = spark.range(3000).withColumn("g", (F.col("id") % 3 == 0).cast("int")).repartition(partitions)
    h = row_hash(["id"], 5)
    cuts, sizes = R.hash_cuts(df, h, F.col("g"), lambda n: {g: [1, k // 2, k - 1, k] for g, k in n.items()})
    assert sizes == {0: 2000, 1: 1000}
    for g, by_rank in cuts.items():
        for rank, cut in by_rank.items():
            assert df.filter((F.col("g") == g) & (h <= cut)).count() == rank
    assert cuts[0][1000] == R.hash_cuts(spark.range(3000).withColumn("g", (F.col("id") % 3 == 0).cast("int")), h, F.col("g"),
                                        lambda n: {0: [1000]})[0][0][1000]


def test_cut_inside_equal_keys_is_refused(spark, tight):
    df = spark.createDataFrame([(1,)] * 20, "id int")
    with pytest.raises(ValueError, match="do not identify"):
        R.hash_cuts(df, row_hash(["id"]), F.lit(0), lambda n: {0: [7]})


def test_hash_share_is_uniform(spark):
    share = spark.range(20000).select(hash_share(["id"], 3).alias("h"))
    row = share.agg(F.avg("h").alias("m"), F.min("h").alias("lo"), F.max("h").alias("hi"), F.avg((F.col("h") < 0.2).cast("int")).alias("p")).first()
    assert abs(row["m"] - 0.5) < 0.02 and 0 <= row["lo"] < 0.01 and 0.99 < row["hi"] < 1 and abs(row["p"] - 0.2) < 0.02


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_running_sums_over_ranges(spark, partitions):
    rng = np.random.default_rng(3)
    scores = np.unique(np.round(np.where(rng.random(900) < 0.4, rng.normal(0.5, 0.001, 900), rng.random(900)), 5))
    data = pd.DataFrame({"g": ["a", "b"] * (len(scores) // 2), "s": scores[:len(scores) // 2 * 2], "n": rng.integers(1, 9, len(scores) // 2 * 2)})
    df = spark.createDataFrame(data).repartition(partitions)
    edges = range_edges(df, "s", 12)
    got = running_sums(df, ["g"], "s", {"above": "n"}, edges).toPandas().sort_values("s")
    want = data.sort_values("s", ascending=False).assign(above=lambda d: d.groupby("g")["n"].cumsum()).sort_values("s")
    assert got["above"].tolist() == want["above"].tolist()


def test_bin_index_is_right_closed_and_includes_lowest(spark):
    edges = [0.0, 1.0, 2.5, 10.0]
    df = spark.createDataFrame([(v,) for v in (-0.1, 0.0, 0.5, 1.0, 1.0001, 2.5, 10.0, 10.1, None)], "x double")
    got = [r[0] for r in df.select(bin_index("x", edges)).collect()]
    assert got == [None, 0, 0, 0, 1, 1, 2, None, None]
    many = [float(i) for i in range(100)]
    numbers = spark.range(1000).select((F.col("id") / 10).alias("x"))
    got = numbers.select("x", bin_index("x", many).alias("b")).toPandas()
    want = pd.cut(got["x"], many, labels=False, include_lowest=True)
    assert (got["b"].fillna(-1) == want.fillna(-1)).all()


def test_interpolation_keeps_equal_neighbours():
    assert Q.interpolate(2.3, 0.1, 0.1) == 0.1
    assert math.isclose(Q.interpolate(1.25, 10.0, 20.0), 12.5)
