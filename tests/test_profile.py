import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.functions import quantiles as Q
from tabloom.operators import profile as P
from tabloom.operators import validate as V
from tabloom.sources.tables import infer_types


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [(1, 2.0, "a", True), (1, 2.0, "a", True), (2, None, "b", False), (3, -1.0, None, None), (100, 0.0, "a", True)],
        "n int, x double, s string, b boolean")


def as_dict(df, key="column"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_shape_counts_duplicates_with_equal_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, 1), (None, None)], "a int, b int")
    row = P.table_shape(df).first()
    assert (row["n_columns"], row["n_rows"], row["n_duplicates"], row["duplicate_pct"]) == (2, 4, 1, 25.0)


def test_shape_of_empty_table(spark):
    row = P.table_shape(spark.createDataFrame([], "a int")).first()
    assert (row["n_rows"], row["n_duplicates"], row["duplicate_pct"]) == (0, 0, None)


def test_shape_reads_negative_zero_as_zero(spark):
    assert P.table_shape(spark.createDataFrame([(0.0,), (-0.0,)], "a double")).first()["n_duplicates"] == 1


def test_moments_match_pandas(spark):
    rng = np.random.default_rng(0)
    values = np.where(rng.random(500) < 0.1, np.nan, rng.gamma(2, 3, 500))
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    series = pd.Series(values)
    row = as_dict(P.numeric_summary(df))["x"]
    for name, want in (("mean", series.mean()), ("median", series.median()), ("q1", series.quantile(0.25)), ("q3", series.quantile(0.75)), ("std", series.std())):
        assert row[name] == pytest.approx(want)
    row = as_dict(P.dispersion_shape(df))["x"]
    assert row["kurtosis"] == pytest.approx(series.kurtosis())
    assert row["skewness"] == pytest.approx(series.skew())
    assert row["rmsd"] == pytest.approx(series.std(ddof=0))
    assert row["variation"] == pytest.approx(series.std() / series.mean())


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [1.0, 2.0, 4.0], [1.0, 2.0, 4.0, 9.0], [3.0] * 6, []])
def test_shape_statistics_of_few_values(spark, values):
    row = as_dict(P.dispersion_shape(spark.createDataFrame([(v,) for v in values], "x double")))["x"]
    skew, kurtosis = pd.Series(values, dtype="float64").skew(), pd.Series(values, dtype="float64").kurtosis()
    assert row["skewness"] is None if math.isnan(skew) else row["skewness"] == pytest.approx(skew)
    assert row["kurtosis"] is None if math.isnan(kurtosis) else row["kurtosis"] == pytest.approx(kurtosis)


def test_profile_row_per_column(spark, small):
    shape, columns = P.profile(small)
    assert shape.first()["n_duplicates"] == 1
    rows = as_dict(columns)
    assert list(rows) == ["n", "x", "s", "b"]
    assert rows["n"]["mode_num"] == 1.0 and rows["n"]["n_distinct"] == 4 and rows["n"]["mean"] == pytest.approx(21.4)
    assert rows["x"]["n_missing"] == 1 and rows["x"]["missing_pct"] == 20.0 and rows["x"]["n_zero"] == 1 and rows["x"]["n_negative"] == 1
    assert rows["x"]["n_distinct"] == 4
    assert rows["s"]["mode_str"] == "a" and rows["s"]["mean"] is None
    assert [(v["v_str"], v["n"], v["pct"]) for v in rows["s"]["distribution"]] == [("a", 3, 60.0), (None, 1, 20.0), ("b", 1, 20.0)]
    assert rows["b"]["type"] == "boolean" and rows["b"]["mean"] is None and rows["b"]["mode_str"] == "true"


def test_profile_threshold_turns_distribution_into_example(spark, small):
    rows = as_dict(P.profile(small, threshold=2)[1])
    assert rows["n"]["distribution"] is None and rows["n"]["example_num"] == 1.0
    assert rows["s"]["example_str"] == "a"


def test_profile_of_empty_table(spark, small):
    shape, columns = P.profile(small.limit(0))
    assert shape.first()["n_rows"] == 0
    assert as_dict(columns)["x"]["mean"] is None and as_dict(columns)["x"]["iqr_outliers"] == 0


def test_profile_takes_four_actions_for_any_width(spark, actions):
    for width in (2, 12):
        df = spark.range(50).select(*[(F.col("id") * i % 7).alias(f"c{i}") for i in range(width)])
        with actions() as seen:
            P.profile(df)
        assert seen.count == 4


def test_profile_takes_more_rounds_for_many_values(spark, monkeypatch):
    monkeypatch.setattr(Q, "GROUPS", 100)
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3).alias("k"))
    rows = as_dict(P.profile(df)[1])
    assert (rows["x"]["q1"], rows["x"]["median"], rows["x"]["q3"]) == (250.75, 500.5, 750.25)
    assert rows["k"]["median"] == 1.0


def test_outlier_counts_are_strict(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 8, 8.0001, -2, -2.5]], "x double")
    series = pd.Series([1, 2, 3, 4, 5, 8, 8.0001, -2, -2.5])
    q1, q3 = series.quantile(0.25), series.quantile(0.75)
    low, high = q1 - 0.5 * (q3 - q1), q3 + 0.5 * (q3 - q1)
    row = as_dict(P.fence_outlier_counts(df, k=0.5))["x"]
    assert (row["n_below"], row["n_above"]) == ((series < low).sum(), (series > high).sum())


def test_constant_and_missing_columns(spark):
    df = spark.createDataFrame([(1, None, 1, "x"), (1, None, None, "y")], "one int, nothing int, part int, s string")
    assert {r["column"]: r["is_constant"] for r in V.constant_columns(df).collect()} == {"one": True, "nothing": True, "part": False, "s": False}
    found = as_dict(V.missing_and_non_numeric(df))
    assert found["nothing"]["n_missing"] == 2 and not found["s"]["is_numeric"]
    with pytest.raises(ValueError, match="non-numeric"):
        V.check_ready(df)


def test_non_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "x double")
    assert V.non_finite(df).first()["n_non_finite"] == 4


def test_correlation_matches_pandas_and_refuses_bad_input(spark):
    rng = np.random.default_rng(2)
    data = pd.DataFrame(rng.normal(size=(200, 3)), columns=["a", "b", "c"]).assign(y=1)
    got = {(r["row"], r["col"]): r["r"] for r in P.correlation_matrix(spark.createDataFrame(data), "y").collect()}
    want = data[["a", "b", "c"]].corr()
    assert len(got) == 9
    for (a, b), r in got.items():
        assert r == pytest.approx(want.loc[a, b])
    with pytest.raises(ValueError, match="constant"):
        P.correlation_matrix(spark.createDataFrame(data.assign(d=3.0)), "y")
    with pytest.raises(ValueError, match="missing"):
        P.correlation_matrix(spark.createDataFrame(data.assign(d=np.where(data["a"] > 0, np.nan, 1.0))), "y")


def test_class_ratio_needs_two_classes(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert V.class_ratio(df, "y").first()["ratio"] == 3.0
    with pytest.raises(Exception, match="exactly 2 classes"):
        V.class_ratio(df.filter("y = 0"), "y").collect()


def test_keep_and_order_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, y int")
    columns = ["b", "a", "y"]
    assert V.keep_columns(df, columns).columns == ["b", "a", "y"]
    assert V.keep_columns(df.drop("y"), columns, "y", expect_target=False).columns == ["b", "a"]
    assert columns == ["b", "a", "y"]
    with pytest.raises(ValueError, match="not found"):
        V.keep_columns(df, ["zzz"])
    ordered = V.order_columns(df.withColumn("c_u", F.lit(1)).withColumn("c_extra", F.lit(1)), ["y", "c", "a"], {"c": {"values": ["t", "u", "v"], "dropped": "v"}})
    assert ordered.columns == ["y", "a", "c_t", "c_u"] and ordered.first()["c_t"] is None


def test_cast_numeric_strict_and_lenient(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", None)], "i string, f string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|malformed"):
        V.cast_numeric(df, {"i": "int"}).collect()
    assert [r["i"] for r in V.cast_numeric(df, {"i": "int"}, lenient=True).collect()] == [1, None]
    with pytest.raises(Exception, match="cannot become an int"):
        V.cast_numeric(df.withColumn("i", F.lit(None).cast("string")), {"i": "int"}).collect()
    with pytest.raises(ValueError, match="to_type"):
        V.cast_numeric(df, {"i": "text"})


def test_columns_of_an_empty_table_have_rows(spark):
    none = spark.createDataFrame([], "a bigint, b string")
    assert sorted(tuple(r) for r in P.mode(none).collect()) == [("a", None, None, None), ("b", None, None, None)]
    assert sorted(tuple(r) for r in P.distinct_count(none).collect()) == [("a", 0), ("b", 0)]
    assert sorted(tuple(r) for r in P.distinct_count(none, approx=True).collect()) == [("a", 0), ("b", 0)]
    assert P.value_distribution(none).collect() == []
    assert [tuple(r) for r in P.whole_number_profile(none).collect()] == [("a", 0, None, None, None, None)]


def test_whole_numbers_beyond_doubles(spark):
    low, high = -(2 ** 63), 2 ** 63 - 1
    rows = [(low,), (high,), (high,), (2 ** 53 + 1,), (2 ** 53,), (None,)]
    found = spark.createDataFrame(rows, "a bigint")
    assert tuple(P.mode(found, whole=True).first())[:2] == ("a", high)
    r = P.whole_number_profile(found).first()
    assert (r.n, r.min, r.max, int(r.range), int(r.sum)) == (5, low, high, high - low, sum(v for v, in rows if v is not None))
    assert P.example_value(found, threshold=1, whole=True).first().lo_long == low
    assert {(r.v_long, r.n) for r in P.value_distribution(found, whole=True).collect()} == {(low, 1), (high, 2), (2 ** 53 + 1, 1), (2 ** 53, 1), (None, 1)}
    tied = spark.createDataFrame([(2 ** 53 + 1,), (2 ** 53,)], "a bigint")
    assert P.mode(tied, whole=True).first().mode_long == 2 ** 53
    with pytest.raises(ValueError):
        P.whole_number_profile(spark.createDataFrame([(1.5,)], "x double"), ["x"])


def test_inference_takes_no_java_suffixes(spark):
    raw = spark.createDataFrame([("1d", "1.5", " 2e3 ", "inf", "1.", "7"), ("3D", ".5", "-1E-2", "NaN", "2", "8")], "a string, b string, c string, d string, e string, f string")
    assert {c: t.simpleString() for c, t in infer_types(raw).items()} == {"a": "string", "b": "double", "c": "double", "d": "double", "e": "double", "f": "bigint"}
