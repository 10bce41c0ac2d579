import pytest
from pyspark.sql import functions as F

from tabloom.operators import sample as S


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1000).withColumn("y", (F.col("id") % 7 == 0).cast("int"))


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("how", [S.split, S.split_exact])
def test_split_is_disjoint_covering_and_independent_of_partitioning(rows, how):
    train, test = how(rows, 0.3, ["id"], 42)
    assert sorted(ids(train) + ids(test)) == list(range(1000))
    for partitions in (1, 7, 64):
        assert ids(how(rows.repartition(partitions), 0.3, ["id"], 42)[1]) == ids(test)
    assert ids(how(rows, 0.3, ["id"], 43)[1]) != ids(test)


@pytest.mark.parametrize("size, want", [(0.3, 300), (0.2999, 300), (0.0001, 1), (0.0, 0), (1.0, 1000)])
def test_exact_split_size_rounds_up(rows, size, want):
    train, test = S.split_exact(rows, size, ["id"])
    assert test.count() == want and train.count() == 1000 - want


def test_oversample_balances_and_keeps_every_row(rows):
    done = S.oversample(rows, "y", ["id"], 1)
    counts = {r["y"]: r["count"] for r in done.groupBy("y").count().collect()}
    assert counts[0] == counts[1] == 857
    copies = [r["count"] for r in done.filter("y = 1").groupBy("id").count().collect()]
    assert len(copies) == 143 and max(copies) - min(copies) <= 1
    assert done.filter("y = 0").distinct().count() == 857


def test_undersample_balances_without_repeating(rows):
    done = S.undersample(rows, "y", ["id"], 1)
    assert {r["y"]: r["count"] for r in done.groupBy("y").count().collect()} == {0: 143, 1: 143}
    assert done.distinct().count() == 286
    assert ids(S.undersample(rows.repartition(13), "y", ["id"], 1)) == ids(done)


def test_balanced_input_stays(spark):
    df = spark.createDataFrame([(1, 0), (2, 1)], "id int, y int")
    assert ids(S.oversample(df, "y", ["id"])) == ids(S.undersample(df, "y", ["id"])) == [1, 2]
    with pytest.raises(ValueError, match="exactly 2 classes"):
        S.oversample(df.filter("y = 0"), "y", ["id"])


def test_folds_are_balanced_per_class(rows):
    folded = S.stratified_folds(rows, "y", ["id"], 5, 3)
    assert folded.count() == 1000
    counts = {}
    for r in folded.groupBy("y", "fold").count().collect():
        counts.setdefault(r["y"], []).append(r["count"])
    for sizes in counts.values():
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    with pytest.raises(ValueError, match="fewer than"):
        S.stratified_folds(rows, "y", ["id"], 200)


def test_resampling_step_without_key(spark):
    df = spark.createDataFrame([(1.0, 0)] * 30 + [(1.0, 1)] * 4, "x double, y int")
    step = S.Resample()
    rule = {"target_column": "y", "resampling_method": "oversample", "random_state": 1}
    done, _ = step.fit_apply(df, {"resampling": rule})
    assert {r["y"]: r["count"] for r in done.groupBy("y").count().collect()} == {0: 30, 1: 30}
    assert done.columns == df.columns and step.apply(df, {"resampling": rule}, {}) is df
    with pytest.raises(ValueError, match="resampling_method"):
        step.fit_apply(df, {"resampling": {**rule, "resampling_method": "none"}})
