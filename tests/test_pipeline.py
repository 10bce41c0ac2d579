import copy

import pytest
from pyspark.sql import functions as F

from tabloom.plans.pipeline import apply_pipeline, configured_steps, fit_pipeline, prepare
from tabloom.operators.sample import split
from tabloom.session import scratch_path
from tabloom.sources.state import PipelineState, load_state, path_exists, save_state
from tabloom.sources.tables import read_table, write_table
from tabloom.streaming.scoring import apply_to_stream, read_stream

CONFIG = {
    "tag": "visits", "columns": ["booked", "minutes", "pages", "spend", "device", "branch"],
    "target_column": "booked", "test_size": 0.25, "random_state": 9,
    "preprocessing": {
        "steps": ["device_text", "wild_spend", "short_visits", "branches", "page_woe", "device_share", "same_scale"],
        "actions": {
            "device_text": {"filling_missing_text_values": [{"column": "device", "fill_missing_values_method": "mode"}]},
            "wild_spend": {"replacing_outliers": [{"column": "spend", "search_method": "iqr", "replacement_method": "median"}]},
            "short_visits": {"filling_missing_numeric_values_with_stats_method": [{"column": "minutes", "fill_missing_values_method": "mean"}]},
            "branches": {"one_hot_encoding": [{"column": "branch", "drop_first": False}]},
            "page_woe": {"woe_encoding": [{"column": "pages", "type": "continuous", "target_column": "booked", "bins": 3}]},
            "device_share": {"target_encoding": [{"column": "device", "type": "categorical", "target_column": "booked", "encoding_method": "mean"}]},
            "same_scale": {"scaling": {"scaler_type": "standard", "columns": ["spend", "minutes"]}},
        },
    },
}
ALL_KINDS = {
    "columns": ["y", "a", "b", "c", "s", "t"], "target_column": "y", "preprocessing": {
        "steps": ["zero", "num", "more", "text", "replace", "remove", "convert", "hot", "ord", "trans", "again", "target", "woe", "res", "scale"],
        "actions": {
            "zero": {"filling_missing_numeric_values_with_zeroes": ["c"]},
            "num": {"filling_missing_numeric_values_with_stats_method": [{"column": "a", "fill_missing_values_method": "mean"}]},
            "more": {"filling_missing_numeric_values_with_stats_method": [{"column": "b", "fill_missing_values_method": "median"}]},
            "text": {"filling_missing_text_values": [{"column": "s", "fill_missing_values_method": "mode"}]},
            "replace": {"replacing_outliers": [{"column": "a", "search_method": "iqr", "replacement_method": "median"}]},
            "remove": {"removing_outliers": [{"column": "b", "search_method": "tukey_fences"}]},
            "convert": {"converting_to_number": [{"column": "c", "to_type": "float"}]},
            "hot": {"one_hot_encoding": [{"column": "t", "drop_first": False}]},
            "ord": {"ordinal_encoding": []},
            "trans": {"transformation": [{"column": "a", "transformation_method": "log"}]},
            "again": {"transformation": [{"column": "b", "transformation_method": "sqrt"}]},
            "target": {"target_encoding": [{"column": "s", "type": "categorical", "target_column": "y", "encoding_method": "mean"}]},
            "woe": {"woe_encoding": [{"column": "b", "type": "continuous", "target_column": "y", "bins": 4}]},
            "res": {"resampling": {"target_column": "y", "resampling_method": "oversample", "random_state": 3}},
            "scale": {"scaling": {"scaler_type": "robust", "columns": ["a", "c"]}},
        }}}


@pytest.fixture(scope="module")
def mixed(spark):
    i = F.col("id")
    return spark.range(600).select(
        "id", (i % 3 == 0).cast("int").alias("y"), F.when(i % 10 != 0, (i * 7 % 50).cast("double")).alias("a"),
        F.when(i % 9 != 0, (i * 13 % 40).cast("double")).alias("b"), F.when(i % 8 != 0, i % 5).cast("int").alias("c"),
        F.when(i % 7 != 0, F.element_at(F.array(F.lit("u"), F.lit("v"), F.lit("w")), (i % 3 + 1).cast("int"))).alias("s"),
        F.element_at(F.array(F.lit("p"), F.lit("q")), (i % 2 + 1).cast("int")).alias("t"))


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_example_chain_end_to_end(spark, visits):
    out = scratch_path(spark, "out")
    done = prepare(spark, CONFIG, visits, output=out)
    train, test = done["train"], done["test"]
    features = ["minutes", "pages", "spend", "device", "branch_north", "branch_south", "branch_west"]
    assert sorted(train.columns) == sorted(["booked", *features]) and train.columns == test.columns
    assert train.count() + test.count() == 400
    row = train.agg(F.avg("spend").alias("m"), F.stddev_pop("spend").alias("s")).first()
    assert abs(row["m"]) < 1e-9 and row["s"] == pytest.approx(1.0)
    assert done["correlation"].count() == len(features) ** 2
    again = spark.read.parquet(done["paths"]["test"])
    assert rows(again) == rows(test)
    replay = apply_pipeline(visits.drop("booked"), CONFIG, load_state(spark, done["paths"]["state"]), expect_target=False)
    assert "booked" not in replay.columns and replay.count() == 400


def test_text_input_gives_the_same_result(spark, visits):
    path = write_table(visits.drop("id"), scratch_path(spark, "in") + ".csv")
    config = {**CONFIG, "key_columns": None}
    done = prepare(spark, config, path, check=True)
    assert done["train"].count() + done["test"].count() == 400


def test_all_kinds_fit_equals_apply(spark, mixed):
    config = copy.deepcopy(ALL_KINDS)
    config["preprocessing"]["steps"].remove("res")
    fitted, state = fit_pipeline(mixed, config, mixed)
    assert rows(apply_pipeline(mixed, config, state)) == rows(fitted)
    assert len(state.steps) == 14


def test_resampling_only_on_train(spark, mixed):
    fitted, state = fit_pipeline(mixed, ALL_KINDS, mixed)
    counts = {r["y"]: r["count"] for r in fitted.groupBy("y").count().collect()}
    assert counts[0] == counts[1]
    replay = apply_pipeline(mixed, ALL_KINDS, state)
    assert replay.count() == mixed.filter("b is not null or true").count()


def test_state_survives_json_and_disk(spark, mixed):
    _, state = fit_pipeline(mixed, ALL_KINDS, mixed)
    back = PipelineState.from_json(state.to_json())
    assert back == state
    path = save_state(spark, state, scratch_path(spark, "state"))
    assert rows(apply_pipeline(mixed, ALL_KINDS, load_state(spark, path))) == rows(apply_pipeline(mixed, ALL_KINDS, state))
    assert load_state(spark, path + "-absent", missing_ok=True) is None
    with pytest.raises(FileNotFoundError):
        load_state(spark, path + "-absent")


def test_large_map_is_saved_with_the_state(spark, mixed, monkeypatch):
    from tabloom.operators import encode
    monkeypatch.setattr(encode, "INLINE_ROWS", 1)
    config = copy.deepcopy(ALL_KINDS)
    config["preprocessing"]["steps"].remove("res")
    fitted, state = fit_pipeline(mixed, config, mixed)
    path = save_state(spark, state, scratch_path(spark, "state"))
    back = load_state(spark, path)
    assert back.step("target").learned["s"]["table"].startswith(path)
    assert rows(apply_pipeline(mixed, config, back)) == rows(fitted)


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_result_does_not_depend_on_partitioning(spark, mixed, partitions):
    config = copy.deepcopy(ALL_KINDS)
    config["preprocessing"]["steps"].remove("res")
    assert rows(fit_pipeline(mixed.repartition(partitions), config, mixed.repartition(partitions))[0]) == rows(fit_pipeline(mixed, config, mixed)[0])


def test_apply_starts_no_action(spark, mixed, actions):
    _, state = fit_pipeline(mixed, ALL_KINDS, mixed)
    with actions() as seen:
        apply_pipeline(mixed, ALL_KINDS, state)
    assert seen.count == 0


def test_single_steps_take_one_action(spark, mixed, actions):
    for kind, rule in (("filling_missing_numeric_values_with_stats_method", [{"column": c, "fill_missing_values_method": "median"} for c in "ab"]),
                       ("scaling", {"scaler_type": "robust", "columns": ["a", "b", "c"]}),
                       ("replacing_outliers", [{"column": c, "search_method": "iqr", "replacement_method": "mean"} for c in "ab"])):
        from tabloom.plans.pipeline import STEPS
        with actions() as seen:
            STEPS[kind].fit(mixed, {kind: rule}, mixed, rows=600)
        assert seen.count == 1, kind


def test_two_steps_of_one_kind_keep_their_own_state(spark, mixed):
    _, state = fit_pipeline(mixed, ALL_KINDS, mixed)
    assert set(state.step("num").learned) == {"a"} and set(state.step("more").learned) == {"b"}


def test_bin_range_comes_from_full_data(spark):
    full = spark.createDataFrame([(float(i), i % 2) for i in range(100)], "x double, y int")
    config = {"columns": ["x", "y"], "target_column": "y", "preprocessing": {"steps": ["w"], "actions": {
        "w": {"woe_encoding": [{"column": "x", "type": "continuous", "target_column": "y", "binning_method": "equal_size", "quantiles": 4}]}}}}
    _, state = fit_pipeline(full.filter("x between 10 and 80"), config, full)
    edges = state.step("w").learned["x"]["bins"]
    assert (edges[0], edges[-1]) == (0.0, 99.0)


def test_stream_equals_batch(spark, mixed):
    train, test = split(mixed, 0.4, ["id"], 1)
    _, state = fit_pipeline(train, ALL_KINDS, mixed)
    arriving, out = scratch_path(spark, "arriving"), scratch_path(spark, "out")
    test.repartition(5).write.parquet(arriving)
    stream = read_stream(spark, arriving, test.schema, files_per_trigger=2)
    query = apply_to_stream(stream, ALL_KINDS, state, out, scratch_path(spark, "log"))
    query.awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(apply_pipeline(test, ALL_KINDS, state))


def test_config_errors_come_before_any_job(spark, mixed, actions):
    for steps, acts in ((["x"], {}), (["x"], {"x": {"unknown": []}}), (["x"], {"x": {}})):
        with actions() as seen, pytest.raises(ValueError):
            fit_pipeline(mixed, {"columns": ["a"], "preprocessing": {"steps": steps, "actions": acts}}, mixed)
        assert seen.count == 0


def test_read_table_types_tokens_and_delimiter(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('i;f;s;b;e\n1;2.5;"a;b";true;\n2;NaN;NA;false;\n;null;"say ""x""";TRUE;NA\n', encoding="utf-8")
    df = read_table(spark, str(path), ";")
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "double", "string", "boolean", "double"]
    got = [tuple(r) for r in df.collect()]
    assert got == [(1, 2.5, "a;b", True, None), (2, None, None, False, None), (None, None, 'say "x"', True, None)]


FUSED = {"columns": ["a", "b", "c", "s", "y"], "target_column": "y", "preprocessing": {
    "steps": ["fill", "text", "cap", "log", "scale", "late"], "actions": {
        "fill": {"filling_missing_numeric_values_with_stats_method": [{"column": "a", "fill_missing_values_method": "median"}]},
        "text": {"filling_missing_text_values": [{"column": "s", "fill_missing_values_method": "placeholder", "placeholder": "x"}]},
        "cap": {"replacing_outliers": [{"column": "b", "search_method": "iqr", "replacement_method": "clip"}]},
        "log": {"transformation": [{"column": "b", "transformation_method": "log"}]},
        "scale": {"scaling": {"scaler_type": "robust", "columns": ["c"]}},
        "late": {"scaling": {"scaler_type": "standard", "columns": ["a"]}}}}}


def test_consecutive_steps_learn_from_one_gathering(spark, mixed, actions):
    """Six steps take two gatherings, as the last one asks for a column that the first has filled; results are those of single steps."""
    with actions() as seen:
        fitted, state = fit_pipeline(mixed, FUSED, mixed)
    assert seen.count == 4       # written, counted, gathered twice
    apart = mixed.select(*FUSED["columns"])
    for name, step, action in configured_steps(FUSED):
        apart, learned = step.fit_apply(apart, action, apart, 600)
        assert learned == state.step(name).learned
    assert rows(apart) == rows(fitted)


def test_nothing_after_the_split_reads_the_source(spark, visits, actions):
    source = scratch_path(spark, "the-source") + ".parquet"
    visits.write.parquet(source)
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark._jsparkSession.sharedState().statusStore()
    with actions() as seen:
        prepare(spark, CONFIG, source, output=scratch_path(spark, "out"))
    bus.waitUntilEmpty()
    listed = store.executionsList()
    plans = [listed.apply(i).physicalPlanDescription() for i in range(listed.size() - seen.count, listed.size())]
    assert sum("the-source" in plan for plan in plans) == 1
    assert seen.count <= 20


def test_unready_data_is_not_put_out(spark, visits):
    out = scratch_path(spark, "unready")
    config = copy.deepcopy(CONFIG)
    config["preprocessing"]["steps"] = config["preprocessing"]["steps"][1:]
    with pytest.raises(ValueError):
        prepare(spark, config, visits, output=out)
    assert not path_exists(spark, out)
