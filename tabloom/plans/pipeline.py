"""Preparation pipelines described by one configuration: fit on train, replay anywhere."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.stats import column_stats
from tabloom.operators.encode import OneHot, Ordinal, TargetEncode, WoeEncode
from tabloom.operators.fill import FillNumeric, FillText, FillZero
from tabloom.operators.outliers import RemoveOutliers, ReplaceOutliers
from tabloom.operators.profile import correlation_matrix
from tabloom.operators.sample import Resample, split, split_exact
from tabloom.operators.transform import ConvertToNumber, Scale, Transform
from tabloom.operators.validate import check_ready, check_same_columns, keep_columns, order_columns
from tabloom.session import materialize, scratch_path, with_row_id
from tabloom.sources.state import PipelineState, StepState, save_state
from tabloom.sources.tables import read_table, write_split

STEPS = {s.kind: s for s in (
    FillZero(), FillNumeric(), FillText(), RemoveOutliers(), ReplaceOutliers(), ConvertToNumber(), OneHot(), Ordinal(),
    Transform(), TargetEncode(), WoeEncode(), Resample(), Scale(),
)}


def load_config(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def configured_steps(config):
    """(name, step, action) in order; an unknown step or kind is an error before any job runs."""
    actions = config["preprocessing"]["actions"]
    found = []
    for name in config["preprocessing"]["steps"]:
        if name not in actions:
            raise ValueError(f"step '{name}' has no action")
        kinds = list(actions[name])
        if len(kinds) != 1 or kinds[0] not in STEPS:
            raise ValueError(f"step '{name}': expected exactly one of {list(STEPS)}, found {kinds}")
        found.append((name, STEPS[kinds[0]], actions[name]))
    return found


def fit_pipeline(train: DataFrame, config: dict, full: DataFrame, written=False) -> tuple[DataFrame, PipelineState]:
    """Run the configured steps over ``train``, learning as they go. Returns the lazy result and what was learned.

    Statistics come from ``train``; one-hot categories and bin ranges from ``full``, which passes through the fill,
    outlier, cast and transform steps with statistics of its own. Both are written once, with the configured columns only,
    unless the caller has done so (``written``); every statistic reads these tables. Consecutive steps that ask for statistics
    of columns that no step among them has changed yet get them from one gathering.
    """
    steps = configured_steps(config)
    train, full = keep_columns(train, config["columns"]), keep_columns(full, config["columns"])
    later_full = last_full_use(steps)
    if not written:
        train = materialize(train, "train")
        full = materialize(full, "full") if later_full >= 0 else train
    rows = full.count()     # of a written table; bounds the rows of train and full at every later step but oversampling
    states, position = [], 0
    while position < len(steps):
        size, asked = gathered(steps[position:])
        batch = steps[position:position + size]
        known = column_stats(train, asked, rows) if asked else {}
        carried = [s for p, s in enumerate(batch, position) if s[1].carries_full and p < later_full]
        full_asked = merged(step.asks(action) or {} for _, step, action in carried) if size else {}
        full_known = column_stats(full, full_asked, rows) if full_asked else {}
        for name, step, action in batch or steps[position:position + 1]:
            train, learned = step.fit_apply(train, action, full, rows, known if size else None)
            if step.carries_full and position < later_full:
                full, _ = step.fit_apply(full, action, full, rows, full_known if size else None)
            if step.kind == Resample.kind:
                rows = 2 * rows
            states.append(StepState(name, step.kind, learned))
            position += 1
    state = PipelineState(tuple(states))
    return order_columns(train, config["columns"], state.one_hot()), state


def merged(requests) -> dict[str, list]:
    asked = {}
    for wants in requests:
        for c, names in wants.items():
            asked.setdefault(c, []).extend(n for n in names if n not in asked[c])
    return asked


def gathered(steps) -> tuple[int, dict[str, list]]:
    """How many of the next steps can learn from one gathering of statistics, and what they ask for together."""
    requests, changed = [], set()
    for _, step, action in steps:
        wants = step.asks(action)
        if wants is None or changed & set(wants):
            break
        requests.append(wants)
        changed |= step.changes(action)
    return len(requests), merged(requests)


FULL_READERS = (OneHot.kind, TargetEncode.kind, WoeEncode.kind)


def last_full_use(steps) -> int:
    """Position of the last step that reads the full data; after it, the full data need not be carried."""
    uses = [i for i, (_, step, _) in enumerate(steps) if step.kind in FULL_READERS]
    return uses[-1] if uses else -1


def apply_pipeline(df: DataFrame, config: dict, state: PipelineState, expect_target=True) -> DataFrame:
    """Replay a fitted pipeline as one lazy plan: no job runs, and a streaming DataFrame is as good as a table.

    ``expect_target=False`` serves scoring data without the label.
    """
    target = config.get("target_column")
    df = keep_columns(df, config["columns"], target, expect_target)
    for name, step, action in configured_steps(config):
        df = step.apply(df, action, state.step(name).learned)
    return order_columns(df, config["columns"], state.one_hot(), target, expect_target)


def split_configured(data: DataFrame, config: dict) -> tuple[DataFrame, DataFrame]:
    """Train and test by ``test_size``, ``random_state`` and ``key_columns``; without a key, rows are numbered first."""
    how = split_exact if config.get("exact_split") else split
    if config.get("key_columns"):
        return how(data, config["test_size"], config["key_columns"], config["random_state"])
    train, test = how(with_row_id(data), config["test_size"], ["__id"], config["random_state"])
    return train.drop("__id"), test.drop("__id")


def written_parts(data: DataFrame, config: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(full, train, test) with the configured columns, from one table that holds a folder for each part."""
    parts = split_configured(data, config)
    needed = keep_columns(data, config["columns"], config.get("target_column")).columns
    flagged = [keep_columns(p, needed).withColumn(PART, F.lit(number)) for number, p in enumerate(parts)]
    both = flagged[0].unionByName(flagged[1])
    path = scratch_path(data.sparkSession, "parts")
    both.write.partitionBy(PART).parquet(path)
    table = data.sparkSession.read.schema(both.schema).parquet(path)
    return (table.drop(PART), *[table.filter(F.col(PART) == number).drop(PART) for number in (0, 1)])


PART = "__part"


def prepare(spark: SparkSession, config: dict, data: DataFrame | str, output: str | None = None, delimiter=",",
            schema=None, file_format="parquet", check=True) -> dict:
    """Read, split, fit on train, replay on test, check, correlate and optionally write.

    The configured columns of both parts are written once, in a folder each, and all else reads these: nothing after the split
    reads the source. Prepared data is checked before anything is put out. Returns train, test, correlation, state and, with
    ``output``, the written paths.
    """
    configured_steps(config)
    if isinstance(data, str):
        text = not data.rstrip("/").endswith(".parquet")
        data = read_table(spark, data, delimiter, schema)
        data = materialize(data, "input") if text else data
    full, train, test = written_parts(data, config)
    train_ready, state = fit_pipeline(train, config, full, written=True)
    test_ready = apply_pipeline(test, config, state)
    check_same_columns(train_ready, test_ready)
    if check:
        check_ready(train_ready, test_ready)
    paths = {}
    if output:
        paths = write_split(train_ready, test_ready, output, config["tag"], file_format)
        if file_format == "parquet":
            train_ready, test_ready = spark.read.parquet(paths["train"]), spark.read.parquet(paths["test"])
        paths["state"] = save_state(spark, state, f"{output}/state_{config['tag']}")
    correlation = correlation_matrix(train_ready, config["target_column"], check)
    if output:
        correlation.write.parquet(f"{output}/correlation_{config['tag']}")
        paths["correlation"] = f"{output}/correlation_{config['tag']}"
    return {"train": train_ready, "test": test_ready, "correlation": correlation, "state": state, "paths": paths}
