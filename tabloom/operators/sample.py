"""Splitting, resampling and folds by a hash of the row's key: same rows for any partitioning, without sorting."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import col, hash_share, require_columns, row_hash
from tabloom.functions.ranks import hash_cuts
from tabloom.operators.steps import Step
from tabloom.session import with_row_id


def split(df: DataFrame, test_size: float, key_cols, seed=0) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, covering, each row by its own hash; about ``test_size`` of the rows are test rows."""
    require_columns(df, key_cols)
    is_test = hash_share(key_cols, seed) < F.lit(float(test_size))
    return df.filter(~is_test), df.filter(is_test)


def split_exact(df: DataFrame, test_size: float, key_cols, seed=0) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ceil(rows * test_size) test rows: those of the lowest hashes."""
    require_columns(df, key_cols)

    def ranks(sizes):
        return {g: [k] for g, n in sizes.items() if 0 < (k := math.ceil(n * test_size)) < n}

    h = row_hash(key_cols, seed)
    cuts, sizes = hash_cuts(df, h, F.lit(0), ranks)
    if not cuts:
        everything = sizes and math.ceil(sizes[0] * test_size) > 0
        return (df.filter(F.lit(False)), df) if everything else (df, df.filter(F.lit(False)))
    is_test = h <= F.lit(next(iter(cuts[0].values())))
    return df.filter(~is_test), df.filter(is_test)


def two_classes(sizes):
    sizes = {g: n for g, n in sizes.items() if g is not None}
    if len(sizes) != 2:
        raise ValueError(f"expected exactly 2 classes, found {sorted(sizes, key=str)}")
    minority, majority = sorted(sizes, key=lambda g: (sizes[g], str(g)))
    return minority, majority, sizes[minority], sizes[majority]


def oversample(df: DataFrame, target, key_cols, seed=0) -> DataFrame:
    """Repeat minority rows until the classes are equal.

    Every minority row is repeated floor(missing / n) times, and those of the lowest hashes once more. The number of
    copies is a literal expression per row, so nothing is shuffled.
    """
    require_columns(df, [target, *key_cols])
    h = row_hash(key_cols, seed)
    state = {}

    def ranks(sizes):
        minority, _, n, m = two_classes(sizes)
        state.update(minority=minority, each=(m - n) // n, rest=(m - n) % n)
        return {minority: [state["rest"]]} if state["rest"] else {}

    cuts, _ = hash_cuts(df, h, col(target), ranks)
    copies = F.lit(state["each"])
    if state["rest"]:
        copies = copies + F.when(h <= F.lit(cuts[state["minority"]][state["rest"]]), 1).otherwise(0)
    times = F.when(col(target) == F.lit(state["minority"]), copies).otherwise(F.lit(0))
    return df.filter(col(target).isNotNull()).withColumn("__copy", F.explode(F.sequence(F.lit(0), times))).drop("__copy")


def undersample(df: DataFrame, target, key_cols, seed=0) -> DataFrame:
    """Keep the whole minority and as many majority rows, those of the lowest hashes."""
    require_columns(df, [target, *key_cols])
    h = row_hash(key_cols, seed)
    state = {}

    def ranks(sizes):
        minority, majority, n, m = two_classes(sizes)
        state.update(minority=minority, majority=majority, n=n, equal=n == m)
        return {} if state["equal"] else {majority: [n]}

    cuts, _ = hash_cuts(df, h, col(target), ranks)
    if state["equal"]:
        return df.filter(col(target).isNotNull())
    cut = cuts[state["majority"]][state["n"]]
    return df.filter((col(target) == F.lit(state["minority"])) | ((col(target) == F.lit(state["majority"])) & (h <= F.lit(cut))))


def stratified_folds(df: DataFrame, target, key_cols, k: int, seed=0, name="fold") -> DataFrame:
    """Add a fold number 0..k-1: shuffled, and in every class the folds differ by at most one row.

    The k - 1 hashes that cut a class into equal parts become literals of a CASE; no window, no shuffle.
    """
    require_columns(df, [target, *key_cols])
    if k < 2:
        raise ValueError("k must be at least 2")
    h = row_hash(key_cols, seed)

    def ranks(sizes):
        for g, n in sizes.items():
            if n < k:
                raise ValueError(f"class {g} has {n} rows, fewer than {k} folds")
        return {g: sorted({n * i // k for i in range(1, k)}) for g, n in sizes.items()}

    cuts, _ = hash_cuts(df, h, col(target), ranks)
    fold = None
    for g, by_rank in cuts.items():
        inner = F.lit(k - 1)
        for i, (_, cut) in reversed(list(enumerate(sorted(by_rank.items())))):
            inner = F.when(F.col("__h") <= F.lit(cut), F.lit(i)).otherwise(inner)
        hit = col(target).eqNullSafe(F.lit(g))
        fold = F.when(hit, inner) if fold is None else fold.when(hit, inner)
    return df.withColumn("__h", h).withColumn(name, fold.cast("int")).drop("__h")


class Resample(Step):
    """Balance the classes of the training data. Test data is never resampled."""

    kind = "resampling"
    methods = {"oversample": oversample, "undersample": undersample}

    def rules(self, action):
        rule = action[self.kind]
        for key in ("target_column", "resampling_method", "random_state"):
            if key not in rule:
                raise ValueError(f"resampling: the key '{key}' is missing")
        if rule["resampling_method"] not in self.methods:
            raise ValueError("resampling_method must be 'oversample' or 'undersample'")
        return rule

    def fit_apply(self, df, action, full=None, rows=None, known=None):
        rule = self.rules(action)
        resample, keys = self.methods[rule["resampling_method"]], rule.get("key_columns")
        if keys:
            return resample(df, rule["target_column"], keys, rule["random_state"]), {}
        return resample(with_row_id(df), rule["target_column"], ["__id"], rule["random_state"]).drop("__id"), {}

    def apply(self, df, action, learned):
        return df
