"""Projection, casts and checks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import (
    FRACTIONAL, col, guarded, is_numeric, numeric_columns, quoted, replace_columns, require_columns,
)


def keep_columns(df: DataFrame, columns, target=None, expect_target=True) -> DataFrame:
    """Project to the listed columns in order; scoring data (``expect_target=False``) goes without the target."""
    wanted = [c for c in columns if expect_target or c != target]
    require_columns(df, wanted)
    return df.select(*[col(c) for c in wanted])


def one_hot_name(column, value) -> str:
    return f"{column}_{value}"


def one_hot_columns(column, learned) -> list[str]:
    """Names of the indicator columns in category order, without the dropped one."""
    return [one_hot_name(column, v) for v in learned["values"] if v != learned.get("dropped")]


def order_columns(df: DataFrame, columns, one_hot_state, target=None, expect_target=True) -> DataFrame:
    """Configured columns, then indicator columns; what is absent becomes null, what is not listed falls away."""
    names = [c for c in columns if c not in one_hot_state and (expect_target or c != target)]
    indicators = [n for c, learned in one_hot_state.items() for n in one_hot_columns(c, learned)]
    have = set(df.columns)
    return df.select(
        *[col(c) if c in have else F.lit(None).cast("double").alias(c) for c in names],
        *[col(c) if c in have else F.lit(None).cast("int").alias(c) for c in indicators],
    )


def cast_numeric(df: DataFrame, rules, lenient=False) -> DataFrame:
    """``rules``: ``{column: 'int' | 'float'}``. Malformed text fails the query; so does a null cast to int.

    With ``lenient`` both become null.
    """
    types = {"int": "bigint", "float": "double"}
    require_columns(df, rules)
    new = {}
    for c, to in rules.items():
        if to not in types:
            raise ValueError(f"to_type must be 'int' or 'float', not '{to}'")
        if lenient:
            new[c] = F.expr(f"try_cast({quoted(c)} as {types[to]})")
        elif to == "int":
            new[c] = guarded(F.expr(f"cast({quoted(c)} as bigint)"), col(c).isNull(), f"missing value in '{c}' cannot become an int")
        else:
            new[c] = F.expr(f"cast({quoted(c)} as double)")
    return replace_columns(df, new)


def split_features_label(df: DataFrame, target) -> tuple[DataFrame, DataFrame]:
    require_columns(df, [target])
    return df.drop(target), df.select(col(target))


def tidy(df: DataFrame, entries) -> DataFrame:
    """Turn one wide row into one row per column: ``entries`` are lists of (field name, Column)."""
    rows = [F.struct(*[c.alias(n) for n, c in entry]) for entry in entries]
    return df.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def missing_and_non_numeric(df: DataFrame) -> DataFrame:
    """(column, n_missing, is_numeric) from one aggregate."""
    wide = df.agg(*[F.count_if(missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)])
    return tidy(wide, [
        [("column", F.lit(c)), ("n_missing", F.col(f"m{i}")), ("is_numeric", F.lit(is_numeric(df, c)))]
        for i, c in enumerate(df.columns)
    ])


def missing(df: DataFrame, name):
    if isinstance(df.schema[name].dataType, FRACTIONAL):
        return col(name).isNull() | F.isnan(col(name))
    return col(name).isNull()


def check_ready(*parts: DataFrame) -> None:
    """Raise if a column of prepared data still misses values or is not numeric. One job for all parts."""
    found = parts[0].limit(0).select(F.lit("").alias("column"), F.lit(0).cast("long").alias("n_missing"), F.lit(True).alias("is_numeric"))
    for df in parts:
        found = found.unionByName(missing_and_non_numeric(df))
    found = found.filter("n_missing > 0 or not is_numeric").collect()
    if found:
        raise ValueError(
            f"columns with missing values: {sorted({r['column'] for r in found if r['n_missing']})}; "
            f"non-numeric columns: {sorted({r['column'] for r in found if not r['is_numeric']})}")


def check_same_columns(train: DataFrame, test: DataFrame) -> None:
    only_train = [c for c in train.columns if c not in test.columns]
    only_test = [c for c in test.columns if c not in train.columns]
    if only_train or only_test:
        raise ValueError(f"columns only in train: {only_train}; only in test: {only_test}")
    if train.columns != test.columns:
        raise ValueError("train and test hold the same columns in different order")


def class_ratio(df: DataFrame, target) -> DataFrame:
    """(n_majority, n_minority, ratio); the query fails unless there are exactly two classes."""
    require_columns(df, [target])
    per_class = df.filter(col(target).isNotNull()).groupBy(col(target).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    totals = per_class.agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("hi"), F.min("n").alias("lo"))
    two = F.col("k") != F.lit(2)
    return totals.select(
        F.col("hi").alias("n_majority"), F.col("lo").alias("n_minority"),
        guarded(F.col("hi").cast("double") / F.col("lo"), two, "expected exactly 2 classes, found ", F.col("k")).alias("ratio"),
    )


def constant_columns(df: DataFrame) -> DataFrame:
    """(column, is_constant): one distinct value, null counted as a value. No distinct is needed."""
    orderable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[
        e for i, c in enumerate(orderable)
        for e in (F.count(col(c)).alias(f"p{i}"), F.min(col(c)).alias(f"lo{i}"), F.max(col(c)).alias(f"hi{i}"))
    ])
    return tidy(wide, [
        [("column", F.lit(c)),
         ("is_constant", (F.col("n") > 0) & (
             (F.col(f"p{i}") == 0) | ((F.col(f"p{i}") == F.col("n")) & (F.col(f"lo{i}") == F.col(f"hi{i}")))))]
        for i, c in enumerate(orderable)
    ])


def non_finite(df: DataFrame) -> DataFrame:
    """(column, n_non_finite): missing, NaN or infinite values of the numeric columns."""
    names = numeric_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, n_non_finite bigint")
    wide = df.agg(*[
        F.count_if(col(c).isNull() | F.isnan(col(c).cast("double")) | (F.abs(col(c).cast("double")) == float("inf"))).alias(f"b{i}")
        for i, c in enumerate(names)
    ])
    return tidy(wide, [[("column", F.lit(c)), ("n_non_finite", F.col(f"b{i}"))] for i, c in enumerate(names)])
