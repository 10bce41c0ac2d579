"""Value frequencies of many columns in one shuffle."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.expressions import FRACTIONAL, INTEGRAL, col, num


def typed_value(df: DataFrame, name: str):
    """A value as (v_long, v_num, v_str); whole numbers only fill the first, to keep the grouping key narrow."""
    kind = df.schema[name].dataType
    whole, real, text = F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(kind, INTEGRAL):
        whole = col(name).cast("bigint")
    elif isinstance(kind, FRACTIONAL):
        real = num(name)
    elif isinstance(kind, T.DecimalType):
        real, text = num(name), col(name).cast("string")
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        text = F.to_json(F.struct(col(name)))
        text = F.when(col(name).isNotNull(), text)
    elif isinstance(kind, T.BinaryType):
        text = F.hex(col(name))
    else:
        text = col(name).cast("string")
    return F.struct(whole.alias("v_long"), real.alias("v_num"), text.alias("v_str"))


def value_counts(df: DataFrame, columns) -> DataFrame:
    """Long table (column, v_long, v_num, v_str, n); a missing value is the row with three nulls.

    Rows are expanded and combined map-side before the shuffle, so a value that fills a third of a column costs one
    row per task.
    """
    columns = list(columns)
    values = F.array(*[typed_value(df, c) for c in columns])
    long = df.select(F.posexplode(values).alias("slot", "v"))
    counted = (long.groupBy("slot", F.col("v.v_long").alias("v_long"), F.col("v.v_num").alias("v_num"),
                            F.col("v.v_str").alias("v_str")).agg(F.count(F.lit(1)).alias("n")))
    name = F.get(F.array(*[F.lit(c) for c in columns]), F.col("slot"))
    number = F.coalesce(F.col("v_num"), F.col("v_long").cast("double"))
    return counted.select(name.alias("column"), "v_long", number.alias("v_num"), "v_str", "n")


def is_missing():
    return F.coalesce(F.col("v_long").cast("string"), F.col("v_num").cast("string"), F.col("v_str")).isNull()


def mode_order(whole=False):
    """Most frequent first, then the smallest value: the smallest struct is the mode. ``whole`` compares whole numbers before doubles."""
    values = [F.col("v_long"), F.col("v_num")] if whole else [F.col("v_num"), F.col("v_long")]
    return F.when(~is_missing(), F.struct((-F.col("n")).alias("neg_n"), *values, F.col("v_str")))


def modes(df: DataFrame, columns) -> dict:
    """``{column: mode}``: the most frequent value, the smallest on ties, null without values. One job."""
    columns = list(columns)
    if not columns:
        return {}
    best = value_counts(df, columns).groupBy("column").agg(F.min(mode_order()).alias("m")).collect()
    found = {r["column"]: python_value(df.schema[r["column"]].dataType, r["m"]) for r in best}
    return {c: found.get(c) for c in columns}


def python_value(kind, value):
    if value is None:
        return None
    if isinstance(kind, INTEGRAL):
        return value["v_long"]
    if isinstance(kind, FRACTIONAL):
        return value["v_num"]
    return value["v_str"]
