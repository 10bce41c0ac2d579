"""Column expressions shared by the operators. None of them starts a job."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType)
NUMERIC = INTEGRAL + FRACTIONAL + (T.DecimalType,)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """The column of that exact name, also when it holds dots or spaces."""
    return F.col(quoted(name))


def num(name: str) -> Column:
    """The column as a double, with NaN read as missing and -0.0 as 0.0."""
    return F.nanvl(col(name).cast("double"), F.lit(None).cast("double")) + F.lit(0.0)


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, NUMERIC)


def numeric_columns(df: DataFrame, leave_out=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in leave_out]


def require_columns(df: DataFrame, names, what="data") -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found in {what}")


def require_numeric(df: DataFrame, names) -> None:
    require_columns(df, names)
    wrong = [n for n in names if not is_numeric(df, n)]
    if wrong:
        raise ValueError(f"columns {wrong} are not numeric")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Read NaN as missing in every float column."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, FRACTIONAL)}
    if not floats:
        return df
    return df.select(*[
        F.when(~F.isnan(col(c)), col(c)).alias(c) if c in floats else col(c) for c in df.columns
    ])


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Give the named columns new values in place, as one projection."""
    return df.select(*[new[c].alias(c) if c in new else col(c) for c in df.columns])


def literal(value, type_name: str) -> Column:
    """A literal of a Spark type from its text form; text keeps doubles exact in JSON."""
    return F.lit(value).cast(type_name)


def row_hash(key_cols, seed=0) -> Column:
    """32 hex digits that depend only on the seed and the row's key, not on where the row lies."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("")) for c in key_cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))


def hash_share(key_cols, seed=0) -> Column:
    """The leading 32 bits of ``row_hash`` as a number in [0, 1)."""
    return F.conv(F.substring(row_hash(key_cols, seed), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def row_fingerprint(columns) -> list[Column]:
    """Two differently seeded 64-bit hashes over values and null flags: 128 bits per row."""
    parts = []
    for f in columns:
        value = col(f.name)
        if isinstance(f.dataType, FRACTIONAL):
            value = value + F.lit(0.0).cast(f.dataType)
        elif isinstance(f.dataType, (T.MapType, T.VariantType)):
            value = F.to_json(F.struct(value))
        parts += [F.isnull(col(f.name)), value]
    return [F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)]


def double_text(value) -> str:
    """A double as SQL text; long lists of literals are much faster to hand over as text than one by one."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    value = float(value)
    if math.isfinite(value):
        return f"{value!r}D"
    return f"CAST('{'NaN' if value != value else 'Infinity' if value > 0 else '-Infinity'}' AS DOUBLE)"


def double_array(values) -> Column:
    """A literal array of doubles."""
    return F.expr(f"array({', '.join(map(double_text, values))})")


def bin_index(name: str, edges) -> Column:
    """Index of the right-closed interval that holds the column's value; the first one also holds its lower edge.

    A balanced tree of comparisons: log2(bins) tests per row, inside generated code. Outside the edges: null.
    """
    x, edges = quoted(name), [double_text(e) for e in edges]
    if not edges:
        return F.lit(None).cast("int")
    if len(edges) == 1:
        return F.expr(f"IF({x} = {edges[0]}, 0, NULL)")

    def choose(first, last):
        if first == last:
            return str(first)
        middle = (first + last) // 2
        return f"IF({x} <= {edges[middle + 1]}, {choose(first, middle)}, {choose(middle + 1, last)})"

    return F.expr(f"IF({x} >= {edges[0]} AND {x} <= {edges[-1]}, {choose(0, len(edges) - 2)}, NULL)")


def guarded(value: Column, bad: Column, message: str, *details: Column) -> Column:
    """``value``, but the query fails with ``message`` on rows where ``bad`` holds.

    The check is part of the output column, so pruning that column is the only way to skip it.
    """
    text = F.concat(F.lit(message), *[F.coalesce(d.cast("string"), F.lit("NULL")) for d in details])
    return F.when(bad, F.raise_error(text)).otherwise(value)


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value.cast("double"), digits)
