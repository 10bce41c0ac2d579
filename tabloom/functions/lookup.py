"""Replacing keys by learned values: a literal map, a broadcast join or a salted shuffle join, by size."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import FRACTIONAL, col, double_array, guarded, num, replace_columns
from tabloom.session import scratch_path

LITERAL_ROWS = 64        # entries of a map literal, which is searched entry by entry
INLINE_ROWS = 10_000     # entries kept in the state itself; such a map is always small enough to broadcast
HOT_SHARE = 1 / 200      # keys with more than this share of the rows are spread over several tasks: at most 200 keys


def text_key(df: DataFrame, name: str) -> Column:
    """A category as text: equal values have equal texts."""
    if isinstance(df.schema[name].dataType, FRACTIONAL):
        return num(name).cast("string")
    return col(name).cast("string")


def store_map(spark, encoded: DataFrame, rows: int, label: str) -> dict:
    """Entry for a map too large for the state: (key, value, n) as a table, and the keys that are hot."""
    path = scratch_path(spark, label)
    encoded.select("key", "value", "n").write.parquet(path)
    stored = spark.read.parquet(path)
    hot = [r["key"] for r in stored.filter(F.col("n") > F.lit(rows * HOT_SHARE)).select("key").collect()]
    return {"table": path, "hot": sorted(hot)}


def replace_by_map(df: DataFrame, name: str, entry: dict, on_unseen="error") -> DataFrame:
    """Replace the column by its entry's value; null keys stay null, unseen keys fail the query or become null."""
    key = text_key(df, name)
    if entry.get("table"):
        return joined(df, name, df.sparkSession.read.parquet(entry["table"]), on_unseen, hot=entry["hot"])
    if len(entry["rows"]) > LITERAL_ROWS:
        table = df.sparkSession.createDataFrame([(k, v, 1) for k, v in entry["rows"]], "key string, value double, n long")
        return joined(df, name, table, on_unseen)
    if not entry["rows"]:
        seen, value = F.lit(False), F.lit(None).cast("double")
    else:
        keys = [k for k, _ in entry["rows"]]
        seen = key.isin(keys)
        value = F.try_element_at(
            F.create_map(*[F.lit(x).cast("string" if i == 0 else "double") for kv in entry["rows"] for i, x in enumerate(kv)]), key)
    return replace_columns(df, {name: checked(value, key, seen, name, on_unseen)})


def checked(value, key, seen, name, on_unseen):
    if on_unseen == "null":
        return value
    if on_unseen != "error":
        raise ValueError("on_unseen must be 'error' or 'null'")
    return guarded(value, key.isNotNull() & ~seen, f"column '{name}': value not found in the training data: ", key)


def joined(df, name, table, on_unseen, hot=None) -> DataFrame:
    """Left join with the map; without ``hot`` the map is small and broadcast.

    In a shuffle join hot and missing keys would each land on one task, so their rows are spread by a salt that depends
    on the row alone, and the few hot map entries are repeated once per salt.
    """
    key, names = text_key(df, name), df.columns
    rows = df.withColumn("__key", key)
    table = table.select(F.col("key").alias("__key"), F.col("value").alias("__value"), F.lit(True).alias("__seen"))
    if hot is None:
        both = rows.join(F.broadcast(table), "__key", "left")
    else:
        salts = max(2, min(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4))
        hashable = [col(f.name) for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
        spread = F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int")
        is_hot = F.col("__key").isin(hot) if hot else F.lit(False)
        rows = rows.withColumn("__salt", F.when(F.col("__key").isNull() | is_hot, spread).otherwise(F.lit(0)))
        table = table.withColumn("__salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1)))
                                                     .otherwise(F.array(F.lit(0)))))
        both = rows.join(table, ["__key", "__salt"], "left")
    value = checked(F.col("__value"), F.col("__key"), F.coalesce(F.col("__seen"), F.lit(False)), name, on_unseen)
    return both.select(*[value.alias(n) if n == name else col(n) for n in names])


def replace_by_bin(name: str, index: Column, entry: dict, bins: int, on_unseen, outside_fails) -> Column:
    """Value of the bin a number falls into: one array access on a literal."""
    by_bin = {int(k): v for k, v in entry["rows"]}
    value = F.get(double_array([by_bin.get(b) for b in range(bins)]), index)
    seen = F.get(double_array([float(b in by_bin) for b in range(bins)]), index) > 0
    x = col(name)
    if on_unseen == "null":
        return value
    result = guarded(value, index.isNotNull() & ~seen, f"column '{name}': no training data in the bin of ", x)
    if outside_fails:
        result = guarded(result, x.isNotNull() & index.isNull(), f"column '{name}': value outside the bins: ", x)
    return result
