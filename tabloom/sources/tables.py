"""Tables in and out: delimited text and Parquet."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.expressions import col, nan_to_null

# The text tokens the usual CSV readers take for a missing value.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Number texts; Spark's own cast would also take Java's suffixes, as in 1d or 2f.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def read_table(spark: SparkSession, path: str, delimiter=",", schema: T.StructType | None = None,
               na_tokens=NA_TOKENS, multi_line=False) -> DataFrame:
    """Delimited UTF-8 text with a header, or Parquet by its ending; NA tokens and NaN become null.

    With a schema the file is read once. Without one, every column is read as text in the same single pass and the
    types follow from one aggregate over all columns (see ``infer_types``). ``multi_line`` allows line breaks inside
    quotes, but such files cannot be split among tasks.
    """
    if path.rstrip("/").endswith(".parquet"):
        return nan_to_null(spark.read.parquet(path))
    reader = (spark.read.option("header", True).option("sep", delimiter).option("encoding", "UTF-8")
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line))
    names = reader.option("inferSchema", False).csv(path).columns if schema is None else schema.names
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = reader.option("enforceSchema", schema is None).schema(text).csv(path)
    raw = raw.select(*[F.when(~F.coalesce(col(c), F.lit("")).isin(*na_tokens), col(c)).alias(c) for c in names])
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else infer_types(raw)
    typed = raw.select(*[col(c).cast(types[c]).alias(c) if not isinstance(types[c], T.StringType) else col(c)
                         for c in names])
    return nan_to_null(typed)


def infer_types(raw: DataFrame) -> dict[str, T.DataType]:
    """Per text column the narrowest of bigint, double, boolean and string that holds all its values. One job."""
    checks = []
    for i, c in enumerate(raw.columns):
        present = col(c).isNotNull()
        checks += [
            F.count_if(present).alias(f"n{i}"),
            F.count_if(present & (~col(c).rlike(r"^\s*[+-]?\d+\s*$") | F.expr(f"try_cast(`{c.replace('`', '``')}` as bigint)").isNull())).alias(f"l{i}"),
            F.count_if(present & (~col(c).rlike(NUMBER) | F.expr(f"try_cast(`{c.replace('`', '``')}` as double)").isNull())).alias(f"d{i}"),
            F.count_if(present & ~F.lower(col(c)).isin("true", "false")).alias(f"b{i}"),
        ]
    row = raw.agg(*checks).first()
    types = {}
    for i, c in enumerate(raw.columns):
        if not row[f"n{i}"]:
            types[c] = T.DoubleType()
        elif not row[f"l{i}"]:
            types[c] = T.LongType()
        elif not row[f"d{i}"]:
            types[c] = T.DoubleType()
        elif not row[f"b{i}"]:
            types[c] = T.BooleanType()
        else:
            types[c] = T.StringType()
    return types


def write_table(df: DataFrame, path: str, delimiter=",", mode="errorifexists") -> str:
    """Write a directory of Parquet files, or of CSV files with header when the path ends in ``.csv``."""
    writer = df.write.mode(mode)
    if path.rstrip("/").endswith(".csv"):
        writer.option("header", True).option("sep", delimiter).option("escape", '"').csv(path)
    else:
        writer.parquet(path)
    return path


def write_split(train: DataFrame, test: DataFrame, directory: str, tag: str, file_format="parquet") -> dict[str, str]:
    """Train and test side by side, named by tag."""
    ending = {"parquet": ".parquet", "csv": ".csv"}[file_format]
    return {
        "train": write_table(train, f"{directory}/train_data_{tag}{ending}"),
        "test": write_table(test, f"{directory}/test_data_{tag}{ending}"),
    }
