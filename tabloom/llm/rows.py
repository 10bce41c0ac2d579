"""Numbered copies of a table, for operators that carry decisions back to their rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.session import materialize

ROW = "__row"


def numbered(df: DataFrame, columns: dict, label: str) -> DataFrame:
    """The given columns ({name: expression}) with a row number, written once to the shared folder.

    The number identifies the row even where keys are null or repeated; a re-run task gives the same table, as only
    committed files are read.
    """
    return materialize(df.select(F.monotonically_increasing_id().alias(ROW), *[c.alias(n) for n, c in columns.items()]), label)


def column(df: DataFrame, name: str):
    """A column by its plain name, dots included."""
    return df["`" + name.replace("`", "``") + "`"]


def partitions(spark) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
