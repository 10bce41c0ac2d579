"""Running sums over an order of any length, spread over many tasks."""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.expressions import double_array


def range_edges(df: DataFrame, order_column: str, buckets: int) -> list[float]:
    """About equally filled ranges of a numeric column, from one bounded sketch; infinite values belong to the outer ranges."""
    grid = double_array([i / buckets for i in range(1, buckets)])
    inner = df.agg(F.percentile_approx(F.col(order_column), grid, 10_000).alias("e")).first()["e"] or []
    return [float("-inf")] + sorted(e for e in set(inner) if math.isfinite(e)) + [float("inf")]


def running_sums(df: DataFrame, group_columns, order_column: str, sums: dict[str, str], edges,
                 small=True) -> DataFrame:
    """Sums of ``sums`` (new name -> column) over all rows of the group at or above the row's order value.

    ``df`` holds one row per group and order value. Rows are cut into ranges; each range is summed on its own task, and
    the totals of the higher ranges, one row per range and group, are added through a join. With ``small`` the caller
    vouches for few groups, and those totals are broadcast.
    """
    group_columns = list(group_columns)
    if len(edges) > 2:
        ranged = Bucketizer(splits=edges, inputCol=order_column, outputCol="__range").transform(df)
    else:
        ranged = df.withColumn("__range", F.lit(0.0))
    totals = ranged.groupBy(*group_columns, "__range").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    above = Window.partitionBy(*group_columns).orderBy(F.desc("__range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group_columns, "__range",
                            *[F.coalesce(F.sum(n).over(above), F.lit(0)).alias(f"__{n}") for n in sums])
    inside = (Window.partitionBy(*group_columns, "__range").orderBy(F.desc(order_column))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select(*df.columns, "__range", *[F.sum(c).over(inside).alias(n) for n, c in sums.items()])
    joined = local.join(F.broadcast(offsets) if small else offsets, [*group_columns, "__range"])
    return joined.select(*df.columns, *[(F.col(n) + F.col(f"__{n}")).alias(n) for n in sums])
