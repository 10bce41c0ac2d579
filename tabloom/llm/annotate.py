"""Adding one struct column to a table, computed from whole texts batch by batch."""

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def annotate(docs: DataFrame, make: Callable, fields: str, into: str, text="text", keep=None) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``) and a struct column ``into`` with the ``fields``.

    ``make()`` runs once per task and returns a function from a string array to the arrays of the fields. Columns travel by
    position, so their names may hold anything or repeat; an input column named ``into`` is replaced.
    """
    names = docs.columns
    kept = [i for i, n in enumerate(names) if n != into and (keep is None or n in keep)]
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    plain = plain.select(F.col(f"c{names.index(text)}").cast("string").alias("text"), *[f"c{i}" for i in kept])
    struct = T._parse_datatype_string(fields)
    schema = T.StructType([*plain.schema.fields[1:], T.StructField("added", struct)])
    arrow = [to_arrow_type(f.dataType) for f in struct.fields]

    def run(batches):
        work = make()
        for batch in batches:
            if batch.num_rows:
                columns = [a if isinstance(a, pa.Array) and a.type == t else pa.array(a, t) for a, t in zip(work(batch.column(0)), arrow)]
                added = pa.StructArray.from_arrays(columns, fields=[pa.field(f.name, t) for f, t in zip(struct.fields, arrow)])
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], added], names=[f.name for f in schema.fields])

    return plain.mapInArrow(run, schema).toDF(*[names[i] for i in kept], into)
