"""Replaying a fitted pipeline on a stream of files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tabloom.functions.expressions import nan_to_null
from tabloom.plans.pipeline import apply_pipeline
from tabloom.sources.state import PipelineState


def read_stream(spark: SparkSession, directory: str, schema, pattern="*.parquet", files_per_trigger=None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return nan_to_null(reader.parquet(directory))


def apply_to_stream(stream: DataFrame, config: dict, state: PipelineState, output: str, checkpoint: str,
                    expect_target=True, available_now=True) -> StreamingQuery:
    """Prepare arriving rows and append them to a Parquet directory, exactly once.

    The pipeline keeps no streaming state: its statistics are literals and small maps.
    """
    prepared = apply_pipeline(stream, config, state, expect_target)
    writer = prepared.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(output)
