"""Session settings and the shared folder for tables that cut lineage."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores="8", app="tabloom", driver_memory="8g", shuffle_partitions=None) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only where that setting is absent on a single machine (tests) a folder is made and set for this session; a cluster
    must name one, as a folder on one machine would not be seen by the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        named = tempfile.mkdtemp(prefix="tabloom-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Unlike a cache it survives lost executors, and later scans read only the columns they need. The shuffle files of the write are of no use
    after it: Spark is told to delete them then, so a chain of tables needs the disk of one shuffle at a time.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame, name="__id") -> DataFrame:
    """Rows with a number of their own, written once so that it never changes; for data without a key."""
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), "numbered")
