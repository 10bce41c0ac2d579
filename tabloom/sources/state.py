"""What a fitted pipeline has learned, as JSON plus Parquet for large encoding maps."""

import dataclasses
import json
import os

from pyspark.sql import SparkSession


@dataclasses.dataclass(frozen=True)
class StepState:
    """One step's statistics, by column. ``name`` keeps two steps of one kind apart."""

    name: str
    kind: str
    learned: dict


@dataclasses.dataclass(frozen=True)
class PipelineState:
    steps: tuple[StepState, ...] = ()

    def step(self, name: str) -> StepState:
        for s in self.steps:
            if s.name == name:
                return s
        raise ValueError(f"the state holds no step '{name}'")

    def one_hot(self) -> dict:
        """Category lists of all one-hot steps, needed for the final column order."""
        merged = {}
        for s in self.steps:
            if s.kind == "one_hot_encoding":
                merged.update(s.learned)
        return merged

    def to_json(self) -> str:
        """The whole state on one line."""
        return json.dumps([dataclasses.asdict(s) for s in self.steps])

    @classmethod
    def from_json(cls, text: str) -> "PipelineState":
        return cls(tuple(StepState(**s) for s in json.loads(text)))


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def write_text(spark: SparkSession, path: str, value) -> str:
    """A JSON value as a one-line text on the cluster's file system."""
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_text(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path).first()["value"])


def save_state(spark: SparkSession, state: PipelineState, directory: str) -> str:
    """Write ``directory``: the state as one JSON text, each table-backed map as a Parquet table beside it."""
    moved = []
    for s in state.steps:
        learned = {}
        for column, entry in s.learned.items():
            if isinstance(entry, dict) and entry.get("table"):
                target = os.path.join(directory, "maps", f"{s.name}-{column}")
                spark.read.parquet(entry["table"]).write.mode("overwrite").parquet(target)
                entry = {**entry, "table": target}
            learned[column] = entry
        moved.append(StepState(s.name, s.kind, learned))
    write_text(spark, os.path.join(directory, "state"), [dataclasses.asdict(s) for s in moved])
    return directory


def load_state(spark: SparkSession, directory: str, missing_ok=False) -> PipelineState | None:
    """Read what ``save_state`` wrote; with ``missing_ok`` an absent state gives None."""
    path = os.path.join(directory, "state")
    if not path_exists(spark, path):
        if missing_ok:
            return None
        raise FileNotFoundError(f"no state in {directory}")
    return PipelineState(tuple(StepState(**s) for s in read_text(spark, path)))
