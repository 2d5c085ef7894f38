"""A training's state on disk, for another driver to go on from."""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemill.functions.lstm import Weights
from cyclemill.session import delete_table
from cyclemill.sources.models import STATS_SCHEMA

STATE_SCHEMA = "state string, packed array<double>"
KEPT = 2


class Journal:
    """Commits of a training run below ``path``, which executors and every driver can reach.

    A commit is written beside the others and then renamed, which file systems such as HDFS do in
    one step: a reader finds the state and the weights of the same round, or those of the round before. The
    last two are kept. Statistics are written by round before the commit; a repeated round replaces them.
    One driver writes at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commit(self, state: dict, weights: Weights) -> None:
        target = f"{self.path}/state-{state['epoch']:08d}-{state['number']:010d}"
        pending = f"{self.path}/.pending-{uuid.uuid4().hex}"
        row = pa.table({"state": [json.dumps(state)], "packed": pa.array([weights.pack()], pa.list_(pa.float64()))})
        self.spark.createDataFrame(row).coalesce(1).write.parquet(pending)
        delete_table(self.spark, target)  # of a driver that died after this very commit
        if not self._fs().rename(self._at(pending), self._at(target)):
            raise OSError(f"could not commit {target}")
        for old in self._states()[:-KEPT]:
            delete_table(self.spark, f"{self.path}/{old}")

    def last(self) -> tuple[dict, Weights] | None:
        """The state and the weights of the last commit."""
        found = self._states()
        if not found:
            return None
        row = self.spark.read.schema(STATE_SCHEMA).parquet(f"{self.path}/{found[-1]}").toArrow()
        state = json.loads(row.column("state")[0].as_py())
        return state, Weights.unpack(row.column("packed")[0].values.to_numpy())

    def add_stats(self, number: int, rows: list[tuple]) -> None:
        """Statistics of one round, replacing those of an attempt that was not committed."""
        made = self.spark.createDataFrame(rows, STATS_SCHEMA).drop("round").coalesce(1)
        made.write.mode("overwrite").parquet(f"{self.path}/stats/round={number}")

    def stats(self) -> DataFrame:
        """Statistics of all committed rounds, as ``read_stats`` gives them."""
        found = self.last()
        rounds = found[0]["rounds"] if found else 0
        empty = self.spark.createDataFrame([], STATS_SCHEMA)
        if not rounds:
            return empty
        held = self.spark.read.schema(STATS_SCHEMA).parquet(f"{self.path}/stats")
        return held.where(F.col("round") < rounds).select(*empty.columns)

    def _states(self) -> list[str]:
        fs, at = self._fs(), self._at(self.path)
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(n for n in names if n.startswith("state-"))

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._at(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a table at ``path`` was written to its end."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)
