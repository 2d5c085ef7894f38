"""Models and training statistics as tables."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemill.functions.lstm import Network, Weights

MODEL_SCHEMA = "run string, round long, layer string, name string, shape array<int>, values array<double>"
CONFIG_SCHEMA = "run string, round long, config string"
STATS_SCHEMA = "run string, epoch long, round long, worker int, n double, loss double, seconds double"
OPTIMIZER_SLOTS = ("mean", "square")


def model_rows(run: str, round_no: int, net: Network, weights: Weights, optimizer: bool = True) -> list[tuple]:
    """One row per parameter block, and per optimizer slot of it if asked for."""
    rows = []
    for slot in ("values", *(OPTIMIZER_SLOTS if optimizer else ())):
        flat = getattr(weights, slot)
        for (layer, name, shape), block in zip(net.layout(), net.blocks(flat)):
            full = name if slot == "values" else f"{name}/{slot}"
            rows.append((run, round_no, layer, full, list(shape), block.ravel().tolist()))
    if optimizer:
        rows.append((run, round_no, "optimizer", "steps", [1], [float(weights.steps)]))
    return rows


def save_model(
    spark: SparkSession,
    path: str,
    net: Network,
    weights: Weights,
    run: str = "model",
    round_no: int = 0,
    optimizer: bool = True,
) -> None:
    """Write the weights (with the optimizer's state, if asked for) and the configuration.

    They replace what was saved of the same run and round; other runs and rounds stay.
    """
    rows = model_rows(run, round_no, net, weights, optimizer)
    config = [(run, round_no, net.to_json())]
    for kind, table in (
        ("weights", spark.createDataFrame(rows, MODEL_SCHEMA)),
        ("config", spark.createDataFrame(config, CONFIG_SCHEMA)),
    ):
        (
            table.coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run", "round")
            .parquet(f"{path}/{kind}")
        )


def read_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_SCHEMA).parquet(f"{path}/weights")


def load_model(
    spark: SparkSession, path: str, run: str = "model", round_no: int | None = None
) -> tuple[Network, Weights]:
    """Restore one model, the latest round by default. Its size is that of one network."""
    mine = F.col("run") == run
    if round_no is None:
        round_no = read_model(spark, path).where(mine).agg(F.max("round")).first()[0]
    if round_no is None:
        raise ValueError(f"no model of run {run} in {path}")
    mine = mine & (F.col("round") == round_no)
    config = spark.read.schema(CONFIG_SCHEMA).parquet(f"{path}/config").where(mine).first()["config"]
    net = Network.from_json(config)
    stored = {(r["layer"], r["name"]): np.array(r["values"]) for r in read_model(spark, path).where(mine).collect()}

    def flat(suffix):
        return np.concatenate([stored[layer, name + suffix] for layer, name, _ in net.layout()])

    if ("optimizer", "steps") not in stored:
        return net, Weights(flat(""))
    return net, Weights(flat(""), flat("/mean"), flat("/square"), float(stored["optimizer", "steps"][0]))


def append_stats(spark: SparkSession, path: str, rows: Iterable[tuple]) -> None:
    spark.createDataFrame(list(rows), STATS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATS_SCHEMA).parquet(path)


STEPS_SCHEMA = (
    "worker int, n double, loss double, batch_id long, iteration long, step int, norm double, "
    "run string, epoch long, round long, kind string"
)


def read_steps(spark: SparkSession, path: str) -> DataFrame:
    """One row per optimiser step of the trainings that were given ``path`` as ``steps_path``."""
    return spark.read.schema(STEPS_SCHEMA).parquet(path).where("kind = 'step'").drop("kind")
