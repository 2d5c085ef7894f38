"""Minibatches dealt to workers so that all of them have about the same to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemill.operators.ordering import number_rows

# fixed values of a multiplicative scatter: which rounds come first has nothing to do with their cost
STRIDE, MODULUS = 2654435761, 4294967291


def scattered(number: Column) -> Column:
    return (number + 1) * F.lit(STRIDE) % F.lit(MODULUS)


def balanced_workers(costs: DataFrame, workers: int, per_worker: int) -> DataFrame:
    """Add ``round`` and ``worker`` to ``(batch_id, cost)``: ``per_worker`` minibatches for each worker and round.

    Minibatches go by falling cost to rounds, and within a round to and fro over the workers. So the shares of a
    round hold neighbours in cost: they differ by at most the cost between the round's first and last minibatch,
    and over all rounds by at most the largest cost. The rounds are then
    scattered, since training should not see long series first. Ties go by ``batch_id``, which is unique.
    """
    down = costs.withColumn("_down", -F.col("cost"))
    placed = number_rows(down, [], ["_down", "batch_id"], "_place").withColumn("_place", F.col("_place") - 1)
    turn = F.expr(f"_place div {workers}")
    at = F.pmod("_place", F.lit(workers))
    dealt = placed.withColumns(
        {
            "_sorted": F.expr(f"_place div {workers * per_worker}"),
            "worker": F.when(turn % 2 == 0, at).otherwise(workers - 1 - at).cast("int"),
        }
    )
    rounds = dealt.select("_sorted").distinct().withColumn("_key", scattered(F.col("_sorted")))
    order = number_rows(rounds, [], ["_key", "_sorted"], "_round").select("_sorted", (F.col("_round") - 1).alias("round"))
    return dealt.join(order, "_sorted").select(*costs.columns, "round", "worker")


def worker_loads(dealt: DataFrame) -> DataFrame:
    """``(worker, n_batches, cost)`` of what ``balanced_workers`` dealt out."""
    return dealt.groupBy("worker").agg(F.count(F.lit(1)).alias("n_batches"), F.sum("cost").alias("cost"))
