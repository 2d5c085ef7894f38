"""Model parameters as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weighted_average(
    vectors: DataFrame, weight: str = "n", values: str = "values", by: Sequence[str] = ()
) -> DataFrame:
    """Average of the vectors, weighted: ``(*by, pos, value, n)``, one row per position.

    The sums combine on the map side, so what moves is bounded by the model's size
    per task, and no task or driver holds all vectors.
    """
    cells = vectors.select(*by, F.col(weight).alias("_n"), F.posexplode(values).alias("pos", "_v"))
    return cells.groupBy(*by, F.col("pos").cast("long").alias("pos")).agg(
        (F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")).alias("value"),
        F.sum("_n").alias("n"),
    )


def parameter_counts(model: DataFrame, layer: str = "layer", values: str = "values") -> DataFrame:
    """Number of parameters of every layer of a model table."""
    return model.groupBy(layer).agg(F.sum(F.size(values)).cast("long").alias("n_params"))
