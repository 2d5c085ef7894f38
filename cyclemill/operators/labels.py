"""Remaining useful life and failure-horizon labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemill.functions.expressions import failure_horizon, near_failure
from cyclemill.operators.ordering import Extent, number_rows
from cyclemill.sizing import small_side


def max_cycles(log: DataFrame, id_col: str = "id", cycle_col: str = "cycle") -> DataFrame:
    """Last observed cycle of every entity: ``(id, max)``."""
    return log.groupBy(id_col).agg(F.max(cycle_col).alias("max"))


def series_lengths(log: DataFrame, id_col: str = "id") -> DataFrame:
    return log.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_cycles"))


def remaining_life(
    log: DataFrame,
    summary: DataFrame | None = None,
    id_col: str = "id",
    cycle_col: str = "cycle",
    entities: int | None = None,
) -> DataFrame:
    """Add ``RUL = max - cycle``; entities the summary does not know get NULL.

    Without a summary the last observed cycle counts as the failure. The summary
    has one row per entity and was pre-aggregated on the map side, so a hot
    entity costs nothing here, and the log is not shuffled if the summary was
    counted (or, as ``entities``, is known) to be small.
    """
    summary = max_cycles(log, id_col, cycle_col) if summary is None else summary
    joined = log.join(small_side(summary, entities), id_col, "left")
    return joined.withColumn("RUL", F.col("max") - F.col(cycle_col)).select(*log.columns, "RUL")


def horizon_labels(df: DataFrame, w0: int = 15, w1: int = 30) -> DataFrame:
    """Add ``label1`` (within ``w1`` cycles) and ``label2`` (far, near, imminent)."""
    return df.withColumns({"label1": near_failure("RUL", w1), "label2": failure_horizon("RUL", w0, w1)})


def extend_with_truth(
    summary: DataFrame,
    truth: DataFrame,
    align: str = "key",
    id_col: str = "id",
    extent: Extent | None = None,
) -> DataFrame:
    """Total life of censored series: last observed cycle plus the true remainder.

    ``truth`` is ``(id, more)``. With ``align="key"`` entities without a truth get
    NULL. With ``align="position"`` the truth's ``id`` is a 1-based position among
    the sorted entities, and the query fails if the two counts differ.
    """
    if align == "key":
        total = summary.join(truth, id_col, "left")
    elif align == "position":
        ranked = number_rows(summary, [], [id_col], "_position", None, extent)
        placed = truth.select(F.col(id_col).alias("_position"), "more")
        both = ranked.join(placed, "_position", "full")
        mismatch = F.raise_error(F.lit("ground truth and log have different numbers of entities"))
        total = both.withColumn(
            id_col,
            F.when(F.col(id_col).isNull() | F.col("more").isNull(), mismatch).otherwise(F.col(id_col)),
        )
    else:
        raise ValueError("align is 'key' or 'position'")
    return total.select(id_col, (F.col("max") + F.col("more")).alias("max"))
