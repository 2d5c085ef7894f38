"""Label pipelines for complete and censored series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cyclemill.operators.labels import extend_with_truth, horizon_labels, max_cycles, remaining_life
from cyclemill.operators.ordering import Extent
from cyclemill.operators.scaling import apply_scaler, fit_scaler, with_cycle_feature


def label_complete(
    log: DataFrame, w0: int = 15, w1: int = 30, summary: DataFrame | None = None
) -> DataFrame:
    """Series that ran to failure: the last cycle is the failure.

    ``summary`` is ``(id, max)`` where it is already known more cheaply than from ``log``.
    """
    return with_cycle_feature(horizon_labels(remaining_life(log, summary), w0, w1))


def label_censored(
    log: DataFrame,
    truth: DataFrame,
    w0: int = 15,
    w1: int = 30,
    align: str = "key",
    summary: DataFrame | None = None,
    entities: int | None = None,
) -> DataFrame:
    """Series cut off before failure: the ground truth says how many cycles were left.

    ``entities`` is their number, or an upper bound, where it is known.
    """
    summary = max_cycles(log) if summary is None else summary
    extent = None if entities is None else Extent(entities, entities, 1)
    total = extend_with_truth(summary, truth, align, extent=extent)
    return with_cycle_feature(horizon_labels(remaining_life(log, total, entities=entities), w0, w1))


def prepare(
    train_log: DataFrame,
    test_log: DataFrame,
    truth: DataFrame,
    features: Sequence[str],
    w0: int = 15,
    w1: int = 30,
    align: str = "key",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labelled and standardised train and test tables, and the statistics fitted on train."""
    train = label_complete(train_log, w0, w1)
    test = label_censored(test_log, truth, w0, w1, align)
    stats = fit_scaler(train, features)
    return apply_scaler(train, stats), apply_scaler(test, stats), stats
