"""Ordered splits and minibatch numbers without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemill.functions.expressions import feature_vector
from cyclemill.operators.ordering import Extent, number_rows, running_totals
from cyclemill.operators.sequences import SEQUENCE_LENGTH, sequence_counts
from cyclemill.sizing import small_side

TRAIN_SHARE = 0.8


def entity_phases(
    entities: DataFrame,
    share: float = TRAIN_SHARE,
    id_col: str = "id",
    extent: Extent | None = None,
) -> DataFrame:
    """``(id, entity_no, phase)``: the first ``int(share * N)`` entities train, the rest validate."""
    ranked = number_rows(
        entities.select(id_col).distinct(), [], [id_col], "entity_no", "_n", extent
    )
    cut = F.floor(F.lit(float(share)) * F.col("_n"))
    phase = F.when(F.col("entity_no") <= cut, "train").otherwise("val")
    return ranked.select(id_col, "entity_no", phase.alias("phase"))


def split_entities(
    log: DataFrame,
    phases: DataFrame,
    id_col: str = "id",
    entities: int | None = None,
) -> DataFrame:
    """Add the entity's ``phase`` to every row."""
    return log.join(small_side(phases.select(id_col, "phase"), entities), id_col)


def entity_range(log: DataFrame, first: int, last: int, id_col: str = "id") -> DataFrame:
    """Entities ``first``..``last``, both included; prunes partitions of a table laid out by id."""
    return log.where(F.col(id_col).between(first, last))


def sample_offsets(
    lengths: DataFrame,
    length: int = SEQUENCE_LENGTH,
    id_col: str = "id",
    n_col: str = "n_cycles",
    extent: Extent | None = None,
) -> DataFrame:
    """``(id, n_cycles, sample_offset, n_all)``: samples of the entities before, and of all.

    Works on one row per entity, so the samples themselves are never sorted.
    """
    counts = sequence_counts(lengths, length, n_col)
    running = running_totals(
        counts,
        [],
        [id_col],
        {"_upto": F.col("n_samples")},
        {"n_all": F.col("n_samples")},
        extent,
    )
    return running.select(id_col, n_col, (F.col("_upto") - F.col("n_samples")).alias("sample_offset"), "n_all")


def index_samples(
    log: DataFrame,
    offsets: DataFrame,
    length: int = SEQUENCE_LENGTH,
    batch_size: int = 16,
    share: float = TRAIN_SHARE,
    id_col: str = "id",
    pos_col: str = "cycle",
    entities: int | None = None,
) -> DataFrame:
    """Keep the rows that label a sample; add its global index, batch and tail-split phase."""
    labelled = log.where(F.col(pos_col) > length)
    places = offsets.select(id_col, "sample_offset", "n_all")
    joined = labelled.join(small_side(places, entities), id_col)
    index = F.col("sample_offset") + F.col(pos_col) - (length + 1)
    cut = F.floor(F.lit(float(share)) * F.col("n_all"))
    return (
        joined.withColumn("sample_idx", index)
        .withColumns(
            {
                "batch_id": F.floor(F.col("sample_idx") / batch_size).cast("long"),
                "phase": F.when(F.col("sample_idx") < cut, "train").otherwise("val"),
            }
        )
        .drop("sample_offset", "n_all")
    )


def window_batch_rows(
    log: DataFrame,
    offsets: DataFrame,
    features: Sequence[str],
    label: str,
    length: int = SEQUENCE_LENGTH,
    batch_size: int = 16,
    id_col: str = "id",
    pos_col: str = "cycle",
    n_col: str = "n_cycles",
    entities: int | None = None,
    tail: str | None = None,
    share: float = TRAIN_SHARE,
) -> DataFrame:
    """The rows each minibatch of windows needs, once per minibatch.

    Neighbouring windows share all but one row, so shipping rows instead of windows
    moves (length + batch_size) / batch_size copies of a row rather than ``length``.
    ``is_label`` marks the rows that label a sample; its window is the ``length``
    rows before it. Every row is placed by arithmetic alone: no window, no shuffle
    apart from a large offset table's join. ``tail="train"`` keeps the first ``share``
    of all samples, ``tail="val"`` the others, numbered from 0 again.
    """
    pos, n = F.col(pos_col), F.col(n_col)
    begin, end = F.lit(0), F.col("n_all")
    if tail:
        cut = F.floor(F.lit(float(share)) * F.col("n_all"))
        begin, end = (begin, cut) if tail == "train" else (cut, end)

    def position_of(sample):
        return sample - F.col("sample_offset") + (length + 1)

    def batch_of(labelled):
        return F.floor((F.col("sample_offset") + labelled - (length + 1) - begin) / batch_size).cast("long")

    first = F.greatest(pos, F.lit(length + 1), position_of(begin))
    last = F.least(pos + length, n, position_of(end) - 1)
    joined = log.drop(n_col).join(small_side(offsets.where(n > length), entities), id_col).where(first <= last)
    placed = joined.withColumn("batch_id", F.explode(F.sequence(batch_of(first), batch_of(last))))
    return placed.select(
        "batch_id",
        F.col(id_col).cast("long").alias("id"),
        pos.cast("long").alias("t"),
        pos.cast("long").alias("pos"),
        feature_vector(features).alias("x"),
        F.col(label).cast("float").alias("y"),
        ((first == pos) & (batch_of(pos) == F.col("batch_id"))).alias("is_label"),
    )


def life_batch_rows(
    log: DataFrame,
    batches: DataFrame,
    features: Sequence[str],
    label: str,
    id_col: str = "id",
    pos_col: str = "cycle",
) -> DataFrame:
    """The rows of each minibatch of whole lives; every row carries a label.

    ``t`` is the row's step in the common time of its batch, whose lives end together.
    """
    rows = log.join(small_side(batches.select(id_col, "steps", "batch_id", "batch_steps")), id_col)
    return rows.select(
        "batch_id",
        F.col(id_col).cast("long").alias("id"),
        (F.col(pos_col) + F.col("batch_steps") - F.col("steps")).cast("long").alias("t"),
        F.col(pos_col).cast("long").alias("pos"),
        feature_vector(features).alias("x"),
        F.col(label).cast("float").alias("y"),
        F.lit(True).alias("is_label"),
    )


def stored_batch_rows(padded: DataFrame, features: int, block_steps: int, id_col: str = "id") -> DataFrame:
    """The rows of minibatches that were stored as padded blocks (see ``padded_lives``), padding left out."""
    cells = padded.select(
        "batch_id",
        F.col(id_col).cast("long").alias("id"),
        "block", "first_pos", "x",
        F.posexplode(F.arrays_zip("mask", "y")).alias("_k", "_cell"),
    ).where("_cell.mask = 1")
    y = F.col("_cell.y")
    label = F.when(F.size(y) > 1, F.array_position(y, F.array_max(y)) - 1).otherwise(F.get(y, F.lit(0)))
    return cells.select(
        "batch_id",
        "id",
        (F.col("block") * block_steps + F.col("_k") + 1).cast("long").alias("t"),
        (F.col("first_pos") + F.col("_k")).cast("long").alias("pos"),
        F.slice("x", F.col("_k") * features + 1, F.lit(features)).alias("x"),
        label.cast("float").alias("y"),
        F.lit(True).alias("is_label"),
    )
