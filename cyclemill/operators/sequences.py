"""Sliding sequences, padded lives and step chunks.

Rows are addressed by their dense 1-based position in the series (see
``ordering.number_rows``). A long series is cut into segments of positions, so
that one task never holds a whole hot series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclemill.functions.expressions import feature_vector, one_hot
from cyclemill.operators.ordering import Extent, number_rows
from cyclemill.sizing import setting, small_side

SEQUENCE_LENGTH = 50
BLOCK_STEPS = 50


def sliding_sequences(
    log: DataFrame,
    features: Sequence[str],
    label: str,
    length: int = SEQUENCE_LENGTH,
    id_col: str = "id",
    pos_col: str = "cycle",
    longest: int | None = None,
    segment_rows: int | None = None,
    keep: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per window of ``length`` rows, labelled by the row just after it.

    A series of n rows gives max(n - length, 0) samples. ``seq`` is the window in
    (time, feature) order as one flat float array.

    ``longest`` is the measured size of the largest series. If it fits a segment,
    the windows reuse the exchange on ``id_col`` that numbered the rows, and its sort
    too if ``order`` names the columns that the positions were numbered by. Otherwise
    (or if it is unknown) the series are cut into segments, each of which also gets
    the ``length`` rows before it, so that no window is lost at a border.
    """
    segment_rows = max(setting(log, "segmentRows", segment_rows), length)
    rows = log.select(id_col, pos_col, *order, feature_vector(features).alias("_x"), label, *keep)
    group = [id_col]
    if longest is None or longest > segment_rows:
        own = F.floor((F.col(pos_col) - 1) / segment_rows)
        needed_next = (F.col(pos_col) - 1) % segment_rows >= segment_rows - length
        rows = rows.withColumns(
            {"_own": own, "_segment": F.explode(F.when(needed_next, F.array(own, own + 1)).otherwise(F.array(own)))}
        )
        group.append("_segment")
    before = Window.partitionBy(*group).orderBy(*(order or [pos_col])).rowsBetween(-length, -1)
    windows = rows.withColumn("_w", F.collect_list("_x").over(before)).where(F.size("_w") == length)
    if "_segment" in group:
        windows = windows.where(F.col("_own") == F.col("_segment"))
    return windows.select(
        id_col,
        F.col(pos_col).alias("label_cycle"),
        F.flatten("_w").alias("seq"),
        F.col(label).cast("float").alias("label"),
        *keep,
    )


def sequence_counts(lengths: DataFrame, length: int = SEQUENCE_LENGTH, n_col: str = "n_cycles") -> DataFrame:
    """Samples that each series of ``(id, n_cycles)`` will give."""
    return lengths.withColumn("n_samples", F.greatest(F.col(n_col) - length, F.lit(0)).cast("long"))


def life_batches(
    lengths: DataFrame,
    batch_size: int = 16,
    id_col: str = "id",
    n_col: str = "n_cycles",
    extent: Extent | None = None,
) -> DataFrame:
    """Put lives, in entity order, into minibatches: ``(id, steps, batch_id, batch_steps)``.

    ``lengths`` has one row per entity. ``batch_steps`` is the longest life of the batch.
    ``extent`` is that of the entities, if known.
    """
    lives = lengths.select(id_col, F.col(n_col).alias("steps"))
    numbered = number_rows(lives, [], [id_col], "_i", None, extent)
    batched = numbered.withColumn("batch_id", F.floor((F.col("_i") - 1) / batch_size).cast("long")).drop("_i")
    return batched.withColumn("batch_steps", F.max("steps").over(Window.partitionBy("batch_id")))


def padded_lives(
    log: DataFrame,
    batches: DataFrame,
    features: Sequence[str],
    label: str,
    classes: int | None,
    id_col: str = "id",
    pos_col: str = "cycle",
    block_steps: int = BLOCK_STEPS,
) -> DataFrame:
    """Lives padded in front to the longest of their batch, in blocks of steps.

    The lives of a batch end together; their common time is cut every ``block_steps``
    steps, and a block of a life is one row, so no row grows with the life. Blocks that
    are all padding are left out. ``x`` is flat (time, feature); ``y`` holds one-hot
    vectors, or the bare target if ``classes`` is None (a regression); ``mask`` is 1 on
    real steps; ``first_pos`` is the position of the block's first step, zero or less
    on padding.
    """
    target = one_hot(label, classes) if classes else F.array(F.col(label).cast("double"))
    timed = log.join(small_side(batches.select(id_col, "steps", "batch_id", "batch_steps")), id_col)
    t = F.col(pos_col) + F.col("batch_steps") - F.col("steps")
    rows = timed.select(
        "batch_id", id_col, F.floor((t - 1) / block_steps).cast("long").alias("block"), t.alias("t"),
        "batch_steps", (t - F.col(pos_col)).alias("_shift"), feature_vector(features).alias("x"), target.alias("y"),
    )
    blocks = rows.groupBy("batch_id", id_col, "block", "batch_steps", "_shift").agg(
        F.sort_array(F.collect_list(F.struct("t", "x", "y"))).alias("cells")
    )
    begin = F.col("block") * block_steps
    gap = (F.get("cells.t", F.lit(0)) - begin - 1).cast("int")
    nothing = F.array(*[F.lit(0 if classes else 0.0)] * (classes or 1))
    return blocks.select(
        "batch_id",
        id_col,
        "block",
        (begin + 1 - F.col("_shift")).alias("first_pos"),
        F.concat(
            F.array_repeat(F.lit(0.0).cast("float"), gap * len(features)), F.flatten(F.col("cells.x"))
        ).alias("x"),
        F.concat(F.array_repeat(nothing, gap), F.col("cells.y")).alias("y"),
        F.concat(F.array_repeat(F.lit(0), gap), F.array_repeat(F.lit(1), F.size("cells"))).alias("mask"),
    )


def step_chunks(log: DataFrame, chunk: int = 50, id_col: str = "id", pos_col: str = "cycle") -> DataFrame:
    """Bounds of the consecutive step blocks that truncated back-propagation works on."""
    number = F.floor((F.col(pos_col) - 1) / chunk).cast("long").alias("chunk")
    return log.groupBy(id_col, number).agg(
        F.min(pos_col).alias("first_step"),
        F.max(pos_col).alias("last_step"),
        F.count(F.lit(1)).alias("n_steps"),
    )


def unmasked_steps(padded: DataFrame, *arrays: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row per real time step of padded series; ``mask`` and ``arrays`` have equal lengths."""
    cells = padded.select(*keys, F.posexplode(F.arrays_zip("mask", *arrays)).alias("step", "_cell"))
    return cells.where(F.col("_cell.mask") == 1).select(
        *keys, F.col("step").cast("long"), *[F.col(f"_cell.{a}").alias(a) for a in arrays]
    )
