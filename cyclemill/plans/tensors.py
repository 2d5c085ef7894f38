"""From Arrow rows of minibatches, in order, to the arrays the kernel takes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemill.functions.lstm import Network

COLUMNS = ("batch_id", "id", "t", "pos", "x", "y", "is_label")


@dataclass
class Minibatch:
    """Windows of a minibatch, or one block of steps of its lives."""

    x: np.ndarray
    y: np.ndarray
    mask: np.ndarray
    # row numbers of the labels in ``table``, shaped like y; -1 on padding
    rows: np.ndarray
    table: pa.Table
    # entity of each life, and whether the block is the first of its minibatch
    ids: np.ndarray | None = None
    first: bool = True


def in_order(rows: DataFrame, net: Network, block: int, *before: str) -> DataFrame:
    """Sort the rows of a task as ``minibatches`` reads them; ``before`` names columns that come first.

    Lives are read block by block, so that a task holds one block of one minibatch at a time.
    """
    keys = ["batch_id", "id", "t"] if net.many_to_one else ["batch_id", "_block", "id", "t"]
    placed = rows.withColumn("_block", F.lit(0) if net.many_to_one else F.floor((F.col("t") - 1) / block))
    return placed.sortWithinPartitions(*before, *keys)


def runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables of the rows that agree in ``keys``, which are together; only one is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def minibatches(batches: Iterator[pa.RecordBatch], net: Network, length: int, block: int) -> Iterator[Minibatch]:
    """Minibatches of windows, or blocks of lives, of rows sorted by ``in_order``."""
    last = None
    for table in runs(batches, ("batch_id", "_block")):
        column = table.column("x").combine_chunks()
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(table), net.features).astype(float)
        y = table.column("y").to_numpy().astype(float)
        if net.many_to_one:
            rows = np.flatnonzero(table.column("is_label").to_numpy(zero_copy_only=False))
            if len(rows):
                if rows.min() < length:
                    raise ValueError("a labelled row has fewer rows before it than the window is long")
                window = x[rows[:, None] + np.arange(-length, 0)]
                yield Minibatch(window, y[rows], np.ones(window.shape[:2]), rows, table)
            continue
        batch = table.column("batch_id")[0].as_py()
        t = table.column("t").to_numpy() - 1
        ids, life = np.unique(table.column("id").to_numpy(), return_inverse=True)
        begin = t.min() // block * block
        rows = np.full((len(ids), t.max() + 1 - begin), -1)
        rows[life, t - begin] = np.arange(len(table))
        real = rows >= 0
        yield Minibatch(x[rows] * real[..., None], y[rows] * real, real.astype(float), rows, table, ids, batch != last)
        last = batch


def carried(state: list, ids: np.ndarray | None, now: np.ndarray, zero: list) -> list:
    """The state of the lives of the last block for those of this one; a life that begins has none yet."""
    if ids is None:
        return zero
    at = np.searchsorted(ids, now)
    known = (at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == now)
    for (h, c), (h0, c0) in zip(state, zero):
        h0[known], c0[known] = h[at[known]], c[at[known]]
    return zero
