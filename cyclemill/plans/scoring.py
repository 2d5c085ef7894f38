"""Bulk scoring."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cyclemill.functions.lstm import Network, forward, zero_state
from cyclemill.operators.sequences import BLOCK_STEPS
from cyclemill.plans.tensors import carried, in_order, minibatches

PREDICTIONS = "id long, pos long, label long, prob array<double>, prediction long"


def score(rows: DataFrame, net: Network, values: np.ndarray, length: int = 50) -> DataFrame:
    """Class probabilities of every labelled row of a batch-row table.

    Batches are independent, so any number of executors can share the work. A task reads
    its rows in order and holds one minibatch of windows, or one block of steps of a
    minibatch of lives whose state it carries on. ``prob`` has one entry per class, two
    for a sigmoid.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, ids = [], None
        for b in minibatches(batches, net, length, BLOCK_STEPS):
            start = None
            if not net.many_to_one:
                start = carried(state, None if b.first else ids, b.ids, zero_state(net, len(b.ids)))
            p, state = forward(net, values, b.x, b.mask, start, keep=False)[:2]
            ids, real = b.ids, b.rows >= 0
            at, p = b.rows[real], p[real]
            if net.outputs == 1:
                p = np.concatenate([1 - p, p], axis=1)
            offsets = pa.array(np.arange(0, p.size + 1, p.shape[1], dtype=np.int32))
            out = b.table.select(["id", "pos"]).take(pa.array(at)).combine_chunks()
            label = pa.array(b.table.column("y").to_numpy()[at].astype(np.int64))
            columns = [
                *(c.combine_chunks().cast(pa.int64()) for c in out.columns),
                label,
                pa.ListArray.from_arrays(offsets, pa.array(p.astype(float).ravel())),
                pa.array(p.argmax(1).astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    schema = pa.schema(
        [(c, pa.int64()) for c in ("id", "pos", "label")]
        + [("prob", pa.list_(pa.float64())), ("prediction", pa.int64())]
    )
    # the weights travel with the function, which Spark broadcasts and cleans up if it is large
    return in_order(rows.repartition("batch_id"), net, BLOCK_STEPS).mapInArrow(predict, PREDICTIONS)
