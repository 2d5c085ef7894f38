"""Exact top-k inner products by aggregation of sorted lists without random access.

Vectors are cut into blocks. In a block, every dimension is a list of its vectors
sorted by that component; for a query, a list is read from the end where its product
is largest. All lists are read in step, from depth to depth: what is newly read is added to the
running sums of its vectors. A vector's score lies between its sum with the unread components at their
worst, and its sum with them at the value their list has come to. Reading stops for a query
when few vectors have an upper bound that reaches the k-th lower bound; the sums of these are completed with their unread
components. Where the bounds have not closed at the last depth, the sums of all vectors are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclemill.llm.common import written

BLOCK = 4096
QUERY_BLOCK = 1024
DEPTHS = (1 / 64, 1 / 8)
QUERIES_AT_ONCE = 128
EXACT = 2.0**52
HALF = 62  # bits of the lower part of a score, on its way between tasks


class Lists:
    """The sorted lists of a block: for each dimension the vectors from small to large component."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, exact: bool = False):
        # whole numbers beyond those of doubles are worked on as Python's
        self.rows, self.ids, self.vectors = rows, ids, vectors.astype(object if exact else np.float64)
        self.low, self.high = self.vectors.min(axis=0), self.vectors.max(axis=0)
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.place = np.empty_like(self.order)
        np.put_along_axis(self.place, self.order, np.arange(len(ids))[:, None], axis=0)
        self.sorted = np.take_along_axis(self.vectors, self.order, axis=0)


def largest(a: np.ndarray) -> float:
    return float(np.abs(a.astype(np.float64)).max(initial=0))


def aggregate(lists: Lists, queries: np.ndarray, query_rows: np.ndarray, k: int, read: list | None = None):
    """(position of the query, vec_id, score) of the k best of the block for every query, ties to the smaller id.

    The queries run together, each with bounds and a stop of its own. A query's own row is no candidate.
    ``read`` receives the depth at which each query stopped, as a share of the block.
    """
    n, dims = lists.vectors.shape
    asked = queries.astype(lists.vectors.dtype).T
    live = np.arange(len(queries))
    # running sums: one row for each vector, one column for each query that still reads
    sums, come = np.zeros((n, len(queries)), dtype=lists.vectors.dtype), 0

    def unread(at, up, down):
        """What is left of the products of the vectors ``at``, whose lists have been read to the depth ``come``."""
        return ((lists.place[at] < n - come) * lists.vectors[at]) @ up + ((lists.place[at] >= come) * lists.vectors[at]) @ down

    for share in DEPTHS:
        depth = int(n * share)
        if depth <= max(come, k):
            continue
        # a positive weight reads its list from the top, a negative one from the bottom
        up, down = np.maximum(asked[:, live], 0), np.minimum(asked[:, live], 0)
        for j in range(dims):
            top, bottom = slice(n - depth, n - come), slice(come, depth)
            sums[lists.order[top, j]] += lists.sorted[top, j, None] * up[j]
            sums[lists.order[bottom, j]] += lists.sorted[bottom, j, None] * down[j]
        come = depth
        below, above = lists.place < n - depth, lists.place >= depth  # not yet read from the top, from the bottom
        upper = sums + (below * lists.sorted[n - depth]) @ up + (above * lists.sorted[depth - 1]) @ down
        lower = sums + (below * lists.low) @ up + (above * lists.high) @ down
        fine = lists.rows[:, None] != query_rows[live][None, :]
        stays = []
        for column, q in enumerate(live):
            at = np.flatnonzero(fine[:, column])
            if len(at) > k:
                kth = np.partition(lower[at, column], len(at) - k)[len(at) - k]
                at = at[upper[at, column] >= kth]
            if len(at) > max(4 * k, n // 64):
                stays.append(column)
                continue
            score = np.zeros(n, dtype=sums.dtype)
            score[at] = sums[at, column] + unread(at, up[:, column], down[:, column])
            yield from best(lists, q, at, score, k)
            if read is not None:
                read.append(depth / n)
        live, sums = live[stays], sums[:, stays]
        if not len(live):
            return
    sums = sums + unread(np.arange(n), np.maximum(asked[:, live], 0), np.minimum(asked[:, live], 0))
    for column, q in enumerate(live):
        yield from best(lists, q, np.flatnonzero(lists.rows != query_rows[q]), sums[:, column], k)
        if read is not None:
            read.append(1.0)


def best(lists: Lists, q: int, at: np.ndarray, scores: np.ndarray, k: int):
    score = scores[at]
    if len(at) > 8 * k:  # all that reach the k-th score, ties included
        fine = score >= np.partition(score, len(score) - k)[len(score) - k]
        at, score = at[fine], score[fine]
    for i in sorted(range(len(at)), key=lambda i: (-score[i], lists.ids[at[i]]))[:k]:
        yield int(q), int(lists.ids[at[i]]), int(score[i])


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and whole-number components; rows with a null vector, component or non-finite value are left out."""
    value = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * scale))
    fine = F.forall(F.col("embedding"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine).select("vec_id", value.alias("v"))


def matrix(column: pd.Series, dims: int) -> np.ndarray:
    """Rows as a matrix; a shorter vector has zeros where it ends."""
    made = np.zeros((len(column), dims), dtype=np.int64)
    for i, v in enumerate(column):
        made[i, :len(v)] = v
    return made


def top_inner_products(
    vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, block: int = BLOCK, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best other vectors for every vec_id divisible by ``every``.

    Queries and candidates meet block by block, so a task holds one block of each.
    Ties go to the smaller vec_id. A vector shorter than another counts as zero where it
    ends. Of rows that repeat a vec_id each is a candidate, and each a query.
    """
    clean = written(quantised(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, n_queries = clean.agg(F.count("*"), F.count_if(F.pmod("vec_id", F.lit(every)) == 0)).first()
    blocks, query_blocks = n // block + 1, n_queries // query_block + 1
    spread = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    candidates = clean.select(spread.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(int(query_blocks - 1)))).alias("part"), "row", "vec_id", "v")
    asked = clean.filter(F.pmod("vec_id", F.lit(every)) == 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(int(blocks - 1)))).alias("block"),
        F.pmod(F.xxhash64("row", F.lit(1)), F.lit(query_blocks)).cast("int").alias("part"),
        # both sides are of one table: the planner tells their columns apart by name only if these differ
        F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("v").alias("query"),
    )

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        made = []
        if len(left) and len(right):
            dims = max(left["v"].map(len).max(), right["query"].map(len).max())
            rows, ids = right["query_row"].to_numpy(), right["query_id"].to_numpy()
            held, wanted = matrix(left["v"], dims), matrix(right["query"], dims)
            exact = dims * largest(held) * largest(wanted) >= EXACT
            lists = Lists(left["row"].to_numpy(), left["vec_id"].to_numpy(), held, exact)
            for at in range(0, len(rows), QUERIES_AT_ONCE):
                for q, v, score in aggregate(lists, wanted[at:at + QUERIES_AT_ONCE], rows[at:at + QUERIES_AT_ONCE], k):
                    made.append((rows[at + q], ids[at + q], v, score >> HALF, score & ((1 << HALF) - 1)))
        return pd.DataFrame(made, columns=["query_row", "query_id", "vec_id", "high", "low"]).astype("int64")

    best = candidates.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInPandas(
        meet, "query_row long, query_id long, vec_id long, high long, low long")
    order = Window.partitionBy("query_row").orderBy(F.desc("high"), F.desc("low"), "vec_id")
    # a score beyond 64 bits comes back as the largest or the smallest number of that size
    whole = F.when(F.col("high").between(-2, 1), F.shiftleft("high", HALF) + F.col("low")).otherwise(
        F.when(F.col("high") > 0, F.lit(2**63 - 1)).otherwise(F.lit(-(2**63))))
    return best.withColumn("score", whole).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
