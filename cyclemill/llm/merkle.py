"""Merkle manifest of a table, with proofs by octopus multiproofs.

Rows are leaves of one tree per group; eight consecutive nodes become one, until a
subroot remains. The subroots of all groups, in the order of their names, are the leaves of
a last tree, whose root stands for the table.

Trees grow in blocks of ``SPAN`` leaves: a task hashes the four levels of its block, and the
blocks' roots are the leaves of the next pass. A proof needs the siblings of every node from
leaf to root. They are not looked up leaf by leaf: a block of leaves computes the least set of
nodes that its own leaves cannot derive, fetches these once, derives the interiors that its
leaves share, and writes out each leaf's proof from them.

Repeated rows are leaves of their own, side by side. Null ids come first. A null group comes
before all others. An empty table has no root and no proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemill.llm.common import written
from cyclemill.operators.ordering import measure, number_rows

FANOUT = 8
LEVELS = 4
SPAN = FANOUT**LEVELS
ROWS_PER_TASK = 1 << 13
TOP = ""  # the tree of subroots; others are "-" (null) or "=" and the name, which sorts as names do
FIRST = -(1 << 63)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field_text(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    own = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(own).cast("string"), F.lit(":"), own), F.lit("-"))


def record_hash(*values: Column) -> Column:
    """Lowercase hex sha256 of a row's fields."""
    return F.sha2(F.concat(*map(field_text, values)), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def sizes(n: int) -> list[int]:
    """Number of nodes on every level of a tree of n leaves, up to the one that remains."""
    made = [n]
    while made[-1] > 1:
        made.append(-(-made[-1] // FANOUT))
    return made


def missing(positions: np.ndarray, n: int) -> list[tuple[int, int]]:
    """(level, position) of the nodes that the leaves at ``positions`` cannot derive but their proofs need."""
    found, own = [], np.unique(positions)
    for level, size in enumerate(sizes(n)[:-1]):
        runs = np.unique(own // FANOUT)
        every = (runs[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        lacking = np.setdiff1d(every[every < size], own, assume_unique=True)
        found += [(level, p) for p in lacking.tolist()]
        own = runs
    return found


def derived(known: dict[tuple[int, int], str], positions: Sequence[int], n: int) -> dict[tuple[int, int], str]:
    """``known`` with all nodes over the leaves at ``positions``."""
    own = sorted(set(positions))
    for level, size in enumerate(sizes(n)[:-1]):
        own = sorted({p // FANOUT for p in own})
        for run in own:
            known[level + 1, run] = digest([known[level, p] for p in range(run * FANOUT, min(run * FANOUT + FANOUT, size))])
    return known


def siblings(known: dict, position: int, n: int, shared: dict) -> list[str]:
    """The other nodes of the run of a leaf and of every node over it; ``shared`` holds those of nodes done before."""
    every = sizes(n)

    def path(level: int, at: int) -> list[str]:
        if level == len(every) - 1:
            return []
        if (level, at) not in shared:
            run = at // FANOUT * FANOUT
            own = [known[level, p] for p in range(run, min(run + FANOUT, every[level])) if p != at]
            shared[level, at] = own + path(level + 1, at // FANOUT)
        return shared[level, at]

    return path(0, position)


def folded(leaf: str, position: int, n: int, proof: Sequence[str]) -> tuple[str, int]:
    """What a leaf and its proof come to, and how many siblings that took."""
    used, now = 0, leaf
    for size in sizes(n)[:-1]:
        run = position // FANOUT * FANOUT
        others = min(FANOUT, size - run) - 1
        own = list(proof[used:used + others])
        own.insert(position - run, now)
        now, used, position = digest(own), used + others, position // FANOUT
    return now, used


def verify(leaf: str, position: int, n: int, top_position: int, n_top: int, proof: Sequence[str]) -> str:
    """The root that a leaf and its whole proof come to."""
    subroot, used = folded(leaf, position, n, proof)
    return folded(subroot, top_position, n_top, proof[used:])[0]


def grown(block: pa.Table) -> pa.Table:
    """The nodes over one block of a level: up to ``LEVELS`` levels, or until one node remains."""
    order = np.argsort(block["pos"].to_numpy(), kind="stable")
    now = np.array(block["hash"].to_pylist(), dtype=object)[order].tolist()
    tree, base, first, size = (block[c][0].as_py() for c in ("tree", "level", "block", "size"))
    first, rows = first * SPAN, []
    for level in range(base + 1, base + LEVELS + 1):
        if size == 1:
            break
        now = [digest(now[i:i + FANOUT]) for i in range(0, len(now), FANOUT)]
        first, size = first // FANOUT, -(-size // FANOUT)
        rows += [(tree, level, first + i, h, size) for i, h in enumerate(now)]
    columns = zip(*rows) if rows else [[]] * 5
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["tree", "level", "pos", "hash", "size"])


NODE = "tree string, level int, pos long, hash string, size long"


def grow(leaves: DataFrame) -> DataFrame:
    """All nodes (tree, level, pos, hash, size: nodes of that level) over leaves (tree, pos, hash, size)."""
    now, made, level = leaves.select("tree", F.lit(0).alias("level"), "pos", "hash", "size"), None, 0
    most = leaves.agg(F.max("size")).first()[0] or 0
    while most > 1:
        blocks = now.withColumn("block", F.expr(f"pos div {SPAN}"))
        above = written(blocks.groupBy("tree", "block").applyInArrow(grown, NODE), "nodes")
        made = above if made is None else made.unionByName(above)
        level, most = level + LEVELS, -(-most // SPAN)
        now = above.filter((F.col("level") == level) & (F.col("size") > 1))
    return leaves.sparkSession.createDataFrame([], NODE) if made is None else made


@dataclass(frozen=True)
class Manifest:
    """Leaves (tree, pos, size, leaf and the columns carried), interior nodes, and trees (tree, top_pos, n_top, subroot)."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: str | None

    def proofs(self, wanted: DataFrame | None = None, claimed: str = "leaf") -> DataFrame:
        """For every leaf, or those of ``wanted`` (rows of ``leaves``): subroot, siblings, and what ``claimed`` comes to.

        ``siblings`` go from the leaf's level to the root, left to right; ``folded`` is the root that the
        hash in the column ``claimed`` gives with them.
        """
        own = (self.leaves if wanted is None else wanted).withColumn("block", F.expr(f"pos div {SPAN}"))
        lacking = own.select("tree", "block", "pos", "size").groupBy("tree", "block").applyInArrow(
            requests, "tree string, block long, of string, level int, pos long")
        blocks = own.select("tree", "block").distinct().join(self.trees.select("tree", "top_pos", "n_top"), "tree")
        tops = blocks.groupBy("tree", "block").applyInArrow(
            top_requests, "tree string, block long, of string, level int, pos long")
        asked = written(lacking.unionByName(tops), "requests")
        least = asked.agg(F.min("level")).first()[0]
        below = self.nodes.select("tree", "level", "pos", "hash")
        if least == 0:  # leaves and subroots themselves are asked for
            below = below.unionByName(self.leaves.select("tree", F.lit(0).alias("level"), "pos", F.col("leaf").alias("hash")))
            below = below.unionByName(self.trees.select(
                F.lit(TOP).alias("tree"), F.lit(0).alias("level"), F.col("top_pos").alias("pos"), F.col("subroot").alias("hash")))
        fetched = asked.join(below.withColumnRenamed("tree", "of"), ["of", "level", "pos"])
        place = blocks.select("tree", "block", F.lit(TOP).alias("of"), F.lit(-1).alias("level"), F.col("top_pos").alias("pos"),
                              F.col("n_top").cast("string").alias("hash"))
        known = fetched.select(*place.columns).unionByName(place)
        schema = own.drop("block").schema.simpleString()[len("struct<"):-1]
        return own.groupBy("tree", "block").cogroup(known.groupBy("tree", "block")).applyInArrow(
            expander(claimed), f"{schema},subroot:string,siblings:array<string>,folded:string")


def requests(block: pa.Table) -> pa.Table:
    """The nodes of its own tree that a block of leaves has to fetch."""
    tree, number, n = (block[c][0].as_py() for c in ("tree", "block", "size"))
    return asked_rows(tree, number, tree, missing(block["pos"].to_numpy(), n))


def top_requests(block: pa.Table) -> pa.Table:
    """The nodes of the tree of subroots that a block of leaves has to fetch."""
    tree, number, at, n = (block[c][0].as_py() for c in ("tree", "block", "top_pos", "n_top"))
    return asked_rows(tree, number, TOP, missing(np.array([at]), n))


def asked_rows(tree: str, block: int, of: str, places: list[tuple[int, int]]) -> pa.Table:
    n = len(places)
    levels, positions = zip(*places) if places else ((), ())
    return pa.table({
        "tree": pa.array([tree] * n, pa.string()), "block": pa.array([block] * n, pa.int64()), "of": pa.array([of] * n, pa.string()),
        "level": pa.array(levels, pa.int32()), "pos": pa.array(positions, pa.int64()),
    })


def expander(claimed: str):
    def expand(own: pa.Table, fetched: pa.Table) -> pa.Table:
        """The proofs of one block of leaves from its own hashes and the nodes fetched for it."""
        tree, n = own["tree"][0].as_py(), own["size"][0].as_py()
        positions, leaves, claims = (own[c].to_pylist() for c in ("pos", "leaf", claimed))
        known, top = {(0, p): h for p, h in zip(positions, leaves)}, {}
        at = n_top = None
        for of, level, p, h in zip(*(fetched[c].to_pylist() for c in ("of", "level", "pos", "hash"))):
            if level < 0:
                at, n_top = p, int(h)
            else:
                (known if of == tree else top)[level, p] = h
        derived(known, positions, n)
        subroot = known[len(sizes(n)) - 1, 0]
        top[0, at] = subroot
        derived(top, [at], n_top)
        over, shared = siblings(top, at, n_top, {}), {}
        proofs = [siblings(known, p, n, shared) + over for p in positions]
        roots = [verify(c, p, n, at, n_top, s) for c, p, s in zip(claims, positions, proofs)]
        return own.drop_columns("block").append_column("subroot", pa.array([subroot] * len(own), pa.string())).append_column(
            "siblings", pa.array(proofs, pa.list_(pa.string()))).append_column("folded", pa.array(roots, pa.string()))

    return expand


def manifest(rows: DataFrame, group: str, order: str, leaf: str = "leaf", rows_per_task: int = ROWS_PER_TASK) -> Manifest:
    """The trees over ``rows``: one per value of ``group``, its leaves by ``order`` (whole numbers) and then by hash."""
    tree = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("-"))
    carried = [c for c in rows.columns if c != leaf]
    plain = written(rows.select(
        tree.alias("tree"), F.coalesce(F.col(order).cast("long"), F.lit(FIRST)).alias("_order"), F.col(leaf).alias("leaf"),
        F.struct(*carried).alias("carried")), "leaves")
    extent = measure(plain, ["tree"])
    numbered = number_rows(plain, ["tree"], ["_order", "leaf"], "pos", "size", extent, rows_per_task)
    leaves = written(numbered.select("tree", (F.col("pos") - 1).alias("pos"), "size", "leaf", "carried"), "leaves")
    nodes = grow(leaves.select("tree", "pos", F.col("leaf").alias("hash"), "size"))
    ends = nodes.filter("size = 1").select("tree", F.col("hash").alias("subroot")).unionByName(
        leaves.filter("size = 1").select("tree", F.col("leaf").alias("subroot")))
    trees = written(number_rows(ends, [], ["tree"], "top_pos", "n_top", extent.as_one_group, rows_per_task)
                    .select("tree", "subroot", (F.col("top_pos") - 1).alias("top_pos"), "n_top"), "trees")
    over = grow(trees.select(F.lit(TOP).alias("tree"), F.col("top_pos").alias("pos"), F.col("subroot").alias("hash"),
                             F.col("n_top").alias("size")))
    root = over.filter("size = 1").select("hash").union(trees.filter("n_top = 1").select("subroot")).first()
    return Manifest(leaves, nodes.unionByName(over), trees, root and root[0])
