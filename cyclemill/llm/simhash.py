"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most ``bits`` bits share at least
``8 - bits`` of their eight positional bytes. The index therefore lists each
fingerprint under the value of its bytes at several positions at once: the
positions fall into four pairs, and any two with two bits or fewer between them
agree on two whole pairs, so they meet in one of six lists keyed by four
positional bytes. For every pair that meets, the shared positional bytes are
tallied; pairs with the guaranteed minimum are verified by their bits.

Only distinct fingerprints are indexed, so copies never meet in pairs. A list of
more than ``LIST`` fingerprints is not paired either: its members are listed once
more under each value of their other four bytes with at most one bit changed. Two
members share such a value exactly if they differ in two bits or fewer, and each is
linked to the least member of the value. That is exact, and linear in the list.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemill.llm.common import column, fresh, written, written_tidily
from cyclemill.llm.graph import components

SHINGLE = 3
BITS = 2
LIST = 64
PAIRS = ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3))
BATCH = 1 << 14


def signature(raw: bytes, size: int) -> int:
    """Bits that are set in more than half of the shingles' hashes; shingles repeat, no words give zero."""
    words = raw.lower().split()  # bytes: only A-Z change, and only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1).tolist()
    ends = ends.tolist()
    digest = xxhash.xxh64_intdigest
    size = min(size, len(words))
    total, n = np.zeros(64, dtype=np.int64), len(words) - size + 1
    for at in range(0, n, BATCH):
        stop = min(n, at + BATCH)
        hashes = np.fromiter(
            (digest(joined[a:b], 42) for a, b in zip(starts[at:stop], ends[at + size - 1:stop + size - 1])),
            dtype="<u8", count=stop - at,
        )
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n, bitorder="little").tobytes(), "little", signed=True)


def fingerprint(text: str = "text", shingle: int = SHINGLE) -> Column:
    """Signed 64-bit fingerprint of a whole text; null and empty texts give 0."""

    def kernel():
        return lambda texts: [(signature(raw, shingle),) for raw in texts]

    return column(kernel, "fp bigint", text)["fp"]


def byte_pair(fp, k: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))


def posting_keys() -> Column:
    """The six list keys of a fingerprint: which two pairs of positions, and their bytes."""
    fp = F.col("fp")
    return F.array(*[
        F.struct(F.lit(i).alias("places"), (F.shiftleft(byte_pair(fp, a), 16) + byte_pair(fp, b)).alias("bytes"))
        for i, (a, b) in enumerate(PAIRS)
    ])


def rest(fp) -> Column:
    """The 32 bits outside a posting's key, as the other two byte pairs."""
    made = None
    for i, own in enumerate(PAIRS):
        c, d = [k for k in range(4) if k not in own]
        value = F.shiftleft(byte_pair(fp, c), 16) + byte_pair(fp, d)
        made = F.when(F.col("places") == i, value) if made is None else made.when(F.col("places") == i, value)
    return made


def shared_bytes(a, b) -> Column:
    """How many of the eight positional bytes are equal."""
    x = F.col(a).bitwiseXOR(F.col(b))
    return sum(
        (F.shiftrightunsigned(x, 8 * k).bitwiseAND(F.lit(0xFF)) == 0).cast("int") for k in range(8)
    )


def links(fingerprints: DataFrame, list_size: int = LIST) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp) whose closure is that of all pairs within two bits."""
    listed = fingerprints.select("fp", F.explode(posting_keys()).alias("k")).select("fp", "k.places", "k.bytes")
    listed = written(listed, "postings")
    sizes = listed.groupBy("places", "bytes").agg(F.count("*").alias("n")).filter("n > 1")
    met = listed.join(sizes, ["places", "bytes"])
    met = written(met, "lists")
    short = met.filter(F.col("n") <= list_size)
    other = short.select("places", "bytes", F.col("fp").alias("other"))
    tallied = (
        short.join(other, ["places", "bytes"]).filter("fp > other")
        .withColumn("tally", shared_bytes("fp", "other")).filter(F.col("tally") >= 8 - BITS)
    )
    verified = tallied.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= BITS)
    changed = F.array(*[F.lit(0 if k < 0 else 1 << k).cast("long") for k in range(-1, 32)])
    long_ = (
        met.filter(F.col("n") > list_size)
        .select("places", "bytes", "fp", rest(F.col("fp")).alias("rest"))
        .select("places", "bytes", "fp", F.explode(F.transform(changed, lambda c: F.col("rest").bitwiseXOR(c))).alias("value"))
    )
    least = long_.groupBy("places", "bytes", "value").agg(F.min("fp").alias("other"), F.count("*").alias("n")).filter("n > 1")
    starred = long_.join(least, ["places", "bytes", "value"]).filter("fp != other")
    return verified.select(F.col("fp").alias("a"), F.col("other").alias("b")).unionByName(
        starred.select(F.col("fp").alias("a"), F.col("other").alias("b"))).distinct()


def grouped(signed: DataFrame, list_size: int = LIST) -> DataFrame:
    """(fp, root) for the fingerprints of a table with a column fp that have any link to another one."""
    return components(links(signed.select("fp").distinct(), list_size))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, list_size: int = LIST) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id reachable over fingerprints within two bits.

    Every row is returned, repeated rows too. Rows without any word have fingerprint 0
    and are linked like others. A component whose doc_ids are all null has a null id.
    """
    signed = written(docs.select("doc_id", fingerprint("text", shingle).alias("fp")), "fingerprints")
    own = signed.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = written(own.join(grouped(signed, list_size).withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(ids, "root").select("fp", "component_id")
    return signed.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, list_size: int = LIST) -> DataFrame:
    """The rows of ``docs`` with one row of each group of ``near_duplicates``: that of the smallest doc_id.

    If that doc_id is repeated, any one of its rows stays; rows without a doc_id stay only where their group has no other. Rows without any
    word have fingerprint 0 and are one group with what lies within two bits of it. An empty table stays empty.
    """
    fp, row = fresh("fp"), fresh("row")
    signed = written_tidily(
        docs.withColumns({fp: fingerprint("text", shingle), row: F.monotonically_increasing_id()}), "signed")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col(row).alias("row"))
    own = written_tidily(signed.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("first")), "nodes")
    nodes = own.join(grouped(own, list_size).withColumnRenamed("node", "fp"), "fp", "left")
    kept = nodes.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    return signed.join(kept.select(F.col("first.row").alias(row)), row, "left_semi").select(*docs.columns)
