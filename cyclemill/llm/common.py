"""What the operators share: whole texts in bounded slices, worker-side caches, tables in the shared folder."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fresh(name: str) -> str:
    """A column name that no table of a user has."""
    return f"__{name}_{uuid.uuid4().hex[:12]}"


def slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """Cut a batch into runs of whole texts of about ``limit`` bytes; a longer text is a run of its own.

    Yields (position of the first text, texts as bytes); a null text is empty.
    """
    at, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = b"" if not text.is_valid else text.as_buffer().to_pybytes()
        if held and size + len(raw) > limit:
            yield at, held
            at, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield at, held


def column(kernel, kind: str, name: str = "text") -> Column:
    """A struct column computed from the text column ``name``, slice by slice.

    ``kernel()`` is called once in a task and returns a function from a list of
    byte strings to a list of as many tuples, in the order of the struct's fields.
    """
    schema = _parse_datatype_string(kind)
    arrow = to_arrow_type(schema)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = kernel()
        for texts in batches:
            made = [row for _, raw in slices(texts) for row in work(raw)]
            columns = zip(*made) if made else [[] for _ in arrow]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow)]
            yield pa.StructArray.from_arrays(arrays, fields=list(arrow))

    return F.arrow_udf(run, schema)(F.col(f"`{name}`"))


def per_worker(key, build):
    """The value of ``build()``, kept for the life of a Python worker."""
    held = sys.modules.setdefault("_cyclemill_worker", types.ModuleType("_cyclemill_worker")).__dict__
    if key not in held:
        held[key] = build()
    return held[key]


def shared(spark: SparkSession, purpose: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``; a local session may go without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # the setting itself cannot be changed in a running session
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cyclemill-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str, codec: str | None = None, group_rows: int | None = None) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe from lost executors.

    Readers decode a row group at once, so a table of large rows is written with few rows in a group (``group_rows``).
    """
    spark = df.sparkSession
    path = shared(spark, purpose)
    options = {} if group_rows is None else {"parquet.block.row.count.limit": group_rows}
    df.write.options(**options).parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def written_tidily(
    df: DataFrame, purpose: str, codec: str | None = None, group_rows: int | None = None, batch_bytes: int | None = None
) -> DataFrame:
    """As ``written``; the shuffle files of the write are removed at its end, which no later plan reads.

    Rows go to Python in batches of some ``batch_bytes``, if given; a larger row is a batch of its own.
    """
    conf = df.sparkSession.conf
    wanted = {TIDY: "true"} if batch_bytes is None else {TIDY: "true", BATCH: str(batch_bytes)}
    before = {key: conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        conf.set(key, value)
    try:
        return written(df, purpose, codec, group_rows)
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def removed(df: DataFrame) -> None:
    """Delete a written table that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def segments(counts: np.ndarray) -> np.ndarray:
    """Where each of the runs of so many items starts, with the end of the last."""
    return np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
