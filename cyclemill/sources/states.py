"""Mergeable states on disk: one part for each run, day or delivery, replaced when it comes again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def put_part(state: DataFrame, path: str, part: str) -> None:
    """Store a state under the name of its part.

    A part that comes again, say of a job that was repeated, replaces itself and is not counted twice.
    """
    (
        state.withColumn("part", F.lit(part))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("part")
        .parquet(path)
    )


def read_parts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The states of all parts. ``schema`` is that of the state; the name of the part is a string."""
    return spark.read.schema(f"{schema}, part string").parquet(path)
