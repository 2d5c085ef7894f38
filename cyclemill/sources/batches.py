"""Minibatch tables on disk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemill.sources.versions import Versions


def write_batches(batches: DataFrame, path: str) -> None:
    """Write minibatches (padded blocks or batch rows) by their column ``phase``, ordered by ``batch_id``.

    The phases written replace what the table held of them; others stay. The numbers of
    one batch stay together, so a filter on ``batch_id`` skips row groups.
    """
    (
        batches.repartition("phase", "batch_id")
        .sortWithinPartitions("phase", "batch_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("phase")
        .parquet(path)
    )


def publish_batches(batches: DataFrame, path: str, phases: Sequence[str]) -> None:
    """Write minibatches of these phases beside those that ``path`` has, and publish all of them in one step.

    Whoever reads meanwhile, or after a failure, finds the phases as they were before; other phases stay.
    """
    versions = Versions(batches.sparkSession, path)
    place = versions.fresh()
    write_batches(batches, place)
    versions.publish(dict.fromkeys(phases, place))
    versions.collect()


def read_batches(spark: SparkSession, path: str, phase: str, places: dict[str, str] | None = None) -> DataFrame:
    """One phase of the version that is published now, or of a table that is not published by versions.

    ``places`` is a version got before with ``Versions.current``: phases read by it belong together.
    Other phases' directories are not listed.
    """
    places = Versions(spark, path).current() if places is None else places
    return spark.read.parquet(places.get(phase, path)).where(F.col("phase") == phase).drop("phase")
