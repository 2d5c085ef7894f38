"""Feature and label series on disk, one directory per bucket of entities or per entity."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemill.operators.columns import split_features_labels
from cyclemill.sizing import setting
from cyclemill.sources.versions import Versions

BUCKETS = 64


def schema_json(df: DataFrame) -> str:
    """The schema after all transforms so far, to be stored or printed."""
    return df.schema.json()


def schema_from_json(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def bucket_of(id_col: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(buckets)).cast("int")


def write_series(
    df: DataFrame,
    folder: str,
    phase: str,
    buckets: int | None = BUCKETS,
    mode: str = "errorifexists",
    segment_rows: int | None = None,
) -> None:
    """Write ``{folder}/{phase}/features`` and ``.../labels`` as CSV with a header.

    A directory holds the entities of one hash bucket, so their number does not grow
    with the fleet. For a small one ``buckets=None`` gives every entity a directory
    ``id=<n>``. A series beyond ``segment_rows`` is spread over several tasks and files.
    """
    place = "bucket" if buckets else "id"
    segment_rows = setting(df, "segmentRows", segment_rows)
    segment = F.floor((F.col("cycle") - 1) / segment_rows)
    for kind, table in zip(("features", "labels"), split_features_labels(df)):
        if buckets:
            table = table.withColumn("bucket", bucket_of("id", buckets))
        (
            table.repartition(F.col(place), segment)
            .sortWithinPartitions(place, "id", "cycle")
            .write.mode(mode)
            .option("header", True)
            .partitionBy(place)
            .csv(f"{folder}/{phase}/{kind}")
        )


def publish_series(
    df: DataFrame, folder: str, phase: str, buckets: int | None = BUCKETS, segment_rows: int | None = None
) -> None:
    """As ``write_series``, but features and labels of the phase replace those that ``folder`` has in one step."""
    versions = Versions(df.sparkSession, folder)
    place = versions.fresh()
    write_series(df, place, phase, buckets, segment_rows=segment_rows)
    versions.publish({phase: place})
    versions.collect()


def published(spark: SparkSession, folder: str, phase: str) -> str:
    """The folder that ``read_series`` reads the published version of the phase from.

    Features and labels read from one such folder belong together.
    """
    return Versions(spark, folder).current()[phase]


def read_series(
    spark: SparkSession,
    folder: str,
    phase: str,
    kind: str,
    schema: T.StructType,
    first: int | None = None,
    last: int | None = None,
    buckets: int | None = BUCKETS,
) -> DataFrame:
    """Read ``features`` or ``labels`` back with the schema of the table written.

    ``first`` and ``last`` bound the entities, both inclusive, and prune directories: of
    fewer entities than ``buckets`` only their buckets are read. ``buckets`` is that of
    the writer.
    """
    inside = [f for f in schema if buckets or f.name != "id"]
    place = T.StructField("bucket", T.IntegerType()) if buckets else schema["id"]
    reader = spark.read.schema(T.StructType([*inside, place])).option("header", True)
    table = reader.csv(f"{folder}/{phase}/{kind}")
    if buckets and first is not None and last is not None and last - first < buckets:
        ids = spark.range(first, last + 1).select(bucket_of("id", buckets).alias("b")).distinct()
        table = table.where(F.col("bucket").isin([r["b"] for r in ids.collect()]))
    table = table.select(*schema.names)
    if first is not None:
        table = table.where(F.col("id") >= first)
    if last is not None:
        table = table.where(F.col("id") <= last)
    return table


def count_series(series: DataFrame) -> DataFrame:
    """Number of entities of a series table, as one row."""
    return series.agg(F.countDistinct("id").alias("n_entities"))
