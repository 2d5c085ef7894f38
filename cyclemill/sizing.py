"""Choosing a plan by measured size.

The bounds are session settings, so a cluster can tune them without code, and a
test can make small data take the plans meant for large data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SETTINGS = {
    # rows of one group that a single task may sort and number
    "spark.cyclemill.rowsPerTask": 1 << 20,
    # rows of one series that a single task may cut into windows
    "spark.cyclemill.segmentRows": 1 << 16,
    # rows of a narrow table that may be broadcast
    "spark.cyclemill.broadcastRows": 500_000,
    # bytes of all workers' parameters together that may be averaged on the driver
    "spark.cyclemill.driverBytes": 64 << 20,
}


def setting(df: DataFrame, name: str, given: int | None = None) -> int:
    """The value given, else the session's, else the default."""
    if given is not None:
        return given
    key = f"spark.cyclemill.{name}"
    return int(df.sparkSession.conf.get(key, str(SETTINGS[key])))


def small_side(df: DataFrame, known_rows: int | None = None, max_rows: int | None = None) -> DataFrame:
    """Mark a narrow table for broadcast if it was counted to be small.

    ``known_rows`` saves the count where an upper bound is at hand. Above the bound
    the table comes back as it is, for a shuffled join in which adaptive execution
    splits a skewed key.
    """
    bound = setting(df, "broadcastRows", max_rows)
    rows = df.limit(bound + 1).count() if known_rows is None else known_rows
    return F.broadcast(df) if rows <= bound else df
