"""Standardisation with statistics fitted on one table and applied to any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemill.functions.expressions import z_score
from cyclemill.sizing import small_side


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row holding ``{mean, std, low, high}`` per column; ``std`` divides by n."""
    return df.agg(
        *[
            F.struct(
                F.avg(c).alias("mean"),
                F.stddev_pop(c).alias("std"),
                F.min(c).cast("double").alias("low"),
                F.max(c).cast("double").alias("high"),
            ).alias(c)
            for c in columns
        ]
    )


def scaler_table(stats: DataFrame) -> DataFrame:
    """The fitted row as ``(feature, mean, std, low, high)`` rows."""
    parts = ("mean", "std", "low", "high")
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), *[F.col(f"`{c}`").getField(p).alias(p) for p in parts])
            for c in stats.columns
        ]
    )
    return stats.select(F.inline(entries))


STATE = "feature string, n long, mean double, off double, m2 double, low double, high double"


def scaler_state(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What ``merge_scaler_states`` needs of some rows: count, mean, centred squares, least and greatest of each column.

    Nulls do not count. A column without values has a count of 0 and nulls. The mean is also kept as its distance
    ``off`` from the least value, of which the values are read as distances: a large offset costs no digits.
    """
    least = df.agg(*[F.min(c).cast("double").alias(f"_low_{i}") for i, c in enumerate(columns)])
    near = [(F.col(c).cast("double") - F.col(f"_low_{i}")).alias(f"_off_{i}") for i, c in enumerate(columns)]
    both = df.select(*columns).crossJoin(F.broadcast(least))  # one row
    one = both.select(*[f"_low_{i}" for i in range(len(columns))], *near).agg(
        *[
            F.struct(
                F.count(f"_off_{i}").alias("n"),
                F.avg(f"_off_{i}").alias("off"),
                (F.var_pop(f"_off_{i}") * F.count(f"_off_{i}")).alias("m2"),
                F.min(f"_low_{i}").alias("low"),
                (F.min(f"_low_{i}") + F.max(f"_off_{i}")).alias("high"),
            ).alias(f"_{i}")
            for i in range(len(columns))
        ]
    )
    entries = [
        F.struct(
            F.lit(c).alias("feature"), F.col(f"_{i}.n").alias("n"), (F.col(f"_{i}.low") + F.col(f"_{i}.off")).alias("mean"),
            *[F.col(f"_{i}.{p}").alias(p) for p in ("off", "m2", "low", "high")],
        )
        for i, c in enumerate(columns)
    ]
    return one.select(F.inline(F.array(*entries)))


def merge_scaler_states(states: DataFrame) -> DataFrame:
    """One state per feature from any number of them, as if it had been taken of all rows at once.

    Means are added up as distances from the least value of all, squares as those within the states and between
    their means.
    """
    some = states.where("n > 0")
    least = some.groupBy("feature").agg(F.min("low").alias("_at"))
    placed = some.join(small_side(least), "feature").withColumn("_off", F.col("low") - F.col("_at") + F.col("off"))
    means = placed.groupBy("feature").agg((F.sum(F.col("n") * F.col("_off")) / F.sum("n")).alias("_mean"))
    apart = F.col("_off") - F.col("_mean")
    merged = placed.join(small_side(means), "feature").groupBy("feature", "_at", "_mean").agg(
        F.sum("n").alias("n"), F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"), F.max("high").alias("high")
    )
    return merged.select(
        "feature", "n", (F.col("_at") + F.col("_mean")).alias("mean"), F.col("_mean").alias("off"), "m2", F.col("_at").alias("low"), "high")


def scaler_of_state(state: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The row that ``apply_scaler`` takes, from a merged state; a feature without values has nulls."""
    entry = F.struct("mean", F.sqrt(F.col("m2") / F.col("n")).alias("std"), "low", "high")
    return state.agg(*[F.max(F.when(F.col("feature") == c, entry)).alias(c) for c in columns])


def apply_scaler(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Standardise the fitted columns in place; ``stats`` is always exactly one row."""
    fitted = stats.columns
    side = stats.withColumnsRenamed({c: f"_stats_{c}" for c in fitted})
    joined = df.crossJoin(F.broadcast(side))

    def scaled(c):
        s = F.col(f"`_stats_{c}`")
        return z_score(c, *[s.getField(part) for part in ("mean", "std", "low", "high")]).alias(c)

    return joined.select(*[scaled(c) if c in fitted else F.col(c) for c in df.columns])


def with_cycle_feature(df: DataFrame, cycle_col: str = "cycle") -> DataFrame:
    """Copy the cycle into ``cycle_norm``, the copy that is standardised."""
    return df.withColumn("cycle_norm", F.col(cycle_col).cast("double"))
