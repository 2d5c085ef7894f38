"""Column bookkeeping: presets, positions, differences and order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

KEY_COLUMNS = ["id", "cycle"]
TARGET_COLUMNS = ["RUL", "label1", "label2"]
SETTING_COLUMNS = [f"setting{i}" for i in range(1, 4)]
SENSOR_COLUMNS = [f"s{i}" for i in range(1, 22)]

# order is part of the contract: sequences are flattened in it
WINDOW_FEATURES = [*SETTING_COLUMNS, "cycle_norm", *SENSOR_COLUMNS]
SERIES_FEATURES = ["cycle", *SETTING_COLUMNS, *SENSOR_COLUMNS]


def drop_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    return df.drop(*[df.columns[i] for i in positions])


def columns_except(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    """The other columns, in the table's own order."""
    unwanted = set(excluded)
    return [c for c in df.columns if c not in unwanted]


def reorder(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def split_features_labels(
    df: DataFrame, keys: Sequence[str] = KEY_COLUMNS, targets: Sequence[str] = TARGET_COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """Feature table (all but the targets) and label table (keys and targets)."""
    return df.drop(*targets), df.select(*keys, *targets)


def pair_features_labels(
    features: DataFrame, labels: DataFrame, keys: Sequence[str] = KEY_COLUMNS
) -> DataFrame:
    """Join the two tables again, row by row."""
    return features.join(labels, list(keys), "inner")
