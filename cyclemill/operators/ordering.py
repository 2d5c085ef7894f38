"""Positions and running totals in an ordered group, whatever the group's size.

A plain ``Window.partitionBy(id)`` puts a whole group into one task. That is the
cheapest plan as long as every group is small, and it cannot work when one
group holds a third of the table. ``running_totals`` therefore measures the
largest group first (one pre-aggregated count) and only then picks a plan:

* every group fits a task: one exchange on the group key, one window;
* some do not: those groups are cut along the order columns into slices, the
  window runs per (group, slice), and each slice adds the total of the slices
  before it. The rows are still exchanged once.

A group counts as oversized above ``limit = max(rows_per_task, rows / HOT_GROUPS)``,
so there are fewer than ``HOT_GROUPS`` of them and fewer than
``(SLICES_PER_LIMIT + 3) * HOT_GROUPS`` slices for each cut, however large the
table is. That bound is what makes their tables safe to collect and broadcast.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemill.functions.expressions import bind
from cyclemill.sizing import setting

HOT_GROUPS = 1 << 14
SLICES_PER_LIMIT = 4
MAX_PIECES = 64
QUANTILE_ACCURACY = 1000
LARGEST_DOUBLE = 1.7976931348623157e308

AXIS = T.StructField("_axis", T.IntegerType())
HIGH = T.StructField("_hi", T.DoubleType())


@dataclass(frozen=True)
class Extent:
    """Row count of a table, row count of its largest group, and number of groups."""

    rows: int
    longest: int
    groups: int

    @property
    def as_one_group(self) -> Extent:
        """Extent of a table that has one row per group, ordered as a whole."""
        return Extent(self.groups, self.groups, 1)


def measure(df: DataFrame, by: Sequence[str]) -> Extent:
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(
        F.sum("n").alias("rows"), F.max("n").alias("longest"), F.count(F.lit(1)).alias("groups")
    ).first()
    return Extent(row["rows"] or 0, row["longest"] or 0, row["groups"])


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    running: Mapping[str, Column],
    overall: Mapping[str, Column] | None = None,
    extent: Extent | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add inclusive running sums (``running``) and whole-group sums (``overall``).

    ``order`` names ascending numeric, string, date or timestamp columns that together
    are unique within a group. ``by`` may be empty: the table is then one group.
    ``extent`` saves the measuring pass where the sizes are known; an upper bound will do.
    """
    overall = dict(overall or {})
    extent = extent or measure(df, by)
    rows_per_task = setting(df, "rowsPerTask", rows_per_task)
    if extent.longest <= rows_per_task:
        return _window_totals(df, by, order, running, overall)

    limit = max(rows_per_task, math.ceil(extent.rows / HOT_GROUPS))
    sliced, slices = _cut_hot_groups(df, by, order, limit)
    keys = [*by, *slices]

    sums = {**{f"_r_{k}": v for k, v in running.items()}, **{f"_o_{k}": v for k, v in overall.items()}}
    per_slice = (
        sliced.where("_hot").groupBy(*keys).agg(*[F.sum(v).alias(k) for k, v in sums.items()])
    )
    # one group's slices are bounded (see above), so these windows stay small
    earlier = Window.partitionBy(*by).orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = per_slice.select(
        *keys,
        *[F.coalesce(F.sum(f"_r_{k}").over(earlier), F.lit(0)).alias(f"_before_{k}") for k in running],
        *[F.sum(f"_o_{k}").over(whole).alias(f"_whole_{k}") for k in overall],
    )
    joined = _null_safe_join(sliced, offsets, keys)
    out = _window_totals(joined, keys, order, running, overall)
    fixed = {k: F.col(k) + F.coalesce(f"_before_{k}", F.lit(0)) for k in running}
    fixed |= {k: F.coalesce(f"_whole_{k}", k) for k in overall}
    return out.withColumns(fixed).select(*df.columns, *fixed)


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    name: str = "cycle",
    length: str | None = None,
    extent: Extent | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Dense 1-based position in each group, and the group's row count if ``length`` is given."""
    one = F.lit(1).cast("long")
    overall = {length: one} if length else {}
    extent = extent or measure(df, by)
    if extent.longest <= setting(df, "rowsPerTask", rows_per_task):
        # row_number lets Spark turn a filter on the position into a limit before the exchange
        position = F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")
        whole = {k: F.sum(v).over(Window.partitionBy(*by)) for k, v in overall.items()}
        return df.withColumns({name: position, **whole})
    return running_totals(df, by, order, {name: one}, overall, extent, rows_per_task)


def _window_totals(df, by, order, running, overall):
    so_far = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    return df.withColumns(
        {k: F.sum(v).over(so_far) for k, v in running.items()}
        | {k: F.sum(v).over(whole) for k, v in overall.items()}
    )


def _cut_hot_groups(df, by, order, limit):
    """Add slice columns that split every group above ``limit`` rows, in order.

    Each pass cuts a group at quantiles of the first part of its order columns that varies.
    What is still too large afterwards (quantiles are approximate, and a pass makes
    at most ``MAX_PIECES`` slices) is cut again by the next pass, until only rows that
    tie in all order columns are left together.
    """
    spark = df.sparkSession
    axes = _axes(df, order)
    slices: list[str] = []
    df = df.withColumn("_hot", F.lit(False))
    for level in itertools.count():  # every pass cuts each crowded group in two at least
        keys = [*by, *slices]
        key_fields = [df.schema[k] for k in keys]
        chosen = [c for c in map(_choose_axis, _crowded_groups(df, keys, axes, limit)) if c]
        if not chosen:
            break
        axis_table = spark.createDataFrame(
            [(*[row[k] for k in keys], axis, lo, hi) for row, axis, lo, hi in chosen],
            T.StructType([*key_fields, AXIS, T.StructField("_lo", T.DoubleType()), HIGH]),
        )
        bounds_table = spark.createDataFrame(
            _quantile_bounds(_null_safe_join(df, axis_table, keys), keys, axes, limit),
            T.StructType([*key_fields, AXIS, HIGH, T.StructField("_bounds", T.ArrayType(T.DoubleType()))]),
        )
        df = _null_safe_join(df, bounds_table, keys)
        name = f"_slice{level}"
        df = df.withColumns(
            {name: _slice_number(_on_axis(axes)), "_hot": F.col("_hot") | F.col("_axis").isNotNull()}
        ).drop("_axis", "_hi", "_bounds")
        slices.append(name)
    if not slices:
        df = df.withColumn("_slice0", F.lit(0))
        slices = ["_slice0"]
    return df, slices


def _crowded_groups(df, keys, axes, limit):
    """Groups above the limit with the range of each order column (bounded: see the module text)."""
    ranges = []
    for i, axis in enumerate(axes):
        ranges += [
            F.min(_finite(axis)).alias(f"_lo{i}"),
            F.max(_finite(axis)).alias(f"_hi{i}"),
            F.count(axis).alias(f"_known{i}"),
            F.coalesce(F.max(F.abs(axis) > LARGEST_DOUBLE), F.lit(False)).alias(f"_odd{i}"),
        ]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *ranges)
    return groups.where(F.col("_n") > limit).collect()


def _choose_axis(row):
    """The first axis that varies in the group, with its range; none if all its rows tie."""
    axis = 0
    while f"_lo{axis}" in row:
        lo, hi = row[f"_lo{axis}"], row[f"_hi{axis}"]
        has_null = 0 < row[f"_known{axis}"] < row["_n"]
        if lo is not None and (lo < hi or has_null):
            return row, axis, lo, hi
        if row[f"_odd{axis}"]:  # infinite or no number: sorted last or first, but not cut apart
            return None
        axis += 1
    return None


def _quantile_bounds(df, keys, axes, limit):
    """(keys, axis, high, bounds) of the crowded groups; their rows are only sketched, not moved.

    The lowest value is always a bound: a value that most rows share gets a slice of its own.
    """
    hot = df.where(F.col("_axis").isNotNull()).withColumn("_v", _finite(_on_axis(axes)))
    sketches = hot.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.first("_axis").alias("_axis"),
        F.first("_lo").alias("_lo"),
        F.first("_hi").alias("_hi"),
        F.percentile_approx("_v", [i / MAX_PIECES for i in range(1, MAX_PIECES)], F.lit(QUANTILE_ACCURACY)).alias(
            "_quantiles"
        ),
    )
    rows = []
    for r in sketches.collect():
        pieces = min(MAX_PIECES, math.ceil(SLICES_PER_LIMIT * r["_n"] / limit))
        picked = {r["_quantiles"][MAX_PIECES * i // pieces - 1] for i in range(1, pieces)}
        bounds = sorted(picked | {r["_lo"]})
        rows.append((*[r[k] for k in keys], r["_axis"], r["_hi"], bounds))
    return rows


def _finite(axis: Column) -> Column:
    return F.when(F.abs(axis) <= LARGEST_DOUBLE, axis)


def _on_axis(axes) -> Column:
    """The order column that the group's ``_axis`` points to; NULL for groups that are not cut."""
    none = F.lit(None).cast("double")
    return reduce(lambda acc, i: F.when(F.col("_axis") == i, axes[i]).otherwise(acc), range(len(axes)), none)


def _slice_number(value: Column) -> Column:
    """0 for NULL, which sorts first, then 1 + number of bounds below; 0 in groups that are not cut."""
    below = bind(F.least(value, F.col("_hi")), lambda v: F.size(F.filter("_bounds", lambda b: b < v)))
    return F.when(value.isNull(), 0).otherwise(below + 1).cast("int")


def _digits(df: DataFrame, name: str, octets: int) -> list[Column]:
    """Doubles that sort, one after another, as the column does, and tell all its values apart.

    A whole number of more bits than a double has gives its high and its low half; a
    string gives its bytes, six at a time, and its length.
    """
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.StringType):
        raw = F.encode(col, "UTF-8")
        parts = [
            F.conv(F.rpad(F.hex(F.substring(raw, at, 6)), 12, "0"), 16, 10).cast("double")
            for at in range(1, octets + 1, 6)
        ]
        return [*parts, F.octet_length(col).cast("double")]
    if isinstance(kind, T.TimestampType):
        col = F.unix_micros(col)
    elif isinstance(kind, T.TimestampNTZType):
        # by way of an interval, because a cast to TIMESTAMP would jump at daylight-saving changes
        since = F.expr(f"`{name}` - timestamp_ntz'1970-01-01 00:00:00'")
        col = (since.cast("interval second").cast("decimal(18,6)") * 1_000_000).cast("long")
    elif isinstance(kind, T.DecimalType):
        whole = F.floor(col)
        high = F.floor(whole / (1 << 40))
        return [high.cast("double"), (whole - high * (1 << 40)).cast("double"), ((col - whole) * (1 << 20)).cast("double")]
    elif isinstance(kind, T.DateType):
        col = F.unix_date(col)
    elif not isinstance(kind, T.LongType):
        return [col.cast("double")]
    return [F.shiftright(col.cast("long"), 32).cast("double"), col.cast("long").bitwiseAND(F.lit((1 << 32) - 1)).cast("double")]


def _axes(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """The order columns as doubles, the first of them first."""
    texts = [c for c in order if isinstance(df.schema[c].dataType, T.StringType)]
    octets = {}
    if texts:
        row = df.agg(*[F.max(F.octet_length(c)).alias(c) for c in texts]).first()
        octets = {c: row[c] or 0 for c in texts}
    return [axis for c in order for axis in _digits(df, c, octets.get(c, 0))]


def _null_safe_join(df, bounded, keys):
    """Left join with a broadcast table whose row count is bounded by this module."""
    if not keys:
        return df.join(F.broadcast(bounded), how="left")
    renamed = bounded.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.join(F.broadcast(renamed), on, "left").drop(*[f"_k_{k}" for k in keys])
