"""Column expressions. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    An expression used inside a higher-order function is otherwise evaluated again
    for every array element.
    """
    return F.transform(F.array(value), body)[0]


def near_failure(rul: ColumnOrName, w1: int = 30) -> Column:
    """1 if at most ``w1`` cycles remain, else 0; an unknown remaining life gives 0."""
    return F.when(_col(rul) <= w1, 1).otherwise(0).cast("long")


def failure_horizon(rul: ColumnOrName, w0: int = 15, w1: int = 30) -> Column:
    """2 imminent (at most ``w0`` cycles), 1 near (at most ``w1``), 0 far or unknown."""
    rul = _col(rul)
    return F.when(rul <= w0, 2).otherwise(near_failure(rul, w1)).cast("long")


def one_hot(label: ColumnOrName, classes: int) -> Column:
    label = _col(label)
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: (i == label).cast("int"))


def z_score(x: ColumnOrName, mean: Column, std: Column, low: Column, high: Column) -> Column:
    """Standardise. A column that was constant when fitted is only shifted.

    Constancy is ``low = high``: the deviation of a constant column comes out of a
    distributed sum as a tiny number rather than zero.
    """
    x = _col(x)
    return F.when(low == high, x - low).otherwise((x - mean) / std)


def sigmoid(x: ColumnOrName) -> Column:
    return 1.0 / (1.0 + F.exp(-_col(x)))


def softmax(scores: ColumnOrName) -> Column:
    """Softmax of an array, shifted by its maximum so that ``exp`` cannot overflow."""
    weights = bind(
        _col(scores), lambda z: bind(F.array_max(z), lambda top: F.transform(z, lambda x: F.exp(x - top)))
    )

    def normalise(w):
        total = F.aggregate(w, F.lit(0.0), lambda acc, x: acc + x)
        return bind(total, lambda t: F.transform(w, lambda x: x / t))

    return bind(weights, normalise)


def activation(scores: ColumnOrName, outputs: int) -> Column:
    """Sigmoid for a single output, softmax for more."""
    scores = _col(scores)
    return F.transform(scores, sigmoid) if outputs == 1 else softmax(scores)


def clip(x: ColumnOrName, bound: float = 0.5) -> Column:
    return F.greatest(F.least(_col(x), F.lit(bound)), F.lit(-bound))


def arg_max(probabilities: ColumnOrName) -> Column:
    """0-based position of the largest entry, the first one if there are several."""
    p = _col(probabilities)
    return (F.array_position(p, F.array_max(p)) - 1).cast("long")


def feature_vector(columns: Sequence[str]) -> Column:
    """The columns in the order given, as one float array."""
    return F.array(*[F.col(c).cast("float") for c in columns])


def feature_major(seq: ColumnOrName, steps: int, features: int) -> Column:
    """Turn a flat (time, feature) array into a flat (feature, time) array."""
    cells = F.sequence(F.lit(0), F.lit(steps * features - 1))

    def turned(values):
        return F.transform(
            cells, lambda i: F.get(values, ((i % steps) * features + F.floor(i / steps)).cast("int"))
        )

    return bind(_col(seq), turned)


def time_major(seq: ColumnOrName, steps: int, features: int) -> Column:
    """Inverse of ``feature_major``."""
    return feature_major(seq, features, steps)


def two_decimals(x: ColumnOrName) -> Column:
    return F.format_number(_col(x), 2)
