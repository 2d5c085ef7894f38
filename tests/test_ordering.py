"""Numbering and running totals, in the plain plan and in the one for oversized groups."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cyclemill.operators.ordering import Extent, measure, number_rows, running_totals


def brute_force(rows, key, order, value):
    groups = {}
    for r in sorted(rows, key=lambda r: [(v is not None, v if v is not None else 0) for v in order(r)]):
        groups.setdefault(key(r), []).append(r)
    out = {}
    for k, members in groups.items():
        total = 0
        for i, r in enumerate(members, 1):
            total += value(r)
            out[r] = (i, total, sum(map(value, members)))
    return out


def check(spark, rows, schema, by, order, limit):
    df = spark.createDataFrame(rows, schema).repartition(7)
    names = df.columns
    at = {n: i for i, n in enumerate(names)}
    want = brute_force(rows, lambda r: tuple(r[at[b]] for b in by), lambda r: [r[at[o]] for o in order], lambda r: r[at["v"]])
    out = running_totals(
        df, by, order, {"no": F.lit(1).cast("long"), "upto": F.col("v")}, {"total": F.col("v")}, rows_per_task=limit
    )
    got = {tuple(r)[: len(names)]: tuple(r)[len(names) :] for r in out.collect()}
    assert got == want


@pytest.mark.parametrize("limit", [5, 40, 10_000])
def test_one_key_holds_a_third(spark, limit):
    rng = random.Random(1)
    rows = [(0 if i % 3 == 0 else rng.randrange(1, 60), rng.randrange(10**6), i, i % 11) for i in range(900)]
    check(spark, rows, "id long, t long, e long, v long", ["id"], ["t", "e"], limit)


@pytest.mark.parametrize("limit", [5, 50])
def test_bursts_and_ties(spark, limit):
    # density rises steeply, and many rows share one time
    rows = [(1, int(1.02**i), i, 1) for i in range(500)] + [(1, 7, 1000 + i, 2) for i in range(300)]
    check(spark, rows, "id long, t long, e long, v long", ["id"], ["t", "e"], limit)


@pytest.mark.parametrize("limit", [3, 1000])
def test_no_group_columns(spark, limit):
    rows = [(i * 37 % 101, i % 5) for i in range(101)]
    check(spark, rows, "k long, v long", [], ["k"], limit)


@pytest.mark.parametrize("limit", [4, 1000])
def test_null_keys_and_null_order(spark, limit):
    rows = [(None, None if i % 4 == 0 else float(i), i, 1) for i in range(60)]
    rows += [(5, 1.5 if i % 2 else None, 100 + i, 3) for i in range(40)]
    check(spark, rows, "id long, t double, e long, v long", ["id"], ["t", "e"], limit)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "decimal(20,3)"])
def test_order_types(spark, kind):
    rows = [(1, i * 7919 % 5000, i, 1) for i in range(200)]
    start = {"timestamp_ntz": "timestamp_ntz'2024-03-31 00:00:00'", "timestamp": "timestamp'2024-03-31 00:00:00'"}
    df = spark.createDataFrame(rows, "id long, m long, e long, v long")
    if kind in start:
        df = df.withColumn("t", F.expr(f"{start[kind]} + make_dt_interval(0, 0, m, 0.25)"))
    elif kind == "date":
        df = df.withColumn("t", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("m") / 100).cast("int")))
    else:
        df = df.withColumn("t", F.col("m").cast(kind) / 8)
    cut = number_rows(df, ["id"], ["t", "e"], "no", "n", rows_per_task=9)
    plain = number_rows(df, ["id"], ["t", "e"], "no", "n")
    assert sorted(map(tuple, cut.select("e", "no", "n").collect())) == sorted(
        map(tuple, plain.select("e", "no", "n").collect())
    )


def test_slices_stay_small(spark):
    """The point of cutting: no (group, slice) keeps more than the limit."""
    from cyclemill.operators.ordering import _cut_hot_groups

    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"), F.pow(F.lit(1.001), "id").alias("t")
    )
    sliced, slices = _cut_hot_groups(df, ["g"], ["t"], 500)
    assert sliced.groupBy("g", *slices).count().agg(F.max("count")).first()[0] <= 500


def test_infinite_and_nan_order_values(spark):
    values = [float("-inf"), float("inf"), float("nan")] + [float(i) for i in range(40)]
    df = spark.createDataFrame([(1, x) for x in values], "id long, t double")
    cut = [r["no"] for r in number_rows(df, ["id"], ["t"], "no", rows_per_task=4).orderBy("t").collect()]
    assert cut == list(range(1, 44))


def test_values_closer_than_a_double_can_tell(spark):
    big = 1 << 60
    check(spark, [(1, big + i, 50 - i, 1) for i in range(40)], "id long, t long, e long, v long", ["id"], ["t", "e"], 5)


def test_measure(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    assert measure(df, ["id"]) == Extent(3, 2, 2)
    assert measure(df.where("id > 5"), ["id"]) == Extent(0, 0, 0)


@pytest.mark.parametrize("names", [
    lambda i: f"engine-{i:05d}", lambda i: f"engine-{i}", lambda i: "x" * (i % 9) + chr(228 + i % 5) + "y" * (i // 9),
])
def test_strings_are_cut(spark, names):
    rows = [(1, names(i), i, 1) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, t string, e long, v long").repartition(5)
    cut = number_rows(df, ["id"], ["t", "e"], "no", "n", rows_per_task=9)
    plain = number_rows(df, ["id"], ["t", "e"], "no", "n")
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))


def test_slices_of_strings_stay_small(spark):
    from cyclemill.operators.ordering import _cut_hot_groups

    df = spark.range(4000).select(F.lit(0).alias("g"), F.format_string("a long common beginning %06d", "id").alias("t"))
    sliced, slices = _cut_hot_groups(df, ["g"], ["t"], 100)
    assert sliced.groupBy("g", *slices).count().agg(F.max("count")).first()[0] <= 100


def test_close_values_are_cut_too(spark):
    from cyclemill.operators.ordering import _cut_hot_groups

    df = spark.range(1000).select(F.lit(0).alias("g"), (F.col("id") + (1 << 60)).alias("t"))
    sliced, slices = _cut_hot_groups(df, ["g"], ["t"], 50)
    assert sliced.groupBy("g", *slices).count().agg(F.max("count")).first()[0] <= 50
