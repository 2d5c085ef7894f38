"""Hand-computed cases and properties of the operators."""

import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cyclemill.functions import expressions as X
from cyclemill.operators import columns, labels, metrics, parameters, scaling, sequences, splits
from cyclemill.operators.ordering import number_rows


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# ------------------------------------------------------------------ labels


def test_rul_and_labels(engines):
    out = labels.horizon_labels(labels.remaining_life(engines), w0=1, w1=2)
    assert rows(out, "id", "cycle", "RUL", "label1", "label2") == [
        (1, 1, 3, 0, 0), (1, 2, 2, 1, 1), (1, 3, 1, 1, 2), (1, 4, 0, 1, 2),
        (2, 1, 2, 1, 1), (2, 2, 1, 1, 2), (2, 3, 0, 1, 2),
    ]


@pytest.mark.parametrize("align", ["key", "position"])
def test_censored_series(spark, engines, align):
    truth = spark.createDataFrame([(1, 5), (2, 7)], "id long, more long")
    total = labels.extend_with_truth(labels.max_cycles(engines), truth, align)
    assert rows(total, "id", "max") == [(1, 9), (2, 10)]
    out = labels.horizon_labels(labels.remaining_life(engines, total), 1, 2)
    assert rows(out, "id", "RUL") == [(1, 5), (1, 6), (1, 7), (1, 8), (2, 7), (2, 8), (2, 9)]
    assert rows(out, "label1", "label2") == [(0, 0)] * 7


def test_position_alignment_uses_rank_not_value(spark, engines):
    sparse = engines.withColumn("id", F.col("id") * 10)
    truth = spark.createDataFrame([(1, 5), (2, 7)], "id long, more long")
    total = labels.extend_with_truth(labels.max_cycles(sparse), truth, "position")
    assert rows(total, "id", "max") == [(10, 9), (20, 10)]


@pytest.mark.parametrize("truth", [[(1, 5)], [(1, 5), (2, 7), (3, 1)]])
def test_position_alignment_rejects_other_counts(spark, engines, truth):
    table = spark.createDataFrame(truth, "id long, more long")
    with pytest.raises(PySparkException, match="different numbers"):
        labels.extend_with_truth(labels.max_cycles(engines), table, "position").collect()


def test_entity_without_truth(spark, engines):
    truth = spark.createDataFrame([(1, 0)], "id long, more long")
    total = labels.extend_with_truth(labels.max_cycles(engines), truth)
    out = labels.horizon_labels(labels.remaining_life(engines, total)).where("id = 2")
    assert rows(out, "RUL", "label1", "label2") == [(None, 0, 0)] * 3


def test_hiding_the_end_keeps_the_remaining_life(spark):
    rng = random.Random(5)
    log = spark.createDataFrame(
        [(e, c) for e in range(20) for c in range(1, rng.randrange(5, 30))], "id long, cycle long"
    )
    truth = labels.max_cycles(log).select("id", (F.col("id") % 4).alias("more"))
    full = labels.remaining_life(log)
    cut = full.join(truth, "id").where(F.col("RUL") >= F.col("more")).select("id", "cycle", F.col("RUL").alias("want"))
    total = labels.extend_with_truth(labels.max_cycles(cut), truth)
    assert labels.remaining_life(cut, total).where("RUL <> want").count() == 0


# ------------------------------------------------------------------ columns


def test_column_operators(engines):
    assert columns.drop_positions(engines, [0, 3]).columns == ["cycle", "a"]
    assert columns.columns_except(engines, ["cycle"]) == ["id", "a", "b"]
    assert columns.reorder(engines, ["b", "id"]).columns == ["b", "id"]
    assert len(columns.WINDOW_FEATURES) == len(columns.SERIES_FEATURES) == 25
    assert columns.WINDOW_FEATURES[3:5] == ["cycle_norm", "s1"]


def test_split_and_pair(engines):
    table = labels.horizon_labels(labels.remaining_life(engines))
    features, targets = columns.split_features_labels(table)
    assert features.columns == ["id", "cycle", "a", "b"]
    assert targets.columns == ["id", "cycle", "RUL", "label1", "label2"]
    assert rows(columns.pair_features_labels(features, targets), *table.columns) == rows(table, *table.columns)


# ------------------------------------------------------------------ scaling


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 0.1), (2.0, 0.1), (4.0, 0.1)] * 40, "x double, c double").repartition(8)
    stats = scaling.fit_scaler(df, ["x", "c"])
    table = {r["feature"]: r for r in scaling.scaler_table(stats).collect()}
    assert abs(table["x"]["mean"] - 7 / 3) < 1e-12
    assert abs(table["x"]["std"] - 1.247219128924647) < 1e-12
    out = scaling.apply_scaler(df, stats).agg(
        F.avg("x"), F.stddev_pop("x"), F.min("c"), F.max("c")
    ).first()
    assert abs(out[0]) < 1e-12 and abs(out[1] - 1) < 1e-12 and (out[2], out[3]) == (0.0, 0.0)
    other = spark.createDataFrame([(1.0, 0.35)], "x double, c double")
    assert abs(scaling.apply_scaler(other, stats).first()["c"] - 0.25) < 1e-12


def test_scaler_keeps_nulls_and_other_columns(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "id long, x double")
    out = scaling.apply_scaler(df, scaling.fit_scaler(df, ["x"]))
    assert rows(out, "id", "x") == [(1, -1.0), (2, None), (3, 1.0)]


# ------------------------------------------------------------------ sequences


def reference_windows(log, length):
    """(id, label cycle, window values) by plain loops."""
    series = {}
    for e, c, v, y in sorted(log):
        series.setdefault(e, []).append((c, v, y))
    out = []
    for e, steps in series.items():
        for stop in range(length, len(steps)):
            out.append((e, steps[stop][0], tuple(v for _, v, _ in steps[stop - length : stop]), float(steps[stop][2])))
    return sorted(out)


def test_small_windows(engines):
    out = sequences.sliding_sequences(engines, ["a"], "cycle", length=2)
    assert rows(out, "id", "label_cycle", "seq") == [(1, 3, [1.0, 2.0]), (1, 4, [2.0, 3.0]), (2, 3, [1.0, 2.0])]
    assert {r[0] for r in rows(sequences.sliding_sequences(engines, ["a"], "cycle", length=3), "id")} == {1}


@pytest.mark.parametrize("longest", [None, 10**6])
@pytest.mark.parametrize("segment", [7, 10, 64])
def test_windows_across_segments(spark, segment, longest):
    rng = random.Random(2)
    log = [(e, c, float(rng.randrange(100)), c % 3) for e in range(6) for c in range(1, rng.choice([3, 7, 8, 60]))]
    df = spark.createDataFrame(log, "id long, cycle long, v double, y long").repartition(5)
    out = sequences.sliding_sequences(df, ["v"], "y", length=7, longest=longest, segment_rows=segment)
    got = sorted((r["id"], r["label_cycle"], tuple(r["seq"]), r["label"]) for r in out.collect())
    assert got == reference_windows(log, 7)


def test_null_cells_do_not_shorten_a_window(spark):
    df = spark.createDataFrame([(1, c, None if c == 2 else float(c)) for c in range(1, 5)], "id long, cycle long, v double")
    out = sequences.sliding_sequences(df, ["v"], "cycle", length=3)
    assert rows(out, "label_cycle", "seq") == [(4, [1.0, None, 3.0])]


def test_layouts(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5, 6],)], "s array<int>")
    turned = df.select(X.feature_major("s", 3, 2).alias("t"))
    assert turned.first()["t"] == [1, 3, 5, 2, 4, 6]
    assert turned.select(X.time_major("t", 3, 2)).first()[0] == [1, 2, 3, 4, 5, 6]


def with_lengths(engines):
    return labels.series_lengths(engines)


def test_padding(engines):
    batches = sequences.life_batches(with_lengths(engines), batch_size=16)
    log = engines.withColumn("y", (F.col("cycle") == 3).cast("long") * 2)
    out = sequences.padded_lives(log, batches, ["a"], "y", 3).where("id = 2").first()
    assert list(out["x"]) == [0.0, 1.0, 2.0, 3.0]
    assert out["mask"] == [0, 1, 1, 1]
    assert out["y"] == [[0, 0, 0], [1, 0, 0], [1, 0, 0], [0, 0, 1]]


def test_long_lives_are_stored_in_blocks(engines):
    batches = sequences.life_batches(with_lengths(engines), batch_size=2)
    assert rows(batches, "id", "steps", "batch_id", "batch_steps") == [(1, 4, 0, 4), (2, 3, 0, 4)]
    padded = sequences.padded_lives(engines, batches, ["a"], "cycle", None, block_steps=3)
    assert rows(padded, "id", "block", "first_pos", "x", "y", "mask") == [
        (1, 0, 1, [1.0, 2.0, 3.0], [[1.0], [2.0], [3.0]], [1, 1, 1]), (1, 1, 4, [4.0], [[4.0]], [1]),
        (2, 0, 0, [0.0, 1.0, 2.0], [[0.0], [1.0], [2.0]], [0, 1, 1]), (2, 1, 3, [3.0], [[3.0]], [1]),
    ]
    # blocks that are all padding are not stored
    small = sequences.padded_lives(engines, batches, ["a"], "cycle", None, block_steps=1)
    assert rows(small.where("id = 2"), "block", "first_pos") == [(1, 1), (2, 2), (3, 3)]
    back = splits.stored_batch_rows(padded, 1, 3)
    want = splits.life_batch_rows(engines, batches, ["a"], "cycle")
    assert rows(back, *back.columns) == rows(want, *back.columns)


def test_step_chunks(engines):
    assert rows(sequences.step_chunks(engines, 3), "id", "chunk", "first_step", "last_step", "n_steps") == [
        (1, 0, 1, 3, 3), (1, 1, 4, 4, 1), (2, 0, 1, 3, 3),
    ]


def test_unmasked_steps(spark):
    df = spark.createDataFrame([(7, [0, 1, 1], [9, 1, 2])], "id long, mask array<int>, y array<int>")
    assert rows(sequences.unmasked_steps(df, "y", keys=["id"]), "id", "step", "y") == [(7, 1, 1), (7, 2, 2)]


# ------------------------------------------------------------------ splits


def test_entity_split_is_ordered_and_complete(spark):
    entities = spark.createDataFrame([(i * 3,) for i in range(11)] * 2, "id long")
    phases = rows(splits.entity_phases(entities), "id", "entity_no", "phase")
    assert [p[2] for p in phases] == ["train"] * 8 + ["val"] * 3
    assert [p[1] for p in phases] == list(range(1, 12))


def test_sample_index_equals_a_global_sort(spark):
    rng = random.Random(4)
    log = [(e, c) for e in range(25) for c in range(1, rng.randrange(2, 40))]
    df = spark.createDataFrame(log, "id long, cycle long")
    offsets = splits.sample_offsets(labels.series_lengths(df), length=9)
    got = rows(splits.index_samples(df, offsets, length=9, batch_size=4), "sample_idx", "id", "cycle", "batch_id", "phase")
    want = sorted((e, c) for e, c in log if c > 9)
    cut = int(0.8 * len(want))
    assert got == [(i, e, c, i // 4, "train" if i < cut else "val") for i, (e, c) in enumerate(want)]


def test_entity_range(engines):
    assert rows(splits.entity_range(engines, 2, 5).select("id").distinct(), "id") == [(2,)]


def test_batch_rows_hold_exactly_the_windows(spark):
    rng = random.Random(6)
    log = [(e, c, float(rng.randrange(1000)), c % 2) for e in range(12) for c in range(1, rng.choice([3, 8, 9, 30]))]
    df = spark.createDataFrame(log, "id long, cycle long, v double, y long").repartition(4)
    df = df.join(labels.series_lengths(df), "id")
    offsets = splits.sample_offsets(labels.series_lengths(df), length=8)
    out = splits.window_batch_rows(df, offsets, ["v"], "y", length=8, batch_size=4)
    groups = {}
    for r in sorted(out.collect(), key=lambda r: (r["batch_id"], r["id"], r["pos"])):
        groups.setdefault((r["batch_id"], r["id"]), []).append(r)
    got = []
    for members in groups.values():
        for i, r in enumerate(members):
            if r["is_label"]:
                window = tuple(m["x"][0] for m in members[i - 8 : i])
                got.append((r["id"], r["pos"], window, r["y"]))
    assert sorted(got) == reference_windows(log, 8)
    # no row travels without being needed: a batch holds its samples and one window per series
    assert all(len(m) == 8 + sum(r["is_label"] for r in m) for m in groups.values())


# ------------------------------------------------------------------ metrics


def test_confusion_and_classes(spark):
    scored = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "label int, prediction int")
    matrix = metrics.confusion_matrix(scored)
    assert rows(matrix, "label", "prediction", "n") == [(0, 0, 1), (0, 1, 1), (1, 1, 2), (2, 0, 1)]
    per = {r["class"]: r for r in metrics.per_class_metrics(matrix).collect()}
    assert per[2]["precision"] is None and per[2]["recall"] == 0.0
    total = metrics.summary_metrics(matrix).first()
    assert total["accuracy"] == 3 / 5
    assert abs(total["precision"] - np.mean([1 / 2, 2 / 3])) < 1e-12
    assert total["precision_classes"] == 2 and total["recall_classes"] == 3


def test_evaluation_agrees_with_its_parts(spark):
    scored = spark.createDataFrame(
        [(0, [0.7, 0.3], 0), (1, [0.6, 0.4], 0), (1, [0.1, 0.9], 1)], "label long, prob array<double>, prediction long"
    )
    out = metrics.evaluation(scored).first()
    assert abs(out["loss"] - metrics.cross_entropy(scored).first()["loss"]) < 1e-12
    assert out["accuracy"] == 2 / 3


def test_auc(spark):
    rng = random.Random(8)
    data = [(rng.randrange(12) / 4, rng.randrange(2)) for _ in range(200)]
    df = spark.createDataFrame(data, "score double, label int")
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert abs(metrics.roc_auc(metrics.roc_points(df)).first()["auc"] - want) < 1e-12
    assert metrics.roc_auc(metrics.roc_points(df.where("label = 1"))).first()["auc"] is None


def test_log_loss_is_finite_at_certainty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0])], "label int, prob array<double>")
    assert abs(metrics.cross_entropy(df).first()["loss"] + np.log(1e-7)) < 1e-9


# ------------------------------------------------------------------ expressions and parameters


def test_expressions(spark):
    df = spark.createDataFrame([([1000.0, 999.0, 1000.0], 2, 3.0)], "z array<double>, y int, x double")
    r = df.select(
        X.softmax("z").alias("p"),
        X.arg_max("z").alias("best"),
        X.one_hot("y", 3).alias("hot"),
        X.clip("x").alias("clip"),
        X.sigmoid(F.lit(0.0)).alias("s"),
        X.activation(F.array(F.lit(0.0)), 1).alias("one"),
        X.two_decimals("x").alias("text"),
    ).first()
    assert abs(sum(r["p"]) - 1) < 1e-12 and r["p"][0] == r["p"][2] > r["p"][1]
    assert (r["best"], r["hot"], r["clip"], r["s"], r["one"], r["text"]) == (0, [0, 0, 1], 0.5, 0.5, [0.5], "3.00")


def test_weighted_average(spark):
    workers = spark.createDataFrame([(1, [0.0, 3.0]), (2, [3.0, 0.0])], "n long, values array<double>")
    assert rows(parameters.weighted_average(workers), "pos", "value", "n") == [(0, 2.0, 3), (1, 1.0, 3)]


def test_results_do_not_depend_on_partitioning(spark, engines):
    a = sequences.sliding_sequences(number_rows(engines.repartition(1), ["id"], ["a"], "c"), ["a"], "c", 2, pos_col="c")
    b = sequences.sliding_sequences(number_rows(engines.repartition(9), ["id"], ["a"], "c"), ["a"], "c", 2, pos_col="c")
    assert rows(a, "id", "label_cycle", "seq") == rows(b, "id", "label_cycle", "seq")
