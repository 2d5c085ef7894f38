"""Mergeable states, the bounded ROC curve and the ledger of bad lines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclemill.operators import metrics, scaling
from cyclemill.sources.logs import read_bad_lines, read_log, read_log_with_ledger
from cyclemill.sources.states import put_part, read_parts


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_merged_scaler_equals_one_pass(spark, offset):
    rng = np.random.default_rng(1)
    a = rng.normal(size=600) + offset
    rows = [(i % 7, float(x), 5.0 if i % 7 else None) for i, x in enumerate(a)]
    df = spark.createDataFrame(rows, "part int, a double, b double").cache()
    held = [r for p in range(8) for r in scaling.scaler_state(df.where(F.col("part") == p), ["a", "b"]).collect()]  # the last is empty
    merge = lambda rows: scaling.merge_scaler_states(spark.createDataFrame(rows, scaling.STATE)).collect()
    merged = spark.createDataFrame(merge(held), scaling.STATE)
    # merging merged states is the same again
    halves = spark.createDataFrame(merge(held[:6]) + merge(held[6:]), scaling.STATE)
    for state in (merged, scaling.merge_scaler_states(halves)):
        got = {r.feature: r for r in state.collect()}
        assert got["a"].n == 600 and got["a"].mean - offset == pytest.approx(np.mean(a - offset), abs=max(1e-12, 1e-15 * abs(offset)))
        assert np.sqrt(got["a"].m2 / 600) == pytest.approx(np.std(a - offset), rel=1e-12)
        assert (got["a"].low, got["a"].high) == pytest.approx((a.min(), a.max())) and got["b"].m2 == 0 and got["b"].mean == 5
    row = scaling.scaler_of_state(merged, ["a", "b"]).first()
    fit = scaling.fit_scaler(df, ["a", "b"]).first()
    assert row.a.std == pytest.approx(fit.a.std, rel=1e-12 if not offset else 1e-7) and row.b.std == 0
    scaled = scaling.apply_scaler(df.select("a", "b"), scaling.scaler_of_state(merged, ["a", "b"]))
    assert scaled.agg(F.max(F.abs("b"))).first()[0] == 0


def scored_rows(seed, n, ties=False):
    rng = np.random.default_rng(seed)
    p = rng.beta(2, 3, n)
    p = np.round(p, 1) if ties else p
    y = (rng.random(n) < p).astype(int)
    return [(int(a), [float(1 - b), float(b)], int(b > 0.5)) for a, b in zip(y, p)]


def test_a_part_that_comes_again_counts_once(spark, tmp_path):
    rows, path = scored_rows(2, 900), str(tmp_path / "states")
    df = spark.createDataFrame([(i % 3, *r) for i, r in enumerate(rows)], "part int, label int, prob array<double>, prediction int").cache()
    for p in (0, 1, 2, 1, 0):
        put_part(metrics.evaluation_state(df.where(F.col("part") == p)), path, f"day {p}")
    states = read_parts(spark, path, metrics.EVALUATION_STATE)
    got, want = metrics.merged_evaluation(states).first().asDict(), metrics.evaluation(df).first().asDict()
    assert all(got[k] == pytest.approx(v, abs=1e-12) for k, v in want.items())
    auc = metrics.roc_auc(metrics.roc_points(df.select(F.col("prob")[1].alias("score"), "label"))).first()["auc"]
    assert abs(got["auc"] - auc) <= got["auc_error"] + 1e-12 and got["auc_error"] < 1e-3
    assert states.count() < len(rows) + 1 and metrics.merged_evaluation(states.limit(0)).first()["loss"] is None


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("bits", [2, 6, 12])
def test_the_error_bound_holds(spark, ties, bits):
    rows = [(p[1], y) for y, p, _ in scored_rows(3, 1500, ties)] + [(1.0, 1), (0.0, 0)]
    df = spark.createDataFrame(rows, "score double, label int").cache()
    auc = metrics.roc_auc(metrics.roc_points(df)).first()["auc"]
    bins = metrics.roc_histogram(df, bits)
    assert bins.count() <= 1 << bits
    got = metrics.binned_auc(bins).first()
    assert abs(got.auc - auc) <= got.auc_error + 1e-12


def test_refining_where_scores_crowd(spark):
    rng = np.random.default_rng(4)
    s = np.concatenate((rng.random(300), 0.5 + rng.random(4000) * 1e-6))
    rows = [(float(x), int(y)) for x, y in zip(s, rng.random(len(s)) < 0.4)]
    df = spark.createDataFrame(rows, "score double, label int").cache()
    auc = metrics.roc_auc(metrics.roc_points(df)).first()["auc"]
    coarse = metrics.binned_auc(metrics.roc_histogram(df, 10)).first()
    bins = metrics.refined_roc(df, 1e-4, 9, 5)
    fine = metrics.binned_auc(bins, "low").first()
    assert coarse.auc_error > 0.1 and fine.auc_error <= 1e-4 and abs(fine.auc - auc) <= fine.auc_error + 1e-12
    assert bins.agg(F.sum("pos") + F.sum("neg")).first()[0] == len(rows)


def test_one_class_has_no_curve(spark):
    df = spark.createDataFrame([(0.3, 1), (0.6, 1)], "score double, label int")
    assert metrics.binned_auc(metrics.roc_histogram(df)).first() == (None, None)


def line(i, c, bad=None):
    own = [str(i), str(c), *["0.5"] * 3, *["1.0"] * 21]
    return bad if bad is not None else " ".join(own) + "  "


def test_bad_lines_are_listed_and_left_out(spark, tmp_path):
    lines = [line(1, c) for c in range(1, 300)] + ["1 2 3", line(2, 1).replace("0.5", "x", 1), "", line(2, 2) + "7 8"]
    (tmp_path / "train_FD001.txt").write_text("\n".join(lines) + "\n")
    ledger = str(tmp_path / "ledger")
    got = read_log_with_ledger(spark, str(tmp_path), "train", ledger, most=0.02)
    assert got.count() == 299 and got.select("id").distinct().count() == 1
    bad = read_bad_lines(spark, ledger).collect()
    assert sorted(r.line for r in bad) == sorted([lines[299], lines[300], lines[302]])
    assert all(r.file.endswith("train_FD001.txt") for r in bad)
    with pytest.raises(ValueError, match="3 of 302"):
        read_log_with_ledger(spark, str(tmp_path), "train", ledger, most=0.001)
    (tmp_path / "train_FD001.txt").write_text("\n".join(lines[:299]) + "\n")
    clean = read_log(spark, str(tmp_path), "train")
    again = read_log_with_ledger(spark, str(tmp_path), "train", ledger)
    assert again.schema == clean.schema and again.exceptAll(clean).count() == 0 and again.count() == clean.count()
    assert read_bad_lines(spark, ledger).count() == 0
