"""The comparison model sees the samples of the sequence classifier, and learns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclemill.functions.lstm import Network, Weights
from cyclemill.plans.comparison import Perceptron, evaluate_comparison, fit_comparison, window_vectors
from cyclemill.plans.experiment import Series, evaluate_windows

LENGTH = 5
FEATURES = ["wear", "noise"]


@pytest.fixture(scope="module")
def worn(spark):
    """Fourteen engines; the label follows from the wear. Cycles have gaps."""
    rng = np.random.default_rng(3)
    rows = [
        (e, 3 * c + e, 2.0 * c / n - 1, float(rng.normal()), int(c > 2 * n / 3))
        for e in range(14) for n in [int(rng.integers(4, 24))] for c in range(1, n + 1)
    ]
    return spark.createDataFrame(rows, "id long, cycle long, wear double, noise double, label1 long").persist()


def test_both_models_are_scored_on_the_same_samples(worn):
    model = fit_comparison(worn, FEATURES, settings=Perceptron(hidden=(4,), length=LENGTH))
    mine, measures = evaluate_comparison(worn, model, FEATURES, length=LENGTH)
    net = Network(features=2, outputs=1, units=(3,), dropout=0.0)
    other, _ = evaluate_windows(worn, net, Weights(net.initial()), FEATURES, length=LENGTH)
    assert mine.schema.simpleString() == other.schema.simpleString()
    key = ("id", "pos", "label")
    assert sorted(map(tuple, mine.select(*key).collect())) == sorted(map(tuple, other.select(*key).collect()))
    row = measures.first()
    # better than the share of the labels as a constant guess, in both measures
    share = mine.agg(F.avg("label")).first()[0]
    assert row["accuracy"] > max(share, 1 - share) + 0.1
    assert 0 < row["loss"] < -share * np.log(share) - (1 - share) * np.log(1 - share)
    assert all(abs(sum(r["prob"]) - 1) < 1e-9 for r in mine.collect())


def test_only_training_entities_train(spark, worn):
    """What the last fifth of the entities looks like changes nothing."""
    other = worn.withColumn("wear", F.when(F.col("id") >= 11, F.lit(99.0)).otherwise(F.col("wear")))
    settings = Perceptron(hidden=(3,), length=LENGTH, iterations=5)
    a, b = (fit_comparison(t.coalesce(1), FEATURES, settings=settings).weights.toArray() for t in (worn, other))
    assert np.allclose(a, b, atol=1e-6)


def test_unknown_labels_and_short_lives_are_no_samples(worn):
    some = worn.withColumn("label1", F.when(F.col("id") != 3, F.col("label1")))
    rows = window_vectors(Series.of(some), FEATURES, "label1", LENGTH).collect()
    sizes = {r["id"]: r["count"] for r in worn.groupBy("id").count().collect() if r["id"] != 3}
    assert len(rows) == sum(max(n - LENGTH, 0) for n in sizes.values())
    assert all(len(r["x"]) == LENGTH * 2 for r in rows)
