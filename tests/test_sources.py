"""Text logs, series directories, minibatch, model and statistics tables."""

import random
import re

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemill.functions.lstm import Network, Weights
from cyclemill.operators.columns import WINDOW_FEATURES
from cyclemill.operators.parameters import parameter_counts
from cyclemill.plans.pipeline import label_complete, prepare
from cyclemill.session import shared_folder
from cyclemill.sources import batches, logs, models, series


def line(engine, cycle, rng):
    numbers = [round(rng.uniform(0, 100), 4) for _ in range(24)]
    return " ".join(map(str, [engine, cycle, *numbers])) + "  "


@pytest.fixture
def folder(tmp_path):
    rng = random.Random(11)
    for unit in ("001", "002"):
        for split, count in (("train", 4), ("test", 3)):
            text = [line(e, c, rng) for e in range(1, count + 1) for c in range(1, 9 + e)]
            (tmp_path / f"{split}_FD{unit}.txt").write_text("\n".join(text) + "\n")
        (tmp_path / f"RUL_FD{unit}.txt").write_text("112 \n98 \n7 \n")
    return str(tmp_path)


def test_read_log(spark, folder):
    log = logs.read_log(spark, folder, "train")
    assert log.columns[:5] == ["id", "cycle", "setting1", "setting2", "setting3"]
    assert log.columns[5:26] == [f"s{i}" for i in range(1, 22)]
    assert log.columns[26:] == ["unit", "split"]
    assert log.count() == sum(8 + e for e in range(1, 5))
    assert log.where(" or ".join(f"{c} is null" for c in log.columns)).count() == 0


def test_malformed_lines_fail(spark, tmp_path):
    good = line(1, 1, random.Random(0))
    (tmp_path / "train_FD001.txt").write_text(good + "\n" + good.replace("1 1 ", "1 x ", 1) + "\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        logs.read_log(spark, str(tmp_path), "train").select("cycle").collect()
    # a short line fails even if the columns asked for are there
    (tmp_path / "train_FD001.txt").write_text(good + "\n1 2 3.5\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        logs.read_log(spark, str(tmp_path), "train").select("id").collect()


def test_read_units(spark, folder):
    both = logs.read_units(spark, folder, "test", ["001", "002"])
    assert {tuple(r) for r in both.select("unit", "split").distinct().collect()} == {("001", "test"), ("002", "test")}
    assert both.select("id").distinct().count() == both.select("unit", "engine").distinct().count() == 6
    truth = logs.read_truths(spark, folder, ["001", "002"])
    assert sorted(r["id"] for r in truth.collect()) == sorted(r["id"] for r in both.select("id").distinct().collect())


def test_units_do_not_mix(spark, folder):
    """Engines of several units share their numbers, not their lives."""
    together = label_complete(logs.read_units(spark, folder, "train", ["001", "002"]).where("unit = '001' or cycle > 3"))
    alone = label_complete(logs.read_log(spark, folder, "train", "001"))
    got = together.where("unit = '001'").select("engine", "cycle", "RUL")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, alone.select("id", "cycle", "RUL").collect()))


def test_read_truth(spark, folder, tmp_path):
    assert [tuple(r) for r in logs.read_truth(spark, folder).orderBy("id").collect()] == [(1, 112), (2, 98), (3, 7)]


def test_truth_keeps_line_order_over_file_splits(spark, tmp_path):
    (tmp_path / "RUL_FD001.txt").write_text("".join(f"{i * 3} \n\n" for i in range(1, 2001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.cyclemill.rowsPerTask", "100")
    try:
        truth = logs.read_truth(spark, str(tmp_path))
        assert truth.where("more <> id * 3").count() == 0 and truth.count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.cyclemill.rowsPerTask")


@pytest.fixture
def prepared(spark, folder):
    train = logs.read_log(spark, folder, "train").drop("unit", "split")
    test = logs.read_log(spark, folder, "test").drop("unit", "split")
    return prepare(train, test, logs.read_truth(spark, folder), WINDOW_FEATURES)


def test_prepare(prepared):
    train, test, stats = prepared
    assert train.columns == test.columns
    assert train.columns[-4:] == ["RUL", "label1", "label2", "cycle_norm"]
    assert set(stats.columns) == set(WINDOW_FEATURES) and stats.count() == 1
    means = train.agg(*[F.avg(c).alias(c) for c in WINDOW_FEATURES]).first()
    assert all(abs(m) < 1e-9 for m in means)
    last = test.where("id = 2").orderBy(F.desc("cycle")).first()
    assert last["RUL"] == 98
    # no test row moves the statistics
    assert abs(test.agg(F.avg("s1")).first()[0]) > 1e-6


@pytest.mark.parametrize("buckets", [None, 3])
def test_series_round_trip(spark, prepared, tmp_path, buckets):
    train = prepared[0]
    series.write_series(train, str(tmp_path / "out"), "train", buckets=buckets, segment_rows=5)
    for kind, columns in (
        ("features", [c for c in train.columns if c not in ("RUL", "label1", "label2")]),
        ("labels", ["id", "cycle", "RUL", "label1", "label2"]),
    ):
        want = train.select(*columns)
        got = series.read_series(spark, str(tmp_path / "out"), "train", kind, want.schema, buckets=buckets)
        assert got.columns == columns
        key = lambda r: tuple(r)[:2]
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert series.count_series(got).first()[0] == 4
    some = series.read_series(spark, str(tmp_path / "out"), "train", "labels", want.schema, 2, 3, buckets)
    assert {r["id"] for r in some.collect()} == {2, 3}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*\b" + ("bucket" if buckets else "id") + "#", plan)
    with pytest.raises(PySparkException):
        series.write_series(train, str(tmp_path / "out"), "train", buckets=buckets)


def test_schema_json(engines):
    reduced = engines.drop("b")
    assert series.schema_from_json(series.schema_json(reduced)) == reduced.schema
    assert isinstance(reduced.schema, T.StructType)


def test_batches_by_phase(spark, engines, tmp_path):
    path = str(tmp_path / "batches")
    table = engines.withColumn("batch_id", F.col("cycle") % 2)
    phased = table.withColumn("phase", F.when(F.col("id") == 1, "train").otherwise("val"))
    batches.write_batches(phased, path)
    batches.write_batches(phased.where("id = 2"), path)  # replaces its phase, keeps the other
    assert batches.read_batches(spark, path, "train").count() == 4
    back = batches.read_batches(spark, path, "val")
    assert back.columns == table.columns
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, table.where("id = 2").collect()))


def test_model_round_trip(spark, tmp_path):
    net = Network(features=3, outputs=3, units=(4, 2), many_to_one=False)
    weights = Weights(net.initial(), np.arange(net.size()) / 7, np.arange(net.size()) / 3, 12)
    path = str(tmp_path / "model")
    models.save_model(spark, path, net, Weights(net.initial()), round_no=1)
    models.save_model(spark, path, net, Weights(net.initial() + 1), round_no=2)
    models.save_model(spark, path, net, weights, round_no=2)  # the last one counts
    models.save_model(spark, path, net, Weights(net.initial()), run="plain", optimizer=False)
    got_net, got = models.load_model(spark, path)
    assert got_net == net and np.array_equal(got.pack(), weights.pack())
    assert models.load_model(spark, path, round_no=1)[1].steps == 0
    assert models.load_model(spark, path, "plain")[1].steps == 0
    with pytest.raises(ValueError):
        models.load_model(spark, path, "unknown")
    plain = models.read_model(spark, path).where("run = 'plain'")
    counts = {r["layer"]: r["n_params"] for r in parameter_counts(plain).collect()}
    assert counts == {"lstm1": 16 * 3 + 16 * 4 + 16, "lstm2": 8 * 4 + 8 * 2 + 8, "output": 2 * 3 + 3}


def test_stats_are_appended(spark, tmp_path):
    path = str(tmp_path / "stats")
    models.append_stats(spark, path, [("r", 1, 0, 0, 16.0, 2.5, 0.1)])
    models.append_stats(spark, path, [("r", 1, 1, 0, 16.0, 2.0, 0.1)])
    assert models.read_stats(spark, path).agg(F.sum("loss")).first()[0] == 4.5


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a != b and a.startswith(root)
