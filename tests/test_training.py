"""Parameter averaging, scoring and everything that travels between rounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclemill.functions.lstm import Adam, Network, Weights, forward, gradient
from cyclemill.operators.labels import series_lengths
from cyclemill.operators.sequences import life_batches
from cyclemill.operators.splits import life_batch_rows, sample_offsets, window_batch_rows
from cyclemill.operators.scaling import apply_scaler, fit_scaler
from cyclemill.plans.experiment import (
    Series, evaluate_lives, evaluate_rows, evaluate_windows, fit_lives, fit_stored, fit_windows, ingest, stored_rows,
    window_rows,
)
from cyclemill.plans.scoring import score
from cyclemill.plans import training
from cyclemill.plans.training import Settings, average_round, export_rounds, train, worker_tasks
from cyclemill.sources.batches import read_batches
from cyclemill.sources.models import load_model, read_stats, read_steps

LENGTH = 5


@pytest.fixture(scope="module")
def fleet(spark):
    """Engines whose sensor rises with wear; the last third of a life is labelled."""
    rng = np.random.default_rng(3)
    rows = []
    for engine in range(14):
        n = int(rng.integers(9, 24))
        for c in range(1, n + 1):
            rows.append((engine, c, n, 2.0 * c / n - 1, float(rng.normal()), int(c > 2 * n / 3)))
    df = spark.createDataFrame(rows, "id long, cycle long, n_cycles long, wear double, noise double, y long")
    return df.repartition(6).persist()


def windows(fleet, batch_size=8):
    offsets = sample_offsets(series_lengths(fleet), LENGTH)
    return window_batch_rows(fleet, offsets, ["wear", "noise"], "y", LENGTH, batch_size)


def lives(fleet, batch_size=4):
    return life_batch_rows(fleet, life_batches(series_lengths(fleet), batch_size), ["wear", "noise"], "y")


def tensors(fleet):
    """All windows and labels in entity order, by plain loops."""
    series = {}
    for r in sorted(fleet.collect(), key=lambda r: (r["id"], r["cycle"])):
        series.setdefault(r["id"], []).append(r)
    x, y = [], []
    for steps in series.values():
        for stop in range(LENGTH, len(steps)):
            # sensors travel as float32
            x.append([[np.float32(r["wear"]), np.float32(r["noise"])] for r in steps[stop - LENGTH : stop]])
            y.append(steps[stop]["y"])
    return np.array(x, float), np.array(y, float)


NET = Network(features=2, outputs=1, units=(5, 4), dropout=0.0, precision="float64")


def test_one_worker_equals_local_training(fleet):
    x, y = tensors(fleet)
    settings = Settings(workers=1, averaging_frequency=1000, length=LENGTH)
    rounds = export_rounds(windows(fleet), settings)
    assert rounds.count == 1
    got, stats = average_round(rounds.read(0), NET, Weights(NET.initial()), Adam(), settings, 0)
    want = Weights(NET.initial())
    for at in range(0, len(y), 8):
        _, _, grad, _ = gradient(NET, want.values, x[at : at + 8], y[at : at + 8])
        want.update(grad, Adam())
    assert np.allclose(got.pack(), want.pack(), atol=1e-12)
    assert stats[0][1] == len(y)


@pytest.mark.parametrize("driver_bytes", [0, 1 << 30])
def test_workers_are_averaged_by_samples_seen(fleet, driver_bytes):
    x, y = tensors(fleet)
    settings = Settings(workers=3, averaging_frequency=1000, length=LENGTH)
    rounds = export_rounds(windows(fleet), settings)
    got, stats = average_round(rounds.read(0), NET, Weights(NET.initial()), Adam(), settings, 0, driver_bytes)
    vectors, seen = [], []
    for worker in range(3):
        mine = Weights(NET.initial())
        n = 0
        for b in range(worker, -(-len(y) // 8), 3):
            cut = slice(8 * b, 8 * b + 8)
            _, count, grad, _ = gradient(NET, mine.values, x[cut], y[cut])
            mine.update(grad, Adam())
            n += count
        vectors.append(mine.pack())
        seen.append(n)
    assert np.allclose(got.pack(), np.average(vectors, axis=0, weights=seen), atol=1e-12)
    assert sorted(s[1] for s in stats) == sorted(seen)


def test_many_workers_share_tasks(spark, fleet, tmp_path):
    """A round of very many workers has tasks by the cores; every worker still starts from the round's weights."""
    x, y = tensors(fleet)
    workers = len(y)
    tasks = worker_tasks(workers, spark.sparkContext.defaultParallelism)
    assert tasks < workers and worker_tasks(141_000, 12) == 138 and worker_tasks(8, 12) == 8
    settings = Settings(workers=workers, averaging_frequency=1, length=LENGTH, epochs=1)
    rounds = export_rounds(windows(fleet, 1), settings)
    got = train(spark, rounds, NET, settings, steps_path=str(tmp_path))
    vectors = []
    for at in range(workers):
        mine = Weights(NET.initial())
        mine.update(gradient(NET, mine.values, x[at : at + 1], y[at : at + 1])[2], Adam())
        vectors.append(mine.pack())
    assert np.allclose(got.weights.pack(), np.mean(vectors, axis=0), atol=1e-12)
    assert read_steps(spark, str(tmp_path)).count() == workers
    assert 0 < len(list(tmp_path.rglob("kind=step/*.parquet"))) <= tasks


@pytest.mark.parametrize("many_to_one", [True, False])
def test_rounds_that_follow_one_another_are_held(spark, fleet, monkeypatch, many_to_one):
    """Rounds are read in groups and each is one job, with the bit-equal results of rounds that are read one by one."""
    monkeypatch.setattr(training, "HELD_ROUNDS", 7)
    net = Network(features=2, outputs=1, units=(5, 4), dropout=0.2, many_to_one=many_to_one)
    settings = Settings(workers=2, averaging_frequency=1, length=LENGTH, tbptt=4, epochs=2, evaluate_every=2)
    rounds = export_rounds(windows(fleet, 4) if many_to_one else lives(fleet, 1), settings)
    assert rounds.count > 6
    weights, stats, cells = Weights(net.initial()), [], []
    for number in range(2 * rounds.count):
        weights, own = average_round(rounds.read(number % rounds.count), net, weights, Adam(), settings, number, cells=cells)
        stats += [(number, *s[:3]) for s in own]
    group = f"held {many_to_one}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        got = train(spark, rounds, net, settings)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    groups = -(-rounds.count // 7)
    assert 2 * rounds.count <= jobs <= 2 * (rounds.count + 3 * groups)
    assert np.array_equal(got.weights.pack(), weights.pack())
    assert [s[2:6] for s in got.stats] == stats
    assert [e["iteration"] for e in got.evaluations if e["data"] == "iteration"] == sorted({c[0] for c in cells})


def test_rounds_hold_every_batch_once(fleet):
    settings = Settings(workers=2, averaging_frequency=3, length=LENGTH)
    rows = windows(fleet, 4)
    rounds = export_rounds(rows, settings)
    per_round = [rounds.read(i) for i in range(rounds.count)]
    for table in per_round:
        assert table.groupBy("worker").agg(F.countDistinct("batch_id").alias("n")).where("n > 3").count() == 0
    assert sum(t.count() for t in per_round) == rows.count()
    assert rounds.read(rounds.count).count() == 0


def test_loss_falls_and_state_is_kept(spark, fleet, tmp_path):
    settings = Settings(epochs=6, workers=2, averaging_frequency=2, length=LENGTH, evaluations_per_epoch=1, patience=3)
    rounds = export_rounds(windows(fleet), settings)
    out = train(
        spark, rounds, NET, settings, Adam(rate=0.02), validation=windows(fleet, 64),
        run="r", stats_path=str(tmp_path / "stats"), model_path=str(tmp_path / "model"),
    )
    by_epoch = [e["loss"] for e in out.evaluations if e["data"] == "epoch"]
    assert by_epoch[-1] < 0.5 * by_epoch[0]
    first = [e for e in out.evaluations if e["round"] == 0]
    assert {e["data"] for e in first} == {"batch", "validation"}
    stats = read_stats(spark, str(tmp_path / "stats"))
    n = len(tensors(fleet)[1])
    assert {r["s"] for r in stats.groupBy("epoch").agg(F.sum("n").alias("s")).collect()} == {n}

    net, saved = load_model(spark, str(tmp_path / "model"), "r")
    assert net == NET and np.array_equal(saved.pack(), out.weights.pack())
    # going on from the saved state equals going on from the one in memory
    one = Settings(epochs=1, workers=2, averaging_frequency=2, length=LENGTH)
    a = train(spark, rounds, NET, one, init=saved)
    b = train(spark, rounds, NET, one, init=out.weights)
    assert np.array_equal(a.weights.pack(), b.weights.pack())
    assert not np.array_equal(a.weights.values, out.weights.values)


def test_early_stop(spark, fleet):
    settings = Settings(epochs=10, workers=2, averaging_frequency=50, length=LENGTH, patience=1)
    rounds = export_rounds(windows(fleet), settings)
    out = train(spark, rounds, NET, settings, Adam(rate=0.0), validation=windows(fleet, 64))
    assert out.epochs == 2


def test_dropout_repeats_exactly(fleet):
    net = Network(features=2, outputs=1, units=(5,), dropout=0.3)
    settings = Settings(workers=2, averaging_frequency=100, length=LENGTH)
    rounds = export_rounds(windows(fleet), settings)
    a, _ = average_round(rounds.read(0), net, Weights(net.initial()), Adam(), settings, 0)
    b, _ = average_round(rounds.read(0), net, Weights(net.initial()), Adam(), settings, 0)
    c, _ = average_round(rounds.read(0), net, Weights(net.initial()), Adam(), settings, 1)
    assert np.array_equal(a.pack(), b.pack()) and not np.array_equal(a.pack(), c.pack())


def test_not_finite_weights_raise(fleet):
    settings = Settings(workers=2, averaging_frequency=100, length=LENGTH)
    rounds = export_rounds(windows(fleet), settings)
    bad = Weights(np.full(NET.size(), np.nan))
    with pytest.raises(FloatingPointError):
        average_round(rounds.read(0), NET, bad, Adam(), settings, 0)


def test_window_scores_equal_a_plain_forward_pass(fleet):
    x, y = tensors(fleet)
    net = Network(features=2, outputs=3, units=(4,), dropout=0.2)
    got = sorted(tuple(r) for r in score(windows(fleet, 16), net, net.initial(), LENGTH).collect())
    prob = forward(net, net.initial(), x)[0]
    assert len(got) == len(y)
    assert np.allclose([g[3] for g in got], prob)
    assert [g[2] for g in got] == y.tolist()
    assert [g[4] for g in got] == prob.argmax(1).tolist()


def test_step_scores_equal_a_plain_forward_pass(fleet):
    net = Network(features=2, outputs=2, units=(4, 3), dropout=0.2, many_to_one=False)
    got = {}
    for r in score(lives(fleet), net, net.initial()).collect():
        got.setdefault(r["id"], {})[r["pos"]] = r["prob"]
    series = {}
    for r in sorted(fleet.collect(), key=lambda r: (r["id"], r["cycle"])):
        series.setdefault(r["id"], []).append([np.float32(r["wear"]), np.float32(r["noise"])])
    assert got.keys() == series.keys()
    for engine, steps in series.items():
        want = forward(net, net.initial(), np.array([steps], float))[0][0]
        assert np.allclose([got[engine][p] for p in range(1, len(steps) + 1)], want)


def test_per_step_training_in_chunks(spark, fleet):
    net = Network(features=2, outputs=2, units=(6,), dropout=0.0, many_to_one=False)
    settings = Settings(epochs=8, workers=2, averaging_frequency=1, tbptt=7, patience=None)
    rounds = export_rounds(lives(fleet), settings)
    out = train(spark, rounds, net, settings, Adam(rate=0.03), validation=lives(fleet))
    losses = [e["loss"] for e in out.evaluations]
    assert losses[-1] < 0.7 * losses[0]
    # one Adam step per chunk of the longest life in each batch, padding included
    assert sum(s[3] == 0 for s in out.stats) >= 8


def test_gradient_over_batches_is_the_pooled_gradient(fleet):
    """One full-batch step per worker, averaged, equals one step on all data (plain gradient)."""
    x, y = tensors(fleet)
    _, n, whole, _ = gradient(NET, NET.initial(), x, y)
    parts = [gradient(NET, NET.initial(), x[i::3], y[i::3]) for i in range(3)]
    pooled = sum(p[1] * p[2] for p in parts) / n
    assert np.allclose(pooled, whole, atol=1e-14)


# ------------------------------------------------------------------ from table to model


@pytest.fixture(scope="module")
def labelled(fleet):
    return fleet.select(
        "id", "cycle", (F.col("n_cycles") - F.col("cycle")).alias("RUL"),
        F.col("y").alias("label1"), (F.col("y") * 2).alias("label2"), "wear", "noise",
    )


def test_tail_split_rows(labelled, fleet):
    x, y = tensors(fleet)
    cut = int(0.8 * len(y))
    for tail, want in (("train", slice(0, cut)), ("val", slice(cut, None))):
        rows = window_rows(Series.of(labelled), ["wear", "noise"], "label1", LENGTH, 4, tail)
        scored = score(rows, NET, NET.initial(), LENGTH).collect()
        got = sorted((r["id"], r["pos"], r["prob"][1]) for r in scored)
        assert np.allclose([g[2] for g in got], forward(NET, NET.initial(), x[want])[0][:, 0])


@pytest.mark.parametrize("split", ["entity", "tail"])
def test_fit_windows(spark, labelled, split):
    settings = Settings(epochs=2, workers=2, averaging_frequency=5, length=LENGTH)
    out = fit_windows(labelled, NET, ["wear", "noise"], split=split, settings=settings, adam=Adam(rate=0.02))
    assert out.rounds > 0 and out.evaluations[-1]["data"] == "epoch"
    predictions, row = evaluate_windows(labelled, NET, out.weights, ["wear", "noise"], length=LENGTH)
    assert predictions.count() > 50 and 0 <= row.first()["accuracy"] <= 1


def test_unknown_split(labelled):
    with pytest.raises(ValueError):
        fit_windows(labelled, NET, ["wear", "noise"], split="other")


def test_fit_lives(labelled):
    net = Network(features=2, outputs=3, units=(5,), dropout=0.1, many_to_one=False)
    settings = Settings(epochs=2, workers=2, averaging_frequency=1)
    out = fit_lives(labelled, net, ["wear", "noise"], batch_size=2, settings=settings, adam=Adam(rate=0.02))
    losses = [e["loss"] for e in out.evaluations]
    assert losses[-1] < losses[0]


def stored(spark, path, phase):
    """Real cells of the stored blocks by entity and position."""
    cells = {}
    for r in read_batches(spark, path, phase).collect():
        x = np.reshape(r["x"], (len(r["mask"]), -1))
        for k, real in enumerate(r["mask"]):
            assert real or not (x[k].any() or any(r["y"][k]))
            if real:
                cells[r["id"], r["first_pos"] + k] = (x[k], r["y"][k])
    return cells


@pytest.mark.parametrize("target, width", [("label2", 3), ("label1", 2), ("RUL", 1)])
def test_ingest(spark, labelled, tmp_path, target, width):
    path = str(tmp_path / "batches")
    test = labelled.where("id < 4")
    for _ in range(2):  # a second ingestion replaces the first
        stats = ingest(labelled, test, path, ["cycle", "wear", "noise"], target, batch_size=3)
    assert stats.columns == ["cycle", "wear", "noise"]
    real = {}
    for phase, entities in (("train", 11), ("val", 3), ("test", 4)):
        cells = stored(spark, path, phase)
        assert len({i for i, _ in cells}) == entities and {len(y) for _, y in cells.values()} == {width}
        real[phase] = len(cells)
        if phase == "train":
            x = np.array([c[0] for c in cells.values()])
            assert np.allclose(x.mean(0), 0, atol=1e-5) and np.allclose(x.std(0), 1, atol=1e-5)
        if target == "RUL":
            want = {(r["id"], r["cycle"]): r["RUL"] for r in labelled.collect()}
            assert all(y[0] == want[k] for k, (_, y) in cells.items())
    assert real["train"] + real["val"] == labelled.count() and real["test"] == test.count()


def test_a_fractional_target_is_kept(spark, labelled, tmp_path):
    half = labelled.withColumn("RUL", F.col("RUL") + 0.5)
    ingest(half, half, str(tmp_path / "b"), ["wear"], "RUL")
    assert {y[0] % 1 for _, y in stored(spark, str(tmp_path / "b"), "train").values()} == {0.5}


def test_train_and_evaluate_from_stored_batches(spark, labelled, tmp_path):
    path = str(tmp_path / "batches")
    ingest(labelled, labelled, path, ["wear", "noise"], "label2", batch_size=3)
    net = Network(features=2, outputs=3, units=(5,), dropout=0.0, many_to_one=False, precision="float64")
    settings = Settings(epochs=2, workers=2, averaging_frequency=1)
    out = fit_stored(spark, path, net, settings, Adam(rate=0.02))
    scaled = apply_scaler(labelled, fit_scaler(labelled.where("id < 11"), ["wear", "noise"]))
    direct = fit_lives(scaled, net, ["wear", "noise"], batch_size=3, settings=settings, adam=Adam(rate=0.02))
    assert np.allclose(out.weights.values, direct.weights.values, atol=1e-6)
    rows = stored_rows(spark, path, "test", 2)
    predictions, row = evaluate_rows(rows, net, out.weights)
    other, _ = evaluate_lives(scaled, net, out.weights, ["wear", "noise"], batch_size=5)
    key = lambda r: (r["id"], r["pos"])
    a, b = sorted(predictions.collect(), key=key), sorted(other.collect(), key=key)
    assert [key(r) for r in a] == [key(r) for r in b]
    assert np.allclose([r["prob"] for r in a], [r["prob"] for r in b], atol=1e-5)
    assert 0 <= row.first()["accuracy"] <= 1


def test_gaps_and_late_beginnings_change_nothing(labelled):
    """Windows and lives are made of rows: cycles may have gaps and begin anywhere."""
    odd = labelled.withColumn("cycle", F.col("cycle") * 3 + F.col("id") * 1000)
    for net, fn in ((NET, evaluate_windows), (STEPS, evaluate_lives)):
        given = {"length": LENGTH} if net is NET else {}
        a, b = (fn(t, net, Weights(net.initial()), ["wear", "noise"], **given)[0] for t in (labelled, odd))
        assert a.count() > 50 and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_a_label_without_a_whole_window_fails(fleet):
    with pytest.raises(Exception, match="fewer rows before it"):
        score(windows(fleet).where("pos > 2"), NET, NET.initial(), LENGTH).collect()


STEPS = Network(features=2, outputs=3, units=(4, 3), dropout=0.0, many_to_one=False, precision="float64")


def test_blocks_carry_the_state(fleet):
    """A life of many blocks scores as in one piece, and so does one that begins in a later block."""
    rng = np.random.default_rng(1)
    lengths = {1: 130, 2: 20, 3: 51}
    data = [(i, c, float(rng.normal()), float(rng.normal()), c % 3) for i, n in lengths.items() for c in range(1, n + 1)]
    log = fleet.sparkSession.createDataFrame(data, "id long, cycle long, wear double, noise double, y long")
    rows = life_batch_rows(log, life_batches(series_lengths(log), 3), ["wear", "noise"], "y")
    got = {(r["id"], r["pos"]): r["prob"] for r in score(rows, STEPS, STEPS.initial()).collect()}
    for i, n in lengths.items():
        x = np.array([[[np.float32(a), np.float32(b)] for e, c, a, b, _ in data if e == i]], float)
        want = forward(STEPS, STEPS.initial(), x)[0][0]
        assert np.allclose([got[i, c] for c in range(1, n + 1)], want)


def test_exported_rounds_can_be_deleted(fleet):
    from pathlib import Path

    rounds = export_rounds(windows(fleet), Settings(workers=2, length=LENGTH))
    assert Path(rounds.path).exists()
    rounds.delete()
    assert not Path(rounds.path).exists()
