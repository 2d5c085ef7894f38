"""Going on after a crash, statistics of every step, evaluations on the way, and balanced workers."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_training import LENGTH, fleet, lives, windows  # noqa: F401

from cyclemill.functions.lstm import Adam, Network, Weights, forward, gradient, log_loss
from cyclemill.operators.balance import balanced_workers, worker_loads
from cyclemill.operators.metrics import evaluation, evaluation_of_cells
from cyclemill.plans.experiment import fit_windows
from cyclemill.plans.scoring import score
from cyclemill.plans.tensors import in_order, minibatches
from cyclemill.plans.training import Settings, average_round, export_rounds, open_rounds, train
from cyclemill.sources.journal import Journal
from cyclemill.sources.models import read_steps

NET = Network(features=2, outputs=1, units=(3,), dropout=0.2, precision="float64")
STILL = Network(features=2, outputs=1, units=(3,), dropout=0.0, precision="float64")
STEPWISE = Network(features=2, outputs=2, units=(3,), dropout=0.0, many_to_one=False, precision="float64")


def statistics(journal):
    return sorted(tuple(r)[:6] for r in journal.stats().collect())


@pytest.mark.parametrize("driver_bytes", ["0", str(1 << 30)])
def test_a_run_cut_short_anywhere_ends_as_a_whole_one(spark, fleet, tmp_path, driver_bytes):  # noqa: F811
    settings = Settings(epochs=3, workers=3, averaging_frequency=2, length=LENGTH, patience=1, evaluate_every=3)
    held = windows(fleet.where("id > 9"))
    rounds = export_rounds(windows(fleet.where("id <= 9")), settings, str(tmp_path / "rounds"))
    spark.conf.set("spark.cyclemill.driverBytes", driver_bytes)

    def run(journal, on_round=None):
        return train(spark, open_rounds(spark, rounds.path), NET, settings, validation=held, journal=journal, on_round=on_round)

    def stop(number, weights):
        raise InterruptedError

    try:
        whole = Journal(spark, str(tmp_path / "whole"))
        want = run(whole)
        broken = Journal(spark, str(tmp_path / "broken"))
        for _ in range(want.rounds):  # dies after every single round
            with pytest.raises(InterruptedError):
                run(broken, stop)
        got = run(broken)
    finally:
        spark.conf.unset("spark.cyclemill.driverBytes")
    assert (got.weights.pack() == want.weights.pack()).all()
    assert got.evaluations == want.evaluations and got.rounds == want.rounds and got.epochs == want.epochs
    assert statistics(broken) == statistics(whole) and len(statistics(whole)) > want.rounds
    # a run that is over stays as it is
    assert (run(broken).weights.pack() == want.weights.pack()).all()


def test_a_crash_before_the_commit_repeats_the_round(spark, fleet, tmp_path, monkeypatch):  # noqa: F811
    settings = Settings(epochs=1, workers=2, averaging_frequency=2, length=LENGTH)
    rounds = export_rounds(windows(fleet), settings)
    want = train(spark, rounds, NET, settings, journal=Journal(spark, str(tmp_path / "a")))
    journal = Journal(spark, str(tmp_path / "b"))
    commit = Journal.commit

    def die(self, state, weights):
        if state["rounds"] == 2:
            raise OSError
        commit(self, state, weights)

    monkeypatch.setattr(Journal, "commit", die)
    with pytest.raises(OSError):
        train(spark, rounds, NET, settings, journal=journal)
    assert journal.last()[0]["rounds"] == 1
    assert {r["round"] for r in journal.stats().collect()} == {0}  # what was not committed does not show
    monkeypatch.undo()
    got = train(spark, rounds, NET, settings, journal=journal)
    assert (got.weights.pack() == want.weights.pack()).all()
    assert statistics(journal) == statistics(Journal(spark, str(tmp_path / "a")))
    rounds.delete()


def test_another_run_does_not_go_on(spark, fleet, tmp_path):  # noqa: F811
    settings = Settings(epochs=1, workers=2, averaging_frequency=2, length=LENGTH)
    rounds, journal = export_rounds(windows(fleet), settings), Journal(spark, str(tmp_path))
    train(spark, rounds, NET, settings, journal=journal)
    with pytest.raises(ValueError, match="journal"):
        train(spark, rounds, NET, settings, Adam(rate=0.5), journal=journal)
    rounds.delete()
    assert Journal(spark, str(tmp_path / "none")).last() is None
    assert Journal(spark, str(tmp_path / "none")).stats().count() == 0


def test_fit_goes_on_from_its_own_export(spark, fleet, tmp_path):  # noqa: F811
    settings = Settings(epochs=2, workers=2, averaging_frequency=2, length=LENGTH)
    outputs = dict(features=["wear", "noise"], label="y", batch_size=8, settings=settings)
    want = fit_windows(fleet, NET, **outputs)

    def stop(number, weights):
        if number == 2:
            raise InterruptedError

    path = str(tmp_path / "fit")
    with pytest.raises(InterruptedError):
        fit_windows(fleet, NET, resume_path=path, on_round=stop, **outputs)
    nothing = fleet.where("id < 0")  # rows are read from the first export
    got = fit_windows(nothing.unionByName(fleet.where("id < 3")), NET, resume_path=path, **outputs)
    assert (got.weights.pack() == want.weights.pack()).all() and got.evaluations == want.evaluations


@pytest.mark.parametrize("net,rows", [(NET, windows), (STEPWISE, lives)])
def test_steps_are_those_of_the_workers(spark, fleet, tmp_path, net, rows):  # noqa: F811
    settings = Settings(epochs=2, workers=3, averaging_frequency=2, length=LENGTH, tbptt=8)
    rounds, path = export_rounds(rows(fleet), settings), str(tmp_path / "steps")
    result = train(spark, rounds, net, settings, steps_path=path)
    steps = read_steps(spark, path)
    sums = steps.groupBy("run", "epoch", "round", "worker").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss")).collect()
    want = {(r[1], r[2], r[3]): (r[4], r[5]) for r in result.stats}
    assert {(r.epoch, r.round, r.worker): r.n for r in sums} == {k: v[0] for k, v in want.items()}
    assert np.allclose([r.loss for r in sums], [want[r.epoch, r.round, r.worker][1] for r in sums])
    assert steps.where("norm > 0 AND n > 0").count() == steps.count()
    batches = rounds.table.select("batch_id").distinct().count()
    assert steps.select("epoch", "batch_id").distinct().count() == 2 * batches
    if net.many_to_one:
        assert steps.count() == 2 * batches
    rounds.delete()


@pytest.mark.parametrize("net,rows", [(NET, windows), (STEPWISE, lives)])
def test_evaluation_on_the_way_equals_a_separate_pass(fleet, net, rows):  # noqa: F811
    """One worker with one minibatch: its weights after the step are those of the round."""
    settings = Settings(workers=1, averaging_frequency=1, length=LENGTH, evaluate_every=10)
    rounds, cells = export_rounds(rows(fleet), settings), []
    weights, _ = average_round(rounds.read(1), net, Weights(net.initial()), Adam(), settings, 0, cells=cells)
    got = evaluation_of_cells([c[1:] for c in cells])
    want = evaluation(score(rounds.read(1), net, weights.values, LENGTH)).first().asDict()
    assert {c[0] for c in cells} == {0}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    rounds.delete()


def most_tasks(spark, name, call):
    """What ``call`` returns, and the tasks of its largest stage."""
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        made = call()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(name) for s in (tracker.getJobInfo(j).stageIds if tracker.getJobInfo(j) else [])]
    return made, max(info.numTasks for info in map(tracker.getStageInfo, stages) if info)


def test_iterations_of_workers_that_share_a_task(spark, fleet):  # noqa: F811
    """Each worker's minibatch is evaluated with that worker's weights, however many workers a task has."""
    rows = windows(fleet, 1)
    workers = rows.agg(F.max("batch_id")).first()[0] + 1
    settings = Settings(workers=workers, averaging_frequency=1, length=LENGTH, evaluate_every=10)
    rounds, cells = export_rounds(rows, settings), []
    net, start = STILL, Weights(STILL.initial())
    _, most = most_tasks(spark, "cells", lambda: average_round(rounds.read(0), net, start, Adam(), settings, 0, cells=cells))
    assert most < workers
    loss = n = 0
    for b in minibatches(in_order(rounds.read(0).repartition(1), net, settings.tbptt).toArrow().to_batches(), net, LENGTH, settings.tbptt):
        mine = Weights(net.initial())
        mine.update(gradient(net, mine.values, b.x, b.y)[2], Adam())
        loss, n = loss + log_loss(net, forward(net, mine.values, b.x)[0], b.y).sum(), n + len(b.y)
    assert sum(c[3] for c in cells) == n == workers and sum(c[4] for c in cells) == pytest.approx(loss, abs=1e-9)
    rounds.delete()


def test_workers_that_share_a_task_go_on_from_the_journal(spark, fleet, tmp_path):  # noqa: F811
    rows = windows(fleet, 1)
    workers = (rows.agg(F.max("batch_id")).first()[0] + 2) // 2
    settings = Settings(epochs=1, workers=workers, averaging_frequency=1, length=LENGTH)
    rounds, journal = export_rounds(rows, settings), Journal(spark, str(tmp_path / "journal"))

    def stop(number, weights):
        raise InterruptedError

    with pytest.raises(InterruptedError):
        train(spark, rounds, NET, settings, journal=journal, on_round=stop)
    got, most = most_tasks(spark, "resumed", lambda: train(spark, rounds, NET, settings, journal=journal))
    assert (got.weights.pack() == train(spark, rounds, NET, settings).weights.pack()).all()
    assert got.rounds == rounds.count == 2 and most < workers
    assert len({r[3] for r in statistics(journal) if r[2] == 0}) == workers
    rounds.delete()


def test_cadence_counts_iterations_through_the_training(spark, fleet):  # noqa: F811
    settings = Settings(epochs=2, workers=2, averaging_frequency=2, length=LENGTH, evaluate_every=3)
    rounds = export_rounds(windows(fleet), settings)
    result = train(spark, rounds, NET, settings)
    found = [e["iteration"] for e in result.evaluations if e["data"] == "iteration"]
    assert found == list(range(0, 2 * 2 * rounds.count, 3))[:len(found)]
    assert len(found) >= 2 * 2 * (rounds.count - 1) // 3
    rounds.delete()


@pytest.mark.parametrize("workers,per_worker", [(8, 5), (3, 1), (64, 5)])
def test_balanced_workers(spark, workers, per_worker):
    """Costs of a heavy-tailed fleet: every minibatch once, every worker within a tenth of the mean.

    With 64 workers the largest minibatch alone is more than a mean share: shares differ by no more than that.
    """
    rng = np.random.default_rng(5)
    cost = np.minimum((rng.pareto(1.2, 6000) + 1) * 50, 20_000).astype(int).tolist()
    costs = spark.createDataFrame(list(enumerate(cost)), "batch_id long, cost long")
    dealt = balanced_workers(costs, workers, per_worker).cache()
    assert sorted((r.batch_id, r.cost) for r in dealt.collect()) == list(enumerate(cost))
    shares = dealt.groupBy("round", "worker").count().collect()
    assert max(r["count"] for r in shares) <= per_worker
    rounds = -(-len(cost) // (workers * per_worker))
    assert {r["round"] for r in shares} == set(range(rounds))
    loads = [r.cost for r in worker_loads(dealt).collect()]
    assert len(loads) == workers and max(loads) - min(loads) <= max(cost)
    assert max(loads) <= max(1.1 * sum(loads) / workers, min(loads) + max(cost))
    assert workers == 64 or max(loads) <= 1.1 * sum(loads) / workers
    # one after the other, as batches come, is worse in most rounds
    def slowest(rows):
        held = {}
        for number, worker, c in rows:
            held.setdefault(number, {}).setdefault(worker, []).append(c)
        return sum(max(map(sum, w.values())) for w in held.values())

    ordered = [(b // (workers * per_worker), b % workers, c) for b, c in enumerate(cost)]
    assert slowest((r["round"], r.worker, r.cost) for r in dealt.collect()) < 0.8 * slowest(ordered)


def test_balanced_workers_of_nothing(spark):
    assert balanced_workers(spark.createDataFrame([], "batch_id long, cost long"), 3, 2).count() == 0


def test_balanced_rounds_hold_every_row_once(fleet):  # noqa: F811
    rows = lives(fleet, 2)
    rounds = export_rounds(rows, Settings(workers=2, averaging_frequency=2, balanced=True))
    key = ["batch_id", "id", "t"]
    assert sorted(map(tuple, rounds.table.select(key).collect())) == sorted(map(tuple, rows.select(key).collect()))
    assert rounds.table.select("batch_id", "round", "worker").distinct().count() == rows.select("batch_id").distinct().count()
    rounds.delete()
