"""Synchronous parameter averaging over Spark workers."""

from __future__ import annotations

import itertools
import math
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from cyclemill.functions.lstm import Adam, Network, Weights, forward, gradient, log_loss, zero_state
from cyclemill.operators.balance import balanced_workers
from cyclemill.operators.metrics import evaluation, evaluation_of_cells
from cyclemill.operators.sequences import BLOCK_STEPS
from cyclemill.plans.scoring import score
from cyclemill.plans.tensors import carried, in_order, minibatches
from cyclemill.session import delete_table, shared_folder
from cyclemill.sizing import setting, small_side
from cyclemill.sources.journal import Journal
from cyclemill.sources.models import append_stats, save_model

MAX_DIRECTORIES = 2048
BATCHES_PER_FILE = 2048
STATS_BUFFER = 10_000
ROUND_SCHEMA = (
    "batch_id long, id long, t long, pos long, x array<float>, y float, is_label boolean, "
    "round long, worker int, round_group int"
)
# one row per worker, and one per optimiser step if they are asked for
CELL = "iteration long, label long, prediction long, n long, loss double"
TRAINED = (
    "kind string, worker int, n double, loss double, seconds double, packed array<double>, "
    f"cells array<struct<{CELL.replace(' ', ':').replace(',:', ', ')}>>, "
    "batch_id long, iteration long, step int, norm double"
)
CHUNK = 1 << 14
# up to so many workers for each core have a task of their own; of more, a task takes several one by one
TASKS_PER_CORE = 4
WORKERS_PER_TASK = 1024
# what a task holds of its results before it hands them on
SENT_BYTES, SENT_ROWS = 16 << 20, 10_000
# rounds that are read from their files at once, and rows of one worker in them
HELD_ROUNDS, HELD_ROWS = 64, 1 << 16


@dataclass(frozen=True)
class Settings:
    epochs: int = 10
    workers: int = 8
    averaging_frequency: int = 5
    length: int = 50
    tbptt: int = BLOCK_STEPS
    # evaluations within an epoch: their cost grows with the data as the epoch's does
    evaluations_per_epoch: int | None = None
    patience: int | None = 1
    # every so many iterations of a worker, its first included, its minibatch is evaluated after the step
    evaluate_every: int | None = None
    # deal minibatches by their real steps; None is for whole lives only, whose minibatches differ
    balanced: bool | None = None


@dataclass(frozen=True)
class Rounds:
    """Minibatches written once; each averaging round reads its own part."""

    table: DataFrame
    count: int
    path: str
    rows: int = 0

    def read(self, number: int) -> DataFrame:
        directory = number % MAX_DIRECTORIES
        return self.table.where((F.col("round_group") == directory) & (F.col("round") == number))

    def held_at_once(self, workers: int) -> int:
        """How many rounds are held together, by the rows that a worker has in a round."""
        return min(HELD_ROUNDS, HELD_ROWS * workers * self.count // max(self.rows, 1))

    def hold(self, first: int, count: int, net: Network, settings: Settings) -> RDD:
        """Rounds ``first`` to ``first + count - 1`` in executors: a partition of each worker's rows, in order, as (round, Arrow stream)."""
        group, last = F.col("round_group"), first + count
        near = group.isin([n % MAX_DIRECTORIES for n in range(first, last)])
        rows = self.table.where(near & F.col("round").between(first, last - 1))
        placed = in_order(rows.repartitionById(settings.workers, F.col("worker")), net, settings.tbptt, "round")
        return placed.mapInArrow(streams, "round long, part binary").rdd.persist(StorageLevel.MEMORY_AND_DISK)

    def delete(self) -> None:
        """Remove the written table once training is done."""
        delete_table(self.table.sparkSession, self.path)


@dataclass
class Trained:
    net: Network
    weights: Weights
    epochs: int = 0
    rounds: int = 0
    # one entry per evaluation: epoch, round, which data, and the measures
    evaluations: list[dict] = field(default_factory=list)
    stats: list[tuple] = field(default_factory=list)


def export_rounds(rows: DataFrame, settings: Settings, path: str | None = None) -> Rounds:
    """Write batch rows by averaging round, spread over the workers: round-robin, or balanced by their steps.

    A worker's share of a round is ``averaging_frequency`` minibatches, so no group
    grows with the data. A round has one file for every ``BATCHES_PER_FILE`` of its
    batches and a directory that it shares only above ``MAX_DIRECTORIES`` rounds; files
    are sorted by round, which lets a round's filter skip the rest. The rows are
    computed once: how many rounds there are is read from the written table.
    """
    spark = rows.sparkSession
    path = path or shared_folder(spark, "rounds")
    if settings.balanced:
        with written(rows, "unbalanced") as plain:
            costs = plain.groupBy("batch_id").agg(F.count(F.lit(1)).alias("cost"))
            dealt = balanced_workers(costs, settings.workers, settings.averaging_frequency)
            side = small_side(dealt.select("batch_id", "round", "worker"))
            _write_rounds(plain.join(side, "batch_id"), settings, path)
    else:
        per_round = settings.workers * settings.averaging_frequency
        number = F.floor(F.col("batch_id") / per_round).cast("long")
        worker = F.pmod("batch_id", F.lit(settings.workers)).cast("int")
        _write_rounds(rows.withColumns({"round": number, "worker": worker}), settings, path)
    return open_rounds(spark, path)


def _write_rounds(rows: DataFrame, settings: Settings, path: str) -> None:
    files = math.ceil(settings.workers * settings.averaging_frequency / BATCHES_PER_FILE)
    (
        rows.withColumn("round_group", (F.col("round") % MAX_DIRECTORIES).cast("int"))
        .repartition("round", F.col("worker") % files)
        .sortWithinPartitions("round_group", "round", "worker")
        .write.mode("overwrite")
        .partitionBy("round_group")
        .parquet(path)
    )


def open_rounds(spark: SparkSession, path: str) -> Rounds:
    """Rounds that were exported before, perhaps by another driver."""
    table = spark.read.schema(ROUND_SCHEMA).parquet(path)
    last, rows = table.agg(F.max("round"), F.count("round")).first()
    return Rounds(table, 0 if last is None else last + 1, path, rows)


@contextmanager
def written(rows: DataFrame | None, purpose: str) -> Iterator[DataFrame | None]:
    """The same rows from a written table, so that repeated use does not recompute them."""
    if rows is None:
        yield None
        return
    spark = rows.sparkSession
    path = shared_folder(spark, purpose)
    rows.write.parquet(path)
    try:
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        delete_table(spark, path)


class Counters:
    """What a worker reports beside its weights: steps taken, and evaluations of its own minibatches."""

    def __init__(self, settings: Settings, round_no: int, record: bool):
        self.every, self.record = settings.evaluate_every, record
        self.first = round_no * settings.averaging_frequency
        self.steps: list[tuple] = []
        self.cells: dict[tuple, list] = {}
        self.batch = self.number = self.step = None
        self.state: list = []

    def begin(self, batch: int) -> None:
        """Minibatches are numbered through the training, by round and place in the worker's share."""
        if batch != self.batch:
            self.number = self.first if self.number is None else self.number + 1
            self.batch, self.step = batch, 0

    def took(self, n: float, loss: float, grad: np.ndarray) -> None:
        if self.record:
            self.steps.append((self.batch, self.number, self.step, n, loss, float(np.sqrt((grad * grad).sum()))))
        self.step += 1

    def evaluate(self, b, net: Network, values: np.ndarray, ids: np.ndarray | None) -> None:
        """Score the minibatch with the weights after its step, without dropout; lives carry a state of their own."""
        if not self.every or self.number % self.every:
            return
        start = None
        if not net.many_to_one:
            start = carried(self.state, None if b.first else ids, b.ids, zero_state(net, len(b.ids)))
        prob, self.state = forward(net, values, b.x, b.mask, start, keep=False)[:2]
        real = b.rows >= 0
        label, p = b.y[real].astype(int), prob[real]
        predicted = (p[:, 0] > 0.5).astype(int) if net.outputs == 1 else p.argmax(1)
        for actual, guess, loss in zip(label.tolist(), predicted.tolist(), log_loss(net, p, label).tolist()):
            cell = self.cells.setdefault((self.number, actual, guess), [0, 0.0])
            cell[0] += 1
            cell[1] += loss


def local_steps(
    batches: Iterator[pa.RecordBatch],
    net: Network,
    weights: Weights,
    adam: Adam,
    settings: Settings,
    seed: int | None,
    counters: Counters | None = None,
) -> tuple[float, float]:
    """Take the optimiser through one worker's minibatches, in order; returns terms seen and summed loss.

    Lives are read in blocks of ``tbptt`` steps; their state goes on from block to block,
    the gradient does not.
    """
    rng = None if seed is None else np.random.default_rng(seed)
    terms = loss = 0.0
    state, ids = [], None
    for b in minibatches(batches, net, settings.length, settings.tbptt):
        start = None
        if not net.many_to_one:
            start = carried(state, None if b.first else ids, b.ids, zero_state(net, len(b.ids)))
        part_loss, n, grad, state = gradient(net, weights.values, b.x, b.y, b.mask, start, rng)
        if n:
            weights.update(grad, adam)
        if counters is not None:
            counters.begin(b.table.column("batch_id")[0].as_py())
            counters.took(n, part_loss, grad)
            counters.evaluate(b, net, weights.values, ids)
        ids = b.ids
        terms, loss = terms + n, loss + part_loss
    return terms, loss


def worker_tasks(workers: int, cores: int) -> int:
    """Tasks of a round: one for each worker, or fewer of several workers each, as a task costs more than a short share."""
    return min(workers, max(TASKS_PER_CORE * cores, math.ceil(workers / WORKERS_PER_TASK)))


def by_value(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """The rows of one value of a column after the other, which lie together; each value's are read to their end."""

    def cut() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            value = batch.column(batch.schema.get_field_index(name)).to_numpy()
            bounds = [0, *(np.flatnonzero(value[1:] != value[:-1]) + 1).tolist(), len(value)]
            for a, b in zip(bounds, bounds[1:]):
                yield int(value[a]), batch.slice(a, b - a)

    for value, own in itertools.groupby(cut(), key=lambda part: part[0]):
        yield value, (batch for _, batch in own)


def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every stretch of rows of one round as an Arrow stream; a longer one has several."""
    for number, own in by_value(batches, "round"):
        for batch in own:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_pydict({"round": pa.array([number]), "part": pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def work_of(worker: int, own: Iterator[pa.RecordBatch], packed, net, adam, settings, round_no: int, record: bool):
    """What a worker makes of its share of a round: a row of ``TRAINED`` with its weights, and its counters."""
    began = time.perf_counter()
    mine = Weights.unpack(packed)
    # the seed depends on round and worker only: a repeated task repeats its result
    seed = (net.seed * 1_000_003 + round_no) * 1_000_003 + worker if net.dropout else None
    counters = Counters(settings, round_no, record)
    terms, loss = local_steps(own, net, mine, adam, settings, seed, counters)
    held = [dict(zip(CELL_NAMES, (*k, *v))) for k, v in sorted(counters.cells.items())]
    whole = {"kind": "worker", "worker": worker, "n": terms, "loss": loss, "seconds": time.perf_counter() - began, "cells": held}
    return {**whole, "packed": mine.pack()}, counters


def average_round(
    rows: DataFrame,
    net: Network,
    weights: Weights,
    adam: Adam,
    settings: Settings,
    round_no: int,
    driver_bytes: int | None = None,
    steps_path: str | None = None,
    cells: list | None = None,
) -> tuple[Weights, list[tuple]]:
    """One round: every worker trains from the same weights, then all are averaged by terms seen.

    If the vectors of all workers together fit ``driver_bytes`` they are averaged on
    the driver. Otherwise they are averaged in Spark, and only the result, of the
    model's size, and one statistics row per worker reach the driver.

    ``steps_path`` is a directory for one row per optimiser step, which the workers write and
    which replaces what was there. ``cells`` receives the counts of ``evaluate_every``: rows of
    (iteration, label, prediction, n, loss), merged over the workers.
    """
    spark = rows.sparkSession
    packed = weights.pack()
    shared = spark.sparkContext.broadcast(packed)
    record = steps_path is not None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size = [], 0
        for worker, own in by_value(batches, "worker"):
            whole, counters = work_of(worker, own, shared.value, net, adam, settings, round_no, record)
            made.append(whole)
            made += [
                {"kind": "step", "worker": worker, "batch_id": batch, "iteration": number, "step": step, "n": n, "loss": part, "norm": norm}
                for batch, number, step, n, part, norm in counters.steps
            ]
            size += packed.nbytes
            if size >= SENT_BYTES or len(made) >= SENT_ROWS:
                yield pa.RecordBatch.from_pylist(made, schema=schema)
                made, size = [], 0
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=schema)

    schema = to_arrow_schema(_parse_datatype_string(TRAINED))
    # a worker lies in one partition, which reads its rows in order
    tasks = worker_tasks(settings.workers, spark.sparkContext.defaultParallelism)
    placed = in_order(rows.repartitionById(tasks, F.col("worker") % tasks), net, settings.tbptt, "worker")
    trained = placed.mapInArrow(work, TRAINED)
    try:
        if record:
            trained.write.mode("overwrite").partitionBy("kind").parquet(steps_path)
            trained = spark.read.schema(TRAINED).parquet(steps_path)
        trained = trained.where("kind = 'worker' AND n > 0")
        if packed.nbytes * settings.workers <= setting(rows, "driverBytes", driver_bytes):
            stats, found, average = _average_here(trained)
        else:
            stats, found, average = _average_in_spark(trained, len(packed))
    finally:
        shared.destroy()
        if record:
            delete_table(spark, f"{steps_path}/kind=worker")
    return _averaged(weights, stats, found, average, round_no, cells)


def average_held_round(
    held: RDD, number: int, net: Network, weights: Weights, adam: Adam, settings: Settings, round_no: int, cells: list | None = None
) -> tuple[Weights, list[tuple]]:
    """As ``average_round``, for round ``number`` of those in ``held``: neither files nor a shuffle nor a plan, for rounds by the thousand."""
    packed = weights.pack()

    def work(worker: int, parts) -> Iterator[dict]:
        own = (batch for part in parts if part["round"] == number for batch in pa.ipc.open_stream(part["part"]))
        yield work_of(worker, own, packed, net, adam, settings, round_no, False)[0]

    made = sorted((r for r in held.mapPartitionsWithIndex(work).collect() if r["n"] > 0), key=lambda r: r["worker"])
    stats = [tuple(r[c] for c in STATS) for r in made]
    average = np.average([r["packed"] for r in made], axis=0, weights=[r["n"] for r in made]) if made else None
    return _averaged(weights, stats, [r["cells"] for r in made], average, round_no, cells)


def _averaged(weights: Weights, stats: list[tuple], found: list, average, round_no: int, cells: list | None):
    if cells is not None:
        cells += merged_cells(found)
    if not stats:
        return weights, []
    if not np.isfinite(average).all():
        raise FloatingPointError(f"round {round_no} produced weights that are not finite")
    return Weights.unpack(average), stats


CELL_NAMES = ("iteration", "label", "prediction", "n", "loss")


def merged_cells(found: list[list[dict]]) -> list[tuple]:
    """Counts of all workers by iteration, label and prediction; losses are summed in the order of the workers."""
    sums: dict[tuple, list] = {}
    for cell in itertools.chain.from_iterable(found):
        held = sums.setdefault((cell["iteration"], cell["label"], cell["prediction"]), [0, 0.0])
        held[0] += cell["n"]
        held[1] += cell["loss"]
    return [(*k, *v) for k, v in sorted(sums.items())]


STATS = ("worker", "n", "loss", "seconds")


def _average_here(trained: DataFrame):
    table = trained.select(*STATS, "cells", "packed").toArrow().sort_by("worker").combine_chunks()
    rows = table.drop_columns("packed").to_pylist()
    stats = [tuple(r[c] for c in STATS) for r in rows]
    if not stats:
        return stats, [], None
    vectors = table.column("packed").combine_chunks().flatten().to_numpy().reshape(len(stats), -1)
    return stats, [r["cells"] for r in rows], np.average(vectors, axis=0, weights=table.column("n").to_numpy())


def _average_in_spark(trained: DataFrame, size: int):
    """Average piece by piece of the vectors, always in the order of the workers, so that a repeated round repeats its result."""

    def average(part: pa.Table) -> pa.Table:
        part = part.sort_by("worker").combine_chunks()
        vectors = part.column("values").combine_chunks().flatten().to_numpy().reshape(len(part), -1)
        mean = np.average(vectors, axis=0, weights=part.column("n").to_numpy())
        return pa.table({"piece": part.column("piece").slice(0, 1), "values": pa.array([mean], pa.list_(pa.float64()))})

    with written(trained.select(*STATS, "cells", "packed"), "vectors") as held:
        rows = sorted(held.select(*STATS, "cells").collect(), key=lambda r: r["worker"])
        starts = F.sequence(F.lit(0), F.lit(size - 1), F.lit(CHUNK))
        pieces = held.select("worker", "n", "packed", F.posexplode(starts).alias("piece", "start")).select(
            "worker", "n", "piece", F.slice("packed", F.col("start") + 1, F.lit(CHUNK)).alias("values"))
        means = pieces.groupBy("piece").applyInArrow(average, "piece int, values array<double>").toArrow()
    if not rows:
        return [], [], None
    made = means.sort_by("piece").column("values").combine_chunks().flatten().to_numpy()
    return [tuple(r[c] for c in STATS) for r in rows], [[c.asDict() for c in r["cells"]] for r in rows], made


def train(
    spark: SparkSession,
    rounds: Rounds,
    net: Network,
    settings: Settings,
    adam: Adam = Adam(),
    init: Weights | None = None,
    validation: DataFrame | None = None,
    run: str = "model",
    stats_path: str | None = None,
    model_path: str | None = None,
    on_round: Callable[[int, Weights], None] | None = None,
    steps_path: str | None = None,
    journal: Journal | None = None,
) -> Trained:
    """Train for up to ``settings.epochs`` passes over the exported rounds.

    ``init`` continues from given weights and optimiser state. ``validation`` holds
    batch rows: its loss after each epoch stops training once it has not improved for
    ``patience`` epochs. ``evaluations_per_epoch`` also evaluates a round's own batches and
    the validation rows so often in an epoch, beginning with its first round. ``evaluate_every``
    evaluates every so many iterations of the workers without another pass.

    ``steps_path`` collects one row per optimiser step. With a ``journal`` every round is
    committed: the same call goes on after the last round of a run that was cut short, with the weights and
    statistics that the whole run would have had. Statistics then lie in the journal.
    """
    with written(validation, "validation") as held:
        return _Run(spark, rounds, net, settings, adam, held, run, stats_path, model_path, on_round, steps_path, journal).go(init)


class _Run:
    """One training: where it stands, and what it writes."""

    def __init__(
        self, spark, rounds, net, settings, adam, validation, run, stats_path, model_path, on_round, steps_path, journal
    ):
        self.spark, self.rounds, self.net, self.settings, self.adam = spark, rounds, net, settings, adam
        self.validation, self.run, self.stats_path, self.model_path = validation, run, stats_path, model_path
        self.on_round, self.steps_path, self.journal = on_round, steps_path, journal
        self.best, self.worse = math.inf, 0
        # the next round of the epoch that is under way
        self.epoch, self.number = 1, 0
        self.over = False
        # rounds that executors hold, and the first of them
        self.held, self.first = None, 0

    def go(self, init: Weights | None) -> Trained:
        self.result = Trained(self.net, init or Weights(self.net.initial()))
        # every, not only the first, round that begins a share of an epoch
        self.every = max(1, math.ceil(self.rounds.count / (self.settings.evaluations_per_epoch or 1)))
        if self.journal:
            self.restore()
        try:
            while not self.over and self.epoch <= self.settings.epochs:
                while self.number < self.rounds.count:
                    self.one_round()
                self.end_epoch()
        finally:
            self.release()
        self.flush()
        return self.result

    def release(self) -> None:
        if self.held is not None:
            self.held.unpersist()
            self.held = None

    def hold(self) -> bool:
        """Have executors hold the round that is next, with those that follow it, unless its workers or their vectors are too many."""
        size, settings = self.result.weights.pack().nbytes, self.settings
        count = self.rounds.held_at_once(settings.workers)
        if (
            self.steps_path or min(count, self.rounds.count) < 2
            or settings.workers > TASKS_PER_CORE * self.spark.sparkContext.defaultParallelism
            or size * settings.workers > setting(self.rounds.table, "driverBytes")
        ):
            return False
        if self.held is None or not self.first <= self.number < self.first + count:
            self.release()
            self.first = self.number
            self.held = self.rounds.hold(self.first, count, self.net, settings)
        return True

    def one_round(self) -> None:
        result, number = self.result, self.result.rounds
        rows, cells = self.rounds.read(self.number), []
        path = self.steps_path and f"{self.steps_path}/run={self.run}/epoch={self.epoch}/round={number}"
        if self.hold():
            result.weights, stats = average_held_round(
                self.held, self.number, self.net, result.weights, self.adam, self.settings, number, cells)
        else:
            result.weights, stats = average_round(
                rows, self.net, result.weights, self.adam, self.settings, number, steps_path=path, cells=cells)
        fresh = [(self.run, self.epoch, number, *s) for s in stats]
        for iteration, own in itertools.groupby(cells, key=lambda c: c[0]):
            self.note("iteration", {"iteration": iteration, **evaluation_of_cells([c[1:] for c in own])})
        if self.settings.evaluations_per_epoch and self.number % self.every == 0:
            self.measure("batch", rows)
            if self.validation is not None:
                self.measure("validation", self.validation)
        result.rounds, self.number = number + 1, self.number + 1
        if self.journal:
            self.journal.add_stats(number, fresh)
            self.commit()
        elif self.stats_path:
            result.stats += fresh
            if len(result.stats) >= STATS_BUFFER:
                self.flush()
        else:
            result.stats += fresh
        if self.on_round:
            self.on_round(result.rounds, result.weights)

    def end_epoch(self) -> None:
        result = self.result
        result.epochs = self.epoch
        if self.model_path:
            save_model(self.spark, self.model_path, self.net, result.weights, self.run, self.epoch)
        if self.validation is not None:
            loss = self.measure("epoch", self.validation)
            improved = loss is not None and loss < self.best
            self.best, self.worse = (loss, 0) if improved else (self.best, self.worse + 1)
            self.over = bool(self.settings.patience and self.worse >= self.settings.patience)
        self.epoch, self.number = self.epoch + 1, 0
        if self.journal:
            self.commit()

    def measure(self, kind: str, rows: DataFrame) -> float:
        scored = score(rows, self.net, self.result.weights.values, self.settings.length)
        row = evaluation(scored, exact=True).first().asDict()
        self.note(kind, row)
        return row["loss"]

    def note(self, kind: str, row: dict) -> None:
        self.result.evaluations.append({"epoch": self.epoch, "round": self.result.rounds, "data": kind, **row})

    def flush(self) -> None:
        if self.stats_path and self.result.stats:
            append_stats(self.spark, self.stats_path, self.result.stats)
            self.result.stats = []

    def mark(self) -> str:
        """What a journal must agree with to be gone on with."""
        return f"{self.net.to_json()} {self.settings} {self.adam} {self.rounds.count}"

    def commit(self) -> None:
        state = {
            "mark": self.mark(), "epoch": self.epoch, "number": self.number, "rounds": self.result.rounds,
            "epochs": self.result.epochs, "best": self.best, "worse": self.worse, "over": self.over,
            "evaluations": self.result.evaluations,
        }
        self.journal.commit(state, self.result.weights)

    def restore(self) -> None:
        found = self.journal.last()
        if found is None:
            return
        state, self.result.weights = found
        if state["mark"] != self.mark():
            raise ValueError("the journal is of a run with another network, other settings or other rounds")
        self.epoch, self.number, self.over = state["epoch"], state["number"], state["over"]
        self.best, self.worse = state["best"], state["worse"]
        self.result.rounds, self.result.epochs = state["rounds"], state["epochs"]
        self.result.evaluations = state["evaluations"]
