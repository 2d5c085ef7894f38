"""From labelled tables to trained and evaluated models, and to minibatch tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemill.functions.lstm import Adam, Network, Weights
from cyclemill.operators.columns import SERIES_FEATURES
from cyclemill.operators.labels import series_lengths
from cyclemill.operators.metrics import evaluation
from cyclemill.operators.ordering import Extent, measure, number_rows
from cyclemill.operators.scaling import apply_scaler, fit_scaler
from cyclemill.operators.sequences import BLOCK_STEPS, life_batches, padded_lives
from cyclemill.operators.splits import (
    entity_phases,
    life_batch_rows,
    sample_offsets,
    stored_batch_rows,
    window_batch_rows,
)
from cyclemill.plans.scoring import score
from cyclemill.plans.training import Settings, Trained, export_rounds, open_rounds, train, written
from cyclemill.session import delete_table
from cyclemill.sizing import small_side
from cyclemill.sources.batches import publish_batches, read_batches
from cyclemill.sources.journal import Journal, finished
from cyclemill.sources.versions import Versions

# outputs of the classifier per target; None is a regression, whose series are only batched
CLASSES = {"RUL": None, "label1": 2, "label2": 3}
SCORING_BATCH = 512
POSITION = "_position"


@dataclass(frozen=True)
class Series:
    """Labelled series with their lengths, measured once for all that follows.

    Rows are numbered in the order of their cycles: cycles may begin late or have gaps,
    but windows and lives are made of rows. ``POSITION`` holds the number.
    """

    log: DataFrame
    lengths: DataFrame
    extent: Extent

    @staticmethod
    def of(log: DataFrame) -> Series:
        extent = measure(log, ["id"])
        return Series(number_rows(log, ["id"], ["cycle"], POSITION, None, extent), series_lengths(log), extent)

    def part(self, phases: DataFrame, phase: str) -> Series:
        """The entities of one phase; the whole's sizes stay valid as upper bounds."""
        mine = phases.where(F.col("phase") == phase).select("id")
        side = small_side(mine, self.extent.groups)
        return Series(
            self.log.join(side, "id", "left_semi"), self.lengths.join(side, "id", "left_semi"), self.extent
        )


@contextmanager
def numbered_once(log: DataFrame) -> Iterator[Series]:
    """The series of ``log`` from a written table, for plans that read its phases one by one; it is deleted at the end."""
    series = Series.of(log)
    with written(series.log, "numbered") as table:
        lengths = table.groupBy("id").agg(F.max(POSITION).alias("n_cycles"))
        yield Series(table, lengths, series.extent)


def window_rows(
    series: Series, features: Sequence[str], label: str, length: int, batch_size: int, tail: str | None = None
) -> DataFrame:
    offsets = sample_offsets(series.lengths, length, extent=series.extent.as_one_group)
    return window_batch_rows(
        series.log,
        offsets,
        features,
        label,
        length,
        batch_size,
        pos_col=POSITION,
        entities=series.extent.groups,
        tail=tail,
    )


def life_rows(series: Series, features: Sequence[str], label: str, batch_size: int) -> DataFrame:
    batches = life_batches(series.lengths, batch_size, extent=series.extent.as_one_group)
    return life_batch_rows(series.log, batches, features, label, pos_col=POSITION)


def fit_windows(
    labelled: DataFrame,
    net: Network,
    features: Sequence[str],
    label: str = "label1",
    split: str = "entity",
    batch_size: int = 16,
    settings: Settings = Settings(),
    adam: Adam = Adam(),
    init: Weights | None = None,
    resume_path: str | None = None,
    **outputs,
) -> Trained:
    """Train on fixed windows with one label each, validating on a fifth of the data.

    ``split="entity"`` holds back the last entities, ``split="tail"`` the last samples,
    which may cut through one entity. With a ``resume_path`` the same call goes on where
    a run that was cut short had got to: its minibatches, weights and statistics lie there.
    """
    if split not in ("entity", "tail"):
        raise ValueError("split is 'entity' or 'tail'")
    with numbered_once(labelled) as whole:
        if split == "entity":
            phases = entity_phases(whole.lengths, extent=whole.extent.as_one_group)
            mine, other, tails = whole.part(phases, "train"), whole.part(phases, "val"), (None, None)
        else:
            mine, other, tails = whole, whole, ("train", "val")
        rows = window_rows(mine, features, label, settings.length, batch_size, tails[0])
        held = window_rows(other, features, label, settings.length, SCORING_BATCH, tails[1])
        return _fit(rows, held, net, settings, adam, init, outputs, resume_path)


def fit_lives(
    labelled: DataFrame,
    net: Network,
    features: Sequence[str],
    label: str = "label2",
    batch_size: int = 16,
    settings: Settings = Settings(),
    adam: Adam = Adam(),
    init: Weights | None = None,
    resume_path: str | None = None,
    **outputs,
) -> Trained:
    """Train on whole lives with a class per cycle, validating on the last entities."""
    with numbered_once(labelled) as whole:
        phases = entity_phases(whole.lengths, extent=whole.extent.as_one_group)
        rows, held = (
            life_rows(part, features, label, batch_size)
            for part in (whole.part(phases, "train"), whole.part(phases, "val"))
        )
        return _fit(rows, held, net, settings, adam, init, outputs, resume_path)


def _fit(rows, held, net, settings, adam, init, outputs, resume_path=None):
    """Export and train. What lies below ``resume_path`` is kept until the training has come to its end."""
    spark = rows.sparkSession
    if settings.balanced is None:
        settings = replace(settings, balanced=not net.many_to_one)
    if resume_path is None:
        rounds = export_rounds(rows, settings)
        try:
            return train(spark, rounds, net, settings, adam, init, held, **outputs)
        finally:
            rounds.delete()
    at, val = f"{resume_path}/rounds", f"{resume_path}/validation"
    rounds = open_rounds(spark, at) if finished(spark, at) else export_rounds(rows, settings, at)
    if not finished(spark, val):
        held.write.mode("overwrite").parquet(val)
    held = spark.read.schema(held.schema).parquet(val)
    trained = train(
        spark, rounds, net, settings, adam, init, held, journal=Journal(spark, f"{resume_path}/journal"), **outputs)
    for path in (at, val):
        delete_table(spark, path)
    return trained


def evaluate_windows(
    labelled: DataFrame,
    net: Network,
    weights: Weights,
    features: Sequence[str],
    label: str = "label1",
    length: int = 50,
) -> tuple[DataFrame, DataFrame]:
    """Predictions on a test table (``pos`` counts an entity's rows), and their evaluation as one row."""
    rows = window_rows(Series.of(labelled), features, label, length, SCORING_BATCH)
    return evaluate_rows(rows, net, weights, length)


def evaluate_lives(
    labelled: DataFrame,
    net: Network,
    weights: Weights,
    features: Sequence[str],
    label: str = "label2",
    batch_size: int = 16,
) -> tuple[DataFrame, DataFrame]:
    """As ``evaluate_windows``, for a network that classifies every step of a whole life."""
    return evaluate_rows(life_rows(Series.of(labelled), features, label, batch_size), net, weights)


def evaluate_rows(
    rows: DataFrame, net: Network, weights: Weights, length: int = 50
) -> tuple[DataFrame, DataFrame]:
    """Predictions on batch rows, which may come from stored minibatches, and their evaluation."""
    predictions = score(rows, net, weights.values, length)
    return predictions, evaluation(predictions)


def fit_stored(
    spark: SparkSession,
    path: str,
    net: Network,
    settings: Settings = Settings(),
    adam: Adam = Adam(),
    init: Weights | None = None,
    resume_path: str | None = None,
    **outputs,
) -> Trained:
    """Train on the minibatches that ``ingest`` wrote, validating on its validation phase."""
    places = Versions(spark, path).current()
    rows, held = (stored_rows(spark, path, phase, net.features, places) for phase in ("train", "val"))
    return _fit(rows, held, net, settings, adam, init, outputs, resume_path)


def stored_rows(
    spark: SparkSession, path: str, phase: str, features: int, places: dict[str, str] | None = None
) -> DataFrame:
    """The batch rows of one phase of an ingested table; ``places`` as in ``read_batches``."""
    return stored_batch_rows(read_batches(spark, path, phase, places), features, BLOCK_STEPS)


def ingest(
    train_table: DataFrame,
    test_table: DataFrame,
    path: str,
    features: Sequence[str] = SERIES_FEATURES,
    target: str = "label2",
    batch_size: int = 16,
    rescale: bool = True,
) -> DataFrame:
    """Write padded minibatches of train, validation and test lives under ``path``.

    The last fifth of the training entities validates. Features are standardised
    with statistics of the training entities only, which are returned; labels are
    not. A regression target is written as it is, a class as a one-hot vector. All phases are
    published in one step: until then, and if the ingestion fails, those of an earlier one are read.
    """
    spark = train_table.sparkSession
    with numbered_once(train_table) as whole:
        phases = entity_phases(whole.lengths, extent=whole.extent.as_one_group)
        parts = {"train": whole.part(phases, "train"), "val": whole.part(phases, "val"), "test": Series.of(test_table)}
        fitted = fit_scaler(parts["train"].log, features)
        stats = spark.createDataFrame(fitted.collect(), fitted.schema)  # one row
        padded = []
        for phase, part in parts.items():
            log = apply_scaler(part.log, stats) if rescale else part.log
            batches = life_batches(part.lengths, batch_size, extent=part.extent.as_one_group)
            rows = padded_lives(log, batches, features, target, CLASSES[target], pos_col=POSITION)
            padded.append(rows.withColumn("phase", F.lit(phase)))
        publish_batches(reduce(DataFrame.unionByName, padded), path, list(parts))
    return stats
