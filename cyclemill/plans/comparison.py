"""A model of another kind on the same windows, to hold the sequence classifier against."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemill.operators.metrics import evaluation
from cyclemill.operators.sequences import SEQUENCE_LENGTH, sliding_sequences
from cyclemill.operators.splits import entity_phases
from cyclemill.plans.experiment import POSITION, Series, numbered_once
from cyclemill.session import delete_table, shared_folder


@dataclass(frozen=True)
class Perceptron:
    """Hidden layers and optimiser of the comparison model; its input is a window as one flat vector."""

    hidden: tuple[int, ...] = (32,)
    classes: int = 2
    iterations: int = 50
    length: int = SEQUENCE_LENGTH
    seed: int = 42


def window_vectors(series: Series, features: Sequence[str], label: str, length: int) -> DataFrame:
    """``(id, pos, label, x)`` of the windows that the sequence classifier gets; windows with an unknown label are left out."""
    windows = sliding_sequences(
        series.log, features, label, length, pos_col=POSITION, longest=series.extent.longest)
    return windows.where(F.col("label").isNotNull()).select(
        "id", F.col("label_cycle").alias("pos"), F.col("label").cast("double").alias("label"),
        array_to_vector(F.transform("seq", lambda v: v.cast("double"))).alias("x"))


def fit_comparison(
    labelled: DataFrame, features: Sequence[str], label: str = "label1", settings: Perceptron = Perceptron()
) -> MultilayerPerceptronClassificationModel:
    """Train on the windows of the entities that ``fit_windows`` trains on.

    Every iteration is a pass over the windows, so they are written once and read from there.
    """
    spark = labelled.sparkSession
    path = shared_folder(spark, "vectors")
    try:
        with numbered_once(labelled) as whole:
            phases = entity_phases(whole.lengths, extent=whole.extent.as_one_group)
            window_vectors(whole.part(phases, "train"), features, label, settings.length).write.parquet(path)
        layers = [settings.length * len(features), *settings.hidden, settings.classes]
        learner = MultilayerPerceptronClassifier(
            layers=layers, maxIter=settings.iterations, seed=settings.seed, featuresCol="x", labelCol="label")
        return learner.fit(spark.read.parquet(path))
    finally:
        delete_table(spark, path)


def evaluate_comparison(
    labelled: DataFrame,
    model: MultilayerPerceptronClassificationModel,
    features: Sequence[str],
    label: str = "label1",
    length: int = SEQUENCE_LENGTH,
) -> tuple[DataFrame, DataFrame]:
    """Predictions and their evaluation, with the columns and the samples of ``evaluate_windows``."""
    scored = model.transform(window_vectors(Series.of(labelled), features, label, length))
    predictions = scored.select(
        "id", F.col("pos").cast("long").alias("pos"), F.col("label").cast("long").alias("label"),
        vector_to_array("probability").alias("prob"), F.col("prediction").cast("long").alias("prediction"))
    return predictions, evaluation(predictions)
