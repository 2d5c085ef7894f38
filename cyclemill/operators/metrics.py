"""Evaluation as aggregates: confusion counts first, everything else from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclemill.operators.ordering import running_totals
from cyclemill.session import kept

PROBABILITY_FLOOR = 1e-7


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)``; at most classes squared rows, combined on the map side."""
    return scored.groupBy(
        F.col(label).cast("long").alias("label"), F.col(prediction).cast("long").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def per_class_metrics(confusion: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of every class that occurs; NULL where undefined.

    ``carry`` names further sums per cell, to be added up by actual class.
    """
    none, n = F.lit(0).cast("long"), F.col("n")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)
    no_carry = [F.lit(0).cast(confusion.schema[c].dataType).alias(c) for c in carry]

    def side(c, actual, predicted, tp, carried):
        counts = [actual.alias("actual"), predicted.alias("predicted"), tp.alias("tp")]
        return F.struct(c.alias("class"), *counts, *carried)

    sides = F.array(
        side(F.col("label"), n, none, hit, [F.col(c) for c in carry]),
        side(F.col("prediction"), none, n, none, no_carry),
    )
    sums = (
        confusion.select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "actual", "predicted", *carry)])
    )

    def ratio(a, b):
        return F.when(b > 0, a / b)

    tp, actual, predicted = F.col("tp"), F.col("actual"), F.col("predicted")
    return sums.withColumns(
        {
            "precision": ratio(tp, predicted),
            "recall": ratio(tp, actual),
            "f1": ratio(2 * tp, actual + predicted),
        }
    )


def _summaries() -> list[Column]:
    return [
        (F.sum("tp") / F.sum("actual")).alias("accuracy"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
        F.count("precision").alias("precision_classes"),
        F.count("recall").alias("recall_classes"),
    ]


def summary_metrics(confusion: DataFrame) -> DataFrame:
    """One row: accuracy, macro precision, recall and F1 over classes where they are defined."""
    return per_class_metrics(confusion).agg(*_summaries())


def evaluation(scored: DataFrame, exact: bool = False) -> DataFrame:
    """Loss and summary metrics in one row, from one pass over ``(label, prob, prediction)``.

    ``exact`` sums the losses as decimals, so that the result does not depend on the order of the rows.
    """
    loss = F.sum(log_loss().cast("decimal(28,18)")).cast("double") if exact else F.sum(log_loss())
    cells = scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"), loss.alias("loss"))
    classes = per_class_metrics(cells, carry=["loss"])
    return classes.agg((F.sum("loss") / F.sum("actual")).alias("loss"), *_summaries())


def evaluation_of_cells(cells: Sequence[tuple]) -> dict:
    """What ``evaluation`` gives, from a few ``(label, prediction, n, loss)`` that were counted elsewhere."""
    whole = sum(n for _, _, n, _ in cells)
    hit, actual, predicted = ({} for _ in range(3))
    for label, guess, n, _ in cells:
        actual[label] = actual.get(label, 0) + n
        predicted[guess] = predicted.get(guess, 0) + n
        if label == guess:
            hit[label] = n

    def mean(values):
        return sum(values) / len(values) if values else None

    classes = sorted({*actual, *predicted})
    precision = [hit.get(c, 0) / predicted[c] for c in classes if predicted.get(c)]
    recall = [hit.get(c, 0) / actual[c] for c in classes if actual.get(c)]
    f1 = [2 * hit.get(c, 0) / (actual.get(c, 0) + predicted.get(c, 0)) for c in classes]
    return {
        "loss": sum(loss for *_, loss in cells) / whole if whole else None,
        "accuracy": sum(hit.values()) / whole if whole else None,
        "precision": mean(precision),
        "recall": mean(recall),
        "f1": mean(f1),
        "precision_classes": len(precision),
        "recall_classes": len(recall),
    }


def log_loss(probabilities: str = "prob", label: str = "label") -> Column:
    """Negative log-probability of the true class, with the probability kept off 0 and 1."""
    p = F.get(F.col(probabilities), F.col(label).cast("int"))
    return -F.log(F.greatest(F.least(p, F.lit(1 - PROBABILITY_FLOOR)), F.lit(PROBABILITY_FLOOR)))


def cross_entropy(scored: DataFrame, probabilities: str = "prob", label: str = "label") -> DataFrame:
    """Mean negative log-probability of the true class, over any number of classes."""
    return scored.agg(
        F.avg(log_loss(probabilities, label)).alias("loss"), F.count(F.lit(1)).alias("n")
    )


def binary_cross_entropy(scored: DataFrame, probability: str = "prob", label: str = "label") -> DataFrame:
    pair = scored.select(
        F.array(1 - F.col(probability), F.col(probability)).alias("prob"), F.col(label).alias("label")
    )
    return cross_entropy(pair)


def roc_points(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """ROC curve, one point per distinct score: rates when that score is the threshold.

    Rows are first aggregated by score, so ties collapse on the map side; the
    cumulated counts then run over slices of the score axis.
    """
    positive = F.col(label).cast("long")
    by_score = scored.groupBy((-F.col(score)).alias("_down")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    )
    # measuring and cutting the score axis read the counts several times: the input runs once
    by_score = kept(by_score, "scores")
    cumulated = running_totals(
        by_score,
        [],
        ["_down"],
        {"tp": F.col("pos"), "fp": F.col("neg")},
        {"all_pos": F.col("pos"), "all_neg": F.col("neg")},
    )
    return cumulated.select(
        (-F.col("_down")).alias("threshold"),
        "pos",
        "neg",
        "tp",
        "fp",
        "all_pos",
        "all_neg",
        F.when(F.col("all_pos") > 0, F.col("tp") / F.col("all_pos")).alias("tpr"),
        F.when(F.col("all_neg") > 0, F.col("fp") / F.col("all_neg")).alias("fpr"),
    )


def roc_auc(points: DataFrame) -> DataFrame:
    """Area under the curve; a tie counts one half. NULL if one class is absent."""
    above = F.col("tp") - F.col("pos")
    area = F.sum(F.col("neg").cast("double") * (above + F.col("pos") / 2))
    pairs = F.max("all_pos").cast("double") * F.max("all_neg")
    return points.agg(F.when(pairs > 0, area / pairs).alias("auc"))


EVALUATION_STATE = "label long, prediction long, bin long, n long, loss double"
SCORE_BITS = 12


def evaluation_state(scored: DataFrame, bits: int = SCORE_BITS) -> DataFrame:
    """What ``merged_evaluation`` needs of some predictions ``(label, prob, prediction)``, without the predictions.

    Counts and summed losses per cell of the confusion matrix and bin of the last class's probability: at most
    classes squared times ``2 ** bits`` rows.
    """
    score = F.element_at("prob", -1)
    return scored.groupBy(
        F.col("label").cast("long").alias("label"), F.col("prediction").cast("long").alias("prediction"),
        score_bin(score, bits).alias("bin"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(log_loss()).alias("loss"))


def score_bin(score: Column, bits: int) -> Column:
    """Number of the bin of a score between 0 and 1; 1 belongs to the last one."""
    width = 1 << bits
    return F.least(F.floor(score * width), F.lit(width - 1)).cast("long")


def merged_evaluation(states: DataFrame) -> DataFrame:
    """One row as ``evaluation`` gives it, from states of any number of parts, with the area under the curve of a
    two-class model (null for others) and how far that may be off."""
    cells = states.groupBy("label", "prediction").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss"))
    classes = per_class_metrics(cells, carry=["loss"])
    row = classes.agg((F.sum("loss") / F.sum("actual")).alias("loss"), *_summaries(), F.max("class").alias("_last"))
    positive = F.when(F.col("label") == 1, F.col("n")).otherwise(0)
    bins = states.groupBy("bin").agg(F.sum(positive).alias("pos"), F.sum(F.col("n") - positive).alias("neg"))
    area = binned_auc(bins)
    both = row.crossJoin(F.broadcast(area))  # one row each
    two = F.col("_last") <= 1
    return both.select(
        *[c for c in row.columns if c != "_last"], *[F.when(two, F.col(c)).alias(c) for c in ("auc", "auc_error")])


def roc_histogram(scored: DataFrame, bits: int = SCORE_BITS, score: str = "score", label: str = "label") -> DataFrame:
    """``(bin, pos, neg)`` of scores between 0 and 1: at most ``2 ** bits`` rows, and the sums of two are that of both tables."""
    positive = F.col(label).cast("long")
    return scored.groupBy(score_bin(F.col(score), bits).alias("bin")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))


def binned_auc(bins: DataFrame, order: str = "bin") -> DataFrame:
    """``(auc, auc_error)``: the area under the curve of binned scores, and the most by which it can differ from the exact one.

    Pairs of one bin count one half; the error is that half, reached if every bin is wholly in or out of order.
    """
    so_far = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # bins are few by construction, whatever was binned
    placed = bins.withColumn("_below", F.coalesce(F.sum("neg").over(so_far), F.lit(0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    sure = F.sum(F.col("pos").cast("double") * F.col("_below"))
    tied = F.sum(F.col("pos").cast("double") * F.col("neg")) / 2
    return placed.agg(F.when(pairs > 0, (sure + tied) / pairs).alias("auc"), F.when(pairs > 0, tied / pairs).alias("auc_error"))


def refined_roc(
    scored: DataFrame, tolerance: float = 1e-4, bits: int = 10, passes: int = 5, score: str = "score", label: str = "label"
) -> DataFrame:
    """``(low, width, pos, neg)``: bins of scores between 0 and 1, cut finer where positives and negatives lie close together.

    A pass cuts the bins that make up most of the error, at most ``2 ** bits`` of them, into ``2 ** bits`` each, until
    ``binned_auc`` by ``low`` is off by ``tolerance`` at most. Ties are told from close scores only down to the last
    pass's width; their error, which is not one of order, stays in the bound.
    """
    spark = scored.sparkSession
    rows = kept(scored.select(F.col(score).cast("double").alias("s"), F.col(label).cast("long").alias("y")), "scores")
    parts, whole = 1 << bits, None
    open_ = [(0.0, 1.0)]
    done: list[tuple] = []
    for number in range(passes):
        width = 1.0 / parts ** (number + 1)
        if number == 0:
            inside = rows
        else:
            starts = spark.createDataFrame([(low,) for low, _ in open_], "_low double")
            inside = rows.join(F.broadcast(starts), F.floor(F.col("s") * parts**number) / parts**number == F.col("_low"))
        low = F.least(F.floor(F.col("s") / width) * width, F.lit(1.0 - width))
        found = [tuple(r) for r in inside.groupBy(low.alias("low")).agg(
            F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).collect()]
        if whole is None:
            whole = max(sum(p for _, p, _ in found) * sum(n for *_, n in found), 1)
        error = lambda r: r[1] * r[2] / 2 / whole
        found.sort(key=error, reverse=True)
        rest = sum(map(error, found)) + sum(p * n / 2 / whole for _, _, p, n in done)
        cut = []
        if number + 1 < passes:
            for r in found[:parts]:
                if rest <= tolerance:
                    break
                rest -= error(r)
                cut.append(r[0])
        chosen = set(cut)
        done += [(low_, width, p, n) for low_, p, n in found if low_ not in chosen]
        open_ = [(low_, width) for low_ in cut]
        if not cut:
            break
    return spark.createDataFrame(done, "low double, width double, pos long, neg long")
