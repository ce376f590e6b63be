"""Classification metrics on a prediction table, each from one pass over it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.functions.numbers import ratio
from ratewise.schema import require_columns

OUTCOMES = ("tp", "fp", "tn", "fn")


BINARY = "labels and predictions must be 0 or 1"


def _outcomes(weight: str | None) -> list[Column]:
    """Weighted counts of the four outcomes for labels and predictions 0 and 1.

    Anything else, null included, raises: no row may drop out of a report unseen.
    """
    amount = F.lit(1) if weight is None else F.col(weight)
    label, prediction = F.col("label"), F.col("prediction")
    hit = {
        "tp": (label == 1.0) & (prediction == 1.0),
        "fp": (label == 0.0) & (prediction == 1.0),
        "tn": (label == 0.0) & (prediction == 0.0),
        "fn": (label == 1.0) & (prediction == 0.0),
    }
    binary = label.isin(0.0, 1.0) & prediction.isin(0.0, 1.0)
    known = F.when(binary, amount).otherwise(F.raise_error(F.lit(BINARY)).cast("int"))
    return [
        F.coalesce(F.sum(F.when(hit[name], known).otherwise(known * 0)), F.lit(0))
        .cast("long")
        .alias(name)
        for name in OUTCOMES
    ]


def confusion_matrix(predictions: DataFrame, weight: str | None = None) -> DataFrame:
    """One row: tp, fp, tn, fn."""
    require_columns(predictions, ["label", "prediction"])
    return predictions.agg(*_outcomes(weight))


def positive_precision() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def positive_recall() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fn"))


def positive_pr(predictions: DataFrame, weight: str | None = None) -> DataFrame:
    """Precision and recall of the positive class, 0 where undefined."""
    return confusion_matrix(predictions, weight).select(
        positive_precision().alias("pos_precision"), positive_recall().alias("pos_recall")
    )


def class_metrics(predictions: DataFrame, weight: str | None = None) -> DataFrame:
    """Accuracy and the class-weighted F1, precision and recall, for any classes.

    The table shrinks to one row per (label, prediction) map-side; everything
    after that works on as many rows as there are pairs of classes.
    """
    require_columns(predictions, ["label", "prediction"])
    amount = F.lit(1) if weight is None else F.col(weight)
    pairs = predictions.groupBy("label", "prediction").agg(F.sum(amount).alias("n"))
    right = F.col("label") == F.col("prediction")
    zero = F.lit(0)
    as_label = F.struct(
        F.col("label").alias("class"),
        F.col("n").alias("actual"),
        zero.alias("predicted"),
        F.when(right, F.col("n")).otherwise(zero).alias("correct"),
    )
    as_prediction = F.struct(
        F.col("prediction").alias("class"),
        zero.alias("actual"),
        F.col("n").alias("predicted"),
        zero.alias("correct"),
    )
    classes = (
        pairs.select(F.inline(F.array(as_label, as_prediction)))
        .groupBy("class")
        .agg(*[F.sum(name).alias(name) for name in ("actual", "predicted", "correct")])
        .withColumn("precision", ratio(F.col("correct"), F.col("predicted")))
        .withColumn("recall", ratio(F.col("correct"), F.col("actual")))
    )
    precision, recall = F.col("precision"), F.col("recall")
    f1 = ratio(2 * precision * recall, precision + recall)
    total = F.sum("actual")

    def weighted(measure: Column) -> Column:
        return F.sum(measure * F.col("actual")) / total

    return classes.agg(
        (F.sum("correct") / total).alias("accuracy"),
        weighted(f1).alias("f1"),
        weighted(precision).alias("weighted_precision"),
        weighted(recall).alias("weighted_recall"),
    )


#: Totals of one range of scores, and its place among the ranges.
RANGE_TOTALS = ("pos", "neg", *OUTCOMES)
RANGE_SCHEMA = ", ".join(["place int", *[f"{name} long" for name in RANGE_TOTALS], "pairs double"])


def _range_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of the sorted scores of a task: its totals, and how many pairs of a positive
    and a negative within it are in order, ties counting half."""
    totals, pairs, rows = dict.fromkeys(RANGE_TOTALS, 0), 0.0, 0
    for batch in batches:
        columns = {name: batch.column(name).to_numpy() for name in RANGE_TOTALS}
        pos, neg = columns["pos"], columns["neg"]
        below = totals["neg"] + np.cumsum(neg) - neg
        pairs += float((pos * (below + neg / 2)).sum())
        rows += batch.num_rows
        for name, values in columns.items():
            totals[name] += int(values.sum())
    if rows:
        row = {"place": TaskContext.get().partitionId(), **totals, "pairs": pairs}
        kinds = pa.schema([("place", pa.int32()), *[(n, pa.int64()) for n in RANGE_TOTALS], ("pairs", pa.float64())])
        yield pa.RecordBatch.from_pylist([row], kinds)


def _ranked_outcomes(predictions: DataFrame, score: str, weight: str | None) -> DataFrame:
    """One row: tp, fp, tn, fn and the area under the ROC curve.

    The area is the share of (positive, negative) pairs that the score puts in
    the right order, ties counting half, so it needs the number of negatives
    below each score. Outcomes are first added up per distinct score. These rows
    are range-partitioned on the score and sorted, and each task runs through its own
    once, so the ranges need no second exchange. The totals of the lower ranges, one row
    per task, are added at the end. Where the ranges are cut only balances the load: any
    cuts give the exact result. Rows without a score have no place in the order and do not
    count for the area, but for everything else.
    """
    require_columns(predictions, ["label", "prediction", score])
    unplaced = F.col("score").isNull()
    scores = (
        predictions.groupBy(F.col(score).cast("double").alias("score"))
        .agg(*_outcomes(weight))
        .withColumn("pos", F.when(unplaced, F.lit(0)).otherwise(F.col("tp") + F.col("fn")).cast("long"))
        .withColumn("neg", F.when(unplaced, F.lit(0)).otherwise(F.col("fp") + F.col("tn")).cast("long"))
    )
    ranged = scores.repartitionByRange("score").sortWithinPartitions("score")
    totals = ranged.select(*RANGE_TOTALS).mapInArrow(_range_totals, RANGE_SCHEMA)
    lower = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    neg_lower = F.coalesce(F.sum("neg").over(lower), F.lit(0))
    crossing = F.col("pos").cast("double") * neg_lower
    all_pairs = F.sum("pos").cast("double") * F.sum("neg")
    ordered_pairs = F.sum(F.col("pairs") + F.col("crossing"))
    return totals.withColumn("crossing", crossing).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in OUTCOMES],
        F.when(all_pairs > 0, ordered_pairs / all_pairs).alias("auc"),
    )


def roc_auc(
    predictions: DataFrame,
    score: str = "score",
    weight: str | None = None,
) -> DataFrame:
    """Exact area under the ROC curve; null unless both classes occur."""
    with_prediction = predictions
    if "prediction" not in predictions.columns:
        with_prediction = predictions.withColumn("prediction", F.lit(0.0))
    return _ranked_outcomes(with_prediction, score, weight).select("auc")


def evaluation_metrics(
    predictions: DataFrame,
    score: str = "score",
    weight: str | None = None,
) -> DataFrame:
    """Every metric of a binary classifier in one row, from one pass.

    rows_test, accuracy, f1, weighted_precision, weighted_recall, auc, tp, fp,
    tn, fn, pos_precision, pos_recall.
    """
    tp, fp, tn, fn = (F.col(name) for name in OUTCOMES)
    total = tp + fp + tn + fn
    precision = (ratio(tn, tn + fn), positive_precision())
    recall = (ratio(tn, tn + fp), positive_recall())
    f1 = tuple(ratio(2 * p * r, p + r) for p, r in zip(precision, recall))

    def weighted(by_class: tuple[Column, Column]) -> Column:
        return ratio(by_class[0] * (tn + fp) + by_class[1] * (tp + fn), total, None)

    return _ranked_outcomes(predictions, score, weight).select(
        total.alias("rows_test"),
        ratio(tp + tn, total, None).alias("accuracy"),
        weighted(f1).alias("f1"),
        weighted(precision).alias("weighted_precision"),
        weighted(recall).alias("weighted_recall"),
        "auc",
        *OUTCOMES,
        precision[1].alias("pos_precision"),
        recall[1].alias("pos_recall"),
    )
