"""Metrics over any table of labels and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.numeric import safe_divide

METRICS = ("accuracy", "precision", "recall", "f1")


def confusion_matrix(predictions: DataFrame, by: Sequence[str] = (), pos_label: int = 0,
                     label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``by..., tp, fp, fn, tn`` for the chosen positive class, in one pass."""
    truth, guess = F.col(label) == pos_label, F.col(prediction) == pos_label
    return predictions.groupBy(*by).agg(
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(~truth & ~guess).alias("tn"),
    )


def confusion_matrices(predictions: DataFrame, by: Sequence[str] = (), label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """``by..., pos_label, tp, fp, fn, tn`` for both classes, in one pass."""
    one = confusion_matrix(predictions, by, 1, label, prediction)
    cells = ("tp", "fp", "fn", "tn")
    rows = [F.struct(F.lit(pos).alias("pos_label"), *[
        F.col(source).alias(name) for source, name in zip(cells if pos else cells[::-1], cells)
    ]) for pos in (0, 1)]
    return one.select(*by, F.inline(F.array(*rows)))


def confusion_table(predictions: DataFrame, by: Sequence[str] = (),
                    classes: Sequence[int] = (0, 1), label: str = "label",
                    prediction: str = "prediction") -> DataFrame:
    """Rows are true classes, columns ``pred_<class>`` predicted ones."""
    return predictions.groupBy(*by, F.col(label).alias("label")).agg(*[
        F.count_if(F.col(prediction) == c).alias(f"pred_{c}") for c in classes
    ])


def _f1(precision: Column, recall: Column) -> Column:
    return safe_divide(2 * precision * recall, precision + recall)


def metrics(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1; 0 where a denominator is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion.select(
        *by,
        safe_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        safe_divide(tp, tp + fp).alias("precision"),
        safe_divide(tp, tp + fn).alias("recall"),
        safe_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def metrics_by_split(predictions: DataFrame, pos_label: int = 0, split: str = "split",
                     label: str = "label", prediction: str = "prediction") -> DataFrame:
    return metrics(
        confusion_matrix(predictions, [split], pos_label, label, prediction), [split]
    )


def classification_report(predictions: DataFrame, by: Sequence[str] = (),
                          classes: Sequence[int] = (0, 1), label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Per class and averaged: ``class, precision, recall, f1, support``.

    Averages are ``macro avg`` and ``weighted avg``; the row ``accuracy`` holds
    it in all three metric columns.
    """
    truth, guess = F.col(label), F.col(prediction)
    counts = []
    for c in classes:
        counts += [
            F.count_if((truth == c) & (guess == c)).alias(f"tp_{c}"),
            F.count_if(guess == c).alias(f"guess_{c}"),
            F.count_if(truth == c).alias(f"support_{c}"),
        ]
    cells = predictions.groupBy(*by).agg(*counts)
    parts = {}
    for c in classes:
        precision = safe_divide(F.col(f"tp_{c}"), F.col(f"guess_{c}"))
        recall = safe_divide(F.col(f"tp_{c}"), F.col(f"support_{c}"))
        parts[c] = (precision, recall, _f1(precision, recall), F.col(f"support_{c}"))
    total = sum((parts[c][3] for c in classes), F.lit(0))
    hits = sum((F.col(f"tp_{c}") for c in classes), F.lit(0))
    accuracy = safe_divide(hits, total)

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.cast("bigint").alias("support"),
        )

    def macro(i: int) -> Column:
        return sum((parts[c][i] for c in classes), F.lit(0.0)) / len(classes)

    def weighted(i: int) -> Column:
        return safe_divide(sum((parts[c][i] * parts[c][3] for c in classes), F.lit(0.0)), total)

    rows = [row(str(c), *parts[c]) for c in classes]
    rows.append(row("accuracy", accuracy, accuracy, accuracy, total))
    rows.append(row("macro avg", *[macro(i) for i in range(3)], total))
    rows.append(row("weighted avg", *[weighted(i) for i in range(3)], total))
    return cells.select(*by, F.inline(F.array(*rows)))


def compare_models(baseline: DataFrame, candidate: DataFrame,
                   by: Sequence[str] = ("split",)) -> DataFrame:
    """Metrics of two models side by side, with the difference.

    Both inputs are metric tables, one row per split.
    """
    def long(df: DataFrame, value: str) -> DataFrame:
        return df.unpivot(list(by), list(METRICS), "metric", value)

    joined = long(baseline, "baseline").join(long(candidate, "candidate"), [*by, "metric"])
    return joined.withColumn("delta", F.col("candidate") - F.col("baseline"))


def best_candidate(results: DataFrame, candidate: str, score: str = "f1",
                   order: str | None = None) -> DataFrame:
    """The candidate with the highest score; among equals the first by ``order``."""
    order = order or candidate
    best = results.agg(F.min(F.struct(
        (-F.col(score)).alias("s"), F.col(order).alias("o"), F.col(candidate).alias("c")
    )).alias("b"))
    return best.select(F.col("b.c").alias(candidate), (-F.col("b.s")).alias(score))
