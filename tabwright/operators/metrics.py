"""Classification metrics, from counts of label and prediction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.running import join_groups, range_edges, with_range


def share(part: Column, whole: Column) -> Column:
    """A ratio that is null for an empty denominator."""
    return F.when(whole != 0, part / whole)


def share_or_zero(part: Column, whole: Column) -> Column:
    """A ratio that is 0 for an empty denominator."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(0.0))


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str | Column] = ()) -> DataFrame:
    """Counts per label and prediction: ``(by..., label, prediction, n)``."""
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def accuracy(df: DataFrame, label: str, prediction: str, by: Sequence[str | Column] = ()) -> DataFrame:
    """Share of equal pairs: ``(by..., n, accuracy)``."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg((F.col(label) == F.col(prediction)).cast("int")).alias("accuracy")
    )


def binary_counts(label: Column, prediction: Column) -> dict[str, Column]:
    """The four cells for classes 0 and 1, as aggregates of one pass."""
    return {
        "tp": F.count_if((label == 1) & (prediction == 1)),
        "fp": F.count_if((label == 0) & (prediction == 1)),
        "fn": F.count_if((label == 1) & (prediction == 0)),
        "tn": F.count_if((label == 0) & (prediction == 0)),
    }


def auc_from_cells(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """Area under the curve of hard labels: the mean of both classes' recall."""
    return (share(tp, tp + fn) + share(tn, tn + fp)) / 2


def auc_hard(df: DataFrame, label: str, prediction: str, by: Sequence[str | Column] = ()) -> DataFrame:
    """AUC computed from hard 0/1 predictions: ``(by..., auc_hard)``."""
    cells = df.groupBy(*by).agg(
        *[c.alias(name) for name, c in binary_counts(F.col(label), F.col(prediction)).items()]
    )
    area = auc_from_cells(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return cells.withColumn("auc_hard", area).drop("tp", "fp", "fn", "tn")


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """AUC of a score for labels 0/1, ties counted half: ``(by..., positives, negatives, auc)``.

    Scores are counted first, then each range of scores is ordered by itself
    and the ranges are put together from their totals.
    """
    by = list(by)
    rows = df.select(*by, F.col(score).cast("double").alias("s"), F.col(label).alias("y")).where(
        F.col("s").isNotNull() & F.col("y").isNotNull()
    )
    counted = rows.groupBy(*by, "s").agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") != 1).alias("q"))
    edges = range_edges(rows, by, "s")
    ranged = with_range(join_groups(counted, edges, by, "score-cuts"), "s").select(*by, "r", "s", "p", "q")
    order = Window.partitionBy(*by, "r").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    # pairs won by the positives of this score against negatives of its range
    won = F.col("p") * (F.sum("q").over(order) - F.col("q") / F.lit(2.0))
    ranges = (
        ranged.withColumn("won", won)
        .groupBy(*by, "r")
        .agg(F.sum("won").alias("won"), F.sum("p").alias("p"), F.sum("q").alias("q"))
    )
    # at most about a thousand ranges per group are left
    earlier = Window.partitionBy(*by).orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranges.withColumn("won", F.col("won") + F.col("p") * F.coalesce(F.sum("q").over(earlier), F.lit(0)))
        .groupBy(*by)
        .agg(F.sum("won").alias("won"), F.sum("p").alias("positives"), F.sum("q").alias("negatives"))
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return totals.select(*by, "positives", "negatives", share(F.col("won"), pairs).alias("auc"))


def classification_report(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., class, precision, recall, f1, support)`` plus three summary rows.

    Classes come first as text, then ``accuracy``, ``macro avg`` and
    ``weighted avg``. The accuracy row carries the accuracy in all three
    columns, which is what micro averaging gives.
    """
    by = list(by)
    cells = confusion(df, label, prediction, by)
    return report_from_confusion(cells, by)


def report_from_confusion(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The report from a small frame of counts ``(by..., label, prediction, n)``."""
    by = list(by)
    hit = F.col("label") == F.col("prediction")
    sides = cells.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("label").cast("string").alias("class"), F.lit(True).alias("is_label")),
                F.struct(F.col("prediction").cast("string").alias("class"), F.lit(False).alias("is_label")),
            )
        ).alias("side"),
        hit.alias("hit"),
        "n",
    )
    n, is_label = F.col("n"), F.col("side.is_label")
    total = lambda condition: F.sum(F.when(condition, n).otherwise(0))
    per_class = sides.groupBy(*by, F.col("side.class").alias("class")).agg(
        total(is_label & F.col("hit")).alias("tp"),
        total(is_label & ~F.col("hit")).alias("fn"),
        total(~is_label & ~F.col("hit")).alias("fp"),
    )
    tp, fn, fp = F.col("tp"), F.col("fn"), F.col("fp")
    scored = per_class.select(
        *by,
        "class",
        share_or_zero(tp, tp + fp).alias("precision"),
        share_or_zero(tp, tp + fn).alias("recall"),
        share_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("support"),
        "tp",
    )
    names = ("precision", "recall", "f1")
    weighted = lambda c: share_or_zero(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    summary = scored.groupBy(*by).agg(
        F.sum("support").alias("support"),
        share_or_zero(F.sum("tp"), F.sum("support")).alias("acc"),
        *[F.avg(c).alias(f"m_{c}") for c in names],
        *[weighted(c).alias(f"w_{c}") for c in names],
    )
    rows = [
        F.struct(F.lit("accuracy").alias("class"), *[F.col("acc").alias(c) for c in names]),
        F.struct(F.lit("macro avg").alias("class"), *[F.col(f"m_{c}").alias(c) for c in names]),
        F.struct(F.lit("weighted avg").alias("class"), *[F.col(f"w_{c}").alias(c) for c in names]),
    ]
    summary_rows = summary.select(*by, "support", F.inline(F.array(*rows)))
    return scored.drop("tp").unionByName(summary_rows)


def compare_predictions(df: DataFrame, label: str, current: str, latest: str) -> DataFrame:
    """Accuracy and hard-label AUC of two predictions held in the same rows, one pass, one row."""
    y = F.col(label)
    cells = {
        f"{cell}_{side}": count
        for side, column in (("current", current), ("latest", latest))
        for cell, count in binary_counts(y, F.col(column)).items()
    }
    totals = df.agg(
        F.count("*").alias("n"),
        F.avg((y == F.col(current)).cast("int")).alias("accuracy_current"),
        F.avg((y == F.col(latest)).cast("int")).alias("accuracy_latest"),
        *[c.alias(name) for name, c in cells.items()],
    )
    area = lambda side: auc_from_cells(*[F.col(f"{c}_{side}") for c in ("tp", "fp", "fn", "tn")])
    return totals.select(
        "n",
        "accuracy_current",
        "accuracy_latest",
        area("current").alias("auc_current"),
        area("latest").alias("auc_latest"),
    )


@dataclass(frozen=True)
class Comparison:
    """Outcome of champion against challenger."""

    challenger_wins: bool
    improvement: float
    accuracy_current: float
    accuracy_latest: float
    auc_current: float | None
    auc_latest: float | None


def champion_challenger(df: DataFrame, label: str, current: str, latest: str) -> Comparison:
    """Whether the current model beats the latest registered one.

    Accuracies are rounded to two places and must be strictly greater; the
    improvement is in percentage points. Only one row of totals is collected.
    """
    row = compare_predictions(df, label, current, latest).first()
    rounded = {k: None if row[k] is None else round(row[k], 2) for k in row.asDict() if k != "n"}
    if rounded["accuracy_current"] is None:
        raise ValueError("no rows to compare models on")
    gain = rounded["accuracy_current"] - rounded["accuracy_latest"]
    return Comparison(gain > 0, gain * 100 if gain > 0 else 0.0, **rounded)
