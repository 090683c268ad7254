"""Profiles: whole-table summaries and per-window quality and column metrics."""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.metrics import auc_from_cells, binary_counts, confusion, report_from_confusion, share
from tabwright.operators.running import exact_quantiles
from tabwright.operators.transform import latest_batch

#: Relative error asked of distinct sketches.
APPROX_ERROR = 0.015
_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "==": operator.eq}


def max_timestamp(df: DataFrame, column: str) -> DataFrame:
    """The newest stamp as a one-row frame."""
    return df.agg(F.max(column).alias(column))


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, n, mean, std)`` with the sample standard deviation, all columns in one pass."""
    totals = df.agg(
        *[
            agg(F.col(f"`{c}`")).alias(f"{name}{i}")
            for i, c in enumerate(columns)
            for name, agg in (("n", F.count), ("mean", F.avg), ("std", F.stddev_samp))
        ]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{name}{i}").alias(name) for name in ("n", "mean", "std")])
        for i, c in enumerate(columns)
    ]
    return totals.select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    """``(column, n)`` per value, with ``share`` of the rows when normalized."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    if not normalize:
        return counts
    return counts.withColumn("share", F.col("n") / df.agg(F.count("*")).scalar())


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values, null included."""
    return df.select(column).distinct()


def distinct_count(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column, exact or by a sketch, one row."""
    count = (lambda c: F.approx_count_distinct(c, APPROX_ERROR)) if approx else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in columns])


def shape(df: DataFrame) -> DataFrame:
    """``(rows, columns)``."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def _window(ts: str, granularity: str) -> Column:
    return F.window(F.col(ts), granularity)


def quality_profile(
    df: DataFrame, ts: str, label: str, prediction: str, by: Sequence[str] = (), granularity: str = "30 minutes"
) -> DataFrame:
    """Binary quality per tumbling window and model, in one aggregate.

    ``(window, by..., n, tp, fp, fn, tn, accuracy_score, auc_hard, precision, recall, f1)``;
    precision, recall and f1 are those of class 1, 0 for an empty denominator.
    """
    y, p = F.col(label), F.col(prediction)
    cells = df.groupBy(_window(ts, granularity).alias("window"), *by).agg(
        F.count("*").alias("n"),
        F.count_if(y == p).alias("hits"),
        *[c.alias(name) for name, c in binary_counts(y, p).items()],
    )
    return quality_from_cells(cells, by)


def quality_from_cells(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The metrics of :func:`quality_profile` from its counts, which can be sums of counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    zero = F.lit(0.0)
    return cells.select(
        "window",
        *by,
        "n",
        "tp",
        "fp",
        "fn",
        "tn",
        share(F.col("hits"), F.col("n")).alias("accuracy_score"),
        auc_from_cells(tp, fp, fn, tn).alias("auc_hard"),
        F.coalesce(share(tp, tp + fp), zero).alias("precision"),
        F.coalesce(share(tp, tp + fn), zero).alias("recall"),
        F.coalesce(share(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
    )


def report_profile(
    df: DataFrame, ts: str, label: str, prediction: str, by: Sequence[str] = (), granularity: str = "30 minutes"
) -> DataFrame:
    """The classification report per window and model, for any number of classes."""
    windowed = df.withColumn("window", _window(ts, granularity))
    groups = ["window", *by]
    return report_from_confusion(confusion(windowed, label, prediction, groups), groups)


_BASIC = {
    "n": F.count,
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "std": F.stddev_samp,
}


def column_profile(
    df: DataFrame,
    ts: str,
    columns: Sequence[str],
    by: Sequence[str] = (),
    granularity: str = "30 minutes",
    approx: bool = False,
) -> DataFrame:
    """``(window, by..., column, n, nulls, min, max, mean, std, distinct, median)``.

    The plain statistics of all columns come from one aggregate of the
    unexpanded rows. With ``approx`` the same pass also gives distinct counts
    and medians from sketches; otherwise both are exact and cost a pass each
    over the numeric columns alone. Values are told apart in their own type; the other
    statistics are doubles, as one result holds columns of several types.
    """
    by = list(by)
    own = [f"_own_{c}" for c in columns]
    rows = df.select(
        _window(ts, granularity).alias("window"),
        *by,
        *[F.col(c).cast("double").alias(c) for c in columns],
        *[F.col(c).alias(o) for c, o in zip(columns, own, strict=True)],
    )
    groups = ["window", *by]
    wide = {name: lambda c, agg=agg: agg(F.col(c)) for name, agg in _BASIC.items()}
    if approx:
        wide["distinct"] = lambda c: F.approx_count_distinct(f"_own_{c}", APPROX_ERROR)
        wide["median"] = lambda c: F.percentile_approx(c, 0.5, 10_000)
    wide["nulls"] = lambda c: F.count_if(F.col(c).isNull())
    totals = rows.groupBy(*groups).agg(
        *[agg(c).alias(f"{name}{i}") for i, c in enumerate(columns) for name, agg in wide.items()]
    )
    names = [n for n in ("n", "nulls", "min", "max", "mean", "std", "distinct", "median") if n in wide]
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{n}{i}").alias(n) for n in names]) for i, c in enumerate(columns)
    ]
    basic = totals.select(*groups, F.inline(F.array(*entries)))
    if approx:
        return basic
    long = rows.select(*groups, *columns).unpivot(groups, list(columns), "column", "value")
    keys = [*groups, "column"]
    # as text, in which numbers of one type differ when they differ; both zeros of a double are one
    texts = [(F.col(o) + F.lit(0).cast(rows.schema[o].dataType)).cast("string").alias(c) for c, o in zip(columns, own, strict=True)]
    exact = rows.select(*groups, *texts).unpivot(groups, list(columns), "column", "value")
    distinct = exact.groupBy(*keys).agg(F.count_distinct("value").alias("distinct"))
    median = exact_quantiles(long, keys, "value", [0.5]).select(*keys, F.get("quantiles", F.lit(0)).alias("median"))
    return _same_groups(_same_groups(basic, distinct, keys), median, keys)


def _same_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_{k}"])
    return left.join(renamed, condition, "left").drop(*[f"_{k}" for k in keys])


def metric_change(profile: DataFrame, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """Add ``previous`` and ``change`` of a metric against the window before.

    The profile has one row per window; its history per model is ordered.
    """
    order = Window.partitionBy(*by).orderBy(F.col("window.start"))
    return profile.withColumn("previous", F.lag(metric).over(order)).withColumn(
        "change", F.col(metric) - F.col("previous")
    )


def alert(profile: DataFrame, column: str = "accuracy_score", op: str = "<", threshold: float = 0.70) -> DataFrame:
    """Rows of the latest window that breach the threshold."""
    flat = profile.withColumn("_start", F.col("window.start"))
    return latest_batch(flat, "_start").drop("_start").where(_COMPARE[op](F.col(column), F.lit(threshold)))
