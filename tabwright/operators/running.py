"""Running sums and order statistics over groups of any size.

Values are counted first, so a frequent value is one row. Groups are then cut
into ranges at approximate quantiles and each range is ordered by itself; the
cuts only decide how work is spread and never change a result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.session import materialize

RANGES = 1024  # per group; a power of two
ACCURACY = 10_000


def join_groups(rows: DataFrame, groups: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """Add per-group columns to rows; ``groups`` has one row per group.

    The groups are written once, so the planner knows their real size: up to
    its broadcast threshold they are sent to every executor, beyond it they are
    joined by a shuffle with adaptive skew handling. Without grouping columns
    the single row is read as scalar subqueries.
    """
    if not by:
        stored = materialize(groups, label)
        return rows.withColumns({c: stored.select(c).scalar() for c in stored.columns})
    stored = materialize(groups.withColumnsRenamed({name: f"_{name}" for name in by}), label)
    condition = reduce(and_, [rows[name].eqNullSafe(stored[f"_{name}"]) for name in by])
    return rows.join(stored, condition).drop(*[f"_{name}" for name in by])


def range_edges(rows: DataFrame, by: Sequence[str], value: str, *extra: Column) -> DataFrame:
    """``(by..., edges, extra...)``: approximate quantiles that cut each group into ``RANGES`` ranges."""
    quantiles = F.percentile_approx(value, [i / RANGES for i in range(1, RANGES)], ACCURACY)
    return rows.groupBy(*by).agg(quantiles.alias("edges"), *extra)


def with_range(df: DataFrame, value: str, name: str = "r") -> DataFrame:
    """Add how many of ``edges`` lie below the value, by bisection.

    One projection per step keeps the search inside generated code.
    """
    df = df.withColumn(name, F.lit(0))
    step = RANGES // 2
    while step:
        ahead = F.get("edges", F.col(name) + (step - 1)) < F.col(value)
        df = df.withColumn(name, F.col(name) + F.when(ahead, step).otherwise(0))
        step //= 2
    return df


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """Interpolated quantiles per group: ``(by..., n, quantiles array<double>)``.

    First a sketch brackets every quantile from both sides. Then values
    inside a bracket are counted one by one and all values between two
    brackets are counted together, so that even a group with a third of all
    rows leaves only the few values around its quantiles to be ordered. A rank
    outside its bracket would fail the job rather than give a wrong value.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    margin = 3.0 / accuracy
    sides = [max(p - margin, 0.0) for p in probabilities], [min(p + margin, 1.0) for p in probabilities]
    asked = sorted({p for side in sides for p in side})

    sketch = rows.groupBy(*by).agg(
        F.count("*").alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", asked, accuracy).alias("_sketch"),
    )
    names = {p: f"_b{i}" for i, p in enumerate(asked)}  # bounds in ascending order
    ends = {0.0: F.col("_min"), 1.0: F.col("_max")}
    bounds = [ends.get(p, F.get("_sketch", F.lit(i))).alias(names[p]) for i, p in enumerate(asked)]
    joined = join_groups(rows, sketch.select(*by, "_n", *bounds), by, "brackets")

    v = F.col("_v")
    near = reduce(or_, [(v >= F.col(names[low])) & (v <= F.col(names[high])) for low, high in zip(*sides)])
    below = F.when(v > F.col(names[asked[-1]]), F.col(names[asked[-1]]))
    for p in reversed(asked[:-1]):
        below = below.when(v > F.col(names[p]), F.col(names[p]))
    marked = joined.withColumn("_near", near).select(
        *by, "_n", "_near", F.when(F.col("_near"), v).otherwise(below).alias("_at")
    )
    counted = marked.groupBy(*by, "_n", "_near", "_at").agg(F.count("*").alias("_c"))
    order = Window.partitionBy(*by).orderBy(F.col("_at").asc_nulls_first(), F.col("_near").desc())
    ranked = counted.withColumn("_upto", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    def at(rank: Column) -> Column:
        here = (F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto"))
        missed = F.raise_error(F.lit("quantile outside its bracket")).cast("double")
        return F.max(F.when(here, F.when(F.col("_near"), F.col("_at")).otherwise(missed)))

    def quantile(p: float) -> Column:
        position = F.lit(float(p)) * (F.col("_n") - 1)
        low, high = at(F.floor(position)), at(F.ceil(position))
        share = F.max(position - F.floor(position))
        return low + share * (high - low)

    return ranked.groupBy(*by).agg(
        F.max("_n").alias("n"), F.array(*[quantile(p) for p in probabilities]).alias("quantiles")
    )

