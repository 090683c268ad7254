"""Profiles kept as mergeable parts: one stored row per day, window and group, merged when read.

A part holds counts, moments and sketches, so parts of any days give the profile of all of
them, and rows of a day that is stored are not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.metrics import binary_counts
from tabwright.operators.profile import quality_from_cells

CELLS = ("n", "hits", "tp", "fp", "fn", "tn")
#: Precision of the sketches: about 0.8 % for distinct counts, 0.7 % of the rank for medians.
DISTINCT_BITS, QUANTILE_SIZE = 14, 400


def partial_profile(
    rows: DataFrame,
    ts: str,
    label: str,
    prediction: str,
    columns: Sequence[str],
    by: Sequence[str] = (),
    granularity: str = "30 minutes",
    day: str = "day",
) -> DataFrame:
    """``(window, by..., n, hits, tp, fp, fn, tn, columns, day)``: the parts of all days of ``rows``, in one aggregate.

    ``columns`` has a struct per numeric column. A window that spans two days has a part
    in each.
    """
    cells = [c.alias(name) for name, c in binary_counts(F.col(label), F.col(prediction)).items()]
    return rows.groupBy(F.window(F.col(ts), granularity).alias("window"), *by, day).agg(
        F.count("*").alias("n"),
        F.count_if(F.col(label) == F.col(prediction)).alias("hits"),
        *cells,
        F.array(*[_part(c, rows.schema[c].dataType) for c in columns]).alias("columns"),
    )


def _part(name: str, kind: T.DataType) -> Column:
    given = F.col(f"`{name}`")
    x = given.cast("double")
    # values are told apart in their own type; both zeros of a double are one
    own = given.cast("bigint") if isinstance(kind, T.IntegralType) else (given + F.lit(0).cast(kind)).cast("string")
    return F.struct(
        F.lit(name).alias("column"),
        F.count(x).alias("n"),
        F.count_if(x.isNull()).alias("nulls"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.avg(x).alias("mean"),
        (F.var_pop(x) * F.count(x)).alias("m2"),
        F.hll_sketch_agg(own, F.lit(DISTINCT_BITS)).alias("distinct"),
        F.kll_sketch_agg_double(x, F.lit(QUANTILE_SIZE)).alias("ranks"),
    )


def merged_quality(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The quality profile of all days that have parts; exactly that of their rows."""
    cells = parts.groupBy("window", *by).agg(*[F.sum(c).alias(c) for c in CELLS])
    return quality_from_cells(cells, by)


def _moments(items: Column) -> Column:
    """``(n, mean, m2)`` of parts put together, in pairs, as differences of means and never of squares."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        return F.when(b["n"] == 0, a).otherwise(
            F.struct(
                n.alias("n"),
                (a["mean"] + apart * (b["n"] / n)).alias("mean"),
                (a["m2"] + b["m2"] + apart * apart * (a["n"] * b["n"] / n)).alias("m2"),
            )
        )

    return F.aggregate(items, zero, add)


def merged_columns(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(window, by..., column, n, nulls, min, max, mean, std, distinct, median)`` of all days that have parts.

    Distinct counts and medians come from sketches, the rest is exact. A window has as many
    parts as days, so they are put together one by one.
    """
    each = parts.select("window", *by, "day", F.explode("columns").alias("c")).select("window", *by, "day", "c.*")
    moments = F.struct("day", "n", F.coalesce("mean", F.lit(0.0)).alias("mean"), F.coalesce("m2", F.lit(0.0)).alias("m2"))
    merged = each.groupBy("window", *by, "column").agg(
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.array_sort(F.collect_list(moments)).alias("_parts"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"),
        F.kll_merge_agg_double("ranks").alias("_ranks"),
    )
    some = F.col("n") > 0
    found = merged.withColumn("_all", _moments(F.col("_parts")))
    return found.select(
        "window",
        *by,
        "column",
        "n",
        "nulls",
        "min",
        "max",
        F.when(some, F.col("_all.mean")).alias("mean"),
        F.when(F.col("n") > 1, F.sqrt(F.col("_all.m2") / (F.col("n") - 1))).alias("std"),
        "distinct",
        F.when(some, F.kll_sketch_get_quantile_double("_ranks", F.lit(0.5))).alias("median"),
    )
