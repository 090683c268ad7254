"""Drift of a current frame against a baseline, all columns together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.metrics import share
from tabwright.session import materialize

# Fixed value: the least share used by the stability index.
SHARE_FLOOR = 1e-6


def _tagged(baseline: DataFrame, current: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """``(column, value, is_current)`` of both frames."""

    def long(df: DataFrame, side: bool) -> DataFrame:
        typed = df.select(*[F.col(c).cast(kind).alias(c) for c in columns])
        values = typed.unpivot([], list(columns), "column", "value").where("value is not null")
        return values.withColumn("is_current", F.lit(side))

    return long(baseline, False).unionByName(long(current, True))


def _sides() -> tuple[Column, Column]:
    return F.count_if(~F.col("is_current")).alias("p"), F.count_if("is_current").alias("q")


def histogram(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, p, q, r, upto_p, upto_q)``: how often each value comes on both sides.

    Every side is scanned once. Values are counted first, so a frequent one is one row,
    then dealt to ranges ``r`` in the order of column and value; ``upto_*`` are running
    counts within a range. The result is written once, all statistics are read from it.
    """
    counted = _tagged(baseline, current, columns, "double").groupBy("column", "value").agg(*_sides())
    ranged = counted.repartitionByRange("column", "value").withColumn("r", F.spark_partition_id())
    order = Window.partitionBy("column", "r").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return materialize(
        ranged.withColumns({f"upto_{side}": F.sum(side).over(order) for side in ("p", "q")}), "histogram"
    )


def _placed(hist: DataFrame) -> DataFrame:
    """``(column, value, p, q, at_p, at_q, np, nq)``: counts up to each value and in all.

    Totals are one row per range and column, so adding up those before a range is small work.
    """
    totals = hist.groupBy("column", "r").agg(*[F.max(f"upto_{side}").alias(f"in_{side}") for side in ("p", "q")])
    whole = Window.partitionBy("column")
    earlier = whole.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "column", "r",
        *[F.coalesce(F.sum(f"in_{side}").over(earlier), F.lit(0)).alias(f"before_{side}") for side in ("p", "q")],
        *[F.sum(f"in_{side}").over(whole).alias(f"n{side}") for side in ("p", "q")],
    )
    at = [(F.col(f"before_{side}") + F.col(f"upto_{side}")).alias(f"at_{side}") for side in ("p", "q")]
    return hist.join(starts, ["column", "r"]).select("column", "value", "p", "q", *at, "np", "nq")


def _greatest_gap() -> Column:
    gap = share(F.col("at_p"), F.col("np")) - share(F.col("at_q"), F.col("nq"))
    return F.max(F.abs(gap)).alias("ks")


def ks_distance(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, ks)``: the greatest distance of both distribution functions."""
    return _placed(histogram(baseline, current, columns)).groupBy("column").agg(_greatest_gap())


def _edges(placed: DataFrame, bins: int) -> DataFrame:
    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("at_p") - F.col("p") <= rank) & (rank < F.col("at_p")), F.col("value")))

    def quantile(share_below: float) -> Column:
        position = F.lit(share_below) * (F.col("np") - 1)
        low, high = at(F.floor(position)), at(F.ceil(position))
        return low + F.max(position - F.floor(position)) * (high - low)

    known = placed.where("np > 0")
    return known.groupBy("column").agg(F.array(*[quantile(i / bins) for i in range(1, bins)]).alias("edges"))


def bin_edges(baseline: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """``(column, edges)``: inner edges at the baseline's exact, interpolated quantiles."""
    return _edges(_placed(histogram(baseline, baseline.limit(0), columns)), bins)


def numeric_drift(baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """``(column, ks, psi)`` of the columns with baseline values.

    ``psi`` is taken on bins whose inner edges are the baseline's quantiles; outer bins are
    open. Both come from one histogram. The edges, a few numbers per named column, become
    literals of the last pass; counts per bin are differences of counts up to the edges.
    """
    placed = _placed(histogram(baseline, current, columns))
    edges = {r["column"]: r["edges"] for r in _edges(placed, bins).collect()}
    if not edges:
        return _nothing(baseline, "column string, ks double, psi double")

    def upto(side: str, i: int) -> Column:
        edge = reduce(lambda found, c: found.when(F.col("column") == c, edges[c][i]), edges, F)
        return F.coalesce(F.max(F.when(F.col("value") <= edge, F.col(f"at_{side}"))), F.lit(0)).alias(f"{side}{i}")

    inner = range(bins - 1)
    counts = placed.where(F.col("column").isin(*edges)).groupBy("column").agg(
        _greatest_gap(), F.max("np").alias("np"), F.max("nq").alias("nq"), *[upto(side, i) for side in ("p", "q") for i in inner]
    )

    def in_bin(side: str, i: int) -> Column:
        high = F.col(f"{side}{i}") if i < bins - 1 else F.col(f"n{side}")
        count = high - F.col(f"{side}{i - 1}") if i else high
        return F.greatest(share(count, F.col(f"n{side}")), F.lit(SHARE_FLOOR))

    terms = [(in_bin("q", i) - in_bin("p", i)) * F.ln(in_bin("q", i) / in_bin("p", i)) for i in range(bins)]
    return counts.select("column", "ks", reduce(add, terms).alias("psi"))


def stability_index(baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """``(column, psi)``, see :func:`numeric_drift`."""
    return numeric_drift(baseline, current, columns, bins).select("column", "psi")


def _nothing(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def categorical_drift(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, chi_square, total_variation, js_distance)`` over the union of values."""
    counts = _tagged(baseline, current, columns, "string").groupBy("column", "value").agg(*_sides())
    sizes = counts.groupBy("column").agg(F.sum("p").alias("np"), F.sum("q").alias("nq"))
    cells = counts.join(F.broadcast(sizes), "column")  # one row per named column
    p, q = share(F.col("p"), F.col("np")), share(F.col("q"), F.col("nq"))
    middle = (p + q) / 2
    expected = lambda n: F.col(n) * (F.col("p") + F.col("q")) / (F.col("np") + F.col("nq"))
    surplus = lambda c, n: (F.col(c) - expected(n)) * (F.col(c) - expected(n)) / expected(n)
    entropy = lambda s: F.when(s > 0, s * F.log2(s / middle)).otherwise(F.lit(0.0))
    return cells.groupBy("column").agg(
        F.sum(surplus("p", "np") + surplus("q", "nq")).alias("chi_square"),
        (F.sum(F.abs(p - q)) / 2).alias("total_variation"),
        F.sqrt(F.greatest(F.sum(entropy(p)) / 2 + F.sum(entropy(q)) / 2, F.lit(0.0))).alias("js_distance"),
    )
