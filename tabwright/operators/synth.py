"""Synthetic rows from a fitted profile.

Every draw is a hash of (row, column, seed): a lost task recomputes the very
same rows, and the result does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.contract import Contract, check_required, check_types
from tabwright.functions.hashing import standard_normal, uniform
from tabwright.operators.profile import numeric_profile
from tabwright.operators.transform import cast, drop_nulls, rename, rename_back, reorder, segment_filter
from tabwright.session import materialize

INLINE = 256  # categories kept in the expression itself
ROW = "_row"


@dataclass(frozen=True)
class Profile:
    """What synthetic rows are drawn from.

    ``numeric`` is ``(column, n, mean, std)``; ``categorical`` is
    ``(column, value, n, low, high, total)``, where a value owns the positions
    from ``low`` up to ``high`` among ``total``.
    """

    numeric: DataFrame
    categorical: DataFrame


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts per value and the positions each value owns, all columns in one shuffle.

    Values are ordered by the first two digits of their digest and then by
    themselves. That order gives 256 groups that are summed up separately, so
    a column with very many values is not handled by one task.
    """
    counts = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .where("value is not null")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("part", F.substring(F.md5("value"), 1, 2))
    )
    parts = counts.groupBy("column", "part").agg(F.sum("n").alias("size"))
    whole = Window.partitionBy("column")
    upto = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    offsets = parts.select(
        "column",
        "part",
        (F.sum("size").over(upto) - F.col("size")).alias("offset"),
        F.sum("size").over(whole).alias("total"),
    )
    inside = Window.partitionBy("column", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    # at most 256 offsets per named column
    placed = counts.join(F.broadcast(offsets), ["column", "part"]).withColumn(
        "high", F.col("offset") + F.sum("n").over(inside)
    )
    return placed.select("column", "value", "n", (F.col("high") - F.col("n")).alias("low"), "high", "total")


def with_share(categorical: DataFrame) -> DataFrame:
    """``(column, value, n, share)`` of a categorical profile."""
    return categorical.select("column", "value", "n", (F.col("n") / F.col("total")).alias("share"))


def fit_profile(
    df: DataFrame,
    contract: Contract,
    segment: tuple[str, str] | None = None,
    key: str | None = None,
    numeric_from_all: bool = False,
) -> Profile:
    """Fit on rows without nulls, of one segment if given.

    ``numeric_from_all`` takes means and deviations from the unfiltered rows.
    """
    check_required(df, contract)
    everything = cast(rename(df, contract), contract)
    clean = cast(rename(drop_nulls(df), contract), contract)
    if segment:
        clean = segment_filter(clean, *segment)
    numeric = [c.alias for c in contract.numeric]
    labels = [c.alias for c in (*contract.categorical, contract.target) if c.alias != key]
    return Profile(
        numeric_profile(everything if numeric_from_all else clean, numeric), categorical_profile(clean, labels)
    )


def rows(spark: SparkSession, n: int) -> DataFrame:
    """``n`` numbered rows."""
    return spark.range(n).withColumnRenamed("id", ROW)


def gen_numeric(mean: float, std: float, name: str, seed: int = 42) -> Column:
    """``round(abs(N(mean, std)), 2)``."""
    drawn = standard_normal([F.col(ROW)], f"{name}|{seed}") * F.lit(float(std)) + F.lit(float(mean))
    return F.round(F.abs(drawn), 2)


def gen_key(seed: int = 42) -> Column:
    """A distinct text per row."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(ROW).cast("string")))


def position(total: Column, name: str, seed: int) -> Column:
    """A uniform position among ``total``."""
    return F.least(F.floor(uniform([F.col(ROW)], f"{name}|{seed}") * total), total - 1)


def gen_categorical(df: DataFrame, categorical: DataFrame, columns: Sequence[str], seed: int = 42) -> DataFrame:
    """Add columns whose values are drawn independently by their share.

    Columns with few values are looked up in a list inside the expression;
    others by a join, see :func:`_draw_by_join`.
    """
    stored = materialize(categorical, "categories")
    sizes = {
        r["column"]: (r["values"], r["total"])
        for r in stored.groupBy("column").agg(F.count("*").alias("values"), F.max("total").alias("total")).collect()
    }
    few = [c for c in columns if c in sizes and sizes[c][0] <= INLINE]
    lists: dict[str, list] = {c: [] for c in few}
    if few:
        for r in stored.where(F.col("column").isin(*few)).orderBy("column", "low").collect():
            lists[r["column"]].append(r)
    for c in columns:
        if c not in sizes:
            df = df.withColumn(c, F.lit(None).cast("string"))
        elif c in lists:
            ends = F.array(*[F.lit(r["high"]) for r in lists[c]])
            values = F.array(*[F.lit(r["value"]) for r in lists[c]])
            at = position(F.lit(sizes[c][1]), c, seed)
            df = df.withColumn("_at", at).withColumn(
                c, F.get(values, F.size(F.filter(ends, lambda e: e <= F.col("_at"))))
            ).drop("_at")
        else:
            df = _draw_by_join(df, stored.where(F.col("column") == c), c, sizes[c], seed)
    return df


def _draw_by_join(df: DataFrame, owned: DataFrame, name: str, size: tuple[int, int], seed: int) -> DataFrame:
    """Draw from a column with many values.

    The positions are cut into as many equal slots as there are values. A
    value is listed in every slot it reaches into and a draw looks only into
    its own slot, so a frequent value is spread over many slots.
    """
    values, total = size
    width = max(total // values, 1)
    slots = F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))
    listed = owned.select(F.col("value").alias(name), "low", "high", F.explode(slots).alias("_slot"))
    drawn = df.withColumn("_at", position(F.lit(total), name, seed)).withColumn(
        "_slot", F.floor(F.col("_at") / width)
    )
    hit = (drawn["_slot"] == listed["_slot"]) & (listed["low"] <= drawn["_at"]) & (drawn["_at"] < listed["high"])
    return drawn.join(listed, hit).select(*df.columns, name)


def synthesize(
    df: DataFrame,
    contract: Contract,
    n: int,
    key: str | None = None,
    segment: tuple[str, str] | None = None,
    seed: int = 42,
    numeric_from_all: bool = False,
) -> DataFrame:
    """``n`` rows like those of ``df``, which must not have been prepared yet.

    Same columns under their source names and in the same order.
    """
    profile = fit_profile(df, contract, segment, key, numeric_from_all)
    return generate(df.sparkSession, profile, contract, n, df.columns, key, seed)


def generate(
    spark: SparkSession,
    profile: Profile,
    contract: Contract,
    n: int,
    order: Sequence[str],
    key: str | None = None,
    seed: int = 42,
) -> DataFrame:
    """Rows from a fitted profile; only its means and deviations pass through the driver."""
    moments = {r["column"]: r for r in profile.numeric.collect()}
    made = rows(spark, n)
    made = made.withColumns(
        {
            c.alias: gen_numeric(moments[c.alias]["mean"] or 0.0, moments[c.alias]["std"] or 0.0, c.alias, seed)
            for c in contract.numeric
        }
    )
    if key:
        made = made.withColumn(key, gen_key(seed))
    labels = [c.alias for c in (*contract.categorical, contract.target) if c.alias != key]
    made = cast(gen_categorical(made, profile.categorical, labels, seed).drop(ROW), contract)
    return reorder(rename_back(check_types(made, contract), contract), order)
