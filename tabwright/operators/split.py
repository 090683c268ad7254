"""Repeatable splits and samples."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.functions.hashing import HASH_DIGITS, hash_bound, key_hash, uniform
from tabwright.session import materialize

_STEP = 4  # digits per round: at most 65,536 ranges
_SMALL = 100_000
_COARSE = 3  # digits of the ranges that draws are dealt to


def hash_split(
    df: DataFrame, key: Sequence[str], test: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` by a hash of the key: no shuffle, same result on any layout.

    The test share is met on average. All rows of a key fall on one side.
    """
    hashed = key_hash([F.col(k) for k in key], seed)
    if test >= 1:
        return df.where(F.lit(False)), df
    return df.where(hashed >= hash_bound(test)), df.where(hashed < hash_bound(test))


def exact_split(
    df: DataFrame, key: Sequence[str], test: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` with exactly ``ceil(test * rows)`` test rows for a unique key.

    The cut is a hash value; finding it costs passes over the key alone and
    the split itself is then a filter without a shuffle. Rows that share a key
    stay together, so with repeated keys the test part is the smallest whole
    set of keys that reaches the count.
    """
    hashed = key_hash([F.col(k) for k in key], seed)
    cut = _cut_value(df.select(hashed.alias("h")), test)
    return df.where(hashed > cut), df.where(hashed <= cut)


def _cut_value(hashes: DataFrame, test: float) -> str:
    """The hash at rank ``ceil(test * rows)``, or a text before all hashes for no test rows.

    Each round counts rows per range of hashes (at most 65,536 ranges, counted
    before the shuffle) and goes on inside the range that holds the rank.
    """
    prefix, below, wanted = "", 0, None
    while len(prefix) < HASH_DIGITS:
        inside = hashes.where(F.col("h").startswith(prefix)) if prefix else hashes
        digits = min(len(prefix) + _STEP, HASH_DIGITS)
        ranges = inside.groupBy(F.substring("h", 1, digits).alias("r")).agg(F.count("*").alias("n"))
        counted = ranges.withColumns(
            {
                "upto": F.sum("n").over(Window.orderBy("r")) + below,
                "goal": F.ceil(F.sum("n").over(Window.partitionBy()) * test) if wanted is None else F.lit(wanted),
            }
        )
        found = counted.where("upto >= goal").orderBy("r").first()
        if found is None or found["goal"] == 0:
            return ""
        prefix, wanted = found["r"], found["goal"]
        below = found["upto"] - found["n"]
        if found["n"] <= _SMALL:
            break
    last = hashes.where(F.col("h").startswith(prefix)).groupBy("h").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy("h")) + below
    return last.withColumn("upto", upto).where(F.col("upto") >= wanted).agg(F.min("h")).first()[0]


def sample_with_replacement(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` independent draws; a row may be drawn more than once. An empty frame gives nothing.

    Rows are numbered by the hash of their key, and every draw is a number below their
    count, told by a hash: repeatable on any layout. Counts per range of hashes (at most
    4,096) tell how many draws each range gets; only ranges with draws are looked into,
    in parts of about a 16-millionth of all rows, so nothing is ordered in one task. The
    key should tell rows apart: those that share one are ordered together.
    """
    hashed = key_hash([F.col(k) for k in key], seed)
    coarse = F.substring("h", 1, _COARSE)
    hashes = df.select(hashed.alias("h"))
    counts = sorted((r["r"], r["n"]) for r in hashes.groupBy(coarse.alias("r")).agg(F.count("*").alias("n")).collect())
    rows = sum(c for _, c in counts)
    if not rows or n <= 0:
        return df.where(F.lit(False))
    starts = [0, *accumulate(c for _, c in counts)][:-1]
    draws = _drawn_ranges(df.sparkSession, n, rows, [r for r, _ in counts], starts, seed)
    draws = materialize(draws, "draws")  # decides what is read next
    asked = [r[0] for r in draws.select("r").distinct().collect()]  # at most 4,096

    inside = hashes.where(coarse.isin(asked)).groupBy("h").agg(F.count("*").alias("c"))
    inside = inside.select(coarse.alias("r"), F.substring("h", 1, 2 * _COARSE).alias("s"), "h", "c")
    per_part = inside.groupBy("r", "s").agg(F.sum("c").alias("c"))
    parts = per_part.withColumn("start", F.sum("c").over(Window.partitionBy("r").orderBy("s")) - F.col("c"))
    in_part = _at_or_below(draws, parts, ["r"], "s")
    order = Window.partitionBy("s").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    firsts = inside.select("s", "h", (F.sum("c").over(order) - F.col("c")).alias("start"))
    picks = _at_or_below(in_part.select("s", "k", "times"), firsts, ["s"], "h").select("h", "k", "times")
    picks = materialize(picks, "picks")

    found = df.withColumn("_h", hashed).where(F.substring("_h", 1, _COARSE).isin(asked))
    found = found.join(picks.select(F.col("h").alias("_h")).distinct(), "_h", "left_semi")
    found = found.withColumn("_k", (F.row_number().over(Window.partitionBy("_h").orderBy(*key)) - 1).cast("bigint"))
    found = found.join(picks.withColumnsRenamed({"h": "_h", "k": "_k", "times": "_times"}), ["_h", "_k"])
    return found.withColumn("_each", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*[f"`{c}`" for c in df.columns])


def _drawn_ranges(spark: SparkSession, n: int, rows: int, names: list[str], starts: list[int], seed: int) -> DataFrame:
    """``(r, k, times)``: how often the row at place ``k`` of the range ``r`` of hashes is drawn."""
    rank = F.floor(uniform([F.col("id"), F.lit("draw")], seed) * F.lit(float(rows))).cast("bigint")
    draws = spark.range(n).select(F.least(rank, F.lit(rows - 1)).alias("rank"), F.lit(0).alias("i"))
    known = F.lit(starts)
    step = 1 << (len(starts) - 1).bit_length()
    while step := step // 2:  # the last range that starts at or below the rank
        ahead = F.get(known, F.col("i") + step)
        draws = draws.withColumn("i", F.col("i") + F.when(ahead <= F.col("rank"), step).otherwise(0))
    placed = draws.select(F.get(F.lit(names), F.col("i")).alias("r"), (F.col("rank") - F.get(known, F.col("i"))).alias("k"))
    return placed.groupBy("r", "k").agg(F.count("*").alias("times"))


def _at_or_below(draws: DataFrame, starts: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``draws`` with the ``name`` that starts last at or below their place in the group, and the place counted from there."""
    none = F.lit(None)
    marks = starts.select(*by, F.col("start").alias("k"), none.cast("bigint").alias("times"), F.struct(name, "start").alias("at"))
    asked = draws.select(*by, "k", "times", none.cast(marks.schema["at"].dataType).alias("at"))
    order = Window.partitionBy(*by).orderBy("k", F.col("times").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    filled = marks.unionByName(asked).withColumn("at", F.last("at", True).over(order)).where("times IS NOT NULL")
    return filled.select(*by, F.col(f"at.{name}").alias(name), (F.col("k") - F.col("at.start")).alias("k"), "times")


def evaluation_sample(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest key hashes: a repeatable sample of fixed size."""
    columns = [F.col(k) for k in key]
    return df.orderBy(key_hash(columns, seed), *columns).limit(n)
