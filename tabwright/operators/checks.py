"""Data checks. Each family is one aggregate pass giving ``(check, column, violations)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.contract import Contract, ContractViolation
from tabwright.functions.values import converted
from tabwright.session import observed

EMPTY = "not_empty"


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def report(df: DataFrame, counts: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Evaluate ``(check, column, aggregate)`` entries in one pass, one row each."""
    aliases = [f"c{i}" for i in range(len(counts))]
    totals = df.agg(*[F.coalesce(agg, F.lit(0)).cast("bigint").alias(a) for (_, _, agg), a in zip(counts, aliases)])
    rows = [
        F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(a).alias("violations"))
        for (check, column, _), a in zip(counts, aliases)
    ]
    return totals.select(F.inline(F.array(*rows)))


Counts = Sequence[tuple[str, str, Column]]


def observing(df: DataFrame, counts: Counts) -> tuple[DataFrame, Observation]:
    """``df`` with checks that are counted in the pass that writes it, not in one of their own."""
    seen = Observation()
    return df.observe(seen, *[agg.alias(f"c{i}") for i, (_, _, agg) in enumerate(counts)]), seen


def violations(seen: Observation, counts: Counts) -> list[tuple[str, str, int]]:
    """``(check, column, violations)`` of a frame that was written."""
    found = observed(seen)
    if not found:  # no rows at all
        return [(check, column, int(check == EMPTY)) for check, column, _ in counts]
    return [(check, column, found[f"c{i}"] or 0) for i, (check, column, _) in enumerate(counts)]


def null_counts(df: DataFrame) -> list[tuple[str, str, Column]]:
    """Nulls per column, of every column whether in a contract or not."""
    return [("not_null", c, F.count_if(_quoted(c).isNull())) for c in df.columns]


def empty_count() -> list[tuple[str, str, Column]]:
    """One violation when there are no rows."""
    return [(EMPTY, "*", F.when(F.count(F.lit(1)) == 0, 1).otherwise(0))]


def malformed_count(column: str) -> list[tuple[str, str, Column]]:
    """Records whose text was kept because they did not fit the read schema."""
    return [("well_formed", column, F.count(_quoted(column)))]


def loss_counts(df: DataFrame, types: Mapping[str, T.DataType]) -> list[tuple[str, str, Column]]:
    """Values per column that a conversion would turn into null."""
    source = {f.name: f.dataType for f in df.schema.fields}
    return [
        (
            "cast",
            name,
            F.count_if(_quoted(name).isNotNull() & converted(_quoted(name), source[name], target).isNull()),
        )
        for name, target in types.items()
    ]


def check_nulls(df: DataFrame) -> DataFrame:
    """Nulls of every column."""
    return report(df, null_counts(df))


def check_not_empty(df: DataFrame) -> DataFrame:
    """Whether there are rows at all."""
    return report(df, empty_count())


def cast_losses(df: DataFrame, types: Mapping[str, T.DataType] | Contract) -> DataFrame:
    """Values lost by converting columns to the given or declared types."""
    if isinstance(types, Contract):
        types = {c.alias: c.spark_type for c in types.columns if c.dtype != "category"}
    return report(df, loss_counts(df, types))


def check_all(df: DataFrame) -> DataFrame:
    """Emptiness and nulls in the same pass."""
    return report(df, empty_count() + null_counts(df))


def enforce(found: DataFrame) -> None:
    """Raise when a report counts any violation; a report has one row per check and column."""
    refuse([(r["check"], r["column"], r["violations"]) for r in found.where("violations > 0").collect()])


def refuse(found: Sequence[tuple[str, str, int]]) -> None:
    """Raise when any of the counts is over zero."""
    broken = [f"{check} {column}: {n} violation(s)" for check, column, n in found if n > 0]
    if broken:
        raise ContractViolation("; ".join(broken))
