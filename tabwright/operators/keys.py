"""Keyed rows: the newest row per key, key checks and joins that stand hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.session import broadcast_limit, materialize, planned_bytes

HOT_SHARE = 0.001
SALTS = 64
_SALT = "_salt"


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the newest by ``order`` (nulls oldest).

    Each task keeps one row per key before the shuffle, so a key with very
    many rows costs no more than others. ``order`` should name enough columns
    to leave no ties between different rows.
    """
    newest = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row")
    return df.groupBy(*key).agg(newest).select("_row.*")


def check_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Violations of a declared key: ``(check, column, violations)``.

    ``key_not_null`` counts rows with a null key part, ``key_unique`` the keys
    that occur more than once.
    """
    name = ",".join(key)
    has_null = _any_null(key)
    counts = df.groupBy(*key).agg(F.count("*").alias("n"))
    totals = counts.agg(
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).cast("bigint").alias("nulls"),
        F.count_if((F.col("n") > 1) & ~has_null).alias("repeats"),
    )
    return totals.select(
        F.inline(
            F.array(
                F.struct(F.lit("key_not_null").alias("check"), F.lit(name).alias("column"), F.col("nulls").alias("violations")),
                F.struct(F.lit("key_unique").alias("check"), F.lit(name).alias("column"), F.col("repeats").alias("violations")),
            )
        )
    )


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with how often."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def _any_null(key: Sequence[str]) -> Column:
    condition = F.lit(False)
    for name in key:
        condition = condition | F.col(name).isNull()
    return condition


def hot_keys(df: DataFrame, key: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows.

    At most ``1 / share`` keys can, so the list is bounded. The counts come from
    a mergeable sketch, one narrow pass without a shuffle. They only decide how
    work is spread; a key listed by mistake costs a little, never a row.
    """
    tracked = max(10, int(2 / share))
    found = (
        df.select(_key_hash(key).alias("h"))
        .agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h, {int(1 / share)}, {max(tracked, 10000)})").alias("top"))
        .first()
    )
    return sorted(item["item"] for item in found["top"] or () if item["count"] >= share * found["n"])


def _key_hash(key: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in key])


def hashable(kind: T.DataType) -> bool:
    """Whether ``xxhash64`` takes the type: no map and no variant at any depth."""
    if isinstance(kind, T.UserDefinedType):
        return hashable(kind.sqlType())
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def content_hash(fields: Sequence[T.StructField]) -> Column:
    """A hash of a row; values that Spark cannot hash count by their text."""
    return F.xxhash64(*[F.col(f"`{f.name}`") if hashable(f.dataType) else F.to_json(F.struct(f"`{f.name}`")) for f in fields])


def keyed_join(left: DataFrame, right: DataFrame, key: Sequence[str], how: str = "left", **options) -> DataFrame:
    """Join ``left`` to ``right``, which has at most one row per key; see :func:`keyed_joins`."""
    return keyed_joins(left, [(right, how)], key, **options)


def keyed_joins(
    left: DataFrame,
    rights: Sequence[tuple[DataFrame, str]],
    key: Sequence[str],
    skew: str = "auto",
    salts: int = SALTS,
) -> DataFrame:
    """Join several frames, each with at most one row per key, shuffling ``left`` once.

    With ``skew="auto"`` right sides the optimizer will broadcast are joined as
    they are. For others the rows of hot left keys are spread over ``salts``
    tasks and only the right rows of those keys are repeated; all joins share
    that layout. ``skew="off"`` leaves everything to adaptive execution,
    ``skew="salt"`` always looks for hot keys.

    Where a row goes depends on its content alone, so a task that is run again
    after a loss sends every row where it went before.
    """
    key = list(key)
    shuffled = []
    limit = broadcast_limit(left.sparkSession)
    for right, how in rights:
        if skew == "off" or left.isStreaming or (skew == "auto" and 0 <= planned_bytes(right) <= limit):
            left = left.join(right, key, how)
        else:
            shuffled.append((right, how))
    hot = hot_keys(left, key) if shuffled else []
    if not hot:
        for right, how in shuffled:
            left = left.join(right, key, how)
        return left
    is_hot = _key_hash(key).isin(*hot)
    content = [f.name for f in left.schema.fields if hashable(f.dataType)]
    if hot_keys(left.where(is_hot), content):
        # Many equal rows, which no hash of the row can separate: draw by position.
        # Positions in a written table are the same however often a task runs.
        left = materialize(left, "copies")
        spread = (F.rand(17) * salts).cast("int")
    else:
        spread = F.pmod(_key_hash(content), F.lit(salts)).cast("int")
    left = left.withColumn(_SALT, F.when(is_hot, spread).otherwise(F.lit(0)))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    for right, how in shuffled:
        left = left.join(right.withColumn(_SALT, F.explode(copies)), [*key, _SALT], how)
    return left.drop(_SALT)
