"""Renaming, conversion, correction and selection of columns; filters and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.contract import Contract
from tabwright.functions.records import from_record, to_record
from tabwright.functions.values import converted, corrected

_NARROW = (T.ByteType, T.ShortType, T.IntegerType)  # every value has an exact double
# Codes of the booking status.
TARGET_CODES = {"Canceled": 1, "Not_Canceled": 0}


def rename(df: DataFrame, contract: Contract) -> DataFrame:
    """Source names to aliases."""
    return df.withColumnsRenamed({c.name: c.alias for c in contract.columns if c.name != c.alias})


def rename_back(df: DataFrame, contract: Contract) -> DataFrame:
    """Aliases to source names."""
    return df.withColumnsRenamed({c.alias: c.name for c in contract.columns if c.name != c.alias})


def cast(df: DataFrame, contract: Contract) -> DataFrame:
    """Convert to the declared types without a shuffle; a category keeps an integer code.

    Text for narrow integers becomes a double in a projection of its own, so
    that it is parsed once however often the range checks look at it.
    """
    declared = {c.alias: c for c in contract.columns}
    parsed = {
        f.name: F.col(f"`{f.name}`").try_cast("double")
        for f in df.schema.fields
        if f.name in declared and isinstance(f.dataType, T.StringType) and isinstance(declared[f.name].spark_type, _NARROW)
    }
    if parsed:
        df = df.select(*[parsed[c].alias(c) if c in parsed else F.col(f"`{c}`") for c in df.columns])
    fields = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        wanted = declared.get(f.name)
        if wanted is None or wanted.accepts(f.dataType):
            fields.append(column)
        else:
            fields.append(converted(column, f.dataType, wanted.spark_type).alias(f.name))
    return df.select(*fields)


def correct_values(df: DataFrame, corrections: Mapping[str, Mapping[Any, Any]], strict: bool = False) -> DataFrame:
    """Replace values per column, as if the corrections were applied one after another."""
    return df.withColumns(
        {c: corrected(F.col(f"`{c}`"), changes, strict, c, df.schema[c].dataType) for c, changes in corrections.items()}
    )


def recode_target(
    df: DataFrame, target: str, codes: Mapping[str, int] = TARGET_CODES, strict: bool = True
) -> DataFrame:
    """Target labels to integer codes; an unknown label fails the job unless lenient."""
    return correct_values(df, {target: codes}, strict)


def select_features(df: DataFrame, contract: Contract, extra: Sequence[str] = ()) -> DataFrame:
    """Modelling columns, target and extra columns such as keys and dates."""
    return df.select(*dict.fromkeys([*contract.features, contract.target.alias, *extra]))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without the named columns; names that are not there are ignored."""
    return df.drop(*columns)


def reorder(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns, in this order."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def split_xy(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Features and label as two projections of one frame."""
    return df.drop(target), df.select(target)


def cast_prediction(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Predictions and labels as integers."""
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


def to_records_json(df: DataFrame, column: str = "record") -> DataFrame:
    """Each row as one JSON object."""
    return df.select(to_record(df.columns).alias(column))


def from_records_json(df: DataFrame, schema, column: str = "record") -> DataFrame:
    """Rows from JSON objects."""
    return df.select(from_record(F.col(column), schema).alias("_r")).select("_r.*")


def partition_by_predicate(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that match, and all others; an unknown condition counts as no match."""
    return df.where(condition), df.where(~F.coalesce(condition, F.lit(False)))


def segment_filter(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Rows of one segment."""
    return df.where(F.col(column) == F.lit(value))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without nulls, in all columns or a subset."""
    return df.dropna(subset=list(subset) if subset else None)


def latest_batch(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value in ``column`` is the greatest one."""
    newest = df.agg(F.max(column)).scalar()
    return df.where(F.col(column) == newest)


def limit(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in a stated order; only ``n`` rows per task are kept."""
    return df.orderBy(*order).limit(n)


def combine(*frames: DataFrame) -> DataFrame:
    """All rows of frames with the same column names, repeats kept."""
    return reduce(DataFrame.unionByName, frames)


def preview(df: DataFrame, n: int, order: Sequence[str | Column]) -> list:
    """The first rows in a stated order, for logs only."""
    return limit(df, n, order).collect()


def tag_model(df: DataFrame, name: str) -> DataFrame:
    """Add the name of the model that scored the rows."""
    return df.withColumn("model_name", F.lit(name))


def flatten_record(df: DataFrame, column: str) -> DataFrame:
    """Fields of a struct column as columns of their own."""
    return df.select(*[c for c in df.columns if c != column], f"{column}.*")
