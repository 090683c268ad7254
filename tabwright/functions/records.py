"""Rows as JSON records and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How dates and times are written as text in records.
JSON_OPTIONS = {
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "ignoreNullFields": "false",
}


def to_record(columns: Sequence[str | Column]) -> Column:
    """One row as a JSON object, dates as text and nulls kept."""
    return F.to_json(F.struct(*columns), JSON_OPTIONS)


def from_record(text: Column, schema: T.StructType) -> Column:
    """The struct written by :func:`to_record`."""
    return F.from_json(text, schema, JSON_OPTIONS)
