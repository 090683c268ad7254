"""Value corrections and type conversion as single expressions."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_WHOLE = r"^\s*[+-]?[0-9]{1,19}\s*$"


def resolve_chain(corrections: Mapping[Any, Any]) -> dict[Any, Any]:
    """What each value ends up as when the corrections are applied one by one.

    ``{1: 2, 2: 3}`` sends 1 to 3, while ``{2: 3, 1: 2}`` leaves it at 2.
    """
    ends: dict[Any, Any] = {}
    for start in corrections:
        value = start
        for old, new in corrections.items():
            if value == old:
                value = new
        ends[start] = value
    return ends


def corrected(
    column: Column, corrections: Mapping[Any, Any], strict: bool = False, name: str = "column", kind: T.DataType | None = None
) -> Column:
    """The column with values replaced; others stay, or fail the job if strict.

    A correction to null gives null. ``kind`` is the column's type: values to replace are
    compared in it, and on text the new ones become text unless every value is mapped.
    One lookup table serves any number of corrections.
    """
    ends = resolve_chain(corrections)
    if not ends:
        return column
    text = isinstance(kind, T.StringType) or (kind is None and any(isinstance(old, str) for old in ends))
    if text:
        ends = {str(old): new for old, new in ends.items()}
    if strict:
        unknown = F.raise_error(F.concat(F.lit(f"unmapped value in {name}: "), column.cast("string")))
        rest = F.when(column.isNotNull(), unknown)
    else:
        rest = column
        if text:  # text stays text when some of it may remain
            ends = {old: None if new is None else str(new) for old, new in ends.items()}
    olds = [F.lit(old) if kind is None else F.lit(old).cast(kind.simpleString()) for old in ends]
    table = F.create_map(*[part for old, new in zip(olds, ends.values(), strict=True) for part in (old, F.lit(new))])
    known = F.coalesce(F.map_contains_key(table, column), F.lit(False))
    return F.when(known, F.try_element_at(table, column)).otherwise(rest)


def converted(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Conversion that truncates fractions and turns what does not fit into null.

    Ranges are compared before casting: a failing ``try_cast`` raises and
    catches an error per row, which is many times slower.
    """
    if source == target:
        return column
    name = target.simpleString()
    if type(target) not in _BITS:
        return column.try_cast(name)
    if isinstance(source, T.StringType):
        # "3" and "3.0" both mean 3; only whole numbers of 64 bits need more than a double
        number = converted(column.try_cast("double"), T.DoubleType(), target)
        if not isinstance(target, T.LongType):
            return number
        return F.when(column.rlike(_WHOLE), column.try_cast("bigint")).otherwise(number)
    if isinstance(source, (T.DoubleType, T.FloatType)):
        end = float(1 << (_BITS[type(target)] - 1))
        above = column >= -end if isinstance(target, T.LongType) else column > -end - 1
        return F.when(above & (column < end), column.cast(name))
    if type(source) in _BITS:
        if _BITS[type(source)] <= _BITS[type(target)]:
            return column.cast(name)
        end = 1 << (_BITS[type(target)] - 1)
        return F.when(column.between(-end, end - 1), column.cast(name))
    return column.try_cast(name)
