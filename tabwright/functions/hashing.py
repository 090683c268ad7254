"""Hash-based draws: the same row gets the same draw on any cluster layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 15


def _digest(keys: Sequence[Column], seed: int | str) -> Column:
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed))))


def key_hash(keys: Sequence[Column], seed: int | str) -> Column:
    """Fifteen hex digits, uniform over distinct keys; their text order is their numeric order."""
    return F.substring(_digest(keys, seed), 1, HASH_DIGITS)


def hash_bound(share: float) -> str:
    """The hash below which a share of all keys lies."""
    return format(min(int(share * 16**HASH_DIGITS), 16**HASH_DIGITS - 1), f"0{HASH_DIGITS}x")


def _number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("double")


def uniform(keys: Sequence[Column], seed: int | str) -> Column:
    """A draw from [0, 1) with 52 bits."""
    return _number(F.substring(_digest(keys, seed), 1, 13)) / F.lit(float(1 << 52))


def standard_normal(keys: Sequence[Column], seed: int | str) -> Column:
    """A draw from N(0, 1) by Box-Muller; both uniforms come from one digest."""
    digest = _digest(keys, seed)
    u = (_number(F.substring(digest, 1, 13)) + 1) / F.lit(float(1 << 52))
    v = _number(F.substring(digest, 14, 13)) / F.lit(float(1 << 52))
    return F.sqrt(F.lit(-2.0) * F.ln(u)) * F.cos(F.lit(2.0) * F.pi() * v)
