"""From a raw table to prepared and split tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.contract import Contract, ContractViolation, check_present_after, check_required, check_types
from tabwright.functions.dates import booking_date, normalize_date
from tabwright.operators.checks import check_all, empty_count, enforce, malformed_count, null_counts, observing, refuse, violations
from tabwright.operators.split import exact_split, hash_split
from tabwright.operators.transform import TARGET_CODES, cast, partition_by_predicate, recode_target, rename
from tabwright.session import materialize
from tabwright.sources.files import CORRUPT, read_csv
from tabwright.sources.tables import append_stamped, mark_for_change_capture


@dataclass(frozen=True)
class DateParts:
    """Aliases of the date columns of a booking."""

    year: str = "arrival_year"
    month: str = "arrival_month"
    day: str = "arrival_date"
    lead: str = "lead_time"
    arrival: str = "date_of_arrival"
    booking: str = "date_of_booking"


@dataclass(frozen=True)
class Prepared:
    """A frame that went through :func:`prepare`; splitting asks for one."""

    df: DataFrame
    contract: Contract


def check_processed(state: Any) -> Prepared:
    """The prepared state, or an error for anything else."""
    if not isinstance(state, Prepared):
        raise ContractViolation("data must be prepared before splitting")
    return state


def check_unprocessed(state: Any) -> DataFrame:
    """A raw frame, or an error when it was prepared already."""
    if isinstance(state, Prepared):
        raise ContractViolation("profiles are fitted on raw data, not on prepared data")
    return state


def prepare(
    df: DataFrame,
    contract: Contract,
    dates: DateParts | None = DateParts(),
    codes: Mapping[str, int] | None = TARGET_CODES,
    strict: bool = True,
    check: bool = True,
) -> Prepared:
    """Check, rename, recode, convert and add the dates, as one projection of the input.

    With ``check`` one aggregate pass looks for nulls in any column and for an
    empty result, and raises.
    """
    check_required(df, contract)
    out = rename(df, contract)
    if codes:
        out = recode_target(out, contract.target.alias, codes, strict)
    out = check_types(cast(out, contract), contract)
    if dates:
        arrival = normalize_date(F.col(dates.year), F.col(dates.month), F.col(dates.day))
        out = out.withColumn(dates.arrival, arrival)
        out = out.withColumn(dates.booking, booking_date(F.col(dates.arrival), F.col(dates.lead)))
    out = check_present_after(check_types(cast(out, contract), contract), contract)
    if check:
        enforce(check_all(out))
    return Prepared(out, contract)


def split(
    state: Prepared, key: str, test: float = 0.2, seed: int = 42, exact: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` of prepared data."""
    method = exact_split if exact else hash_split
    return method(check_processed(state).df, [key], test, seed)


def ingest(
    spark: SparkSession,
    path: str,
    contract: Contract,
    tables: Mapping[str, str],
    key: str,
    segment: tuple[str, str] | None = None,
    dates: DateParts | None = DateParts(),
    codes: Mapping[str, int] | None = TARGET_CODES,
    test: float = 0.2,
    seed: int = 42,
    ts: datetime | None = None,
    locations: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """CSV to ``train``, ``test`` and ``extra`` tables, marked for change capture.

    ``extra`` holds the rows outside the segment; without a segment all rows are split
    and there is no such table. The text is parsed and
    prepared once and checked in the pass that stores the result; the three writes work on
    that, and one timestamp stands for the whole run. A record that does not fit the header,
    a null in any column or an empty file stops the run before anything is
    written.
    """
    state = prepare(read_csv(spark, path, contract, typed=False), contract, dates, codes, check=False)
    checks = empty_count() + malformed_count(CORRUPT) + null_counts(state.df.drop(CORRUPT))
    counted, seen = observing(state.df, checks)
    clean = materialize(counted, "prepared").drop(CORRUPT)
    refuse(violations(seen, checks))
    wanted, extra = partition_by_predicate(clean, F.col(segment[0]) == segment[1]) if segment else (clean, None)
    train, held_out = split(Prepared(wanted, contract), key, test, seed)
    ts = ts or datetime.now(timezone.utc)
    parts = {"train": train, "test": held_out} | ({"extra": extra} if segment else {})
    for name, part in parts.items():
        append_stamped(part, tables[name], ts, (locations or {}).get(name))
    saved = {name: tables[name] for name in parts}
    mark_for_change_capture(spark, saved.values())
    return saved
