"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def normalize_date(year: Column, month: Column, day: Column) -> Column:
    """A valid date from parts that may be out of range.

    Parts past their end move on to the first day of the next month (month 13
    is January of the next year); parts before their start move up to it. Years
    before 1 give 0001-01-01. Anything past the year 9999 is null.
    """
    y, m, d = (part.cast("int") for part in (year, month, day))
    first = F.make_date(y, m, F.lit(1))
    moved = (
        F.when(y < 1, F.make_date(F.lit(1), F.lit(1), F.lit(1)))
        .when(y > 9999, F.lit(None).cast("date"))
        .when(m < 1, F.make_date(y, F.lit(1), F.lit(1)))
        .when(m > 12, F.make_date(y + 1, F.lit(1), F.lit(1)))
        .when(d < 1, first)
        .when(d > F.dayofmonth(F.last_day(first)), F.add_months(first, 1))
        .otherwise(F.make_date(y, m, d))
    )
    return F.when(y.isNotNull() & m.isNotNull() & d.isNotNull() & (F.year(moved) <= 9999), moved)


def booking_date(arrival: Column, lead_days: Column) -> Column:
    """Arrival minus the lead time in days."""
    return F.date_sub(arrival.cast("date"), lead_days.cast("int"))


def lead_time(arrival: Column, booking: Column) -> Column:
    """Whole days from booking to arrival; negative when booked after arrival."""
    return F.datediff(arrival.cast("date"), booking.cast("date"))


def event_time(epoch_ms: Column, exact: bool = False) -> Column:
    """Timestamp of an epoch in milliseconds, whole seconds unless ``exact``."""
    if exact:
        return F.timestamp_millis(epoch_ms.cast("bigint"))
    return F.timestamp_seconds(F.floor(epoch_ms / 1000).cast("bigint"))


def register_lead_time(spark: SparkSession, name: str = "calculate_lead_time") -> str:
    """Make the lead time callable from SQL, as a SQL function without Python."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(date_of_arrival DATE, date_of_booking DATE) "
        "RETURNS INT RETURN datediff(date_of_arrival, date_of_booking)"
    )
    return name
